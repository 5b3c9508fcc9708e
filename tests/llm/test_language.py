"""Language identification: n-grams and updates against plain Python, accuracy on held-out labels."""

import math
import zlib
from collections import Counter

import numpy as np

from riskloom.llm import language, queries


def plain_ngrams(text):
    """n-grams of the lower-cased text with what is no letter as a boundary."""
    marked = "".join(c if c.isalpha() else "\0" for c in f"\0{(text or '').lower()}\0")
    found = Counter()
    for n in (1, 2, 3):
        for i in range(len(marked) - n + 1):
            gram = marked[i : i + n]
            if gram != "\0" and "\0\0" not in gram:
                found[gram] += 1
    return found


def bucket_of(gram):
    code = sum((ord(c) + 1 if c != "\0" else 1) << 21 * k for k, c in enumerate(gram))
    return int(language.mixed(np.array([code], np.uint64))[0] % np.uint64(language.BUCKETS))


def test_ngrams_of_odd_texts(odd_docs):
    texts = [r.text for r in odd_docs.collect()] + ["\U0001f600\U00020000x", "İstanbul ß", "a\n\nb", "日本語"]
    text, bucket, count, has = language.ngrams(texts)
    got = [Counter() for _ in texts]
    for t, b, c in zip(text.tolist(), bucket.tolist(), count.tolist()):
        got[t][b] += c
    for t, g, h in zip(texts, got, has):
        expected = Counter()
        for gram, c in plain_ngrams(t).items():
            expected[bucket_of(gram)] += c
        assert g == expected, t
        assert h == any(c.isalpha() for c in (t or "").lower())


def test_updates_follow_the_leader():
    """Scalar follow-the-regularised-leader, one coordinate after the other."""
    rng = np.random.default_rng(3)
    z, n = np.zeros((language.BUCKETS + 1, 3)), np.zeros((language.BUCKETS + 1, 3))
    zs, ns = {}, {}
    for _ in range(200):
        buckets = np.sort(rng.choice(30, 6, replace=False))
        weights, label = rng.random(6), int(rng.integers(0, 3))
        language.learn(z, n, buckets, weights, label)
        w = {}
        for b in buckets:
            for c in range(3):
                s, m = zs.get((b, c), 0.0), ns.get((b, c), 0.0)
                w[b, c] = 0.0 if abs(s) <= language.L1 else -(s - math.copysign(language.L1, s)) / (
                    (language.SMOOTH + math.sqrt(m)) / language.RATE + language.L2)
        logits = [sum(x * w[b, c] for b, x in zip(buckets, weights)) for c in range(3)]
        total = sum(map(math.exp, logits))
        for b, x in zip(buckets, weights):
            for c in range(3):
                g = x * (math.exp(logits[c]) / total - (c == label))
                m = ns.get((b, c), 0.0)
                zs[b, c] = zs.get((b, c), 0.0) + g - (math.sqrt(m + g * g) - math.sqrt(m)) / language.RATE * w[b, c]
                ns[b, c] = m + g * g
    assert all(abs(z[k] - v) < 1e-9 for k, v in zs.items()) and all(abs(n[k] - v) < 1e-9 for k, v in ns.items())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op13_language_id(spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    langs = {d.lang for d in docs.values()}
    for r in rows:
        text = docs[r.doc_id].text
        assert (r.lang_pred == "und") == (text is None or not any(c.isalpha() for c in text))
        assert r.lang_pred in langs | {"und"} and 0 <= r.score <= 1
    test = [r for r in rows if r.held_out and r.lang_pred != "und" and docs[r.doc_id].lang is not None]
    hits = [r.lang_pred == docs[r.doc_id].lang for r in test]
    loss = np.mean([-math.log(max(r.score if hit else 1 - r.score, 1e-12)) for r, hit in zip(test, hits)])
    print("accuracy", np.mean(hits), "loss", loss, Counter((docs[r.doc_id].lang, r.lang_pred) for r, h in zip(test, hits) if not h))
    assert np.mean(hits) > 0.98
    assert abs(np.mean([r.score for r in test]) - np.mean(hits)) < 0.02  # calibrated


def test_weights_are_sparse_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    runs = []
    for parts in (2, 7):
        model = language.fit(docs.repartition(parts))
        runs.append((model.temperature, {(r.doc_id, r.lang_pred, round(r.score, 6)) for r in language.identify(docs, model).collect()}))
        weights = language.weights_of(model.state, len(model.languages))
        seen = language._state(model.state, len(model.languages))[1] > 0
        assert 0.1 < (weights[seen] == 0).mean() < 1  # the elastic net leaves weights out
    assert runs[0] == runs[1]


def test_odd_documents(spark, odd_docs, no_docs):
    model = language.fit(odd_docs)
    rows = language.identify(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and {r.lang_pred for r in rows} <= {"en", "und"}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert language.identify(no_docs, model).count() == 0
    nothing = language.fit(no_docs)
    assert {(r.lang_pred, r.score) for r in language.identify(odd_docs, nothing).collect()} == {("und", 0.0)}


def test_a_much_copied_text_is_one_example(spark):
    rows = [(i, "the same words again and again", "en") for i in range(2000)] + [(3000 + i, f"otro texto con palabras {chr(97 + i % 26) * 3}", "es") for i in range(60)]
    rows += [(None, "no id", "en"), (9000, None, "en"), (9001, "sin lengua", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    sample = language._sample(docs, "text", "lang")
    assert sample.filter("label = 'en'").count() == 1 and sample.filter("label = 'es'").count() <= 26
    model = language.fit(docs)
    assert {r.lang_pred for r in language.identify(docs.filter("lang = 'es'"), model).collect()} == {"es"}
