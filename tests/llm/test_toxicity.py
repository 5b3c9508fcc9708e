"""Scores on held-out labels, and the block-max search against all cosines."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from riskloom.llm import queries, toxicity


def auc(scores, labels):
    order = sorted(zip(scores, labels))
    ranks, i = {}, 0
    pos = [s for s, y in order if y]
    neg = [s for s, y in order if not y]
    return np.mean([np.mean([(p > q) + 0.5 * (p == q) for q in neg]) for p in pos])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op10_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    test = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    hits = [(r.predicted, labels[r.doc_id]) for r in test]
    tp, fp, fn = hits.count((1, 1)), hits.count((1, 0)), hits.count((0, 1))
    print("AUC", auc([r.score for r in test], [labels[r.doc_id] for r in test]), tp, fp, fn)
    assert auc([r.score for r in test], [labels[r.doc_id] for r in test]) > 0.9
    assert tp / (tp + fp) > 0.8 and tp / (tp + fn) > 0.75  # the small table has about 100 such rows


def test_search_is_exact():
    rng = np.random.default_rng(0)
    vectors = []
    for _ in range(500):
        terms = np.sort(rng.choice(40, rng.integers(0, 8), replace=False))
        w = rng.integers(1, 4, len(terms)).astype(float)
        vectors.append((terms, (w / (np.linalg.norm(w) or 1)).astype(np.float32)))
    flat = (*(np.concatenate([v[k] for v in vectors], dtype=kind, casting='unsafe') for k, kind in ((0, np.int32), (1, np.float32))), np.array([len(t) for t, _ in vectors]))
    index = toxicity.Index(np.arange(40, dtype=np.uint64), np.ones(40), list(range(500)), rng.integers(0, 2, 500), flat).build()
    dense = np.zeros((500, 40))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for i in range(0, 500, 7):
        t, w = vectors[i]
        cosines = np.round(dense @ dense[i], 12)
        expected = sorted(((-c, j) for j, c in enumerate(cosines) if c > 0 and j != i))[:15]
        got = index.nearest(t, w, 15, without=i)
        assert [j for _, j in got] == [j for _, j in expected]
        assert np.allclose([s for s, _ in got], [-c for c, _ in expected])


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, int(i % 2), 1) for i in range(18)] + [(None, 1, 1), (4, None, 1), (2, 0, 1)],
                                   "doc_id long, toxic int, quality int")
    index = toxicity.fit(odd_docs, labels)
    rows = toxicity.score(odd_docs, index).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(no_docs, index).count() == 0
    assert toxicity.without_toxic(odd_docs, index).columns == odd_docs.columns
    empty = toxicity.fit(odd_docs, labels.limit(0))
    assert {r.score for r in toxicity.score(odd_docs, empty).collect()} == {0.5}
    assert toxicity.fit(no_docs, labels).alone == 0.5


def test_rare_words_and_near_copies_count(spark):
    """Toxic examples in groups of three with words of their own; near copies of them are found."""
    rng = random.Random(5)

    def words(n, size=7):
        return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=size)) for _ in range(n)]

    plain = words(300)
    topics = [words(12) for _ in range(60)]
    texts = [(" ".join(rng.choices(plain, k=60)), 0) for _ in range(400)]
    texts += [(" ".join(rng.choices(plain, k=30) + rng.sample(topic, 10)), 1) for topic in topics for _ in range(3)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic int")
    index = toxicity.fit(docs, labels)
    words_of_examples = {w for i, (t, _) in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 for w in t.split()}
    assert set(toxicity.term_hashes([' '.join(sorted(words_of_examples))])[0].tolist()) <= set(toxicity.index_of(index.folder).hashes.tolist())
    again = [(1000 + i, t.rsplit(" ", 2)[0] + " " + " ".join(words(2)), y) for i, (t, y) in enumerate(texts)]
    rows = toxicity.score(spark.createDataFrame([r[:2] for r in again], "doc_id long, text string"), index).collect()
    truth = {i: y for i, _, y in again}
    hits = [(r.predicted, truth[r.doc_id]) for r in rows]
    assert hits.count((1, 1)) > 0.9 * 180 and hits.count((1, 0)) < 0.05 * 400


def plain_terms(text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    return Counter(t for w in words for t in [w + " ", *(w[:k] for k in toxicity.PREFIXES if len(w) > k)])


def test_votes_scores_and_calibration_against_brute_force(spark):
    """Dictionaries of strings give the same neighbours, the same votes under the other folds, and the same scores."""
    rng = random.Random(11)
    common, bad = ["".join(rng.choices("abcdefg", k=rng.randint(2, 9))) for _ in range(80)], ["idiotic", "clownish", "pathetically"]
    texts = [" ".join(rng.choices(common, k=rng.randint(1, 40)) + (rng.sample(bad, 2) if i % 4 == 0 else [])) for i in range(260)]
    texts[20:30] = [texts[0]] * 10  # copies
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(900, ""), (901, None)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    fitted = toxicity.fit(docs, labels)
    index = toxicity.index_of(fitted.folder)

    rows = defaultdict(list)
    for i in range(200):
        if zlib.crc32(str(i).encode()) % 5:
            rows[texts[i]].append(i)
    examples = {t: (min(i), int(np.mean([j % 4 == 0 for j in i]) >= 0.5)) for t, i in rows.items()}
    assert sorted(index.ids) == sorted(i for i, _ in examples.values())  # one place for each distinct text
    fold, place = dict(zip(index.ids, index.folds.tolist())), {}
    df = Counter(t for text in [*texts, "", ""] for t in set(plain_terms(text)))
    n = len(texts) + 2

    def vectors(without):
        known = [t for t, (i, _) in examples.items() if fold[i] != without]
        size = [sum(examples[t][1] == y for t in known) for y in (0, 1)]
        seen = [Counter(term for t in known if examples[t][1] == y for term in plain_terms(t).keys()) for y in (0, 1)]
        every = {term for t in examples for term in plain_terms(t)}
        idf = {}
        for term in every:
            clean, toxic = seen[0][term], seen[1][term]
            spread = math.sqrt(max(size[0] * size[1] * (clean + toxic) * (sum(size) - clean - toxic), 1.0))
            phi = abs(toxic * (size[0] - clean) - clean * (size[1] - toxic)) / spread
            idf[term] = (math.log((1 + n) / (1 + df[term])) + 1) * (1 + 10 * phi)

        def vector(text):
            w = {t: (1 + math.log(c)) * idf[t] for t, c in plain_terms(text).items() if t in idf}
            norm = math.sqrt(sum(x * x for x in w.values())) or 1.0
            return {t: x / norm for t, x in w.items()}

        return vector, {t: vector(t) for t in known}

    def votes(query, known):
        near = sorted((-round(sum(x * v.get(t, 0.0) for t, x in query.items()), 12), place[examples[text][0]], text) for text, v in known.items())
        near = [(-c, t) for c, _, t in near[:15] if c < 0]
        return sum(c * examples[t][1] for c, t in near) / sum(c for c, _ in near) if near else None

    expected = Counter()
    for f in range(5):
        vector, known = vectors(f)
        place.update({i: n for n, i in enumerate(toxicity.index_of(fitted.folder, f).ids)})
        for t, (i, label) in examples.items():
            if fold[i] == f:
                vote = votes(vector(t), known)
                expected[None if vote is None else round(vote * 50), label] += 1
    got = {(r["level"], r["label"]): r["n"] for r in toxicity._votes(spark, fitted.folder)}
    assert got == expected
    vector, known = vectors(-1)
    place.update({i: n for n, i in enumerate(index.ids)})
    for r in toxicity.score(docs, fitted).collect():
        vote = votes(vector(texts[r.doc_id] if r.doc_id < 900 else ""), known)
        assert abs(r.score - (fitted.alone if vote is None else np.interp(vote, fitted.edges, fitted.rates))) < 1e-6


def test_repeated_ids_are_learnt_alike(spark):
    rows = [(7, f"text number {i} of one id") for i in range(300)] + [(i, f"other words {i}") for i in range(100, 160)]
    labels = spark.createDataFrame([(7, 1)] + [(i, 0) for i in range(100, 160)], "doc_id long, toxic int")
    runs = []
    for parts in (2, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        fitted = toxicity.fit(docs, labels)
        assert toxicity.index_of(fitted.folder).ids.count(7) <= 1
        runs.append(sorted((r.doc_id, round(r.score, 9)) for r in toxicity.score(docs, fitted).collect()))
    assert runs[0] == runs[1]


def test_calibration_is_monotone():
    votes = [(None, 0, 30), (0, 0, 50), (10, 0, 3), (10, 1, 5), (20, 0, 9), (20, 1, 1), (50, 1, 20)]
    edges, rates, alone = toxicity.calibrated(votes, (1.0, 2.0))
    assert rates == sorted(rates) and edges == sorted(edges) and len(edges) == 3 and abs(alone - 0.5 / 31) < 1e-12
    pooled = ((10.5 / 14) * 14 + (2.5 / 12) * 12) / 26
    assert abs(rates[1] - pooled) < 1e-12


def test_index_is_mapped_from_its_file(spark, tmp_path):
    """What is read gives the same neighbours as what was built, without a copy in the worker."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(200)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    fitted = toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int"))
    built, found = toxicity._index(fitted.folder), toxicity.Index.read(f"{fitted.folder}/index.arrow")
    for name in toxicity._SAVED:
        assert np.array_equal(getattr(built, name), getattr(found, name)) and not getattr(found, name).flags.owndata
    assert built.ids == found.ids and built.blocks == found.blocks
    queries = [built.vector(*v) for v in toxicity.term_vectors(texts, built.hashes)]
    assert built.nearest_all(queries, 15) == found.nearest_all(queries, 15)
    maps = open("/proc/self/maps").read()
    assert f"{fitted.folder.removeprefix('file:')}/index.arrow" in maps
