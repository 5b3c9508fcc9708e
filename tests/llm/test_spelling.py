"""Spelling groups against all pairs of words, and the hot keys against the plain ones."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from riskloom.llm import spelling

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute_force(rows):
    seen = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            crc = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if crc % 97 == 0:
                word = word[: crc % len(word)] + word[crc % len(word) + 1 :]
            seen[word] += 1
    return groups({w: n for w, n in seen.items() if len(w) >= 5 and n >= 3})


def groups(counts):
    out = {}
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        out[w] = best if best is not None and counts[best] >= 2 * n else None
    rows = set()
    for w, n in counts.items():
        root = w
        while out[root] is not None:
            root = out[root]
        rows.add((w, out[w], root, n, len(near[w]), counts.get(out[w])))
    return rows


def found(docs):
    rows = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in spelling.spelling_groups(docs).collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def test_odd_documents(spark, odd_docs, no_docs):
    assert found(odd_docs) == brute_force([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert found(no_docs) == set()


def made_up(seed, letters="abcéZ", n=400):
    rng = random.Random(seed)
    stems = ["".join(rng.choices(letters, k=rng.randint(4, 9))) for _ in range(12)]
    words = []
    for _ in range(3000):
        word = rng.choice(stems)
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randint(0, len(word))
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]])
        words.append(word)
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(n)]
    return rows + [(None, "Word word WORD " * 5), (7, None), (8, "x" * 3000 + " " + "x" * 3001 + (" " + "x" * 3000) * 7 + (" " + "x" * 3001) * 3)]


def test_dense_vocabulary(spark):
    for seed in (1, 2):
        rows = made_up(seed)
        assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute_force(rows)


def test_hot_keys_are_exact(spark, monkeypatch):
    rows = made_up(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = brute_force(rows)
    for hot in (0, 3):
        monkeypatch.setattr(spelling, "HOT", hot)
        assert found(docs) == expected


def test_neighbours_reach_every_edit():
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzéÿ"

    def codes(word):
        return np.array([[ord(c) for c in word]], np.uint64)

    for _ in range(300):
        word = "".join(rng.choices(letters[:4], k=rng.randint(5, 12)))
        at, kind = rng.randint(0, len(word) - 1), rng.randint(0, 2)
        other = [word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]][kind]
        if len(other) >= 5:
            keys = set(spelling.neighbour_keys(codes(word))[0].tolist())
            assert keys & set(spelling.own_keys(codes(other))[0].tolist()), (word, other)
    assert spelling.own_keys(codes("hello")).shape == (1, 2)


def test_long_chains(spark):
    """A chain of forms over many words ends at its last."""
    words = ["a" * (5 + i) for i in range(9)]
    rows = [(i * 3 + 1, " ".join([w] * 3 * 2**k)) for i, (k, w) in enumerate(enumerate(words))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == brute_force(rows)


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(docs) == brute_force([(r.doc_id, r.text) for r in docs.collect()])
