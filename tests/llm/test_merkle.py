"""The manifest against a plain tree in Python, the closed form against the log."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskloom.llm import merkle

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    values = [None if row[c] is None else str(row[c]) for c in COLUMNS]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, at):
    for nodes in levels[:-1]:
        first = at - at % 8
        yield "".join(nodes[first:at]), "".join(nodes[at + 1 : first + 8])
        at //= 8


def brute_force(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row["lang"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row), row))
    names = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    built = {lang: levels_of([t[2] for t in sorted(trees[lang], key=lambda t: t[:3])]) for lang in names}
    top = levels_of([built[lang][-1][0] for lang in names])
    out = Counter()
    for place, lang in enumerate(names):
        for at, (*_, leaf, row) in enumerate(sorted(trees[lang], key=lambda t: t[:3])):
            changed = dict(row)
            if zlib.crc32(str("" if row["doc_id"] is None else row["doc_id"]).encode()) % 3 == 0 and row["text"] is not None:
                changed["text"] = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row["text"])
            node, proof = leaf_of(changed), ""
            for left, right in [*path(built[lang], at), *path(top, place)]:
                node, proof = sha(left + node + right), proof + left + right
            out[row["doc_id"], leaf, built[lang][-1][0], top[-1][0], sha(proof), node, node == top[-1][0]] += 1
    return out


def found(docs):
    names = ("key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return Counter(tuple(r[n] for n in names) for r in merkle.proofs(merkle.manifest(docs)).collect())


def rows_of(docs):
    return [{c: r[c] for c in COLUMNS} for r in docs.collect()]


def test_odd_documents(spark, odd_docs, no_docs):
    assert found(odd_docs) == brute_force(rows_of(odd_docs))
    assert found(no_docs) == Counter()
    assert merkle.manifest(no_docs).root is None


@pytest.mark.parametrize("sizes", [[1], [8], [9, 1], [512, 513, 7], [4097, 2, 600, 1, 1, 1, 1, 1, 1, 3]])
def test_trees_of_many_sizes(spark, sizes):
    rows = [(i * 7 % 100_003 - 50, f"Text {i}", f"l{k}" if k else None, "s", i) for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert found(docs) == brute_force(rows_of(docs))


def test_a_hot_key_is_dealt_out(spark):
    """A third of all rows have one id, and half of those are equal."""
    rows = [(None if i % 3 == 0 else i, "same" if i % 2 else f"Text {i}", "en", "s", 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    assert found(docs) == brute_force(rows_of(docs))


@pytest.mark.parametrize("leaves", [1, 2, 7, 8, 9, 63, 64, 65, 500, 512])
def test_places_follow_from_sizes(leaves):
    nodes = [f"{i:064x}" for i in range(leaves)]
    for height in range(merkle.height_of(leaves), 4):
        log = merkle.append_log(nodes, height)
        expected, level = nodes, 0
        while True:
            at = merkle.postorder(level, np.arange(len(expected)), leaves, height)
            assert [log[i] for i in at] == expected
            if level == height:
                break
            expected, level = [sha("".join(expected[i : i + 8])) for i in range(0, len(expected), 8)], level + 1
        assert int(at[0]) == len(log) - 1
