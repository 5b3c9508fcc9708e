"""Removed bytes against every string of a window's length, and the suffix sort against sorting."""

import hashlib
import random

import numpy as np
import pytest

from riskloom.llm import queries, suffix_dedup, suffix_sort

SF = "/root/testdata/sf0.001"


def brute_force(rows, window):
    """[(doc_id, n_bytes, n_removed, n_spans, sha256)]; ids are distinct and not null."""
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        text = (r["text"] or "").encode()
        gone = bytearray(len(text))
        for i in range(len(text) - window + 1):
            s = text[i : i + window]
            if s in seen:
                gone[i : i + window] = b"\1" * window
            seen.add(s)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        rest = bytes(b for b, g in zip(text, gone) if not g)
        out.append((r["doc_id"], len(text), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def got(frame):
    return sorted((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect())


@pytest.fixture(scope="module")
def passages(spark):
    """Shared passages at any place, copies, runs of one letter, and edits."""
    rng = random.Random(3)
    letters = "ab cdé\n"
    common = ["".join(rng.choice(letters) for _ in range(n)) for n in (99, 100, 101, 130, 180, 400, 1000)]
    texts = [None, "", "a" * 99, "a" * 100, "a" * 101, "a" * 700, "ab" * 300, "abc" * 400, common[3] * 3]
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts.append("".join(rng.choice(letters) for _ in range(rng.randrange(0, 150))))
            piece = rng.choice(common)
            if rng.random() < 0.3:
                cut = rng.randrange(len(piece))
                piece = piece[:cut] + "#" + piece[cut + 1 :]
            if rng.random() < 0.5:
                piece = piece[rng.randrange(len(piece)) :]
            parts.append(piece)
        texts.append("".join(parts))
    texts += texts[20:40]
    rng.shuffle(texts)
    rows = [(i * 3, t, 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_chars long").repartition(6)


def test_removed_bytes(spark, passages):
    for docs in (passages, spark.read.parquet(f"{SF}/documents.parquet")):
        assert got(suffix_dedup.without_repeats(docs)) == brute_force(docs.collect(), 100)


def test_hot_anchors_by_digest(passages, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    assert got(suffix_dedup.without_repeats(passages, 64)) == brute_force(passages.collect(), 64)


def test_small_batches_and_pieces(spark, passages, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 37)
    monkeypatch.setattr(suffix_dedup, "_ROWS", 5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert got(suffix_dedup.without_repeats(passages)) == brute_force(passages.collect(), 100)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_hash_collision_is_seen(passages, monkeypatch):
    monkeypatch.setattr(suffix_sort, "common", lambda h, x, y, most: most.copy())
    data = np.frombuffer(b"banana bandana", np.uint8)
    start = np.arange(len(data))
    order, _ = suffix_sort.sorted_suffixes(data, np.zeros(len(data), int), start, len(data) - start)
    assert order.tolist() == sorted(start, key=lambda i: data[i:].tobytes())


def test_suffix_sort():
    rng = np.random.default_rng(4)
    for _ in range(60):
        data = rng.integers(97, 99, 80).astype(np.uint8)
        n = 40
        start = rng.integers(0, 60, n)
        length = rng.integers(0, 20, n)
        group = np.sort(rng.integers(0, 4, n))
        order, lcp = suffix_sort.sorted_suffixes(data, group, start, length)
        text = [data[s : s + k].tobytes() for s, k in zip(start, length)]
        assert [(group[i], text[i]) for i in order] == sorted((g, t) for g, t in zip(group, text))
        for k in range(1, n):
            a, b = text[order[k - 1]], text[order[k]]
            same = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
            assert lcp[k] == (same if group[order[k]] == group[order[k - 1]] else -1)


def test_odd_documents(odd_docs, no_docs):
    found = got_by_id(suffix_dedup.without_repeats(odd_docs))
    assert found[0] == [(0, 0)] and found[None] == [(7, 0)] and found[1] == [(0, 0)]
    assert found[15] == [(5000, 4999)] and found[14] == [(15000, 14995)]  # runs of one letter and of one word
    assert len(set(found[18])) == 1 and len(found[18]) == 2  # a repeated row is the same document
    assert suffix_dedup.without_repeats(no_docs).count() == 0
    assert suffix_dedup.deduplicated(odd_docs).columns == odd_docs.columns


def got_by_id(frame):
    found = {}
    for r in frame.collect():
        found.setdefault(r.row.doc_id, []).append((r.n_bytes, r.n_removed))
    return found


def test_deduplicated_keeps_what_is_left(passages):
    rest = {r.doc_id: r for r in suffix_dedup.deduplicated(passages).collect()}
    for doc_id, n, removed, _, sha in brute_force(passages.collect(), 100):
        assert (doc_id in rest) == (removed == 0 or removed < n)
        if removed and doc_id in rest:
            assert rest[doc_id].n_chars == len(rest[doc_id].text)


def test_query(spark):
    rows = queries.op9_suffix_dedup(spark, SF).collect()
    assert sorted(map(tuple, rows)) == brute_force(spark.read.parquet(f"{SF}/documents.parquet").collect(), 100)


def test_many_texts_of_one_id(spark):
    """2,000 different texts without an id; a removal in one is never made in another."""
    rng = random.Random(9)
    common = ["".join(rng.choices("abcdefgh ", k=n)) for n in (150, 220)]
    texts = ["".join(rng.choices("abcdefgh ", k=rng.randrange(250))) + rng.choice(common)
             + "".join(rng.choices("abcdefgh ", k=rng.randrange(120))) for _ in range(2000)]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").repartition(6)
    hashes = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) AS h").collect()}
    expected = brute_force([{"doc_id": hashes[t], "text": t} for t in texts], 100)
    assert sorted(r[1:] for r in got_without_ids(suffix_dedup.without_repeats(docs))) == sorted(r[1:] for r in expected)


def got_without_ids(frame):
    return [(None, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()]
