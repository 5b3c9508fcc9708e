"""Targets by water filling, shares near their targets, repeatable draws."""

import re
from collections import defaultdict

import pytest

from riskloom.llm import mixing

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Share 150 % by weight, stop at twice the size, reshare the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not full:
            out |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


@pytest.mark.parametrize("range_rows", [5000, 3])
def test_mix(spark, odd_docs, no_docs, monkeypatch, range_rows):
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    for docs in (odd_docs, spark.read.parquet(f"{SF}/documents.parquet")):
        given = docs.collect()
        rows = mixing.mix(docs).collect()
        assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(docs).collect()), key=str)
        sizes, source_of = defaultdict(int), defaultdict(set)
        for r in given:
            sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
        expected, taken = targets(sizes), defaultdict(int)
        assert sorted((str(r.doc_id), r.size) for r in rows) == sorted((str(r["doc_id"]), len(WORD.findall(r["text"] or ""))) for r in given)
        for r in rows:
            taken[r.source] += r.taken
            assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
            assert r.target == pytest.approx(expected[r.source])
        assert sum(expected.values()) == pytest.approx(1.5 * sum(sizes.values()))
        for s in sizes:
            assert abs(taken[s] - expected[s]) <= 1
    assert mixing.mix(no_docs).count() == 0


def test_epochs_come_first_and_keys_order_the_rest(spark):
    rows = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    for group in by.values():
        whole = int(group[0].target // group[0].source_size)
        extra = [r.taken - whole * r.size for r in sorted(group, key=lambda r: (r.key, r.doc_id)) if r.size]
        assert all(0 <= e <= r for e, r in zip(extra, [r.size for r in sorted(group, key=lambda r: (r.key, r.doc_id)) if r.size]))
        zero = [e == 0 for e in extra]
        assert zero == sorted(zero)  # taken from the least key up


def test_better_documents_come_earlier(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'s' as source",
                                        "if(id % 2 = 0, 'plain words here', '### $$$ %%%') as text")
    rows = mixing.mix(docs).collect()
    mean = {k: sum(r.key for r in rows if r.doc_id % 2 == k) / 2000 for k in (0, 1)}
    assert mean[0] < mean[1] / 4


def test_mixed_documents(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    copies = {r.doc_id: r["count"] for r in mixing.mixed_documents(docs).groupBy("doc_id").count().collect()}
    for r in mixing.mix(docs).collect():
        assert copies.get(r.doc_id, 0) == (int(r.taken / r.size + 0.5) if r.size else 1)
    assert mixing.mixed_documents(odd_docs).columns == odd_docs.columns
    assert mixing.mixed_documents(no_docs).count() == 0
