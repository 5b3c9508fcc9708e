"""The search against all scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import topk


def brute_force(rows, every, k):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v):
            w = [int(np.floor(256 * float(np.float32(c)))) for c in v]
            vectors[i] = min(vectors.get(i, w), w)
    out = []
    for q, v in vectors.items():
        if q % every == 0:
            best = sorted((-min(max(sum(a * b for a, b in zip(v, w)), -(1 << 63)), (1 << 63) - 1), i) for i, w in vectors.items() if i != q and len(w) == len(v))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [8192, 7])
def test_exact(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "ROWS", block)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.2, 6).tolist()) for i in range(150)]
    rows += [(1000 + i, rows[i][1]) for i in range(40)]  # ties
    rows += [(5000, None), (5001, [None] * 6), (5002, [float("nan")] * 6), (5003, [float("inf")] * 6), (None, [0.1] * 6)]
    rows += [(6000, [1.0, 2.0]), (6010, [2.0, 1.0]), (7000, []), (20, [0.5] * 6), (8000, [9e5] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).repartition(4)
    got = topk.top_k(frame, F.col("vec_id") % 10 == 0, 5).collect()
    assert sorted(map(tuple, got)) == brute_force(rows, 10, 5)


def test_empty(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(frame, F.col("vec_id") % 10 == 0).count() == 0


def test_large_components(spark, monkeypatch):
    """Finite components of any size: exact scores, those beyond a long at its ends."""
    monkeypatch.setattr(topk, "ROWS", 16)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 1, 4).tolist()) for i in range(60)]
    rows += [(100, [1e19, 0.0, 0.0, 1.0]), (110, [-1e19, 1.0, 0.0, 0.0]), (111, [3e38, 0.0, 0.0, 0.0]), (120, [1e9, 2.0, 0.0, 0.0]), (121, [1e9, 2.0, 0.0, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 10 == 0, 5).collect())) == brute_force(rows, 10, 5)


def test_queries_go_where_their_bounds_reach(spark, monkeypatch):
    """Far clusters: a query is sent to few blocks, and the result is that of all scores."""
    monkeypatch.setattr(topk, "ROWS", 40)
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 4, (8, 6))
    rows = [(i, (centres[i % 8] * 2 + rng.normal(0, 0.05, 6)).tolist()) for i in range(800)]
    rows += [(1000 + i, [0.25] * 6) for i in range(300)]  # equal vectors
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 20 == 0, 5).collect())) == brute_force(rows, 20, 5)


def test_queries_of_a_block_are_scored_together():
    """Few short vectors tie at the k-th place, a query may be one of the block, and a score to beat leaves few."""
    rng = np.random.default_rng(5)
    v = rng.integers(-3, 4, (300, 8)).astype(float)
    ids = rng.permutation(1000)[:300]
    block = topk.Block(ids, v, np.zeros((300, 0)))
    q, own = v[:40], np.where(np.arange(40) % 2, ids[:40], 5000 + np.arange(40))
    beat = np.where(np.arange(40) % 3, -np.inf, 25.0)
    place, names, scores = block.search_all(own, q, 5, beat)
    for i in range(40):
        every = sorted((-int(s), int(n)) for s, n in zip(v @ q[i], ids) if n != own[i] and s >= beat[i])[:5]
        assert [(-s, n) for n, s in zip(names[place == i].tolist(), scores[place == i].tolist())] == every
        assert block.search(int(own[i]), q[i], np.empty(0), 5, -np.inf)[: len(every)] == every
    assert all(len(part) == 0 for part in topk.Block(np.empty(0, np.int64), np.zeros((0, 8)), np.zeros((0, 0))).search_all(own, q, 5, beat))
