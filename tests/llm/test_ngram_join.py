"""Groups of the n-gram join against all pairs, on tables and on planted near copies."""

import random

import pytest

import numpy as np
from pyspark.sql import functions as F
from riskloom.llm import ngram_join, queries
from riskloom.llm.graph import components

SF = "/root/testdata/sf0.001"


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_force(rows, width, percent):
    """[(doc_id, n_shingles, component_id)] by comparing all pairs of distinct sets."""
    sets = [shingle_set(r["text"], width) for r in rows]
    distinct = sorted({s for s in sets if s}, key=len)
    group = {s: i for i, s in enumerate(distinct)}

    def find(i, up=list(range(len(distinct)))):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i, up

    for i, a in enumerate(distinct):
        for j in range(i + 1, len(distinct)):
            if len(a) * 100 < percent * len(distinct[j]):
                break
            both = len(a & distinct[j])
            if 100 * both >= percent * (len(a) + len(distinct[j]) - both):
                (x, up), (y, _) = find(i), find(j)
                up[x] = y
    ids: dict[int, int] = {}
    for r, s in zip(rows, sets):
        if s and r["doc_id"] is not None:
            c = find(group[s])[0]
            ids[c] = min(ids.get(c, r["doc_id"]), r["doc_id"])
    return sorted(((r["doc_id"], len(s), ids.get(find(group[s])[0]) if s else r["doc_id"]) for r, s in zip(rows, sets)), key=str)


def got(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=str)


def edited(words, edits, rng, vocabulary):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return " ".join(words)


@pytest.fixture(scope="module")
def near_copies(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["The", "AND"]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    texts = []
    for length in (3, 5, 9, 12, 20, 31, 60, 90, 200, 400):
        for _ in range(6):
            base = [rng.choice(vocabulary) for _ in range(length)] + (passage if rng.random() < 0.5 else [])
            texts += [edited(base, e, rng, vocabulary) for e in (0, 0, 1, 1, 2, 3, 5, 8)]
            texts.append(" ".join(base + [rng.choice(vocabulary) for _ in range(max(1, length // 10))]))
    rng.shuffle(texts)
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_groups_are_exact(spark, near_copies, odd_docs, width, percent):
    for docs in (near_copies, odd_docs, spark.read.parquet(f"{SF}/documents.parquet")):
        assert got(ngram_join.similar_groups(docs, width, percent)) == brute_force(docs.collect(), width, percent)


def test_large_clusters_are_tiled(spark, near_copies, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 4)
    assert got(ngram_join.similar_groups(near_copies, 5, 80)) == brute_force(near_copies.collect(), 5, 80)


def test_a_set_is_sent_to_one_block_and_tiles_look_for_links_between_labels(spark, near_copies, monkeypatch):
    """A class costs one row, however many tiles its cluster has; some rows of a large cluster are joined to no other."""
    monkeypatch.setattr(ngram_join, "TILE", 4)
    rows = [(i, 20 + i % 30, i, i, 7) for i in range(500)]
    members = spark.createDataFrame(rows, "class long, n_grams long, rep_id long, rep_hash long, cluster long")
    placed = ngram_join._placed(members, 80).collect()
    assert sorted(r["class"] for r in placed) == list(range(500)) and all(r["large"] for r in placed)
    assert len({r["block"] for r in placed}) > 30 and len({(r["block"], r["band"]) for r in placed}) == len({r["block"] for r in placed})

    rng, bands = np.random.default_rng(4), ngram_join.Bands(80)
    bases = [rng.choice(10_000, 100, replace=False) for _ in range(3)]
    sets = [np.unique(np.concatenate([bases[i % 3][: 100 - i % 5], 20_000 + rng.choice(10_000, i % 7)])).astype(np.uint64) for i in range(60)]
    for labels in (None, np.where(np.arange(60) % 3 == 0, -1, np.arange(60)), np.arange(60) % 3, np.zeros(60, int)):
        up = list(range(60)) if labels is None else [int(np.flatnonzero(labels == v)[0]) for v in labels]
        links = ngram_join.spanning_links(sets, bands, labels)
        assert len(links) == len(set(up)) - (1 if labels is not None and not labels.any() else 3)
        for a, b in links:
            both = len(np.intersect1d(sets[a], sets[b]))
            assert up[a] != up[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)
            up = [up[a] if u == up[b] else u for u in up]


def test_frequent_grams_may_be_left_out(near_copies, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT_IN_BATCH", 2)
    assert got(ngram_join.similar_groups(near_copies, 3, 90)) == brute_force(near_copies.collect(), 3, 90)


def test_bands_hold_all_links():
    for percent in (80, 90):
        bands = ngram_join.Bands(percent)
        for a in range(1, 300):
            for b in range(a, a * 100 // percent + 1):
                assert bands.of(b) - bands.of(a) in (0, 1)
                least = -(-percent * (a + b) // (100 + percent))
                assert a + b - 2 * least <= bands.differences(bands.of(a))


def test_one_of_each_group(near_copies, no_docs):
    kept = {r.doc_id for r in ngram_join.one_of_each_group(near_copies, 5, 80).collect()}
    assert kept == {c for _, _, c in brute_force(near_copies.collect(), 5, 80)}
    assert ngram_join.one_of_each_group(no_docs).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, 900), (900, 7), (7, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(100, 141)} == {100} and found[900] == found[7] == 5


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(queries.op3_ngram_join(spark, SF)) == brute_force(docs.collect(), 3, 90)


def test_different_texts_without_ids(spark):
    """Near copies under null ids, and one repeated row: each class fetches its own text once."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(2000):
        text = list(words[(i % 4) * 100 : (i % 4) * 100 + 100])
        text[int(rng.integers(100))] = f"own{i}"
        rows.append((None if i % 3 else i, " ".join(text)))
    rows += [(None, "the same row again and again and again")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.similar_groups(docs, width=3, percent=90)
    assert got.count() == len(rows)
    assert {r["component_id"] for r in got.filter("n_shingles > 50").select("component_id").distinct().collect()} == {0, 3, 6, 9}
    plan = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    keys = plan.select("doc_id", "text_hash").distinct()
    assert plan.join(keys.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")),
                     F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))).count() == len(rows)
