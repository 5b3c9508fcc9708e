"""Base measures against plain Python, and the verdict on labelled rows."""

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from riskloom.llm import quality, queries

SF = "/root/testdata/sf0.1"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeat = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = Counter(x for x in text.split("\n") if WORD.search(x))
    return (len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text),
            sum(n - 1 for n in lines.values()), len(repeat))


def test_base_measures(spark, odd_docs, no_docs):
    for docs in (odd_docs, spark.read.parquet(f"{SF}/documents.parquet").limit(800)):
        rows = quality.base_measures(docs).collect()
        expected = Counter((r["doc_id"], *base(r["text"])) for r in docs.collect())
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == expected
    odd = quality.judge(odd_docs).collect()
    assert len(odd) == odd_docs.count() and all(not (r.base_failed and r.kept) for r in odd)
    assert quality.judge(no_docs).count() == 0


def test_sketches_merge(spark):
    values = spark.range(5000).select(F.lit("en").alias("lang"), (F.col("id") % 7).cast("string").alias("source"),
                                      F.lit("symbols").alias("measure"), quality.bucket(F.xxhash64("id") % 100_000 + 100_000).alias("edge"), F.lit(1).alias("n"))
    parts = quality.sketches(values, ["lang", "source"])
    direct = {tuple(r) for r in quality.sketches(values, ["lang"]).collect()}
    assert {tuple(r) for r in quality.sketches(parts, ["lang"]).collect()} == direct
    off = spark.range(1, 5000).select(F.col("id"), quality.bucket(F.col("id")).alias("edge")).filter("edge > id or id > edge * 17 / 16")
    assert off.count() == 0


def test_clean_documents_stay_and_junk_goes(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = Counter((labels[r.doc_id], r.kept) for r in queries.op4_quality_rules(spark, SF).collect()
                   if labels.get(r.doc_id) is not None and not r.base_failed)
    assert seen[1, True] > 0.995 * (seen[1, True] + seen[1, False])
    assert seen[0, False] > 0.95 * (seen[0, True] + seen[0, False])


def sets_of_fences(spark, docs):
    rows = quality.base_measures(docs).filter("n_words >= 50 and 2 * n_repeat_words <= n_words")
    long = rows.selectExpr("lang", "source", "stack(4, 'symbols', n_symbols * 1000000 div word_chars, 'repeats', n_repeat_words * 1000000 div n_words,"
                           " 'lines', n_dup_lines * 1000000 div n_words, 'length', word_chars * 1000000 div n_words) as (measure, value)")
    fine = quality.sketches(long.withColumn("edge", quality.bucket(F.col("value"))).withColumn("n", F.lit(1)), ["lang", "source"])
    return quality.fences(fine, ["lang", "source"]).filter(F.col("n_rows") >= quality.MIN_GROUP).collect()


def test_the_sketches_set_the_fences(spark):
    """Wherever a measure varies, its fence is not the floor; for words' lengths and repeats that is everywhere."""
    found = sets_of_fences(spark, spark.read.parquet(f"{SF}/documents.parquet"))
    apart = Counter((r.measure, r.fence != quality.MEASURES[r.measure][2]) for r in found)
    assert apart["length", True] and not apart["length", False]
    assert apart["repeats", True] > apart["repeats", False]
    assert len({r.fence for r in found if r.measure == "length"}) > 3  # groups have fences of their own


def test_a_source_full_of_junk(spark):
    """Two of five documents of one source are symbols; they go, and the clean ones of all sources stay."""
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefghij"), rng.integers(3, 9))) for _ in range(500)]
    rows = []
    for i in range(2000):
        junk = i % 20 == 0 and i % 50 < 20  # source s0 has 100 rows
        text = " ".join("#*$% " if junk and k % 2 else w for k, w in enumerate(rng.choice(words, 120)))
        rows.append((i, text, "en", f"s{i % 20}", junk))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, junk boolean")
    assert 0.3 < frame.filter("source = 's0' and junk").count() / frame.filter("source = 's0'").count() < 0.5
    kept = {r.doc_id: r.kept for r in quality.judge(frame).collect()}
    assert all(kept[r[0]] != r[4] for r in rows if r[4])
    assert sum(kept[r[0]] for r in rows if not r[4]) > 0.995 * sum(not r[4] for r in rows)
