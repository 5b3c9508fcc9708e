"""Quality rules with thresholds that adapt to each (language, source).

1. Whole-text measures per document, in Arrow tasks.
2. Per (language, source) and measure a mergeable quantile sketch: counts of log-linear buckets
   (a ratio in parts per million keeps its eight leading bits, so a quantile is off by at most
   1/128 of itself). Two sketches merge by adding counts, so Spark sums them map-side; the size of
   a sketch is fixed, whatever the number of rows.
3. From each sketch a fence: `q90 + SPREAD * (q90 - q75)`. A measure that is the same up to its ninth decile has no
   spread to go by: then the measure's floor is the fence, or the ninth decile if that is above it.
4. The fences join back to the documents, and rows beyond one are rejected. A source's fence may be lower
   than that of its language, not higher, so that a source full of junk does not raise its own.

Groups with fewer than MIN_GROUP measured rows use the language's fences, and if that is as small
those of all rows. Documents with no word fail the base rules, and are not measured."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.words import WordHashes, parts, shingles, word_hashes
from riskloom.shipping import ship

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Fences: measure -> (numerator, denominator, floor in parts per million).
MEASURES = {
    "symbols": ("n_symbols", "word_chars", 50_000),
    "repeats": ("n_repeat_words", "n_words", 350_000),
    "lines": ("n_dup_lines", "n_words", 50_000),
    "length": ("word_chars", "n_words", 10_000_000),
}
SPREAD, MIN_GROUP, BITS = 12, 100, 8
_NEW_LINE = "\n"


def measured(text: bytes, hashes: WordHashes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one text."""
    words = text.split()
    n = len(words)
    raw = np.frombuffer(text, np.uint8)
    white = (raw == 32) | ((raw >= 9) & (raw <= 13))
    chars = int(np.count_nonzero(~white & ((raw & 0xC0) != 0x80)))
    symbols = sum(text.count(s.encode()) for s in SYMBOLS)
    seen: set[bytes] = set()
    dup_lines = 0
    for line in text.split(b"\n"):
        if line in seen:
            dup_lines += 1
        elif line and not line.isspace():
            seen.add(line)
    repeat = 0
    grams = shingles(hashes.of(words), 3)
    if len(grams):
        _, inverse, counts = np.unique(grams, return_inverse=True, return_counts=True)
        again = counts[inverse] > 1
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k : n - 2 + k] |= again
        repeat = int(covered.sum())
    return n, chars, symbols, dup_lines, repeat


def base_measures(docs: DataFrame) -> DataFrame:
    """One row per document: id, lang, source and the whole-text counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in parts(batches):
            rows = np.array([measured((t or "").encode(), hashes) for t in batch.column(1).to_pylist()], np.int64)
            rows = rows.reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), *(pa.array(rows[:, k]) for k in range(5))],
                names=["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])

    slim = docs.select("doc_id", "text", "lang", "source")
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}
    return slim.mapInArrow(run, f"doc_id {kinds['doc_id']}, lang {kinds['lang']}, source {kinds['source']}, "
                           "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint")


def bucket(value: Column) -> Column:
    """The lower edge of a value's bucket: its leading BITS."""
    drop = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, edge, n): the mergeable sketches of every group."""
    return rows.groupBy(*keys, "measure", "edge").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, n_rows, fence) from merged sketches; a sketch has at most a few thousand buckets."""
    from pyspark.sql import Window

    per = Window.partitionBy(*keys, "measure")
    placed = sketch.withColumn("upto", F.sum("n").over(per.orderBy("edge"))).withColumn("total", F.sum("n").over(per))

    def quantile(percent: int) -> Column:
        return F.min(F.when(F.col("upto") * 100 >= F.col("total") * percent, F.col("edge")))

    cut = placed.groupBy(*keys, "measure").agg(
        F.max("total").alias("n_rows"), quantile(75).alias("q75"), quantile(90).alias("q90"))
    floor = F.create_map(*[F.lit(x) for name, (_, _, least) in MEASURES.items() for x in (name, least)])
    spread = F.col("q90") - F.col("q75")
    fence = F.when(spread > 0, F.col("q90") + SPREAD * spread).otherwise(F.greatest(floor[F.col("measure")], F.col("q90")))
    return cut.select(*keys, "measure", "n_rows", fence.cast("bigint").alias("fence"))


def judge(docs: DataFrame) -> DataFrame:
    """The documents' counts with `base_failed` and `kept`.

    Needs doc_id, text, lang and source; other columns are ignored. A null text has no words
    and fails. Null languages and sources are groups of their own. Repeated rows are judged
    each, ties in a sketch share a bucket, no rows give no rows."""
    ship(docs.sparkSession)
    rows = base_measures(docs).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    from riskloom.sources.scratch import written

    rows = written(rows, "quality-measures")
    parts = {name: F.expr(f"{top} * 1000000 div nullif({bottom}, 0)") for name, (top, bottom, _) in MEASURES.items()}
    long = rows.filter("n_words > 0 and not base_failed").select("lang", "source", F.explode(F.create_map(
        *[x for name, value in parts.items() for x in (F.lit(name), value)])).alias("measure", "value"))
    fine = sketches(long.withColumn("edge", bucket(F.col("value"))).withColumn("n", F.lit(1)), ["lang", "source"])
    fine = written(fine, "quality-sketches")
    levels = [fences(fine, ["lang", "source"]), fences(sketches(fine, ["lang"]), ["lang"]), fences(sketches(fine, []), [])]

    def wide(level: DataFrame, keys: list[str], tag: str) -> DataFrame:
        enough = level.filter(F.col("n_rows") >= MIN_GROUP) if keys else level
        return enough.groupBy(*[F.col(k).alias(f"{tag}_{k}") for k in keys]).pivot("measure", list(MEASURES)).agg(
            F.first("fence")).select(*[f"{tag}_{k}" for k in keys], *[F.col(m).alias(f"{tag}_{m}") for m in MEASURES])

    tags = ["own", "language", "all"]
    tables = [wide(level, keys, tag) for level, keys, tag in zip(levels, [["lang", "source"], ["lang"], []], tags)]
    joined = rows
    for table, keys, tag in zip(tables[:2], [["lang", "source"], ["lang"]], tags):
        joined = joined.join(table, functools.reduce(
            Column.__and__, [rows[k].eqNullSafe(table[f"{tag}_{k}"]) for k in keys]), "left")
    joined = joined.join(F.broadcast(tables[2]), F.lit(True), "left")  # one row
    beyond = functools.reduce(Column.__or__, [
        F.coalesce(parts[m] > F.coalesce(F.least(f"own_{m}", f"language_{m}"), F.col(f"all_{m}")), F.lit(False))
        for m in MEASURES])
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), False).otherwise(~beyond).alias("kept"))
