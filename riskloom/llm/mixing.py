"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a token budget, its target. It is spent on complete epochs first: every document
once per epoch. What is left goes to documents in the order of exponential keys `-ln(u) / weight`
(u is a hash of the id in (0, 1), the weight is the document's quality), summed up until the
budget is reached; the last document gives the words that are missing.

The running sum is taken in two steps, so that a source with a third of all rows is no single
task: keys fall into ranges of about RANGE_ROWS rows, the ranges' totals are summed up per
source, and within a range only its own rows are ordered. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.sources.scratch import written

#: Fixed values of the mix: weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE_PERCENT, MOST_EPOCHS = 150, 2
RANGE_ROWS = 5_000
WORD = r"[^\x20\x09-\x0D]+"
#: Characters that speak against a text's quality.
ODD_CHARACTERS = "#*$%&|<>{}[]0123456789"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def quality_weight(text: Column) -> Column:
    """Between 0.05 and 1: one for plain prose, less the more odd characters there are."""
    length = F.greatest(F.length(text), F.lit(1))
    odd = F.length(text) - F.length(F.translate(text, ODD_CHARACTERS, ""))
    return F.coalesce(F.lit(1.0) / (F.lit(1.0) + F.lit(19.0) * odd / length), F.lit(1.0))


def uniform(doc_id: Column, seed: int) -> Column:
    """A repeatable number in (0, 1) for each id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    whole = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return (whole + 0.5) / F.lit(float(1 << 52))


def source_targets(sized: DataFrame) -> DataFrame:
    """(source, n_rows, source_size, target) of rows with `source` and `size`.

    Targets are `min(2 * size, level * weight)` with the one level that spends the whole share:
    the sources are walked in the order in which they fill up."""
    totals = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    every = Window.partitionBy()
    ranked = totals.withColumn("weight", weight).withColumn("room", F.col("source_size") * MOST_EPOCHS)
    walk = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    so_far = walk.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        (F.sum("source_size").over(every) * SHARE_PERCENT / F.lit(100.0) - F.coalesce(F.sum("room").over(so_far), F.lit(0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(so_far), F.lit(0))))
    # a source is full if the level that the sources from here on would share reaches its room;
    # the first that is not full sets the level of all that follow
    levels = ranked.withColumn("level", level).withColumn("step", F.row_number().over(walk))
    open_ = F.when(F.col("level") * F.col("weight") < F.col("room"), F.struct("step", "level"))
    levels = levels.withColumn("shared", F.min(open_).over(every)["level"])
    return levels.select("source", "n_rows", "source_size", F.coalesce(
        F.least(F.col("room").cast("double"), F.col("shared") * F.col("weight")), F.col("room").cast("double")).alias("target"))


def mix(docs: DataFrame, size: Column | None = None, weight: Column | None = None, seed: int = 7) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, key) for every row of `docs`.

    Uses doc_id, text and source, whatever else there is. A null text has no words and takes
    nothing; a null source is a source, the last; an empty source's target is 0. Rows that share an
    id share a key and follow each other by size; equal rows are interchangeable, so reruns agree.
    No rows give no rows."""
    sized = docs.select(
        F.col("doc_id"), F.col("source"), (size if size is not None else word_count(F.col("text"))).alias("size"),
        (-F.log(uniform(F.col("doc_id"), seed)) / (weight if weight is not None else quality_weight(F.col("text")))).alias("key"))
    # texts are read once; what follows works on a few numbers a document
    sized = written(sized, "mix-sizes")
    targets = written(source_targets(sized), "mix-targets")
    ranges = F.ceil(F.col("n_rows") / RANGE_ROWS)
    placed = sized.join(F.broadcast(targets.withColumnRenamed("source", "of_source")),
                        sized["source"].eqNullSafe(F.col("of_source"))).drop("of_source").withColumn(
        "range", F.least(F.floor((1 - F.exp(-F.col("key"))) * ranges), ranges - 1))
    totals = placed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    before = F.sum("range_size").over(Window.partitionBy("source").orderBy("range")) - F.col("range_size")
    starts = totals.select(F.col("source").alias("of_source"), F.col("range").alias("of_range"), before.alias("before_range"))
    located = placed.join(starts, placed["source"].eqNullSafe(F.col("of_source")) & (placed["range"] == F.col("of_range")))
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("before_range") + F.coalesce(F.sum("size").over(within), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    left = F.round(F.col("target") - epochs * F.col("source_size")).cast("bigint")
    share = F.greatest(F.least(left - ahead, F.col("size")), F.lit(0))
    return located.select("doc_id", "source", "size", "source_size", "target",
                          (epochs * F.col("size") + share).cast("bigint").alias("taken"), "key")


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The documents of the mix, with their columns: a row for each copy. A document of which
    the mix takes a part is there if it takes half of it at least. Documents without a word
    have no share in a budget of words and stay as they are.

    Decisions join back by id and size; rows with a null id are looked up likewise."""
    taken = mix(docs, seed=seed).groupBy("doc_id", "size").agg(F.max("taken").alias("taken"))
    taken = taken.select(F.col("doc_id").alias("mix_doc_id"), F.col("size").alias("mix_size"), F.col("taken").alias("mix_taken"))
    copies = F.when(F.col("mix_size") > 0, F.floor(F.col("mix_taken") / F.col("mix_size") + 0.5)).otherwise(1).cast("int")
    columns = docs.columns
    rows = docs.join(taken, docs["doc_id"].eqNullSafe(F.col("mix_doc_id")) & (word_count(docs["text"]) == F.col("mix_size")))
    return rows.withColumn("mix_copy", F.explode(F.array_repeat(F.lit(1), copies))).select(*columns)


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / coalesce(1.0::DOUBLE / (1.0::DOUBLE + 19.0::DOUBLE * (length(text) - length(translate(text, '#*$%&|<>{}[]0123456789', '')))
      / greatest(length(text), 1)), 1.0::DOUBLE) AS key
  FROM documents),
totals AS (SELECT source, count(*) AS n_rows, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight, source_size * 2 AS room
  FROM totals),
walked AS (
  SELECT *, ((sum(source_size) OVER () * 150 / 100.0::DOUBLE) - coalesce(sum(room) OVER before, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level,
    row_number() OVER (ORDER BY room / weight::DOUBLE, source NULLS LAST) AS step
  FROM ranked
  WINDOW before AS (ORDER BY room / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT *, coalesce(least(room::DOUBLE, arg_min(level, step) FILTER (WHERE level * weight < room) OVER () * weight), room::DOUBLE) AS target
  FROM walked),
placed AS (
  SELECT s.doc_id, s.size, s.key, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
  (epochs * size + greatest(least(round(target - epochs * source_size)::BIGINT - ahead, size), 0))::BIGINT AS taken
FROM placed
"""
