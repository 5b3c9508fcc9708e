"""Exact ranks, cuts and quantiles that never put a whole group into one task.

The common trick: count rows per (group, bucket) with an order-preserving bucket, add the
counts up over the small bucket table, and only look inside the buckets that matter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUANTILE_ACCURACY = 100_000
# How far a bracket may reach from its rank, as a share of the group: the narrowest that
# holds four rows on each side.
BRACKETS = (1.0, 1e-1, 1e-2, 1e-3, 1e-4)


def hash_bucket(key: Column) -> Column:
    """First three hex digits of a digest: 4096 buckets in digest order."""
    return F.substring(key, 1, 3)


def running_totals(values: DataFrame, by: list[str], bucket: Column, order: list[Column],
                   sums: list[str]) -> DataFrame:
    """Add `<name>_before`, the total of `name` over all earlier rows of the group.

    `bucket` must not decrease along `order` and have few distinct values; sorting then
    happens inside (group, bucket) only."""
    marked = values.withColumn("__slab", bucket)
    totals = marked.groupBy(*by, "__slab").agg(*[F.sum(c).alias(f"__t_{c}") for c in sums])
    earlier = Window.partitionBy(*by).orderBy("__slab").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        *by, "__slab",
        *[F.coalesce(F.sum(f"__t_{c}").over(earlier), F.lit(0)).alias(f"__o_{c}") for c in sums],
    )
    inside = Window.partitionBy(*by, "__slab").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    keys = [*by, "__slab"]
    out = marked.join(offsets, keys)
    for c in sums:
        out = out.withColumn(
            f"{c}_before", F.col(f"__o_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))
        )
    return out.drop("__slab", *[f"__o_{c}" for c in sums])


def digest_cutoffs(rows: DataFrame, by: list[str], key: str, wanted: DataFrame) -> DataFrame:
    """Per group the digest of the n-th row in digest order, n = `wanted(by…, n)`.

    Groups are classes or settings, so the cuts broadcast. Groups with n <= 0 are absent; n
    beyond the group size gives its last digest. Only the bucket holding the cut is ranked."""
    keyed = rows.select(*by, F.col(key).alias("__key")).withColumn(
        "__bucket", hash_bucket(F.col("__key"))
    )
    counts = keyed.groupBy(*by, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    spread = running_totals(
        counts, by, F.substring("__bucket", 1, 1), [F.col("__bucket")], ["__n"]
    )
    sizes = counts.groupBy(*by).agg(F.sum("__n").alias("__size"))
    cut = (
        spread.join(sizes.join(wanted.where("n > 0"), by), by)
        .withColumn("__rank", F.least("n", "__size") - F.col("__n_before"))
        .where("__rank >= 1 and __rank <= __n")
        .select(*by, "__bucket", "__rank")
    )
    ranked = keyed.join(F.broadcast(cut), [*by, "__bucket"]).withColumn(
        "__pos",
        F.row_number().over(Window.partitionBy(*by, "__bucket").orderBy("__key")),
    )
    return ranked.where("__pos = __rank").select(*by, F.col("__key").alias("cut_key"))


def exact_quantiles(rows: DataFrame, by: list[str], value: str, probs: list[float],
                    few_groups: bool = False) -> DataFrame:
    """Linear-interpolated quantiles per group as `q0, q1, …`, plus the non-null count `n`.

    A mergeable sketch brackets each wanted rank, by a share that shrinks as the group grows; the
    exact values are then picked among the distinct values inside the bracket. `few_groups`
    says that the groups are settings (columns, classes), so one row each may broadcast."""
    side = F.broadcast if few_groups or not by else (lambda df: df)
    data = rows.select(*by, F.col(value).cast("double").alias("__v")).where("__v is not null")
    lows = [max(p - w, 0.0) for p in probs for w in BRACKETS]
    highs = [min(p + w, 1.0) for p in probs for w in BRACKETS]
    chosen = sum((F.when(F.col("n") * w >= 4, 1).otherwise(0) for w in BRACKETS[1:]), F.lit(0))
    sketch = data.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("__v").alias("__min"),
        F.max("__v").alias("__max"),
        F.percentile_approx("__v", lows, QUANTILE_ACCURACY).alias("__lows"),
        F.percentile_approx("__v", highs, QUANTILE_ACCURACY).alias("__highs"),
    )
    marks = []
    for i, p in enumerate(probs):
        at = F.lit(i * len(BRACKETS)) + chosen
        low = F.when(F.get(F.array(*map(F.lit, lows)), at) == 0.0, F.col("__min")).otherwise(F.get("__lows", at))
        high = F.when(F.get(F.array(*map(F.lit, highs)), at) == 1.0, F.col("__max")).otherwise(F.get("__highs", at))
        rank = F.lit(p) * (F.col("n") - 1)
        marks.append(F.struct(
            F.lit(i).alias("i"), low.alias("low"), high.alias("high"),
            F.floor(rank).cast("bigint").alias("r0"), F.ceil(rank).cast("bigint").alias("r1"),
            (rank - F.floor(rank)).alias("w"),
        ))
    brackets = sketch.select(*by, "n", F.array(*marks).alias("__marks"))
    joined = data.join(side(brackets), by) if by else data.crossJoin(side(brackets))
    inside = F.exists("__marks", lambda m: F.col("__v").between(m["low"], m["high"]))
    span = range(len(probs))
    pooled = joined.groupBy(*by, F.when(inside, F.col("__v")).alias("__v")).agg(
        F.count(F.lit(1)).alias("__c"), F.first("n").alias("n"),
        F.first("__marks").alias("__marks"),
        *[
            F.count_if(F.col("__v") < F.get("__marks", F.lit(i))["low"]).alias(f"__s{i}")
            for i in span
        ],
    )
    below = pooled.groupBy(*by).agg(*[F.sum(f"__s{i}").alias(f"__b{i}") for i in span])
    distinct = pooled.where("__v is not null").drop(*[f"__s{i}" for i in span])
    facts = distinct.join(side(below), by) if by else distinct.crossJoin(side(below))
    ordered = Window.partitionBy(*by, "__i").orderBy("__v")
    exploded = facts.select(
        *by, "n", "__v", "__c",
        F.explode(
            F.array(*[
                F.struct(F.get("__marks", F.lit(i)).alias("m"), F.col(f"__b{i}").alias("b"))
                for i in range(len(probs))
            ])
        ).alias("__x"),
    ).where("__v between __x.m.low and __x.m.high")
    placed = (
        exploded.withColumn("__i", F.col("__x.m.i"))
        .withColumn("__end", F.col("__x.b") + F.sum("__c").over(ordered))
        .withColumn("__start", F.col("__end") - F.col("__c"))
    )

    def at(rank: str, i: int) -> Column:
        hit = (
            (F.col("__i") == i)
            & (F.col("__start") <= F.col(f"__x.m.{rank}"))
            & (F.col(f"__x.m.{rank}") < F.col("__end"))
        )
        return F.max(F.when(hit, F.col("__v")))

    picks = []
    for i in range(len(probs)):
        weight = F.max(F.when(F.col("__i") == i, F.col("__x.m.w")))
        picks.append((at("r0", i) + (at("r1", i) - at("r0", i)) * weight).alias(f"q{i}"))
    return placed.groupBy(*by).agg(F.first("n").alias("n"), *picks)


def average_percent_rank(rows: DataFrame, by: list[str], value: str, weight: Column | None = None) -> DataFrame:
    """Per distinct value the average-tie percent rank, with its exact integer parts.

    Output `(by…, value, peers, before, total, pct_rank)`: join it back on the value. The
    sort runs inside log-scaled value buckets. `weight` counts a row several times."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(
        F.sum(F.lit(1) if weight is None else weight).alias("peers")
    )
    number = F.col(value).cast("double")
    bucket = F.floor(F.signum(number) * F.log1p(F.abs(number)) * 64).cast("bigint")
    placed = running_totals(counts, by, bucket, [F.col(value)], ["peers"])
    totals = counts.groupBy(*by).agg(F.sum("peers").alias("total"))
    joined = placed.join(totals, by) if by else placed.crossJoin(F.broadcast(totals))
    return joined.select(
        *by, value, "peers", F.col("peers_before").alias("before"), "total",
        ((F.col("before") + (F.col("peers") + 1) / 2) / F.col("total")).alias("pct_rank"),
    )
