"""Lookup joins and the counts that feed them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_counts(events: DataFrame, key: str, name: str = "event_count") -> DataFrame:
    """Rows per key; a missing key is not a customer and is left out."""
    if key not in events.columns:
        raise ValueError(f"Key column {key!r} not found in the event file.")
    return (
        events.where(F.col(f"`{key}`").isNotNull())
        .groupBy(F.col(f"`{key}`").alias(key))
        .agg(F.count(F.lit(1)).alias(name))
    )


def join_counts(customers: DataFrame, counts: DataFrame, customer_key: str, counts_key: str,
                target: str) -> DataFrame:
    """Every customer once, with their count or 0. Repeated keys in `counts` are added up.

    Keys match as text; equal key types are compared as they are, which keeps a
    partitioning by that key usable."""
    left, right = F.col(f"`{customer_key}`"), F.col(f"`{counts_key}`")
    if dict(customers.dtypes)[customer_key] != dict(counts.dtypes)[counts_key]:
        left, right = left.cast("string"), right.cast("string")
    lookup = counts.groupBy(right.alias("__key")).agg(F.sum(target).alias("__count"))
    kept = customers.drop(target)
    return (
        kept.join(lookup, left == F.col("__key"), "left")
        .withColumn(target, F.coalesce("__count", F.lit(0)).cast("int"))
        .drop("__key", "__count")
    )


def profile_lookup(rows: DataFrame, profiles: DataFrame, key: str = "company_id") -> DataFrame:
    """Attach the company profile; rows of unknown companies are left to `unknown_companies`."""
    return rows.join(profiles, key)


def unknown_companies(rows: DataFrame, profiles: DataFrame, key: str = "company_id") -> DataFrame:
    return rows.select(key).distinct().join(profiles.select(key), key, "left_anti")


def align_backtest(forecast: DataFrame, holdout: DataFrame, key: str = "company_id") -> DataFrame:
    """Give the first forecast steps the actual value and date of the held-out rows.

    `forecast(company, step, date, …)`, `holdout(company, step, date, actual)`; steps of
    the holdout count its rows from 1, so the match is by position, not by calendar."""
    actuals = holdout.select(
        key, "step", F.col("date").alias("actual_date"), F.col("actual").cast("double")
    )
    return (
        forecast.join(actuals, [key, "step"], "left")
        .withColumn("date", F.coalesce("actual_date", "date"))
        .withColumn("is_projection", F.col("actual").isNull())
        .drop("actual_date")
    )


def alias_lookup(value, mapping: dict, default=None):
    """Dictionary lookup as an expression: no join, no shuffle."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), value)
    return found if default is None else F.coalesce(found, F.lit(default))


def union_all(*frames: DataFrame) -> DataFrame:
    """Vertical concatenation by column name; absent columns are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
