"""How rows are laid out for work done in Python."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Partition by key into the configured number of shuffle partitions.

    An explicit number is kept as it is, so groups that are small in bytes but heavy to
    compute are not merged into a few tasks."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over the configured number of shuffle partitions, by their place in the input.

    A file of few row groups is read by as few tasks, whatever its rows cost later. The place is the same when a
    task runs again, so no sort is needed."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn("__place", F.monotonically_increasing_id()).repartition(n, "__place").drop("__place")
