"""Missing values, encoding, scaling and splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskloom.config import CHURN_BASE_COLUMNS
from riskloom.functions.scalars import seeded_key
from riskloom.operators.ordering import digest_cutoffs, exact_quantiles

MAX_CATEGORIES = 1000


def engineer_features(customers: DataFrame) -> DataFrame:
    """Churn features as a projection: no shuffle."""
    absent = [c for c in CHURN_BASE_COLUMNS if c not in customers.columns]
    if absent:
        raise ValueError(f"Missing churn feature columns: {absent}")
    usage, tenure = F.col("usage_frequency"), F.col("tenure")

    def flag(test: Column) -> Column:
        return F.coalesce(test, F.lit(False)).cast("int")

    return customers.withColumns({
        "spend_per_login": F.try_divide(F.col("monthly_spend"), usage + 1),
        "tickets_per_tenure": F.try_divide(F.col("support_tickets"), tenure + 1),
        "usage_per_tenure": F.try_divide(usage, tenure + 1),
        # fixed values: the three limits
        "low_usage_flag": flag(usage <= 4),
        "high_ticket_flag": flag(F.col("support_tickets") >= 1),
        "early_customer_flag": flag(tenure <= 6),
    })


def _is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """One row: the smallest of the most frequent values; counted per value before picking."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.min_by(column, F.struct(-F.col("n"), F.col(column))).alias("fill")
    )


def _long(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, column_name, value): the columns under each other, for one pass over all."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keys, F.inline(cells))


def fill_values(df: DataFrame, columns: list[str], strategy: str) -> DataFrame:
    """One row holding the fill value of every column."""
    one = None
    means = [c for c in columns if _is_numeric(df, c) and strategy == "mean"]
    if means:
        one = df.agg(*[F.avg(c).alias(c) for c in means])
    medians = [c for c in columns if _is_numeric(df, c) and strategy == "median"]
    if medians:
        middle = exact_quantiles(_long(df, [], medians), ["column_name"], "value", [0.5], few_groups=True)
        value = middle.agg(*[F.max(F.when(F.col("column_name") == c, F.col("q0"))).alias(c) for c in medians])
        one = value if one is None else one.crossJoin(F.broadcast(value))
    for column in columns:
        if column in means or column in medians:
            continue
        default = F.lit(0) if _is_numeric(df, column) else F.lit("unknown")
        value = most_frequent(df, column).select(
            F.coalesce(F.col("fill"), default.cast(df.schema[column].dataType)).alias(column)
        )
        one = value if one is None else one.crossJoin(F.broadcast(value))
    return one


def fill_missing(df: DataFrame, columns: list[str], strategy: str = "median") -> DataFrame:
    """Fill NULLs of the given columns; text always takes its mode. `drop` removes rows
    with any NULL instead. Mean and median make a whole-number column a double."""
    if strategy not in {"median", "mean", "mode", "drop"}:
        raise ValueError("strategy must be one of: median, mean, mode, drop")
    if strategy == "drop":
        return df.dropna()
    fills = fill_values(df, columns, strategy).select(
        *[F.col(c).alias(f"__fill_{c}") for c in columns]
    )
    joined = df.crossJoin(F.broadcast(fills))
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"__fill_{c}")) for c in columns}
    ).select(*df.columns)


def categories(df: DataFrame, column: str) -> list[str]:
    """Distinct values for the one-hot layout, refused beyond `MAX_CATEGORIES`.

    Column names of a wide table must be known before it is planned, hence the read."""
    found = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string")).distinct()
    names = [r[0] for r in found.limit(MAX_CATEGORIES + 1).collect()]
    if len(names) > MAX_CATEGORIES:
        raise ValueError(f"Column {column!r} has more than {MAX_CATEGORIES} categories")
    return sorted(names)


def encode_categorical(df: DataFrame, columns: list[str]) -> DataFrame:
    """One 0/1 column `<column>_<value>` per value; NULL is 0 everywhere."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"Missing columns: {absent}")
    out = [c for c in df.columns if c not in columns]
    dummies = [
        F.coalesce((F.col(c).cast("string") == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c in columns
        for v in categories(df, c)
    ]
    return df.select(*out, *dummies)


def scale_numeric(df: DataFrame, columns: list[str], method: str = "standard") -> DataFrame:
    """z-score with the population deviation, or min-max. A constant column becomes 0."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"Missing columns: {absent}")
    if method not in {"standard", "minmax"}:
        raise ValueError("method must be one of: standard, minmax")
    if not columns:
        return df
    low, spread = (F.avg, F.stddev_pop) if method == "standard" else (
        F.min, lambda c: F.max(c) - F.min(c)
    )
    stats = df.agg(*[low(c).alias(f"__a_{c}") for c in columns],
                   *[spread(c).alias(f"__b_{c}") for c in columns])

    def scaled(c: str) -> Column:
        shifted = F.col(c) - F.col(f"__a_{c}")
        return F.when(F.col(f"__b_{c}") == 0, shifted * 0.0).otherwise(
            F.try_divide(shifted, F.col(f"__b_{c}"))
        )

    joined = df.crossJoin(F.broadcast(stats))
    return joined.withColumns({c: scaled(c) for c in columns}).select(*df.columns)


def robust_scale(df: DataFrame, columns: list[str], by: str = "company_id") -> DataFrame:
    """(x - median) / interquartile range per company; a zero range only centres."""
    quarts = exact_quantiles(_long(df, [by], columns), [by, "column_name"], "value", [0.25, 0.5, 0.75])
    iqr = F.col("q2") - F.col("q0")
    wide = quarts.groupBy(by).agg(*[x for c in columns for x in (
        F.max(F.when(F.col("column_name") == c, F.col("q1"))).alias(f"__median_{c}"),
        F.max(F.when(F.col("column_name") == c, F.when(iqr == 0, F.lit(1.0)).otherwise(iqr))).alias(f"__unit_{c}"))])
    out = df.join(wide, by, "left")
    scaled = {f"{c}_scaled": (F.col(c) - F.col(f"__median_{c}")) / F.col(f"__unit_{c}") for c in columns}
    return out.withColumns(scaled).drop(*[f"__{k}_{c}" for c in columns for k in ("median", "unit")])


def split_stratified(df: DataFrame, id_column: str, label: str, test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Add `is_test`: per label the rows with the smallest seeded digests, exactly
    round(n * test_size) of them. The big table is only scanned, never shuffled."""
    keyed = df.withColumn("__digest", seeded_key(seed, F.col(id_column)))
    wanted = keyed.groupBy(label).agg(
        F.bround(F.count(F.lit(1)) * F.lit(test_size), 0).cast("bigint").alias("n")
    )
    cuts = digest_cutoffs(keyed.select(label, "__digest"), [label], "__digest", wanted)
    return (
        keyed.join(F.broadcast(cuts), label, "left")
        .withColumn("is_test", F.coalesce(F.col("__digest") <= F.col("cut_key"), F.lit(False)))
        .drop("__digest", "cut_key")
    )


def split_chronological(daily: DataFrame, test_days: int = 30, key: str = "company_id",
                        date: str = "date") -> DataFrame:
    """Add `is_test` for the last rows by date, and why a company cannot be split.

    A company has at most one row per calendar day, which bounds the window."""
    if test_days <= 0:
        raise ValueError("test_days must be positive")
    return split_by_holdout(daily.withColumn("holdout_days", F.lit(test_days)), key, date).drop(
        "holdout_days"
    )


def split_by_holdout(daily: DataFrame, key: str = "company_id", date: str = "date") -> DataFrame:
    """As `split_chronological` with the number of held-out rows in `holdout_days`."""
    recent = Window.partitionBy(key).orderBy(F.col(date).desc())
    n_rows = F.count(F.lit(1)).over(Window.partitionBy(key))
    short = F.col("__n") <= F.col("holdout_days")
    return (
        daily.withColumn("recency", F.row_number().over(recent))
        .withColumn("__n", n_rows)
        .withColumn("is_test", ~short & (F.col("recency") <= F.col("holdout_days")))
        .withColumn("skipped_reason", F.when(short, F.concat(
            F.lit("Need more than "), F.col("holdout_days").cast("string"),
            F.lit(" rows to split; got "), F.col("__n").cast("string"))))
        .drop("__n")
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """`(label, n, weight)` with weight n / (classes * n_label), and `positive_weight`,
    the negatives per positive, for 0/1 labels. One row per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()
    return counts.withColumn(
        "weight", F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))
    ).withColumn(
        "positive_weight",
        F.greatest(F.sum(F.when(F.col(label).cast("string") == "0", F.col("n")).otherwise(0)).over(every), F.lit(1))
        / F.greatest(F.sum(F.when(F.col(label).cast("string") == "1", F.col("n")).otherwise(0)).over(every), F.lit(1)),
    )
