"""Dashboard figures and exploratory profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.config import RECENT_ROWS, SENTIMENT_LABELS
from riskloom.functions.scalars import half_even, nan_to_null, parse_number
from riskloom.operators.ordering import exact_quantiles

# Risk bins (above, up to, shown as); the first includes its lower edge.
RISK_BINS = [
    (0.0, 0.2, "0-20%"), (0.2, 0.4, "20-40%"), (0.4, 0.6, "40-60%"), (0.6, 0.8, "60-80%"),
    (0.8, 1.0, "80-100%"),
]


def _rows() -> Column:
    return F.count(F.lit(1))


def long_numeric(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """One row per (input row, column): `column_name, value`."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
        for c in columns
    ])
    return df.select(*keep, F.inline(cells))


def churn_kpis(scored: DataFrame) -> DataFrame:
    p = nan_to_null(parse_number(F.col("churn_prob")))
    return scored.groupBy("company_id").agg(
        _rows().alias("customers"), F.avg(p).alias("mean_churn_prob"),
        F.count_if(p >= 0.5).alias("high_risk"), F.max(p).alias("max_churn_prob"),
    )


def high_risk_mask(scored: DataFrame) -> DataFrame:
    return scored.where("churn_prob >= 0.5")


def risk_histogram(scored: DataFrame) -> DataFrame:
    """Customers per 20-point risk bin; empty bins are there with 0."""
    p = F.col("churn_prob")
    counts = [
        F.count_if(((p > low) | ((p == low) & (i == 0))) & (p <= high)).alias(f"b{i}")
        for i, (low, high, _) in enumerate(RISK_BINS)
    ]
    stats = scored.groupBy("company_id").agg(*counts)
    rows = F.array(*[
        F.struct(F.lit(name).alias("risk_bin"), F.col(f"b{i}").alias("customers"))
        for i, (_, _, name) in enumerate(RISK_BINS)
    ])
    return stats.select("company_id", F.inline(rows))


def sentiment_mix(scored: DataFrame) -> DataFrame:
    label = F.col("label")
    return scored.groupBy("company_id").agg(
        _rows().alias("reviews"),
        *[F.count_if(label == name).alias(name) for name in SENTIMENT_LABELS],
        F.avg(nan_to_null(parse_number(F.col("score")))).alias("mean_positivity"),
    )


def weekly_positivity(scored: DataFrame) -> DataFrame:
    """Mean score per week ending on Sunday; weeks without reviews are there with NULL."""
    week = F.next_day(F.date_sub("review_date", 1), "SUN")
    score = nan_to_null(parse_number(F.col("score")))
    means = scored.where(score.isNotNull()).groupBy("company_id", week.alias("week_end")).agg(
        F.avg(score).alias("mean_score"), _rows().alias("reviews")
    )
    spine = means.groupBy("company_id").agg(
        F.min("week_end").alias("first_week"), F.max("week_end").alias("last_week")
    ).select(
        "company_id",
        F.explode(F.sequence("first_week", "last_week", F.expr("interval 7 days"))).alias("week_end"),
    )
    return spine.join(means, ["company_id", "week_end"], "left").withColumn(
        "reviews", F.coalesce("reviews", F.lit(0))
    )


def anomaly_kpis(flagged: DataFrame, n: int = RECENT_ROWS) -> DataFrame:
    """Days, flags, recent flags and flag rate; a company has one row per calendar day."""
    recency = F.row_number().over(Window.partitionBy("company_id").orderBy(F.col("date").desc()))
    flag = F.col("is_anomaly")
    return flagged.select("company_id", "is_anomaly", recency.alias("recency")).groupBy(
        "company_id"
    ).agg(
        _rows().alias("days"), F.count_if(flag).alias("flagged"),
        F.count_if(flag & (F.col("recency") <= n)).alias("flagged_recent"),
        F.avg(flag.cast("double")).alias("flag_rate"),
    )


def forecast_kpis(forecast: DataFrame) -> DataFrame:
    """Backtest errors in percent and units, current and projected level, relative change."""
    actual, predicted = F.col("actual"), F.col("forecast")
    error = F.abs(actual - predicted)
    stats = forecast.groupBy("company_id").agg(
        (F.avg(F.try_divide(error, F.abs(actual))) * 100).alias("backtest_mape"),
        F.avg(error).alias("backtest_mae"),
        F.avg(actual).alias("current_level"),
        F.avg(F.when(actual.isNull(), predicted)).alias("projected_level"),
    )
    return stats.withColumn(
        "projected_change",
        F.try_divide(F.col("projected_level") - F.col("current_level"), F.col("current_level")),
    )


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    stats = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(columns)])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("nulls"))
        for i, c in enumerate(columns)
    ])
    return stats.select(F.inline(rows))


def describe_columns(df: DataFrame, numeric: list[str], text: list[str] = ()) -> DataFrame:
    """Count, moments, exact quartiles of numbers; distinct values, top value of text."""
    cells = long_numeric(df, numeric)
    moments = cells.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quarts = exact_quantiles(cells, ["column_name"], "value", [0.25, 0.5, 0.75], few_groups=True)
    out = moments.join(
        quarts.select("column_name", F.col("q0").alias("q25"), F.col("q1").alias("q50"),
                      F.col("q2").alias("q75")),
        "column_name",
        "left",
    )
    for column in text:
        counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(_rows().alias("n"))
        best = F.struct(-F.col("n"), F.col(column))
        out = out.unionByName(
            counts.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("count"), _rows().alias("unique"),
                F.min_by(column, best).alias("top"), F.max("n").alias("freq"),
            ).withColumn("column_name", F.lit(column)),
            allowMissingColumns=True,
        )
    return out


def class_balance(df: DataFrame, label: str) -> DataFrame:
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(_rows().alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def label_correlation(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    stats = df.agg(*[
        F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c) for c in columns
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("correlation")) for c in columns
    ])
    return stats.select(F.inline(rows)).orderBy(F.abs("correlation").desc(), "column_name")


def means_by_label(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    return df.groupBy(label).agg(*[half_even(F.avg(c), 2).alias(c) for c in columns])


def churn_rate_by_plan(df: DataFrame, plan: str = "plan_type", label: str = "churn_label") -> DataFrame:
    """Row-normalised plan x label table."""
    return df.groupBy(plan).agg(
        F.avg(F.when(F.col(label) == 0, 1.0).otherwise(0.0)).alias("stayed"),
        F.avg(F.when(F.col(label) == 1, 1.0).otherwise(0.0)).alias("churned"),
    )


def numeric_histogram(df: DataFrame, columns: list[str], bins: int = 30) -> DataFrame:
    """Equal-width bins between each column's extremes, empty bins included."""
    cells = long_numeric(df, columns).where("value is not null")
    edges = cells.groupBy("column_name").agg(
        F.min("value").alias("low"), F.max("value").alias("high")
    )
    width = (F.col("high") - F.col("low")) / bins
    place = F.least(
        F.floor(F.coalesce(F.try_divide(F.col("value") - F.col("low"), width), F.lit(0.0))),
        F.lit(bins - 1),
    )
    # one row per column name: `columns` is a setting
    counts = cells.join(F.broadcast(edges), "column_name").groupBy(
        "column_name", place.cast("int").alias("bin_no")
    ).agg(_rows().alias("n"))
    spine = edges.select(
        "column_name", "low", width.alias("width"),
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin_no"),
    )
    return spine.join(counts, ["column_name", "bin_no"], "left").select(
        "column_name", "bin_no", (F.col("low") + F.col("bin_no") * F.col("width")).alias("bin_low"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def review_length_stats(reviews: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """Words per review by label. Lengths are counted before the median is taken."""
    text = F.trim(F.regexp_replace("review_text", r"\s+", " "))
    words = F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))
    sized = reviews.where(F.col("review_text").isNotNull()).select(label, words.alias("words"))
    stats = sized.groupBy(label).agg(
        _rows().alias("count"), half_even(F.avg("words"), 2).alias("mean"),
        F.min("words").alias("min"), F.max("words").alias("max"),
    )
    middle = exact_quantiles(sized, [label], "words", [0.5], few_groups=True)
    return stats.join(middle.select(label, F.col("q0").alias("median")), label)


def rating_by_sentiment(reviews: DataFrame, label: str = "sentiment_label") -> DataFrame:
    stars = F.col("star_rating")
    return reviews.groupBy(label).agg(
        half_even(F.avg(stars), 2).alias("mean"), F.min(stars).alias("min"), F.max(stars).alias("max")
    )


def company_summary(daily: DataFrame, truth: str | None = None) -> DataFrame:
    """Date range, rows, injected anomalies where known, and metric levels."""
    aggs = [
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        _rows().alias("days"),
        half_even(F.avg("revenue"), 2).alias("mean_revenue"),
        half_even(F.min("revenue"), 2).alias("min_revenue"),
        half_even(F.max("revenue"), 2).alias("max_revenue"),
        half_even(F.avg("active_users"), 2).alias("mean_active_users"),
        half_even(F.avg("signups"), 2).alias("mean_signups"),
    ]
    if truth:
        aggs.append(F.count_if(F.col(truth)).alias("injected_anomalies"))
    return daily.groupBy("company_id").agg(*aggs)


def revenue_change(daily: DataFrame) -> DataFrame:
    """Last over first revenue, in percent."""
    ends = daily.groupBy("company_id").agg(
        F.min_by("revenue", "date").alias("first_revenue"),
        F.max_by("revenue", "date").alias("last_revenue"),
    )
    change = (F.try_divide(F.col("last_revenue"), F.col("first_revenue")) - 1) * 100
    return ends.withColumn("change_percent", change)


def metric_pivot(daily: DataFrame, metric: str, company_ids: list[str]) -> DataFrame:
    """Date x company matrix; the columns have to be named up front."""
    return daily.groupBy("date").pivot("company_id", company_ids).agg(F.first(metric))
