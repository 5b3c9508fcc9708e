"""Company-level signals, each one aggregation with map-side combine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import METRIC_DROP, RECENT_ROWS, SERIES_COLUMNS
from riskloom.functions.scalars import clip01, half_even_int, nan_to_null, parse_number
from riskloom.operators.ranking import last_n_rows

IN_LINE = "in line with forecast"
TINY = 1e-9


def _number(df: DataFrame, name: str):
    """A column as a double, NULL where it is no number; only text needs parsing."""
    column = F.col(name)
    if dict(df.dtypes).get(name) == "string":
        column = parse_number(column)
    return nan_to_null(column.cast("double"))


def signal_churn(scored: DataFrame) -> DataFrame:
    return scored.groupBy("company_id").agg(
        F.coalesce(F.avg(_number(scored, "churn_prob")), F.lit(0.0)).alias("churn_prob")
    )


def _mean_score(scored: DataFrame) -> Column:
    """The mean of the scores, summed as exact decimals so that no order of rows changes it."""
    score = _number(scored, "score").cast("decimal(20,15)")
    return F.try_divide(F.sum(score).cast("double"), F.count(score))


def signal_sentiment(scored: DataFrame) -> DataFrame:
    return scored.groupBy("company_id").agg(
        F.coalesce(_mean_score(scored), F.lit(1.0)).alias("sentiment_positivity")
    )


def dominant_sentiment(scored: DataFrame) -> DataFrame:
    """Verdict by mean positivity, by the most frequent label where no score exists."""
    stats = scored.groupBy("company_id").agg(
        _mean_score(scored).alias("m"), F.mode("label", True).alias("top_label")
    )
    verdict = (
        F.when(F.col("m") < 0.45, "negative")
        .when(F.col("m") < 0.6, "neutral")
        .when(F.col("m").isNotNull(), "positive")
        .otherwise(F.coalesce("top_label", F.lit("unknown")))
    )
    return stats.select("company_id", verdict.alias("dominant_sentiment"))


def review_signals(scored: DataFrame) -> DataFrame:
    """Positivity and verdict in one pass."""
    stats = scored.groupBy("company_id").agg(
        _mean_score(scored).alias("m"), F.mode("label", True).alias("top_label")
    )
    verdict = (
        F.when(F.col("m") < 0.45, "negative")
        .when(F.col("m") < 0.6, "neutral")
        .when(F.col("m").isNotNull(), "positive")
        .otherwise(F.coalesce("top_label", F.lit("unknown")))
    )
    return stats.select(
        "company_id", F.coalesce("m", F.lit(1.0)).alias("sentiment_positivity"),
        verdict.alias("dominant_sentiment"),
    )


def _recent_stats(flagged: DataFrame, n: int) -> DataFrame:
    recent = last_n_rows(flagged, n)
    flag = F.coalesce(F.col("is_anomaly"), F.lit(False))
    aggs = [
        F.avg(flag.cast("double")).alias("anomaly_flag_ratio"),
        F.count_if(flag).alias("recent_anomalies"),
    ]
    for c in [c for c in SERIES_COLUMNS if c in flagged.columns]:
        aggs.append(F.avg(_number(flagged, c)).alias(f"__all_{c}"))
        aggs.append(F.avg(F.when(flag, _number(flagged, c))).alias(f"__flag_{c}"))
    return recent.groupBy("company_id").agg(*aggs)


def anomaly_signals(flagged: DataFrame, n: int = RECENT_ROWS) -> DataFrame:
    """Flag share, flag count and the metrics that fell on flagged days, over the last rows."""
    stats = _recent_stats(flagged, n)
    fell = []
    for c in [c for c in SERIES_COLUMNS if c in flagged.columns]:
        drop = F.try_divide(F.col(f"__flag_{c}") - F.col(f"__all_{c}"), F.abs(f"__all_{c}"))
        fell.append(F.when(drop < METRIC_DROP, F.lit(c)))
    dropped = F.array_compact(F.array(*fell)) if fell else F.array().cast("array<string>")
    return stats.select(
        "company_id", "anomaly_flag_ratio", "recent_anomalies", dropped.alias("dropped_metrics")
    )


def signal_anomaly_ratio(flagged: DataFrame, n: int = RECENT_ROWS) -> DataFrame:
    return _recent_stats(flagged.select("company_id", "date", "is_anomaly"), n).select(
        "company_id", "anomaly_flag_ratio"
    )


def recent_anomaly_count(flagged: DataFrame, n: int = RECENT_ROWS) -> DataFrame:
    return _recent_stats(flagged.select("company_id", "date", "is_anomaly"), n).select(
        "company_id", "recent_anomalies"
    )


def dropped_metrics(flagged: DataFrame, n: int = RECENT_ROWS) -> DataFrame:
    return anomaly_signals(flagged, n).select("company_id", "dropped_metrics")


def forecast_signals(forecast: DataFrame) -> DataFrame:
    """Downside deviation and the trend phrase from one conditional aggregation.

    Rows with both values are the backtest; rows with a forecast only are the projection."""
    actual, predicted = _number(forecast, "actual"), _number(forecast, "forecast")
    paired = actual.isNotNull() & predicted.isNotNull()
    ahead = actual.isNull() & predicted.isNotNull()
    means = forecast.groupBy("company_id").agg(
        F.avg(F.when(paired, predicted)).alias("f"),
        F.avg(F.when(paired, actual)).alias("a"),
        F.avg(F.when(ahead, predicted)).alias("p"),
    )
    f, a, p = F.col("f"), F.col("a"), F.col("p")
    shortfall = F.when(F.abs(f) > TINY, F.greatest((f - a) / F.abs(f), F.lit(0.0)))
    decline = F.when(
        p.isNotNull() & (F.abs(a) > TINY), F.greatest((a - p) / F.abs(a), F.lit(0.0))
    )
    parts = F.array_compact(F.array(shortfall, decline))
    total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    deviation = F.when(F.size(parts) > 0, clip01(total / F.size(parts))).otherwise(0.0)
    gap = F.when(F.abs(f) >= TINY, (a - f) / F.abs(f))
    percent = half_even_int(F.abs(gap) * 100).cast("string")
    trend = (
        F.when(gap < -0.05, F.concat(percent, F.lit("% below forecast")))
        .when(gap > 0.05, F.concat(percent, F.lit("% above forecast")))
        .otherwise(IN_LINE)
    )
    return means.select(
        "company_id", deviation.alias("forecast_deviation"), trend.alias("forecast_trend")
    )


def signal_forecast_deviation(forecast: DataFrame) -> DataFrame:
    return forecast_signals(forecast).select("company_id", "forecast_deviation")


def forecast_trend(forecast: DataFrame) -> DataFrame:
    return forecast_signals(forecast).select("company_id", "forecast_trend")
