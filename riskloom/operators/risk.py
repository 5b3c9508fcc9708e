"""Weighted risk score, its parts, its wording and the assessment of all companies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import (
    ANOMALY_SATURATION, FORECAST_SATURATION, LOW_BELOW, MEDIUM_BELOW, RiskWeights,
)
from riskloom.functions.scalars import (
    clip01, half_even_int, humanize_feature, join_readable, one_decimal_percent_text,
    percent_text, safe_signal,
)
from riskloom.operators.signals import IN_LINE

# Names of the signals in the score contract.
SIGNALS = ["churn_prob", "sentiment_positivity", "anomaly_flag_ratio", "forecast_deviation"]
SIGNAL_DEFAULTS = [0.0, 1.0, 0.0, 0.0]
CONTRIBUTIONS = ["Churn", "Sentiment", "Anomalies", "Forecast"]
FACTORS_TYPE = "array<struct<feature:string,value:double>>"


def normalized_terms(churn: Column, positivity: Column, ratio: Column, deviation: Column) -> list[Column]:
    """The four signals as risk shares in [0, 1]."""
    return [
        safe_signal(churn, 0.0),
        F.lit(1.0) - safe_signal(positivity, 1.0),
        clip01(safe_signal(ratio, 0.0) / ANOMALY_SATURATION),
        clip01(safe_signal(deviation, 0.0) / FORECAST_SATURATION),
    ]


def _weighted(signals: list[Column], weights: RiskWeights) -> list[Column]:
    shares = [weights.churn, weights.sentiment, weights.anomaly, weights.forecast]
    return [F.lit(float(w)) * t for w, t in zip(shares, normalized_terms(*signals))]


def risk_score(signals: list[Column], weights: RiskWeights = RiskWeights()) -> Column:
    total = F.lit(0.0)
    for part in _weighted(signals, weights):
        total = total + part
    return clip01(total) * 100


def risk_label(score: Column) -> Column:
    return F.when(score < LOW_BELOW, "Low").when(score < MEDIUM_BELOW, "Medium").otherwise("High")


def risk_colour(score: Column) -> Column:
    return F.when(score < LOW_BELOW, "green").when(score < MEDIUM_BELOW, "orange").otherwise("red")


def signal_contributions(signals: list[Column], weights: RiskWeights = RiskWeights()) -> Column:
    """Points per signal; they add up to the score unless it is clipped."""
    points = [p * 100 for p in _weighted(signals, weights)]
    return F.struct(*[p.alias(n) for p, n in zip(points, CONTRIBUTIONS)])


# The clauses of the sentence.
def explanation_text(factors: Column, sentiment: Column, anomalies: Column, trend: Column) -> Column:
    """One sentence: two main factors, mood, recent anomalies, revenue trend."""
    names = F.transform(F.slice(factors, 1, 2), lambda f: humanize_feature(f["feature"]))
    lead = F.when(
        F.size(factors) > 0,
        F.concat(F.lit("Risk driven primarily by "), join_readable(names)),
    ).otherwise("Risk driven by overall customer churn signals")
    mood = (
        F.when(sentiment == "negative", "customer sentiment is mostly negative")
        .when(sentiment == "neutral", "customer sentiment is flat")
        .when(sentiment == "positive", "customer sentiment is healthy")
        .otherwise("customer sentiment is unclear")
    )
    word = F.when(anomalies == 1, "day").otherwise("days")
    odd = F.when(anomalies > 0, F.concat(
        anomalies.cast("string"), F.lit(" anomalous "), word, F.lit(" detected in the last 30 days")
    ))
    revenue = F.concat(F.lit("revenue is trending "), trend)
    return F.concat(F.concat_ws("; ", lead, mood, odd, revenue), F.lit("."))


def combine_signals(companies: DataFrame, churn: DataFrame, sentiment: DataFrame,
                    anomaly: DataFrame, forecast: DataFrame) -> DataFrame:
    """All companies with their four signals; a company without a table gets the neutral value.

    Every side has one row per company."""
    joined = companies.select("company_id")
    for side in (churn, sentiment, anomaly, forecast):
        joined = joined.join(side, "company_id", "left")
    filled = {
        n: F.coalesce(F.col(n), F.lit(d)) for n, d in zip(SIGNALS, SIGNAL_DEFAULTS)
    }
    texts = {
        "dominant_sentiment": F.coalesce("dominant_sentiment", F.lit("unknown")),
        "recent_anomalies": F.coalesce("recent_anomalies", F.lit(0).cast("bigint")),
        "forecast_trend": F.coalesce("forecast_trend", F.lit(IN_LINE)),
    }
    filled.update({n: c for n, c in texts.items() if n in joined.columns})
    return joined.withColumns(filled)


def assess_companies(signals: DataFrame, factors: DataFrame | None = None,
                     weights: RiskWeights = RiskWeights()) -> DataFrame:
    """Score, band, points, factors and sentence for the output of `combine_signals`.

    The factors come as columns of `signals`, or as `factors(company_id, top_factors,
    explanation_source)`, or not at all."""
    if factors is None and "top_factors" in signals.columns:
        joined = signals
    elif factors is None:
        joined = signals.withColumn("top_factors", F.lit(None).cast(FACTORS_TYPE)).withColumn(
            "explanation_source", F.lit(None).cast("string")
        )
    else:
        joined = signals.join(
            factors.select("company_id", "top_factors", "explanation_source"), "company_id", "left"
        )
    joined = joined.withColumns({
        "top_factors": F.coalesce("top_factors", F.expr("array()").cast(FACTORS_TYPE)),
        "explanation_source": F.coalesce("explanation_source", F.lit("none")),
    })
    values = [F.col(s) for s in SIGNALS]
    scored = joined.withColumn("risk_score", risk_score(values, weights))
    score = F.col("risk_score")
    carried = [c for c in ("dropped_metrics",) if c in joined.columns]
    return scored.select(
        "company_id",
        "risk_score",
        risk_label(score).alias("risk_label"),
        risk_colour(score).alias("risk_colour"),
        F.struct(*SIGNALS).alias("signals"),
        signal_contributions(values, weights).alias("contributions"),
        "top_factors",
        "explanation_source",
        explanation_text(
            F.col("top_factors"), F.col("dominant_sentiment"), F.col("recent_anomalies"),
            F.col("forecast_trend"),
        ).alias("explanation_text"),
        *carried,
    )


def score_breakdown(assessments: DataFrame, weights: RiskWeights = RiskWeights()) -> DataFrame:
    """Four rows per company: signal, readable raw value, weight, points."""
    raw = [
        F.concat(percent_text(F.col("signals.churn_prob")), F.lit(" mean churn probability")),
        F.concat(percent_text(F.col("signals.sentiment_positivity")), F.lit(" review positivity")),
        F.concat(
            half_even_int(F.col("signals.anomaly_flag_ratio") * 30).cast("string"),
            F.lit(" of last 30 days flagged"),
        ),
        F.concat(
            one_decimal_percent_text(F.col("signals.forecast_deviation")),
            F.lit(" projected downside"),
        ),
    ]
    shares = [weights.churn, weights.sentiment, weights.anomaly, weights.forecast]
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("signal_no"), F.lit(name).alias("signal"), text.alias("raw_value"),
            F.lit(float(w)).alias("weight"), F.col(f"contributions.{name}").alias("points"),
        )
        for i, (name, text, w) in enumerate(zip(CONTRIBUTIONS, raw, shares))
    ])
    return assessments.select("company_id", F.inline(rows))


def explanation_method(assessments: DataFrame) -> DataFrame:
    """How the factor chart was computed, from the source tag."""
    source = F.col("explanation_source")
    method = F.element_at(F.split(source, ":"), -1)
    # Heading and caption per method.
    shown = [
        (source == "shap", "SHAP",
         "SHAP values — positive pushes risk up, negative pulls it down."),
        (method == "feature_importances", "model feature importances",
         "SHAP was unavailable, so these are the model's own feature importances: "
         "magnitude only, so they rank drivers without showing direction."),
        (method == "coefficients", "model coefficients",
         "SHAP was unavailable, so these are the absolute model coefficients: "
         "magnitude only, so they rank drivers without showing direction."),
        (method == "permutation", "permutation sensitivity",
         "SHAP was unavailable, so each bar is how much the predicted churn "
         "probability moves when that feature is shuffled — magnitude only."),
    ]
    heading, caption = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for test, h, c in shown:
        heading, caption = heading.when(test, h), caption.when(test, c)
    return assessments.select(
        "company_id", "explanation_source",
        heading.otherwise("").alias("heading"), caption.otherwise("").alias("caption"),
    )
