"""Scoring all companies in one job."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import EngineConfig
from riskloom.operators import anomaly, churn, forecast, recommend, risk, signals, text, validation
from riskloom.operators.preparation import engineer_features
from riskloom.operators.series import build_features
from riskloom.shipping import ship
from riskloom.sources.scratch import written


@dataclass
class Models:
    """Trained models; a missing one leaves its signal neutral."""

    churn: churn.ChurnModel | None = None
    sentiment: text.SentimentModel | None = None
    forest: DataFrame | None = None
    forecast: DataFrame | None = None


@dataclass
class Bundle:
    """Everything a scoring run gives, as DataFrames keyed by company.

    `release` frees the daily tables that several parts of the run share."""

    assessments: DataFrame
    customers: DataFrame
    reviews: DataFrame
    anomalies: DataFrame
    forecast: DataFrame
    blocked: DataFrame | None = None
    shared: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        for frame in self.shared:
            frame.unpersist()


def combine(companies: DataFrame, churn_table: DataFrame, reviews: DataFrame, anomalies: DataFrame,
            projected: DataFrame, config: EngineConfig) -> DataFrame:
    """Scored tables to assessments with recommendations: one aggregation per table, then
    joins of one row per company."""
    merged = risk.combine_signals(
        companies,
        churn_table,
        signals.review_signals(reviews),
        signals.anomaly_signals(anomalies),
        signals.forecast_signals(projected),
    )
    return recommend.recommendations(risk.assess_companies(merged, None, config.weights))


def flag_days(features: DataFrame, forest: DataFrame | None, config: EngineConfig) -> DataFrame:
    """Daily features with flags from one forest for all companies."""
    if forest is None:
        return anomaly.without_detector(features)
    # the scores are read by the quantile and by the join: written once
    raw = written(anomaly.score_global(features, forest), "day-scores")
    return anomaly.contamination_threshold(raw, config.contamination)


def flag_own_days(features: DataFrame, config: EngineConfig) -> DataFrame:
    """Daily features with flags from a forest fitted on each company's own days."""
    ship(features.sparkSession)
    forest = written(anomaly.train_isolation_forest(
        features, ["company_id", "date"], config.contamination, config.n_trees,
        config.tree_sample, config.seed, group="company_id",
    ), "forest")
    raw = written(anomaly.score_per_group(features, forest), "day-scores")
    return anomaly.contamination_threshold(raw, config.contamination, "company_id")


def score_companies(companies: DataFrame, customers: DataFrame, reviews: DataFrame, daily: DataFrame,
                    models: Models, config: EngineConfig = EngineConfig()) -> Bundle:
    """Known companies: trained churn, sentiment and global anomaly models, and the saved
    forecast table (or a fit on all but the held-out days)."""
    ship(customers.sparkSession)
    features = engineer_features(customers)
    days = build_features(daily).persist()
    scored_reviews = text.score_sentiment(reviews, models.sentiment)
    flagged = flag_days(days, models.forest, config)
    if models.forecast is None:
        projected = forecast.backtest_and_project(days, config.forecast_model, config.horizon_days)
    else:
        projected = forecast.project_saved(days, models.forecast, config.horizon_days)
    assessments = combine(
        companies, churn.company_churn(features, models.churn), scored_reviews, flagged, projected,
        config,
    )
    return Bundle(assessments, churn.score_churn(features, models.churn), scored_reviews, flagged,
                  projected, shared=[days])


def score_uploaded(customers: DataFrame, reviews: DataFrame | None, daily: DataFrame | None,
                   models: Models, config: EngineConfig = EngineConfig(),
                   strict: bool = False) -> Bundle:
    """New companies: all tables are checked first and companies with issues are set aside
    (`strict` raises instead), so a scored company has one row a day; churn and sentiment reuse the trained models; anomaly and
    forecast models are fitted on each company's own days."""
    blocked = written(validation.gate_upload(customers, reviews, daily), "blocked")
    if strict:
        first = blocked.first()
        if first is not None:
            raise ValueError(first.error)
    spark = ship(customers.sparkSession)
    usable = validation.accepted(customers, blocked)
    companies = usable.select("company_id").distinct()
    if reviews is None:
        reviews = spark.createDataFrame([], "company_id string, review_text string")
    if daily is None:
        daily = spark.createDataFrame(
            [], "company_id string, date date, revenue double, active_users bigint, signups bigint"
        )
    reviews = validation.accepted(reviews, blocked)
    daily = validation.accepted(daily, blocked).withColumn("date", F.col("date").cast("date"))

    features = engineer_features(usable)
    if models.sentiment is None:
        scored_reviews = text.score_sentiment(reviews.drop("sentiment_label"), None)
    else:
        scored_reviews = text.score_sentiment(reviews, models.sentiment)
    days = build_features(daily).persist()
    flagged = flag_own_days(days, config)
    ready = validation.forecast_readiness(days).select("company_id", "holdout_days")
    projected = forecast.backtest_by_holdout(days.join(ready, "company_id"), config.forecast_model)
    assessments = combine(
        companies, churn.company_churn(features, models.churn), scored_reviews, flagged, projected,
        config,
    )
    quality = validation.data_quality(companies, usable, reviews, days)
    facts = F.struct("customers", "reviews", "timeseries_days", "forecast_note").alias("data_quality")
    assessments = assessments.join(quality.select("company_id", facts), "company_id").withColumn(
        "profile", F.lit("Uploaded")
    )
    return Bundle(assessments, churn.score_churn(features, models.churn), scored_reviews, flagged,
                  projected, blocked, [days])
