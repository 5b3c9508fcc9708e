"""Training all models and persisting them with their metrics."""

from __future__ import annotations

from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.config import EngineConfig
from riskloom.operators import anomaly, churn, forecast, text
from riskloom.operators.preparation import engineer_features, split_by_holdout, split_stratified
from riskloom.operators.series import build_features
from riskloom.plans.scoring import Models
from riskloom.shipping import ship
from riskloom.sources.files import write_metrics, write_table
from riskloom.sources.scratch import written


@dataclass
class Trained:
    models: Models
    churn_metrics: DataFrame | None = None
    best_churn: str | None = None
    sentiment_metrics: DataFrame | None = None
    anomaly_metrics: DataFrame | None = None
    forecast_metrics: DataFrame | None = None
    candidates: dict[str, churn.ChurnModel] = field(default_factory=dict)


def train_churn_models(customers: DataFrame, config: EngineConfig, families=None, settings=None):
    """Candidates on the training split; the best by ROC-AUC on the held-out rows."""
    split = split_stratified(
        engineer_features(customers), "customer_id", "churn_label", config.test_size, config.seed
    ).persist()
    candidates = churn.train_candidates(
        split.where("not is_test"), config.seed, families or churn.FAMILIES, settings
    )
    metrics = written(churn.candidate_metrics(candidates, split.where("is_test")), "churn-metrics")
    best = churn.select_best(metrics).first().best_model
    split.unpersist()
    return candidates[best], candidates, metrics, best


def train_all(customers: DataFrame, reviews: DataFrame, daily: DataFrame,
              config: EngineConfig = EngineConfig(), truth: str | None = None, families=None,
              settings=None) -> Trained:
    """Fit churn, sentiment, anomaly and forecast models; metrics come as DataFrames. Fitted
    tables are written to the shared folder."""
    spark = ship(customers.sparkSession)

    def reviewed() -> tuple[text.SentimentModel, DataFrame]:
        split = split_stratified(reviews, "review_id", "sentiment_label", config.test_size, config.seed)
        model = text.train_sentiment(
            split.where("not is_test"), max_features=config.max_features, min_df=config.min_df
        )
        return model, text.evaluate_sentiment(text.score_sentiment(split.where("is_test"), model))

    # both have steps of few tasks: they run side by side
    with ThreadPool(1) as pool:
        waiting = pool.apply_async(inheritable_thread_target(spark)(reviewed))
        best_model, candidates, churn_metrics, best = train_churn_models(customers, config, families, settings)
        sentiment, sentiment_metrics = waiting.get()

    features = build_features(daily).persist()
    forest = written(anomaly.train_isolation_forest(
        features, ["company_id", "date"], config.contamination, config.n_trees,
        config.tree_sample, config.seed,
    ), "forest")
    anomaly_metrics = None
    if truth:
        flagged = anomaly.contamination_threshold(
            anomaly.score_global(features, forest), config.contamination
        )
        anomaly_metrics = anomaly.evaluate_anomalies(flagged, truth)

    days = split_by_holdout(features.withColumn("holdout_days", F.lit(config.horizon_days))).where(
        "skipped_reason is null"
    )
    fitted = written(forecast.train_forecast(days.where("not is_test"), config.forecast_model), "forecasts")
    forecast_metrics = forecast.evaluate_forecast(
        forecast.predict(fitted, config.horizon_days), forecast.holdout_steps(days), fitted
    )
    return Trained(Models(best_model, sentiment, forest, fitted), churn_metrics, best,
                   sentiment_metrics, anomaly_metrics, forecast_metrics, candidates)


def save_candidates(trained: Trained, path: str) -> None:
    """Every churn family below its name."""
    for name, model in trained.candidates.items():
        model.save(f"{path}/candidates/{name}")


def save_models(models: Models, path: str) -> None:
    if models.churn:
        models.churn.save(f"{path}/churn")
    if models.sentiment:
        models.sentiment.save(f"{path}/sentiment")
    if models.forest is not None:
        write_table(models.forest, f"{path}/forest")
    if models.forecast is not None:
        write_table(models.forecast, f"{path}/forecast")


def load_models(spark: SparkSession, path: str) -> Models:
    """Whatever can be loaded; an absent model is None and its signal stays neutral."""

    def attempt(load):
        try:
            return load()
        except Exception as error:  # only an absent path means that there is no model
            if any(sign in str(error) for sign in ("PATH_NOT_FOUND", "Input path does not exist")):
                return None
            raise

    return Models(
        attempt(lambda: churn.ChurnModel.load(spark, f"{path}/churn")),
        attempt(lambda: text.SentimentModel.load(spark, f"{path}/sentiment")),
        attempt(lambda: spark.read.parquet(f"{path}/forest")),
        attempt(lambda: spark.read.parquet(f"{path}/forecast")),
    )


def save_metrics(trained: Trained, path: str) -> None:
    for name in ("churn_metrics", "sentiment_metrics", "anomaly_metrics", "forecast_metrics"):
        frame = getattr(trained, name)
        if frame is not None:
            write_metrics(frame, f"{path}/{name}")
