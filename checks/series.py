"""Windows, ranking, samples and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs
from checks.fragments import FRAGMENTS, HOLDOUT
from checks.registry import check
from riskloom.config import SERIES_COLUMNS
from riskloom.functions.scalars import seeded_key
from riskloom.operators import forecast, ordering, preparation, ranking, recommend, series
from riskloom.sources import warehouse

ROLLED = [f"{c}_rolling_{k}_{w}" for c in SERIES_COLUMNS for w in (7, 30) for k in ("mean", "std")]
RESIDUALS = [f"{c}_rolling_residual_{w}" for c in SERIES_COLUMNS for w in (7, 30)]
ZSCORES = [f"{c}_zscore_{w}" for c in SERIES_COLUMNS for w in (7, 30)]
CHANGES = [f"{c}_{p}pct_change_1d" for c in SERIES_COLUMNS for p in ("", "abs_")]
RATIOS = ["revenue_per_active_user", "signup_rate"]


def _spec(names: list[str], digits: int = 6) -> str:
    return "company_id date " + " ".join(f"{n}:f{digits}" for n in names)


# Means of whole cents are exact in both engines; deviations are compared to a tenth of a cent.
MEANS = " ".join(f"{n}:f6" for n in ROLLED if "_mean_" in n)
DEVIATIONS = " ".join(f"{n}:f{1 if n.startswith('revenue') else 6}" for n in ROLLED if "_std_" in n)


def daily_cents(spark, d):
    return warehouse.daily_metrics(spark, d).withColumn("revenue", F.round(F.col("revenue") * 100))


@check(f"company_id date {MEANS} {DEVIATIONS}", "SELECT * FROM cent_features")
def q_rolling_mean_std(spark, d):
    return series.rolling_mean_std(daily_cents(spark, d))


@check(_spec(RESIDUALS), "SELECT * FROM raw_features")
def q_rolling_residual(spark, d):
    return series.rolling_residual(series.rolling_mean_std(warehouse.daily_metrics(spark, d)))


@check(_spec(ZSCORES), "SELECT * FROM raw_features")
def q_rolling_zscore(spark, d):
    return series.rolling_zscore(series.rolling_mean_std(warehouse.daily_metrics(spark, d)))


@check(_spec(CHANGES), "SELECT * FROM raw_features")
def q_pct_change(spark, d):
    return series.pct_change(warehouse.daily_metrics(spark, d))


@check(_spec(RATIOS) + " day_of_week:i", "SELECT * FROM raw_features")
def q_calendar_and_ratios(spark, d):
    return series.calendar_and_ratios(warehouse.daily_metrics(spark, d))


@check(f"company_id date {MEANS} {DEVIATIONS} " + " ".join(f"{n}:f" for n in RESIDUALS + ZSCORES + CHANGES)
       + " revenue_per_active_user:f4 signup_rate:f revenue:f active_users:i signups:i day_of_week:i",
       "SELECT * FROM zeroed_cents")
def q_build_features(spark, d):
    return series.build_features(daily_cents(spark, d))


@check("company_id date revenue_per_active_user:f signups_pct_change_1d:f", """
  WITH spine AS (
    SELECT c.company_id, g.day AS date, coalesce(t.revenue, 0) AS revenue, coalesce(t.active_users, 0) AS active_users,
      coalesce(t.signups, 0) AS signups
    FROM company_dim c CROSS JOIN (SELECT unnest(generate_series((SELECT min(date) FROM daily)::TIMESTAMP,
      (SELECT max(date) FROM daily)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day) g
    LEFT JOIN daily t ON t.company_id = c.company_id AND t.date = g.day)
  SELECT company_id, date, coalesce(revenue / nullif(active_users, 0), 0) AS revenue_per_active_user,
    coalesce(signups::DOUBLE / nullif(lag(signups) OVER (PARTITION BY company_id ORDER BY date), 0) - 1, 0) AS signups_pct_change_1d
  FROM spine""")
def q_build_features_spine(spark, d):
    """Days without orders as zero rows, so that every guarded division meets a zero."""
    daily = warehouse.daily_metrics(spark, d)
    span = daily.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("date"))
    spine = warehouse.companies(spark, d).select("company_id").crossJoin(F.broadcast(days))
    filled = spine.join(daily, ["company_id", "date"], "left").na.fill(0, SERIES_COLUMNS)
    return series.build_features(filled)


@check("user_id:i event_type pct_rank:f", """
  SELECT DISTINCT u.user_id, u.event_type, (rank() OVER (PARTITION BY event_type ORDER BY n)
    + (count(*) OVER (PARTITION BY event_type, n) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY event_type) AS pct_rank
  FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) u""")
def q_avg_percent_rank(spark, d):
    counts = warehouse.table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(ordering.average_percent_rank(counts, ["event_type"], "n"), ["event_type", "n"])


@check("company_id recent_anomalies:i", "SELECT company_id, recent_anomalies FROM anomaly_signal")
def q_recent_anomaly_count(spark, d):
    from riskloom.operators.signals import recent_anomaly_count

    return recent_anomaly_count(inputs.flagged_days(spark, d))


@check("company_id date recency:i revenue:f", """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY date DESC) AS recency FROM daily) x
  WHERE recency <= 90""")
def q_last_n_rows(spark, d):
    return ranking.last_n_rows(warehouse.daily_metrics(spark, d), 90)


@check("company_id date seasonal_residual:f4", """
  SELECT company_id, date, revenue - lag(revenue, 7) OVER (PARTITION BY company_id ORDER BY date) AS seasonal_residual
  FROM daily""")
def q_seasonal_lag(spark, d):
    return series.seasonal_residuals(warehouse.daily_metrics(spark, d))


@check("company_id season_no:i tail_value:f", """
  SELECT company_id, 7 - r AS season_no, revenue AS tail_value
  FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY date DESC) AS r FROM daily) x WHERE r <= 7""")
def q_seasonal_tail(spark, d):
    return series.seasonal_tail(warehouse.daily_metrics(spark, d))


# ---------------------------------------------------------------- ranking


@check("company_id customer_id:i churn_prob:f", "SELECT * FROM scored_customers")
def q_rank_customers(spark, d):
    return ranking.rank_customers(inputs.scored_customers(spark, d))


@check("company_id rank:i customer_id churn_prob:f plan_type", """
  SELECT company_id, rank, substr(customer_id::VARCHAR, 1, 10) || '…' AS customer_id, churn_prob, plan_type
  FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY churn_prob DESC, customer_id) AS rank
        FROM scored_customers) x WHERE rank <= 25""")
def q_top_risk_customers(spark, d):
    return ranking.top_risk_customers(inputs.scored_customers(spark, d))


@check("company_id rank:i review_id:i score:f star_rating:i review_date", """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY score, review_id) AS rank
    FROM scored_reviews WHERE label = 'negative') x WHERE rank <= 15""")
def q_worst_reviews(spark, d):
    return ranking.worst_reviews(inputs.scored_reviews(spark, d))


@check("company_id rank:i date anomaly_score:f", """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY anomaly_score, date) AS rank
    FROM flagged_days WHERE is_anomaly) x WHERE rank <= 20""")
def q_worst_days(spark, d):
    return ranking.worst_days(inputs.flagged_days(spark, d))


@check("company_id features:a", """
  SELECT company_id, list(feature ORDER BY rank) AS features FROM factor_ranks GROUP BY company_id""")
def q_top_factors(spark, d):
    return ranking.top_factors(inputs.attribution(spark, d)).select(
        "company_id", F.col("top_factors.feature").alias("features")
    )


@check("company_id actions:a", """
  SELECT company_id, list(action ORDER BY item_no) AS actions FROM advice GROUP BY company_id""")
def q_sort_recommendations(spark, d):
    advised = recommend.recommendations(inputs.assessed(spark, d))
    rows = recommend.recommendation_rows(advised).withColumn("rule_no", F.col("item_no"))
    return recommend.sort_recommendations(rows).select(
        "company_id", F.col("recommendations.action").alias("actions")
    )


@check("company_id actions:a", """
  SELECT company_id, list(action ORDER BY item_no) FILTER (WHERE item_no < 3) AS actions FROM advice GROUP BY company_id""")
def q_top_recommendations(spark, d):
    advised = recommend.recommendations(inputs.assessed(spark, d))
    return recommend.top_recommendations(advised).select(
        "company_id", F.col("recommendations.action").alias("actions")
    )


@check("company_id risk_score:f risk_label", "SELECT * FROM banded")
def q_rank_companies(spark, d):
    return ranking.rank_companies(inputs.assessed(spark, d))


PORTFOLIOS = [("Healthy", "healthy", 220), ("Mixed", "mixed", 200), ("At Risk", "at_risk", 190)]
FRAGMENTS["engaged"] = """
  SELECT *, 2 * (2 * u_rank + u_peers - 1) - (2 * t_rank + t_peers - 1) AS engagement FROM (
    SELECT *, rank() OVER (ORDER BY usage_frequency) AS u_rank, count(*) OVER (PARTITION BY usage_frequency) AS u_peers,
      rank() OVER (ORDER BY support_tickets) AS t_rank, count(*) OVER (PARTITION BY support_tickets) AS t_peers
    FROM customers) x"""


@check("portfolio customer_id:i position:i", f"""
  SELECT p.portfolio, e.customer_id, e.position FROM (
    SELECT customer_id, row_number() OVER (ORDER BY engagement DESC, md5('42:' || customer_id)) - 1 AS position,
      count(*) OVER () AS total FROM engaged) e
  JOIN (VALUES {', '.join(str(p) for p in PORTFOLIOS)}) p(portfolio, kind, n) ON CASE p.kind
    WHEN 'healthy' THEN e.position < n
    WHEN 'at_risk' THEN e.position >= e.total - least(n, e.total)
    ELSE e.position >= greatest((e.total - least(n, e.total)) // 2, 0)
      AND e.position < greatest((e.total - least(n, e.total)) // 2, 0) + n END""")
def q_portfolio_slice(spark, d):
    settings = spark.createDataFrame(PORTFOLIOS, "portfolio string, customer_filter string, n_customers int")
    return ranking.portfolio_slice(warehouse.customers(spark, d), settings)


MIX = [("Healthy", "negative", 0.10, 180), ("Healthy", "neutral", 0.20, 180), ("Healthy", "positive", 0.70, 180),
       ("Mixed", "negative", 0.35, 160), ("Mixed", "neutral", 0.30, 160), ("Mixed", "positive", 0.35, 160),
       ("At Risk", "negative", 0.65, 170), ("At Risk", "neutral", 0.20, 170), ("At Risk", "positive", 0.15, 170)]


@check("portfolio review_id:i sentiment_label", f"""
  SELECT m.portfolio, r.review_id, r.sentiment_label FROM (
    SELECT review_id, sentiment_label, row_number() OVER (PARTITION BY sentiment_label ORDER BY md5('42:' || review_id)) AS r
    FROM reviews) r
  JOIN (VALUES {', '.join(str(m) for m in MIX)}) m(portfolio, label, share, total)
    ON m.label = r.sentiment_label AND r.r <= round_even((m.total * m.share)::DOUBLE, 0)""")
def q_stratified_sample(spark, d):
    mix = spark.createDataFrame(MIX, "portfolio string, label string, share double, total int")
    rows = warehouse.reviews(spark, d).select("review_id", "sentiment_label")
    return ranking.stratified_sample(rows, mix, "review_id", "sentiment_label")


@check("company_id customer_id:i tenure:i", "SELECT * FROM customers ORDER BY customer_id LIMIT 10")
def q_preview(spark, d):
    return ranking.preview(warehouse.customers(spark, d), "customer_id")


@check("event_type n:i q0:f q1:f q2:f", """
  SELECT event_type, count(value) AS n, quantile_cont(value, 0.03) AS q0, quantile_cont(value, 0.5) AS q1,
    quantile_cont(value, 0.99) AS q2 FROM events GROUP BY event_type""")
def q_exact_quantiles(spark, d):
    return ordering.exact_quantiles(
        warehouse.table(spark, d, "events"), ["event_type"], "value", [0.03, 0.5, 0.99]
    )


@check("event_id:i is_low", """
  SELECT event_id, r <= 100 AS is_low FROM (
    SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY md5('7:' || event_id)) AS r FROM events) x""")
def q_digest_cutoffs(spark, d):
    rows = warehouse.table(spark, d, "events").select(
        "event_id", "event_type", seeded_key(7, F.col("event_id")).alias("digest")
    )
    wanted = rows.select("event_type").distinct().withColumn("n", F.lit(100))
    cuts = ordering.digest_cutoffs(rows, ["event_type"], "digest", wanted)
    return rows.join(F.broadcast(cuts), "event_type").withColumn("is_low", F.col("digest") <= F.col("cut_key"))


# ---------------------------------------------------------------- forecasts


def train_days(spark, d):
    split = preparation.split_chronological(warehouse.daily_metrics(spark, d), HOLDOUT)
    return split.where("not is_test and skipped_reason is null").select("company_id", "date", "revenue")


FORECAST_SPEC = "company_id step:i date forecast:f2 lower_bound:f2 upper_bound:f2"


@check("company_id step:i date", "SELECT company_id, step, date FROM naive_forecast")
def q_future_dates(spark, d):
    return forecast.future_dates(forecast.fit_naive(train_days(spark, d)), 60)


@check(FORECAST_SPEC, """
  SELECT *, forecast - margin AS lower_bound, forecast + margin AS upper_bound FROM naive_forecast WHERE step <= 30""")
def q_forecast_seasonal_naive(spark, d):
    return forecast.forecast_seasonal_naive(train_days(spark, d), 30)


@check("company_id step:i date forecast:f", """
  SELECT company_id, step, date, last_value AS forecast FROM naive_forecast WHERE step <= 30""")
def q_forecast_naive(spark, d):
    return forecast.forecast_naive(train_days(spark, d), 30)


@check(FORECAST_SPEC + " model_type")
def q_forecast_holt_winters(spark, d):
    return forecast.forecast_holt_winters(train_days(spark, d), 30)


@check(FORECAST_SPEC + " model_type")
def q_forecast_trend_seasonal(spark, d):
    return forecast.forecast_trend_seasonal(train_days(spark, d), 30)


@check("company_id model_type last_date n_rows:i residual_std:f4 base:f4 slope:f")
def q_train_forecast(spark, d):
    return forecast.train_forecast(
        warehouse.daily_metrics(spark, d, "nation").select("company_id", "date", "revenue"), "auto"
    )


@check("company_id step:i lower_bound:f upper_bound:f", """
  SELECT company_id, step, least(actual, forecast) AS lower_bound, greatest(actual, forecast) AS upper_bound FROM projected
  WHERE actual IS NOT NULL""")
def q_order_bounds(spark, d):
    rows = inputs.projected(spark, d).where("actual is not null")
    crossed = rows.withColumn("lower_bound", F.col("actual")).withColumn("upper_bound", F.col("actual"))
    return forecast.order_bounds(crossed)


_SCORES = """
  SELECT company_id, avg(abs(actual - forecast)) AS mae, sqrt(avg((actual - forecast) ** 2)) AS rmse,
    avg(abs((actual - forecast) / CASE WHEN abs(actual) >= 1e-9 THEN actual END)) * 100 AS mape,
    avg((actual BETWEEN forecast - margin AND forecast + margin)::INT) AS coverage, count(*) AS horizon_days,
    avg(abs(actual - last_value)) AS naive_mae, sqrt(avg((actual - last_value) ** 2)) AS naive_rmse,
    avg(abs((actual - last_value) / CASE WHEN abs(actual) >= 1e-9 THEN actual END)) * 100 AS naive_mape
  FROM naive_forecast JOIN holdout_rows USING (company_id, step) GROUP BY company_id"""
FRAGMENTS["forecast_scores"] = _SCORES


@check("company_id model_type mae:f4 rmse:f4 mape:f coverage:f horizon_days:i naive_mae:f4 naive_rmse:f4 naive_mape:f "
       "mape_improvement_pp:f beats_naive", """
  SELECT *, 'seasonal_naive' AS model_type, naive_mape - mape AS mape_improvement_pp, mape < naive_mape AS beats_naive
  FROM forecast_scores""")
def q_evaluate_forecast(spark, d):
    split = preparation.split_by_holdout(
        warehouse.daily_metrics(spark, d).withColumn("holdout_days", F.lit(HOLDOUT))
    )
    models = forecast.fit_seasonal_naive(split.where("not is_test and skipped_reason is null"))
    return forecast.evaluate_forecast(
        forecast.predict(models, HOLDOUT), forecast.holdout_steps(split), models
    )


@check(FORECAST_SPEC + " actual:f is_projection", "SELECT * FROM projected")
def q_backtest_and_project(spark, d):
    return inputs.projected(spark, d)


@check("backend companies:i mae:f4 rmse:f4 mape:f beats_naive:i", """
  SELECT 'seasonal_naive' AS backend, count(*) AS companies, avg(mae) AS mae, avg(rmse) AS rmse, avg(mape) AS mape,
    count(*) FILTER (WHERE mape < naive_mape) AS beats_naive FROM forecast_scores
  UNION ALL
  SELECT 'naive', count(*), avg(naive_mae), avg(naive_rmse), avg(naive_mape), 0 FROM forecast_scores""")
def q_compare_backends(spark, d):
    return forecast.compare_backends(warehouse.daily_metrics(spark, d), ["seasonal_naive", "naive"])


@check("backend companies:i mae:f4 mape:f coverage:f beats_naive:i")
def q_compare_fitted_backends(spark, d):
    return forecast.compare_backends(warehouse.daily_metrics(spark, d), ["prophet", "ets", "seasonal_naive"])


@check("company_id date actual:f", """
  SELECT company_id, date, actual FROM projected WHERE actual IS NOT NULL""")
def q_split_backtest_projection(spark, d):
    return inputs.projected(spark, d).where(F.col("actual").isNotNull())
