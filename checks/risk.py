"""Signals, score, recommendations, dashboard figures and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs
from checks.fragments import CHURN_COEFFICIENTS, FRAGMENTS, rules_over
from checks.registry import check
from riskloom.config import CHURN_NUMERIC_COLUMNS
from riskloom.functions import scalars
from riskloom.operators import churn, profiling, recommend, risk, signals
from riskloom.sources import warehouse

# ---------------------------------------------------------------- filters and scalars


@check("review_id:i label", "SELECT review_id, label FROM scored_reviews WHERE label = 'negative'")
def q_filter_equals(spark, d):
    return inputs.scored_reviews(spark, d).where("label = 'negative'")


@check("company_id date anomaly_score:f", "SELECT * FROM flagged_days WHERE is_anomaly")
def q_filter_flagged(spark, d):
    return inputs.flagged_days(spark, d).where("is_anomaly")


@check("company_id customer_id:i", "SELECT company_id, customer_id FROM scored_customers WHERE churn_prob >= 0.5")
def q_high_risk_mask(spark, d):
    return profiling.high_risk_mask(inputs.scored_customers(spark, d))


@check("p_partkey:i slug human joined", """
  SELECT p_partkey, regexp_replace(trim(lower(p_name || '  X')), '\\s+', '_', 'g') AS slug,
    trim(replace(regexp_replace('numeric__' || replace(p_name, ' ', '_'), '^.*?__', ''), '_', ' ')) AS human,
    CASE p_partkey % 4 WHEN 0 THEN 'several factors' WHEN 1 THEN p_name
      WHEN 2 THEN p_name || ' and ' || p_brand ELSE p_name || ', ' || p_brand || ' and ' || p_type END AS joined
  FROM part""")
def q_text_scalars(spark, d):
    name = F.col("p_name")
    items = F.slice(F.array("p_name", "p_brand", "p_type"), F.lit(1), (F.col("p_partkey") % 4).cast("int"))
    return warehouse.table(spark, d, "part").select(
        "p_partkey", scalars.slugify(F.concat(name, F.lit("  X"))).alias("slug"),
        scalars.humanize_feature(F.concat(F.lit("numeric__"), F.replace(name, F.lit(" "), F.lit("_")))).alias("human"),
        scalars.join_readable(items).alias("joined"),
    )


@check("event_id:i signal:f plain:f shown", """
  SELECT event_id, CASE WHEN v IN ('nan', 'inf') OR try_cast(v AS DOUBLE) IS NULL THEN 0.5
      ELSE least(greatest(v::DOUBLE, 0), 1) END AS signal,
    CASE WHEN v IN ('nan', 'inf') OR try_cast(v AS DOUBLE) IS NULL THEN -1 ELSE v::DOUBLE END AS plain,
    round_even(value / 200 * 100, 0)::BIGINT || '%' AS shown
  FROM (SELECT *, CASE event_id % 5 WHEN 0 THEN 'nan' WHEN 1 THEN 'n/a' WHEN 2 THEN 'inf'
          ELSE (event_id % 97 / 64.0 - 0.25)::DOUBLE::VARCHAR END AS v FROM events) x""")
def q_number_scalars(spark, d):
    key = F.col("event_id")
    text = (
        F.when(key % 5 == 0, "nan").when(key % 5 == 1, "n/a").when(key % 5 == 2, "inf")
        .otherwise((key % 97 / 64.0 - 0.25).cast("string"))
    )
    rows = warehouse.table(spark, d, "events").select("event_id", "value", text.alias("v"))
    return rows.select(
        "event_id", scalars.safe_signal(F.col("v"), 0.5).alias("signal"),
        scalars.finite_or(F.col("v"), -1.0).alias("plain"),
        scalars.percent_text(F.col("value") / 200).alias("shown"),
    )


@check("o_orderkey:i parsed", """
  SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE o_orderdate::DATE END AS parsed FROM orders""")
def q_parse_date(spark, d):
    layouts = ["yyyy-MM-dd", "M/d/yyyy", "yyyy/MM/dd", "dd-MMM-yyyy", "MMM d, yyyy"]
    key = F.col("o_orderkey")
    text = F.when(key % 6 == 5, "last tuesday")
    for i, layout in enumerate(layouts):
        text = text.when(key % 6 == i, F.date_format("o_orderdate", layout))
    rows = warehouse.table(spark, d, "orders").select("o_orderkey", text.alias("t"))
    return rows.withColumn("parsed", scalars.parse_date(F.col("t")).cast("date"))


# ---------------------------------------------------------------- signals


@check("company_id churn_prob:f", "SELECT * FROM churn_signal")
def q_signal_churn(spark, d):
    return signals.signal_churn(inputs.scored_customers(spark, d))


@check("company_id sentiment_positivity:f", "SELECT * FROM review_signal")
def q_signal_sentiment(spark, d):
    return signals.signal_sentiment(inputs.scored_reviews(spark, d))


@check("company_id anomaly_flag_ratio:f", "SELECT * FROM anomaly_signal")
def q_signal_anomaly_ratio(spark, d):
    return signals.signal_anomaly_ratio(inputs.flagged_days(spark, d))


@check("company_id forecast_deviation:f", "SELECT * FROM forecast_signal")
def q_signal_forecast_deviation(spark, d):
    return signals.signal_forecast_deviation(inputs.projected(spark, d))


@check("company_id forecast_trend", "SELECT * FROM forecast_signal")
def q_forecast_trend(spark, d):
    return signals.forecast_trend(inputs.projected(spark, d))


@check("company_id dominant_sentiment", "SELECT * FROM review_signal")
def q_dominant_sentiment(spark, d):
    return signals.dominant_sentiment(inputs.scored_reviews(spark, d))


@check("company_id dropped_metrics:a", "SELECT * FROM anomaly_signal")
def q_dropped_metrics(spark, d):
    return signals.dropped_metrics(inputs.flagged_days(spark, d))


# ---------------------------------------------------------------- score and advice

# Signals per customer: the same expressions over many more rows than there are companies.
FRAGMENTS["customer_signals"] = """
  SELECT s.customer_id::VARCHAR AS company_id, s.churn_prob,
    (customer_id % 101) / 100.0::DOUBLE AS sentiment_positivity, (customer_id % 13) / 120.0::DOUBLE AS anomaly_flag_ratio,
    (customer_id % 17) / 130.0::DOUBLE AS forecast_deviation,
    list_filter([CASE WHEN customer_id % 2 = 0 THEN 'revenue' END, CASE WHEN customer_id % 3 = 0 THEN 'active_users' END,
      CASE WHEN customer_id % 5 = 0 THEN 'signups' END], lambda m: m IS NOT NULL) AS dropped_metrics
  FROM scored_customers s"""


def customer_signals(spark, d):
    key = F.col("customer_id")
    fell = F.array_compact(F.array(
        F.when(key % 2 == 0, "revenue"), F.when(key % 3 == 0, "active_users"), F.when(key % 5 == 0, "signups")
    ))
    return inputs.scored_customers(spark, d).select(
        key.cast("string").alias("company_id"), "churn_prob",
        ((key % 101) / 100.0).alias("sentiment_positivity"), ((key % 13) / 120.0).alias("anomaly_flag_ratio"),
        ((key % 17) / 130.0).alias("forecast_deviation"), fell.alias("dropped_metrics"),
    )


_TERMS = """churn_prob AS churn_term, 1 - sentiment_positivity AS sentiment_term,
  least(anomaly_flag_ratio / 0.10, 1) AS anomaly_term, least(forecast_deviation / 0.10, 1) AS forecast_term"""
FRAGMENTS["customer_scores"] = f"""
  SELECT *, 100 * least(greatest(0.35 * churn_term + 0.20 * sentiment_term + 0.20 * anomaly_term + 0.25 * forecast_term, 0), 1) AS risk_score
  FROM (SELECT *, {_TERMS} FROM customer_signals) x"""


def _values():
    return [F.col(s) for s in risk.SIGNALS]


@check("company_id churn_term:f sentiment_term:f anomaly_term:f forecast_term:f", "SELECT * FROM customer_scores")
def q_normalized_terms(spark, d):
    names = ["churn_term", "sentiment_term", "anomaly_term", "forecast_term"]
    return customer_signals(spark, d).withColumns(dict(zip(names, risk.normalized_terms(*_values()))))


@check("company_id risk_score:f", "SELECT * FROM customer_scores")
def q_risk_score(spark, d):
    return customer_signals(spark, d).withColumn("risk_score", risk.risk_score(_values()))


@check("company_id risk_label risk_colour", """
  SELECT company_id, CASE WHEN risk_score < 30 THEN 'Low' WHEN risk_score < 60 THEN 'Medium' ELSE 'High' END AS risk_label,
    CASE WHEN risk_score < 30 THEN 'green' WHEN risk_score < 60 THEN 'orange' ELSE 'red' END AS risk_colour FROM customer_scores""")
def q_risk_band(spark, d):
    score = risk.risk_score(_values())
    return customer_signals(spark, d).withColumn("risk_label", risk.risk_label(score)).withColumn(
        "risk_colour", risk.risk_colour(score)
    )


@check("company_id Churn:f Sentiment:f Anomalies:f Forecast:f", """
  SELECT company_id, 35 * churn_term AS Churn, 20 * sentiment_term AS Sentiment, 20 * anomaly_term AS Anomalies,
    25 * forecast_term AS Forecast FROM customer_scores""")
def q_signal_contributions(spark, d):
    return customer_signals(spark, d).select("company_id", risk.signal_contributions(_values()).alias("c")).select(
        "company_id", "c.*"
    )


@check("company_id explanation_text", "SELECT * FROM assessed")
def q_explanation_text(spark, d):
    return inputs.assessed(spark, d)


@check("company_id risk_score:f risk_label risk_colour churn_prob:f sentiment_positivity:f anomaly_flag_ratio:f "
       "forecast_deviation:f Churn:f Sentiment:f Anomalies:f Forecast:f explanation_source explanation_text", """
  SELECT *, churn_points AS Churn, sentiment_points AS Sentiment, anomaly_points AS Anomalies,
    forecast_points AS Forecast, 'shap' AS explanation_source FROM banded""")
def q_assess_companies(spark, d):
    return inputs.assessed(spark, d).select("*", "signals.*", "contributions.*")


ADVICE_SPEC = "company_id item_no:i action reason priority"


@check(ADVICE_SPEC, rules_over("customer_signals"))
def q_recommendations(spark, d):
    rows = customer_signals(spark, d).select("company_id", F.struct(*risk.SIGNALS).alias("signals"), "dropped_metrics")
    return recommend.recommendation_rows(recommend.recommendations(rows))


@check(ADVICE_SPEC, "SELECT * FROM advice")
def q_company_recommendations(spark, d):
    return recommend.recommendation_rows(recommend.recommendations(inputs.assessed(spark, d)))


@check(ADVICE_SPEC, """
  SELECT company_id, row_number() OVER (PARTITION BY company_id ORDER BY rule_no) - 1 AS item_no, action, reason, priority FROM (
    SELECT company_id, 5 AS rule_no, 'Investigate the payment and billing pipeline for failed charges.' AS action,
      'Revenue showed an unusual drop on recently flagged days.' AS reason, 'high' AS priority
    FROM customer_signals WHERE list_contains(dropped_metrics, 'revenue')
    UNION ALL SELECT company_id, 6, 'Check for a product outage or a recent breaking release.',
      'Active users dropped sharply on recently flagged days.', 'high' FROM customer_signals WHERE list_contains(dropped_metrics, 'active_users')
    UNION ALL SELECT company_id, 7, 'Review the signup funnel and any recent marketing or pricing changes.',
      'Signups dropped sharply on recently flagged days.', 'high' FROM customer_signals WHERE list_contains(dropped_metrics, 'signups')
    UNION ALL SELECT company_id, 8, 'Review flagged anomalous days against your release and campaign calendar.',
      round_even(anomaly_flag_ratio * 100, 0)::BIGINT || '% of the last 30 days were flagged as anomalous.', 'medium'
    FROM customer_signals WHERE len(dropped_metrics) = 0) x""")
def q_anomaly_recommendations(spark, d):
    return recommend.anomaly_recommendations(customer_signals(spark, d))


@check("company_id signal_no:i signal raw_value weight:f points:f", """
  SELECT company_id, x.n AS signal_no, x.signal, CASE x.n
      WHEN 0 THEN round_even(churn_prob * 100, 0)::BIGINT || '% mean churn probability'
      WHEN 1 THEN round_even(sentiment_positivity * 100, 0)::BIGINT || '% review positivity'
      WHEN 2 THEN round_even(anomaly_flag_ratio * 30, 0)::BIGINT || ' of last 30 days flagged'
      ELSE printf('%.1f', round_even(forecast_deviation * 1000, 0) / 10) || '% projected downside' END AS raw_value,
    x.weight, CASE x.n WHEN 0 THEN churn_points WHEN 1 THEN sentiment_points WHEN 2 THEN anomaly_points ELSE forecast_points END AS points
  FROM assessed CROSS JOIN (VALUES (0, 'Churn', 0.35), (1, 'Sentiment', 0.20), (2, 'Anomalies', 0.20), (3, 'Forecast', 0.25)) x(n, signal, weight)""")
def q_score_breakdown(spark, d):
    return risk.score_breakdown(inputs.assessed(spark, d))


_SOURCES = ["shap", "shap_failed:feature_importances", "shap_not_installed:coefficients", "shap_failed:permutation", "none"]


@check("company_id explanation_source heading shown:i", """
  SELECT c_custkey::VARCHAR AS company_id, s.source AS explanation_source, s.heading, s.shown FROM customer
  JOIN (VALUES (0, 'shap', 'SHAP', 62), (1, 'shap_failed:feature_importances', 'model feature importances', 135),
    (2, 'shap_not_installed:coefficients', 'model coefficients', 131),
    (3, 'shap_failed:permutation', 'permutation sensitivity', 131), (4, 'none', '', 0)) s(n, source, heading, shown)
    ON s.n = c_custkey % 5""")
def q_explanation_method(spark, d):
    rows = warehouse.table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("company_id"),
        inputs.pick(_SOURCES, F.col("c_custkey") % 5).alias("explanation_source"),
    )
    return risk.explanation_method(rows).withColumn("shown", F.length("caption"))


# ---------------------------------------------------------------- dashboard figures


@check("company_id customers:i mean_churn_prob:f high_risk:i max_churn_prob:f", """
  SELECT company_id, count(*) AS customers, avg(churn_prob) AS mean_churn_prob,
    count(*) FILTER (WHERE churn_prob >= 0.5) AS high_risk, max(churn_prob) AS max_churn_prob
  FROM scored_customers GROUP BY company_id""")
def q_churn_kpis(spark, d):
    return profiling.churn_kpis(inputs.scored_customers(spark, d))


@check("company_id risk_bin customers:i", """
  SELECT c.company_id, b.name AS risk_bin, count(s.customer_id) AS customers FROM company_dim c
  CROSS JOIN (VALUES (-1, 0.2, '0-20%'), (0.2, 0.4, '20-40%'), (0.4, 0.6, '40-60%'), (0.6, 0.8, '60-80%'), (0.8, 1.0, '80-100%')) b(low, high, name)
  LEFT JOIN scored_customers s ON s.company_id = c.company_id AND s.churn_prob > b.low AND s.churn_prob <= b.high
  GROUP BY c.company_id, b.name""")
def q_risk_histogram(spark, d):
    return profiling.risk_histogram(inputs.scored_customers(spark, d))


@check("company_id reviews:i negative:i neutral:i positive:i mean_positivity:f", """
  SELECT company_id, count(*) AS reviews, count(*) FILTER (WHERE label = 'negative') AS negative,
    count(*) FILTER (WHERE label = 'neutral') AS neutral, count(*) FILTER (WHERE label = 'positive') AS positive,
    avg(score) AS mean_positivity FROM scored_reviews GROUP BY company_id""")
def q_sentiment_mix(spark, d):
    return profiling.sentiment_mix(inputs.scored_reviews(spark, d))


@check("company_id week_end mean_score:f reviews:i", """
  SELECT company_id, week_end, avg(score) AS mean_score, count(score) AS reviews FROM (
    SELECT company_id, unnest(generate_series(min(w)::TIMESTAMP, max(w)::TIMESTAMP, INTERVAL 7 DAY))::DATE AS week_end
    FROM (SELECT company_id, (review_date + (7 - isodow(review_date))::INT) AS w FROM scored_reviews) x GROUP BY company_id) s
  LEFT JOIN (SELECT company_id, (review_date + (7 - isodow(review_date))::INT) AS week_end, score FROM scored_reviews) r
    USING (company_id, week_end) GROUP BY company_id, week_end""")
def q_weekly_positivity(spark, d):
    return profiling.weekly_positivity(inputs.scored_reviews(spark, d))


@check("company_id days:i flagged:i flagged_recent:i flag_rate:f", """
  SELECT f.company_id, count(*) AS days, count(*) FILTER (WHERE is_anomaly) AS flagged,
    any_value(a.recent_anomalies) AS flagged_recent, avg(is_anomaly::INT) AS flag_rate
  FROM flagged_days f JOIN anomaly_signal a USING (company_id) GROUP BY f.company_id""")
def q_anomaly_kpis(spark, d):
    return profiling.anomaly_kpis(inputs.flagged_days(spark, d))


@check("company_id backtest_mape:f backtest_mae:f4 current_level:f4 projected_level:f4 projected_change:f", """
  SELECT *, (projected_level - current_level) / current_level AS projected_change FROM (
    SELECT company_id, avg(abs((actual - forecast) / actual)) * 100 AS backtest_mape, avg(abs(actual - forecast)) AS backtest_mae,
      avg(actual) AS current_level, avg(forecast) FILTER (WHERE actual IS NULL) AS projected_level
    FROM projected GROUP BY company_id) x""")
def q_forecast_kpis(spark, d):
    return profiling.forecast_kpis(inputs.projected(spark, d))


# ---------------------------------------------------------------- exploratory profiles


@check("column_name nulls:i", """
  SELECT 'spend' AS column_name, count(*) - count(spend) AS nulls FROM holey UNION ALL
  SELECT 'usage', count(*) - count(usage) FROM holey UNION ALL SELECT 'plan', count(*) - count(plan) FROM holey
  UNION ALL SELECT 'note', count(*) - count(note) FROM holey UNION ALL SELECT 'customer_id', 0""")
def q_null_profile(spark, d):
    from checks.core import holey_customers

    return profiling.null_profile(holey_customers(spark, d))


_DESCRIBED = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c})::DOUBLE AS min, "
    f"quantile_cont({c}, 0.25)::DOUBLE AS q25, quantile_cont({c}, 0.5)::DOUBLE AS q50, quantile_cont({c}, 0.75)::DOUBLE AS q75, "
    f"max({c})::DOUBLE AS max, NULL AS \"unique\", NULL AS top, NULL AS freq FROM customers"
    for c in CHURN_NUMERIC_COLUMNS
)


@check("column_name count:i mean:f4 std:f4 min:f4 q25:f4 q50:f4 q75:f4 max:f4 n_unique:i top freq:i", f"""
  SELECT *, "unique" AS n_unique FROM ({_DESCRIBED} UNION ALL
  SELECT 'plan_type', (SELECT count(plan_type) FROM customers), NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    (SELECT count(DISTINCT plan_type) FROM customers), plan_type, n
  FROM (SELECT plan_type, count(*) AS n FROM customers GROUP BY plan_type ORDER BY n DESC, plan_type LIMIT 1) x) y""")
def q_describe_columns(spark, d):
    return profiling.describe_columns(
        warehouse.customers(spark, d), CHURN_NUMERIC_COLUMNS, ["plan_type"]
    ).withColumnRenamed("unique", "n_unique")


@check("churn_label:i n:i share:f", """
  SELECT churn_label, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM customers GROUP BY churn_label""")
def q_class_balance(spark, d):
    return profiling.class_balance(warehouse.customers(spark, d), "churn_label")


@check("column_name correlation:f", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, corr({c}, churn_label) AS correlation FROM customers" for c in CHURN_NUMERIC_COLUMNS))
def q_label_correlation(spark, d):
    return profiling.label_correlation(warehouse.customers(spark, d), CHURN_NUMERIC_COLUMNS, "churn_label")


@check("churn_label:i " + " ".join(f"{c}:f2" for c in CHURN_NUMERIC_COLUMNS), "SELECT churn_label, " + ", ".join(
    f"avg({c}) AS {c}" for c in CHURN_NUMERIC_COLUMNS) + " FROM customers GROUP BY churn_label")
def q_means_by_label(spark, d):
    return profiling.means_by_label(warehouse.customers(spark, d), CHURN_NUMERIC_COLUMNS, "churn_label")


@check("plan_type stayed:f churned:f", """
  SELECT plan_type, 1 - avg(churn_label) AS stayed, avg(churn_label) AS churned FROM customers GROUP BY plan_type""")
def q_churn_rate_by_plan(spark, d):
    return profiling.churn_rate_by_plan(warehouse.customers(spark, d))


_BINS = " UNION ALL ".join(f"""
  SELECT '{c}' AS column_name, b.bin_no, e.low + b.bin_no * (e.high - e.low) / 30 AS bin_low, count(v.v) AS n
  FROM (SELECT min({c})::DOUBLE AS low, max({c})::DOUBLE AS high FROM customers) e
  CROSS JOIN (SELECT unnest(range(0, 30)) AS bin_no) b
  LEFT JOIN (SELECT {c}::DOUBLE AS v, (SELECT min({c})::DOUBLE FROM customers) AS low, (SELECT max({c})::DOUBLE FROM customers) AS high FROM customers) v
    ON least(floor((v.v - v.low) / ((v.high - v.low) / 30)), 29) = b.bin_no
  GROUP BY b.bin_no, e.low, e.high""" for c in CHURN_NUMERIC_COLUMNS)


@check("column_name bin_no:i bin_low:f4 n:i", _BINS)
def q_numeric_histogram(spark, d):
    return profiling.numeric_histogram(warehouse.customers(spark, d), CHURN_NUMERIC_COLUMNS)


@check("sentiment_label count:i mean:f2 median:f min:i max:i", """
  SELECT sentiment_label, count(*) AS count, avg(w) AS mean, quantile_cont(w, 0.5)::DOUBLE AS median, min(w) AS min, max(w) AS max
  FROM (SELECT sentiment_label, len(string_split(trim(regexp_replace(review_text, '\\s+', ' ', 'g')), ' ')) AS w FROM reviews) x
  GROUP BY sentiment_label""")
def q_review_length_stats(spark, d):
    return profiling.review_length_stats(warehouse.reviews(spark, d))


@check("sentiment_label mean:f2 min:i max:i", """
  SELECT sentiment_label, avg(star_rating) AS mean, min(star_rating) AS min, max(star_rating) AS max FROM reviews GROUP BY sentiment_label""")
def q_rating_by_sentiment(spark, d):
    return profiling.rating_by_sentiment(warehouse.reviews(spark, d))


@check("company_id first_date last_date days:i mean_revenue:f2 min_revenue:f2 max_revenue:f2 mean_active_users:f2 "
       "mean_signups:f2 injected_anomalies:i", """
  SELECT company_id, min(date) AS first_date, max(date) AS last_date, count(*) AS days, avg(revenue) AS mean_revenue,
    min(revenue) AS min_revenue, max(revenue) AS max_revenue, avg(active_users) AS mean_active_users,
    avg(signups) AS mean_signups, count(*) FILTER (WHERE is_anomaly) AS injected_anomalies
  FROM flagged_days GROUP BY company_id""")
def q_company_summary(spark, d):
    return profiling.company_summary(inputs.flagged_days(spark, d), "is_anomaly")


@check("company_id first_revenue:f last_revenue:f change_percent:f", """
  SELECT *, (last_revenue / first_revenue - 1) * 100 AS change_percent FROM (
    SELECT company_id, arg_min(revenue, date) AS first_revenue, arg_max(revenue, date) AS last_revenue FROM daily GROUP BY company_id) x""")
def q_revenue_change(spark, d):
    return profiling.revenue_change(warehouse.daily_metrics(spark, d))


_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@check("date AFRICA:f AMERICA:f ASIA:f EUROPE:f MIDDLE_EAST:f", "SELECT date, " + ", ".join(
    f"any_value(revenue) FILTER (WHERE company_id = '{r}') AS {r.replace(' ', '_')}" for r in _REGIONS) + " FROM daily GROUP BY date")
def q_metric_pivot(spark, d):
    pivot = profiling.metric_pivot(warehouse.daily_metrics(spark, d), "revenue", _REGIONS)
    return pivot.withColumnRenamed("MIDDLE EAST", "MIDDLE_EAST")


# ---------------------------------------------------------------- model metrics that SQL can follow


FRAGMENTS["rounded_scores"] = "SELECT churn_label, round(churn_prob, 4) AS churn_prob FROM scored_customers"
FRAGMENTS["curve"] = """
  SELECT *, coalesce(sum(pos) OVER w, 0) AS pos_above, coalesce(sum(neg) OVER w, 0) AS neg_above,
    sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM (SELECT churn_prob, count(*) FILTER (WHERE churn_label = 1) AS pos, count(*) FILTER (WHERE churn_label = 0) AS neg
        FROM rounded_scores GROUP BY churn_prob) x
  WINDOW w AS (ORDER BY churn_prob DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


@check("roc_auc:f pr_auc:f f1:f tn:i fp:i fn:i tp:i", """
  SELECT (SELECT sum(pos_above * neg + pos * neg / 2.0::DOUBLE) / (any_value(p) * any_value(n)) FROM curve) AS roc_auc,
    (SELECT sum(pos * (pos_above + pos)::DOUBLE / (pos_above + pos + neg_above + neg)) / any_value(p) FROM curve) AS pr_auc,
    2.0::DOUBLE * tp / (2 * tp + fp + fn) AS f1, tn, fp, fn, tp
  FROM (SELECT count(*) FILTER (WHERE churn_prob >= 0.5 AND churn_label = 1) AS tp,
      count(*) FILTER (WHERE churn_prob >= 0.5 AND churn_label = 0) AS fp,
      count(*) FILTER (WHERE churn_prob < 0.5 AND churn_label = 1) AS fn,
      count(*) FILTER (WHERE churn_prob < 0.5 AND churn_label = 0) AS tn FROM rounded_scores) c""")
def q_evaluate_churn(spark, d):
    scored = inputs.scored_customers(spark, d).withColumn("churn_prob", F.round("churn_prob", 4))
    return churn.evaluate_churn(scored)


@check("plan_type best_model roc_auc:f", """
  SELECT plan_type, arg_max(model, auc) AS best_model, max(auc) AS roc_auc FROM (
    SELECT plan_type, 'rate_' || churn_label AS model, avg(usage_frequency) AS auc FROM customers GROUP BY ALL) x GROUP BY plan_type""")
def q_select_best(spark, d):
    metrics = warehouse.customers(spark, d).groupBy(
        "plan_type", F.concat(F.lit("rate_"), F.col("churn_label").cast("string")).alias("model")
    ).agg(F.avg("usage_frequency").alias("roc_auc"))
    return churn.select_best(metrics, ["plan_type"])


@check("company_id feature value:f", "SELECT * FROM attribution")
def q_explain_factors(spark, d):
    return churn.linear_attribution(inputs.features(spark, d), CHURN_COEFFICIENTS)


@check("is_anomaly company_id date", """
  SELECT f.company_id, date, -abs(revenue_zscore_30) < t.cut AS is_anomaly FROM series_features f
  JOIN (SELECT company_id, quantile_cont(-abs(revenue_zscore_30), 0.03) AS cut FROM series_features GROUP BY company_id) t USING (company_id)""")
def q_contamination_threshold(spark, d):
    from riskloom.operators.anomaly import contamination_threshold

    raw = inputs.flagged_days(spark, d).withColumn("raw_score", -F.abs("revenue_zscore_30"))
    return contamination_threshold(raw, 0.03, "company_id")


@check("precision:f recall:f f1:f detected:i injected:i", """
  SELECT tp::DOUBLE / detected AS precision, tp::DOUBLE / injected AS recall, 2.0::DOUBLE * tp / (detected + injected) AS f1, detected, injected
  FROM (SELECT count(*) FILTER (WHERE is_anomaly AND abs(revenue_zscore_7) > 3) AS tp, count(*) FILTER (WHERE is_anomaly) AS detected,
          count(*) FILTER (WHERE abs(revenue_zscore_7) > 3) AS injected FROM flagged_days) x""")
def q_evaluate_anomalies(spark, d):
    from riskloom.operators.anomaly import evaluate_anomalies

    rows = inputs.flagged_days(spark, d).withColumn("truth", F.abs("revenue_zscore_7") > 3)
    return evaluate_anomalies(rows, "truth")
