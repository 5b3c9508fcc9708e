"""SQL of the canonical and scored tables that the checks share."""

from __future__ import annotations

from riskloom.config import SERIES_COLUMNS

# Fixed linear model that stands in for a fitted one, so that SQL can follow.
CHURN_INTERCEPT = 1.1
CHURN_COEFFICIENTS = {
    "tenure": -0.02, "monthly_spend": -0.000002, "usage_frequency": -0.05,
    "support_tickets": 0.15, "spend_per_login": 0.00001, "low_usage_flag": 0.8,
    "high_ticket_flag": 0.4,
}
SCORE_BY_LABEL = {"negative": 0.1, "neutral": 0.5, "positive": 0.9}
HOLDOUT = 30


def _customers(company: str) -> str:
    return f"""
      SELECT c.{company} AS company_id, c.c_custkey AS customer_id,
        greatest(round_even((h.cutoff - h.first_order) / 30.44::DOUBLE, 0)::INT, 1) AS tenure,
        h.spend / greatest(round_even((h.cutoff - h.first_order) / 30.44::DOUBLE, 0)::INT, 1) AS monthly_spend,
        h.n_orders::INT AS usage_frequency, coalesce(t.n, 0)::INT AS support_tickets,
        c.c_mktsegment AS plan_type, CASE WHEN h.n_later = 0 THEN 1 ELSE 0 END AS churn_label,
        h.first_order AS signup_date
      FROM cust_company c JOIN order_history h ON c.c_custkey = h.o_custkey
      LEFT JOIN (SELECT user_id, count(*) AS n FROM ticket_events GROUP BY user_id) t
        ON t.user_id = c.c_custkey"""


def _daily(company: str) -> str:
    return f"""
      SELECT c.{company} AS company_id, d.date, round(sum(d.amount), 2) AS revenue,
        count(*) AS active_users, count(*) FILTER (WHERE d.date = d.first_day) AS signups
      FROM (SELECT o_custkey, o_orderdate::DATE AS date, sum(o_totalprice) AS amount,
              min(o_orderdate::DATE) OVER (PARTITION BY o_custkey) AS first_day
            FROM orders GROUP BY o_custkey, o_orderdate::DATE) d
      JOIN cust_company c ON c.c_custkey = d.o_custkey
      GROUP BY c.{company}, d.date"""


def _series_features(source: str) -> str:
    rolled, derived = [], []
    for c in SERIES_COLUMNS:
        for w in (7, 30):
            over = f"OVER (PARTITION BY company_id ORDER BY date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
            need = max(3, w // 4)
            rolled.append(f"CASE WHEN count({c}) {over} >= {need} THEN avg({c}::DOUBLE) {over} END AS {c}_rolling_mean_{w}")
            rolled.append(f"CASE WHEN count({c}) {over} >= {need} THEN stddev_samp({c}::DOUBLE) {over} END AS {c}_rolling_std_{w}")
            m, s = f"{c}_rolling_mean_{w}", f"{c}_rolling_std_{w}"
            derived.append(f"({c} - {m}) / nullif({m}, 0) AS {c}_rolling_residual_{w}")
            derived.append(f"({c} - {m}) / nullif({s}, 0) AS {c}_zscore_{w}")
        rolled.append(
            f"{c}::DOUBLE / nullif(lag({c}::DOUBLE) OVER (PARTITION BY company_id ORDER BY date), 0) - 1 AS {c}_pct_change_1d"
        )
        derived.append(f"abs({c}_pct_change_1d) AS {c}_abs_pct_change_1d")
    return f"""
      SELECT *, {', '.join(derived)}, (isodow(date) - 1)::INT AS day_of_week,
        revenue / nullif(active_users, 0) AS revenue_per_active_user,
        signups / nullif(active_users, 0) AS signup_rate
      FROM (SELECT *, {', '.join(rolled)} FROM {source}) r"""


def _zeroed_features(source: str) -> str:
    names = []
    for c in SERIES_COLUMNS:
        for w in (7, 30):
            names += [f"{c}_rolling_mean_{w}", f"{c}_rolling_std_{w}", f"{c}_rolling_residual_{w}", f"{c}_zscore_{w}"]
        names += [f"{c}_pct_change_1d", f"{c}_abs_pct_change_1d"]
    names += ["revenue_per_active_user", "signup_rate"]
    return (
        "SELECT company_id, date, revenue, active_users, signups, day_of_week, "
        + ", ".join(f"coalesce({n}, 0) AS {n}" for n in names)
        + f" FROM {source}"
    )


_LOGIT = " + ".join(f"({w}) * {c}" for c, w in CHURN_COEFFICIENTS.items())

FRAGMENTS: dict[str, str] = {
    "cust_company": """
      SELECT c.c_custkey, r.r_name AS region_name, n.n_name AS nation_name, c.c_mktsegment
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
      JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "company_dim": "SELECT r_name AS company_id, r_regionkey::BIGINT AS company_no FROM region",
    "cutoff_day": "SELECT max(o_orderdate)::DATE - 180 AS cutoff FROM orders",
    "order_history": """
      SELECT * FROM (
        SELECT o.o_custkey, x.cutoff,
          min(o.o_orderdate::DATE) FILTER (WHERE o.o_orderdate::DATE <= x.cutoff) AS first_order,
          round(sum(o.o_totalprice) FILTER (WHERE o.o_orderdate::DATE <= x.cutoff), 2) AS spend,
          count(*) FILTER (WHERE o.o_orderdate::DATE <= x.cutoff) AS n_orders,
          count(*) FILTER (WHERE o.o_orderdate::DATE > x.cutoff) AS n_later
        FROM orders o CROSS JOIN cutoff_day x GROUP BY o.o_custkey, x.cutoff) h
      WHERE n_orders > 0""",
    "ticket_events": "SELECT event_id, user_id FROM events WHERE event_type = 'error'",
    "customers": _customers("region_name"),
    "nation_customers": _customers("nation_name"),
    "daily": _daily("region_name"),
    "nation_daily": _daily("nation_name"),
    "reviews": """
      SELECT *, CASE sentiment_label WHEN 'negative' THEN review_id % 2 + 1
                 WHEN 'neutral' THEN 3 ELSE review_id % 2 + 4 END::INT AS star_rating
      FROM (SELECT d.company_id, doc_id AS review_id, text AS review_text,
              CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 0 THEN 'neutral' ELSE 'positive' END AS sentiment_label,
              DATE '2024-01-01' + (doc_id % 90)::INT AS review_date
            FROM documents JOIN labels USING (doc_id)
            JOIN company_dim d ON d.company_no = substr(source, 4)::BIGINT % 5) v""",
    "churn_features": """
      SELECT *, monthly_spend / (usage_frequency + 1) AS spend_per_login,
        support_tickets / (tenure + 1) AS tickets_per_tenure,
        usage_frequency / (tenure + 1) AS usage_per_tenure,
        CASE WHEN usage_frequency <= 4 THEN 1 ELSE 0 END AS low_usage_flag,
        CASE WHEN support_tickets >= 1 THEN 1 ELSE 0 END AS high_ticket_flag,
        CASE WHEN tenure <= 6 THEN 1 ELSE 0 END AS early_customer_flag
      FROM customers""",
    "scored_customers": f"""
      SELECT *, 1 / (1 + exp(-({CHURN_INTERCEPT} + {_LOGIT}))) AS churn_prob FROM churn_features""",
    "scored_reviews": """
      SELECT *, sentiment_label AS label,
        CASE sentiment_label WHEN 'negative' THEN 0.1::DOUBLE WHEN 'neutral' THEN 0.5::DOUBLE
          ELSE 0.9::DOUBLE END AS score
      FROM reviews""",
    "raw_features": _series_features("daily"),
    "daily_cents": "SELECT * REPLACE (round(revenue * 100) AS revenue) FROM daily",
    "cent_features": _series_features("daily_cents"),
    "zeroed_cents": _zeroed_features("cent_features"),
    "series_features": _zeroed_features("raw_features"),
    "flagged_days": """
      SELECT *, abs(revenue_zscore_30) > 3 AS is_anomaly, -abs(revenue_zscore_30) AS anomaly_score
      FROM series_features""",
    "recent_days": """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY date DESC) AS recency
        FROM flagged_days) x WHERE recency <= 30""",
    "days_split": f"""
      SELECT *, CASE WHEN n > {HOLDOUT} THEN recency <= {HOLDOUT} ELSE false END AS is_test
      FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY date DESC) AS recency,
              count(*) OVER (PARTITION BY company_id) AS n FROM daily) x""",
    "train_days": "SELECT company_id, date, revenue FROM days_split WHERE NOT is_test AND n > 30",
    "holdout_rows": f"""
      SELECT company_id, {HOLDOUT} - recency + 1 AS step, date, revenue AS actual
      FROM days_split WHERE is_test""",
    "weekly_tail": """
      SELECT company_id, 7 - r AS season_no, revenue AS tail_value
      FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY date DESC) AS r FROM train_days) x
      WHERE r <= 7""",
    "naive_models": """
      SELECT company_id, max(date) AS last_date, arg_max(revenue, date) AS last_value, count(*) AS n_rows,
        CASE WHEN count(*) > 7 THEN stddev_pop(residual) ELSE stddev_pop(revenue) END AS residual_std
      FROM (SELECT *, revenue - lag(revenue, 7) OVER (PARTITION BY company_id ORDER BY date) AS residual
            FROM train_days) x
      GROUP BY company_id""",
    "naive_forecast": """
      SELECT m.company_id, s.step, m.last_date + s.step::INT AS date, m.last_value,
        CASE WHEN m.n_rows >= 7 THEN t.tail_value ELSE m.last_value END AS forecast,
        1.96 * m.residual_std * sqrt(s.step) AS margin
      FROM naive_models m CROSS JOIN (SELECT unnest(range(1, 61)) AS step) s
      LEFT JOIN weekly_tail t ON t.company_id = m.company_id AND t.season_no = (s.step - 1) % 7""",
    "projected": """
      SELECT f.company_id, f.step, coalesce(h.date, f.date) AS date, h.actual, f.forecast,
        least(f.forecast - margin, f.forecast) AS lower_bound,
        greatest(f.forecast + margin, f.forecast) AS upper_bound, h.actual IS NULL AS is_projection
      FROM naive_forecast f LEFT JOIN holdout_rows h ON h.company_id = f.company_id AND h.step = f.step""",
    "churn_signal": "SELECT company_id, avg(churn_prob) AS churn_prob FROM scored_customers GROUP BY company_id",
    "review_signal": """
      SELECT company_id, sentiment_positivity,
        CASE WHEN sentiment_positivity < 0.45 THEN 'negative' WHEN sentiment_positivity < 0.6 THEN 'neutral'
          ELSE 'positive' END AS dominant_sentiment
      FROM (SELECT company_id, sum(score::DECIMAL(20,15))::DOUBLE / count(score) AS sentiment_positivity FROM scored_reviews GROUP BY company_id) x""",
    "anomaly_signal": """
      SELECT company_id, anomaly_flag_ratio, recent_anomalies, list_filter([
          CASE WHEN (r_f - r_a) / nullif(abs(r_a), 0) < -0.10 THEN 'revenue' END,
          CASE WHEN (u_f - u_a) / nullif(abs(u_a), 0) < -0.10 THEN 'active_users' END,
          CASE WHEN (s_f - s_a) / nullif(abs(s_a), 0) < -0.10 THEN 'signups' END], lambda m: m IS NOT NULL) AS dropped_metrics
      FROM (SELECT company_id, avg(is_anomaly::INT) AS anomaly_flag_ratio,
              count(*) FILTER (WHERE is_anomaly) AS recent_anomalies,
              avg(revenue) AS r_a, avg(revenue) FILTER (WHERE is_anomaly) AS r_f,
              avg(active_users) AS u_a, avg(active_users) FILTER (WHERE is_anomaly) AS u_f,
              avg(signups) AS s_a, avg(signups) FILTER (WHERE is_anomaly) AS s_f
            FROM recent_days GROUP BY company_id) x""",
    "forecast_means": """
      SELECT company_id, avg(forecast) FILTER (WHERE actual IS NOT NULL) AS f, avg(actual) AS a,
        avg(forecast) FILTER (WHERE actual IS NULL) AS p
      FROM projected GROUP BY company_id""",
    "forecast_signal": """
      SELECT company_id,
        CASE WHEN abs(f) > 1e-9 AND p IS NOT NULL AND abs(a) > 1e-9
             THEN least(greatest((greatest((f - a) / abs(f), 0) + greatest((a - p) / abs(a), 0)) / 2, 0), 1)
             WHEN abs(f) > 1e-9 THEN least(greatest((f - a) / abs(f), 0), 1) ELSE 0 END AS forecast_deviation,
        CASE WHEN (a - f) / abs(f) < -0.05 THEN round_even(abs((a - f) / abs(f)) * 100, 0)::BIGINT || '% below forecast'
             WHEN (a - f) / abs(f) > 0.05 THEN round_even(abs((a - f) / abs(f)) * 100, 0)::BIGINT || '% above forecast'
             ELSE 'in line with forecast' END AS forecast_trend
      FROM forecast_means""",
    "signal_table": """
      SELECT d.company_id, coalesce(c.churn_prob, 0) AS churn_prob,
        coalesce(r.sentiment_positivity, 1) AS sentiment_positivity,
        coalesce(a.anomaly_flag_ratio, 0) AS anomaly_flag_ratio,
        coalesce(f.forecast_deviation, 0) AS forecast_deviation,
        coalesce(r.dominant_sentiment, 'unknown') AS dominant_sentiment,
        coalesce(a.recent_anomalies, 0) AS recent_anomalies, a.dropped_metrics,
        coalesce(f.forecast_trend, 'in line with forecast') AS forecast_trend
      FROM company_dim d LEFT JOIN churn_signal c USING (company_id)
      LEFT JOIN review_signal r USING (company_id) LEFT JOIN anomaly_signal a USING (company_id)
      LEFT JOIN forecast_signal f USING (company_id)""",
    "attribution": "SELECT c.company_id, x.feature, x.weight * (CASE x.feature "
      + " ".join(f"WHEN '{c}' THEN c.m_{c} - o.m_{c}" for c in CHURN_COEFFICIENTS)
      + " END) AS value FROM (SELECT company_id, "
      + ", ".join(f"avg({c}) AS m_{c}" for c in CHURN_COEFFICIENTS)
      + " FROM churn_features GROUP BY company_id) c CROSS JOIN (SELECT "
      + ", ".join(f"avg({c}) AS m_{c}" for c in CHURN_COEFFICIENTS)
      + " FROM churn_features) o CROSS JOIN (VALUES "
      + ", ".join(f"('{c}', {w}::DOUBLE)" for c, w in CHURN_COEFFICIENTS.items())
      + ") x(feature, weight)",
    "factor_ranks": """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY abs(value) DESC, feature) AS rank
        FROM attribution) x WHERE rank <= 3""",
    "terms_table": """
      SELECT company_id, churn_prob AS churn_term, 1 - sentiment_positivity AS sentiment_term,
        least(anomaly_flag_ratio / 0.10, 1) AS anomaly_term, least(forecast_deviation / 0.10, 1) AS forecast_term
      FROM signal_table""",
    "assessed": """
      SELECT s.*, t.* EXCLUDE (company_id),
        35 * churn_term AS churn_points, 20 * sentiment_term AS sentiment_points,
        20 * anomaly_term AS anomaly_points, 25 * forecast_term AS forecast_points,
        100 * least(greatest(0.35 * churn_term + 0.20 * sentiment_term + 0.20 * anomaly_term
          + 0.25 * forecast_term, 0), 1) AS risk_score,
        'Risk driven primarily by ' || f.names
          || CASE s.dominant_sentiment WHEN 'negative' THEN '; customer sentiment is mostly negative'
               WHEN 'neutral' THEN '; customer sentiment is flat' WHEN 'positive' THEN '; customer sentiment is healthy'
               ELSE '; customer sentiment is unclear' END
          || CASE WHEN recent_anomalies = 1 THEN '; 1 anomalous day detected in the last 30 days'
               WHEN recent_anomalies > 1 THEN '; ' || recent_anomalies || ' anomalous days detected in the last 30 days'
               ELSE '' END
          || '; revenue is trending ' || s.forecast_trend || '.' AS explanation_text
      FROM signal_table s JOIN terms_table t USING (company_id)
      JOIN (SELECT company_id, string_agg(replace(feature, '_', ' '), ' and ' ORDER BY rank) AS names
            FROM factor_ranks WHERE rank <= 2 GROUP BY company_id) f USING (company_id)""",
    "banded": """
      SELECT *, CASE WHEN risk_score < 30 THEN 'Low' WHEN risk_score < 60 THEN 'Medium' ELSE 'High' END AS risk_label,
        CASE WHEN risk_score < 30 THEN 'green' WHEN risk_score < 60 THEN 'orange' ELSE 'red' END AS risk_colour
      FROM assessed""",
}


def percent(x: str) -> str:
    return f"(round_even(({x}) * 100, 0)::BIGINT || '%')"


_CRITICAL = "((churn_prob > 0.55 AND sentiment_positivity < 0.45) OR (forecast_deviation > 0.08 AND churn_prob > 0.35))"
_RULES = [
    ("churn_prob > 0.55 AND sentiment_positivity < 0.45", 0, 1,
     "'Prioritize retention outreach for the at-risk segment and review recent negative feedback themes.'",
     f"'High churn risk (' || {percent('churn_prob')} || ') combined with negative customer sentiment (' || {percent('sentiment_positivity')} || ' positivity).'"),
    ("forecast_deviation > 0.08 AND churn_prob > 0.35", 0, 2,
     "'Run an immediate pricing and retention review -- revenue decline is compounding with churn risk.'",
     f"'Revenue is ' || {percent('forecast_deviation')} || ' off forecast while churn risk sits at ' || {percent('churn_prob')} || '.'"),
    (f"churn_prob > 0.55 AND NOT {_CRITICAL}", 1, 3,
     "'Launch a targeted win-back campaign for the highest-risk customers.'",
     f"'Mean churn probability across the customer base is ' || {percent('churn_prob')} || '.'"),
    ("churn_prob > 0.35 AND churn_prob <= 0.55", 2, 3,
     "'Schedule check-in calls with low-usage accounts before they lapse.'",
     f"'Churn probability is elevated at ' || {percent('churn_prob')} || '.'"),
    ("sentiment_positivity < 0.45", 1, 4,
     "'Triage recent negative reviews and publish a response plan for the most common complaint themes.'",
     f"'Average review positivity is only ' || {percent('sentiment_positivity')} || '.'"),
    ("anomaly_flag_ratio > 0.03 AND list_contains(dropped_metrics, 'revenue')", 1, 5,
     "'Investigate the payment and billing pipeline for failed charges.'",
     "'Revenue showed an unusual drop on recently flagged days.'"),
    ("anomaly_flag_ratio > 0.03 AND list_contains(dropped_metrics, 'active_users')", 1, 6,
     "'Check for a product outage or a recent breaking release.'",
     "'Active users dropped sharply on recently flagged days.'"),
    ("anomaly_flag_ratio > 0.03 AND list_contains(dropped_metrics, 'signups')", 1, 7,
     "'Review the signup funnel and any recent marketing or pricing changes.'",
     "'Signups dropped sharply on recently flagged days.'"),
    ("anomaly_flag_ratio > 0.03 AND len(dropped_metrics) = 0", 2, 8,
     "'Review flagged anomalous days against your release and campaign calendar.'",
     f"{percent('anomaly_flag_ratio')} || ' of the last 30 days were flagged as anomalous.'"),
    (f"forecast_deviation > 0.08 AND NOT {_CRITICAL}", 2, 9,
     "'Re-forecast the quarter and investigate why actuals are diverging from the model.'",
     f"'Actual revenue is deviating ' || {percent('forecast_deviation')} || ' from forecast.'"),
]
_PRIORITY = ["critical", "high", "medium", "low", "info"]


def rules_over(source: str) -> str:
    """Every fired rule of the signal rows in `source`, in order; the calm item if none."""
    fired = " UNION ALL ".join(
        f"SELECT company_id, {u} AS urgency, {n} AS rule_no, {a} AS action, {r} AS reason, '{_PRIORITY[u]}' AS priority "
        f"FROM {source} WHERE {test}"
        for test, u, n, a, r in _RULES
    )
    calm = (
        "SELECT company_id, 4, 10, 'Healthy -- no immediate action required. Continue monitoring.', "
        f"'All four risk signals are within normal ranges.', 'info' FROM {source} "
        f"WHERE company_id NOT IN (SELECT company_id FROM ({fired}) f)"
    )
    return (
        "SELECT company_id, row_number() OVER (PARTITION BY company_id ORDER BY urgency, rule_no) - 1 AS item_no, "
        f"action, reason, priority FROM ({fired} UNION ALL {calm}) x"
    )


FRAGMENTS["advice"] = rules_over("signal_table")
