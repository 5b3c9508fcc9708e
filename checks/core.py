"""Sources, ingest, validation, preparation, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs
from checks.fragments import FRAGMENTS
from checks.registry import check
from riskloom.config import CHURN_BASE_COLUMNS, CHURN_NUMERIC_COLUMNS, SERIES_COLUMNS
from riskloom.functions import scalars
from riskloom.operators import ingest, joins, preparation, recommend, validation
from riskloom.sources import files, warehouse
from riskloom.sources.scratch import scratch_path

FRAGMENTS["catalog_rows"] = inputs.CATALOG_SQL
FRAGMENTS["cell_rows"] = inputs.CELLS_SQL
FRAGMENTS["saas_rows"] = inputs.SAAS_SQL
FRAGMENTS["upload_customers"] = inputs.RAW_CUSTOMERS_SQL
FRAGMENTS["upload_reviews"] = inputs.RAW_REVIEWS_SQL
FRAGMENTS["upload_days"] = inputs.RAW_DAILY_SQL

CUSTOMER_SPEC = ("company_id customer_id:i tenure:i monthly_spend:f usage_frequency:i "
                 "support_tickets:i plan_type churn_label:i")

# ---------------------------------------------------------------- sources and sinks


@check(CUSTOMER_SPEC, "SELECT * FROM customers")
def q_read_customers(spark, d):
    path = scratch_path(spark, "customers")
    files.write_table(warehouse.customers(spark, d).drop("signup_date"), path, "csv")
    return files.read_customers(spark, path)


@check("company_id review_id:i review_text star_rating:i sentiment_label review_date", """
  SELECT company_id, review_id, md5(review_text) AS review_text, star_rating, sentiment_label, review_date
  FROM reviews""")
def q_read_reviews(spark, d):
    path = scratch_path(spark, "reviews")
    files.write_table(warehouse.reviews(spark, d), path, "csv")
    return files.read_reviews(spark, path).withColumn("review_text", F.md5("review_text"))


@check("company_id date revenue:f active_users:i signups:i", "SELECT * FROM daily")
def q_read_daily_metrics(spark, d):
    path = scratch_path(spark, "daily")
    daily = warehouse.daily_metrics(spark, d).withColumnRenamed("company_id", "company_name")
    parted = daily.withColumn("part", scalars.slugify(F.col("company_name")))
    odd = F.length("company_name") % 2 == 1
    # half of the companies export their columns in another order
    files.write_table(parted.where(odd), f"{path}/raw", "csv", ["part"])
    turned = parted.where(~odd).select("signups", "revenue", "date", "company_name", "active_users", "part")
    files.write_table(turned, f"{path}/raw", "csv", ["part"], "append")
    return files.read_daily_metrics(spark, f"{path}/raw/part=*")


_NA = "[" + ", ".join(f"'{t}'" for t in scalars.NA_TOKENS) + "]"


@check("o_orderkey:i cell", f"""
  SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS cell FROM orders""")
def q_normalize_na(spark, d):
    key = F.col("o_orderkey")
    raw = warehouse.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(key % 4 == 0, inputs.pick(scalars.NA_TOKENS, key % len(scalars.NA_TOKENS)))
        .otherwise(F.col("o_orderpriority")).alias("cell"),
    )
    return raw.withColumn("cell", scalars.normalize_na(F.col("cell")))


@check("company_id risk_score:f risk_label churn_prob:f sentiment_positivity:f anomaly_flag_ratio:f "
       "forecast_deviation:f churn_points:f factors:a explanation_text", """
  SELECT b.company_id, round(risk_score, 2) AS risk_score, risk_label, round(churn_prob, 4) AS churn_prob,
    round(sentiment_positivity, 4) AS sentiment_positivity, round(anomaly_flag_ratio, 4) AS anomaly_flag_ratio,
    round(forecast_deviation, 4) AS forecast_deviation, round(churn_points, 2) AS churn_points, f.factors,
    explanation_text
  FROM banded b JOIN (SELECT company_id, list(feature ORDER BY rank) AS factors FROM factor_ranks GROUP BY company_id) f
    USING (company_id)""")
def q_write_assessment(spark, d):
    path = scratch_path(spark, "assessment")
    files.write_assessment(inputs.assessed(spark, d), path)
    back = spark.read.json(path)
    return back.select(
        "company_id", "risk_score", "risk_label", "signals.*",
        F.col("contributions.Churn").alias("churn_points"),
        F.col("top_factors.feature").alias("factors"), "explanation_text",
    )


@check("company_id file_name report_name report_label first_action customers_used:i note", """
  SELECT b.company_id, replace(lower(b.company_id), ' ', '_') || '_risk_report.json' AS file_name,
    b.company_id AS report_name, risk_label AS report_label, a.action AS first_action, q.n AS customers_used,
    CASE WHEN t.n >= 60 THEN 'Using a 30-day backtest (60+ days of history available).' ELSE 'short' END AS note
  FROM banded b JOIN advice a ON a.company_id = b.company_id AND a.item_no = 0
  JOIN (SELECT company_id, count(*) AS n FROM customers GROUP BY company_id) q ON q.company_id = b.company_id
  JOIN (SELECT company_id, count(*) AS n FROM daily GROUP BY company_id) t ON t.company_id = b.company_id""")
def q_write_report(spark, d):
    quality = validation.data_quality(
        warehouse.companies(spark, d), warehouse.customers(spark, d), warehouse.reviews(spark, d),
        warehouse.daily_metrics(spark, d),
    )
    packed = quality.select(
        "company_id",
        F.struct("customers", "reviews", "timeseries_days", "forecast_note").alias("data_quality"),
    )
    advised = recommend.recommendations(inputs.assessed(spark, d)).join(packed, "company_id")
    path = scratch_path(spark, "report")
    files.write_report(advised, path)
    get = lambda p: F.get_json_object("report", p)
    return spark.read.json(path).select(
        "company_id", "file_name", get("$.company_name").alias("report_name"),
        get("$.risk_label").alias("report_label"),
        get("$.recommendations[0].action").alias("first_action"),
        get("$.data_quality.customers").cast("bigint").alias("customers_used"),
        get("$.data_quality.forecast_note").alias("note"),
    )


@check("company_id date revenue:f active_users:i signups:i", "SELECT * FROM daily")
def q_write_dataset(spark, d):
    path = scratch_path(spark, "dataset")
    files.write_table(warehouse.daily_metrics(spark, d), path, "parquet", ["company_id"])
    return spark.read.parquet(path)


# ---------------------------------------------------------------- ingest


@check("o_orderkey:i normalized", """
  SELECT o_orderkey, regexp_replace(lower(o_orderpriority), '[^a-z0-9]', '', 'g') AS normalized FROM orders""")
def q_normalize_name(spark, d):
    return warehouse.table(spark, d, "orders").withColumn(
        "normalized", scalars.normalize_name(F.col("o_orderpriority"))
    )


def _mapping_sql() -> None:
    """Scored (company, field, column) options, then one pick per field in target order."""
    rows = []
    for f_no, (field, aliases) in enumerate(ingest.COLUMN_ALIASES.items()):
        rows.append(f"({f_no}, '{field}', 1, 0, '{field.replace('_', '')}')")
        rows += [f"({f_no}, '{field}', 2, {i}, '{a}')" for i, a in enumerate(aliases)]
        longest = [a for a in sorted(aliases, key=len, reverse=True) if len(a) >= 4]
        rows += [f"({f_no}, '{field}', 3, {i}, '{a}')" for i, a in enumerate(longest)]
    FRAGMENTS["alias_rows"] = f"SELECT * FROM (VALUES {', '.join(rows)}) v(field_no, field, tier, place, alias)"
    FRAGMENTS["unique_headers"] = """
      SELECT company_id, norm, arg_max(column_name, position) AS column_name, min(position) AS position
      FROM (SELECT *, regexp_replace(lower(column_name), '[^a-z0-9]', '', 'g') AS norm FROM catalog_rows) x
      GROUP BY company_id, norm"""
    FRAGMENTS["header_options"] = """
      SELECT u.company_id, a.field_no, a.field, u.column_name, a.tier, a.tier * 1000000 + a.place * 1000 + u.position AS cost
      FROM unique_headers u JOIN alias_rows a
        ON CASE WHEN a.tier = 3 THEN contains(u.norm, a.alias) ELSE u.norm = a.alias END"""
    earlier = []
    for i in range(len(ingest.COLUMN_ALIASES)):
        taken = " UNION ALL ".join(f"SELECT company_id, column_name FROM pick_{j}" for j in earlier)
        free = f"AND (company_id, column_name) NOT IN ({taken})" if earlier else ""
        FRAGMENTS[f"pick_{i}"] = f"""
          SELECT company_id, field_no, field, arg_min(column_name, cost) AS column_name, arg_min(tier, cost) AS tier
          FROM header_options WHERE field_no = {i} {free} GROUP BY company_id, field_no, field"""
        earlier.append(i)
    picks = " UNION ALL ".join(f"SELECT * FROM pick_{i}" for i in earlier)
    FRAGMENTS["mapping_rows"] = f"""
      SELECT c.company_id, f.field_no, f.field, p.column_name,
        CASE p.tier WHEN 1 THEN 'exact' WHEN 2 THEN 'likely' WHEN 3 THEN 'guess' END AS confidence
      FROM (SELECT DISTINCT company_id FROM catalog_rows) c
      CROSS JOIN (SELECT DISTINCT field_no, field FROM alias_rows) f
      LEFT JOIN ({picks}) p ON p.company_id = c.company_id AND p.field_no = f.field_no"""


_mapping_sql()


@check("company_id field_no:i field column_name confidence", "SELECT * FROM mapping_rows")
def q_detect_column_mapping(spark, d):
    return ingest.detect_column_mapping(inputs.catalog(spark, d))


@check("company_id field column_name", """
  SELECT company_id, field, arg_min(column_name, cost) AS column_name FROM header_options GROUP BY company_id, field""")
def q_best_match_per_field(spark, d):
    return ingest.best_match_per_field(inputs.catalog(spark, d))


FRAGMENTS["date_like"] = """
  SELECT company_id, column_name, avg((try_strptime(value, ['%Y-%m-%d', '%m/%d/%Y']) IS NOT NULL)::INT) > 0.8 AS looks_like_dates
  FROM (SELECT *, row_number() OVER (PARTITION BY company_id, column_name ORDER BY row_no) AS n
        FROM cell_rows WHERE value IS NOT NULL) x
  WHERE n <= 25 GROUP BY company_id, column_name"""
_SIGNUP = "[" + ", ".join(f"'{a}'" for a in ingest.SIGNUP_DATE_ALIASES) + "]"
FRAGMENTS["signup_columns"] = f"""
  SELECT company_id, arg_min(column_name, rank) AS column_name FROM (
    SELECT u.company_id, u.column_name,
      CASE WHEN list_position({_SIGNUP}, u.norm) > 0 THEN list_position({_SIGNUP}, u.norm)
        WHEN (contains(u.norm, 'date') OR contains(u.norm, 'created') OR contains(u.norm, 'since'))
          AND coalesce(l.looks_like_dates, false) THEN 1000 + u.position END AS rank
    FROM unique_headers u LEFT JOIN date_like l ON l.company_id = u.company_id AND l.column_name = u.column_name) x
  GROUP BY company_id"""


@check("company_id column_name looks_like_dates", "SELECT * FROM date_like")
def q_looks_like_dates(spark, d):
    return ingest.looks_like_dates(inputs.cells(spark, d))


@check("company_id column_name", "SELECT * FROM signup_columns")
def q_detect_signup_date_column(spark, d):
    return ingest.detect_signup_date_column(
        inputs.catalog(spark, d), ingest.looks_like_dates(inputs.cells(spark, d))
    )


BILLING_MAP = {
    "customer_id": "Customer ID", "tenure": None, "monthly_spend": "Monthly Recurring Revenue",
    "usage_frequency": "Login Count (30d)", "support_tickets": None, "plan_type": "Plan Name",
}
_MONTHS = """greatest(round_even(((max(signup_date) OVER (PARTITION BY company_id)) - signup_date) / 30.44::DOUBLE, 0)::INT, 1)"""


@check("company_id customer_id:i monthly_spend:f usage_frequency:i plan_type tenure:i support_tickets:i", f"""
  SELECT company_id, customer_id, monthly_spend, usage_frequency, plan_type, {_MONTHS} AS tenure, 0 AS support_tickets
  FROM customers""")
def q_apply_mapping(spark, d):
    return ingest.apply_mapping(
        inputs.billing_export(spark, d), BILLING_MAP, "Created (UTC)", ingest.SAFE_DEFAULTS
    )


@check("company_id customer_id:i tenure:i", f"""
  SELECT company_id, customer_id, CASE WHEN customer_id % 9 = 0 THEN 1 ELSE
    greatest(round_even(((max(CASE WHEN customer_id % 9 <> 0 THEN signup_date END) OVER (PARTITION BY company_id))
      - signup_date) / 30.44::DOUBLE, 0)::INT, 1) END AS tenure
  FROM customers""")
def q_derive_tenure(spark, d):
    raw = warehouse.customers(spark, d).withColumn(
        "joined", F.when(F.col("customer_id") % 9 == 0, "not a date").otherwise(F.col("signup_date").cast("string"))
    )
    return ingest.derive_tenure(raw.drop("tenure"), "joined")


@check("company_id matched:a unmatched:a", """
  SELECT company_id, coalesce(list(field ORDER BY field_no) FILTER (WHERE column_name IS NOT NULL), []) AS matched,
    coalesce(list(field ORDER BY field_no) FILTER (WHERE column_name IS NULL), []) AS unmatched
  FROM mapping_rows GROUP BY company_id""")
def q_mapping_summary(spark, d):
    return ingest.mapping_summary(ingest.detect_column_mapping(inputs.catalog(spark, d)))


@check("company_id field_no:i field", """
  SELECT m.company_id, m.field_no, m.field FROM mapping_rows m JOIN signup_columns s USING (company_id)
  WHERE m.column_name IS NULL AND (m.field IN ('monthly_spend', 'plan_type')
    OR (m.field = 'tenure' AND s.column_name IS NULL))""")
def q_unmapped_fields(spark, d):
    catalog = inputs.catalog(spark, d)
    mapping = ingest.detect_column_mapping(catalog)
    signup = ingest.detect_signup_date_column(
        catalog, ingest.looks_like_dates(inputs.cells(spark, d))
    )
    return ingest.unmapped_fields(mapping, signup)


@check("company_id customer_id:i spend_per_login:f tickets_per_tenure:f usage_per_tenure:f low_usage_flag:i "
       "high_ticket_flag:i early_customer_flag:i", "SELECT * FROM churn_features")
def q_engineer_features(spark, d):
    return inputs.features(spark, d)


FRAGMENTS["saas_customers"] = """
  SELECT sha256(Customer_ID) AS customer_id,
    greatest(round_even(Account_Age_Days / 30::DOUBLE, 0)::INT, 1) AS tenure,
    round_even(least(greatest(25 + Daily_Usage_Mins * 0.85::DOUBLE, 10), 200) * 100, 0) / 100 AS monthly_spend,
    CASE Login_Frequency WHEN 'Daily' THEN 30 WHEN 'Weekly' THEN 4 WHEN 'Monthly' THEN 1 ELSE 0 END AS usage_frequency,
    CASE WHEN regexp_matches(lower(Last_Support_Ticket), 'support|bug|issue|confusing|cancel|waiting|problem|error|broken')
      THEN 1 ELSE 0 END AS support_tickets,
    CASE WHEN Daily_Usage_Mins <= -1 THEN 'nan' WHEN Daily_Usage_Mins <= 25 THEN 'basic'
      WHEN Daily_Usage_Mins <= 80 THEN 'pro' ELSE 'enterprise' END AS plan_type,
    Churn AS churn_label
  FROM saas_rows"""


@check("customer_id tenure:i monthly_spend:f2 usage_frequency:i support_tickets:i plan_type churn_label:i",
       "SELECT * FROM saas_customers")
def q_standardize_source_churn(spark, d):
    return ingest.standardize_source_churn(inputs.saas_source(spark, d))


@check("c_custkey:i hashed", "SELECT c_custkey, sha256(c_name) AS hashed FROM customer")
def q_anonymize_id(spark, d):
    return warehouse.table(spark, d, "customer").withColumn("hashed", scalars.anonymize_id(F.col("c_name")))


@check("c_custkey:i masked", "SELECT c_custkey, substr(c_name, 1, 10) || '…' AS masked FROM customer")
def q_mask_id(spark, d):
    return warehouse.table(spark, d, "customer").withColumn("masked", scalars.mask_id(F.col("c_name")))


# ---------------------------------------------------------------- validation


def _num(c: str) -> str:
    return f"try_cast({c} AS DOUBLE)"


def _numeric_issue_sql(c: str) -> list[str]:
    bad = f"count(*) FILTER (WHERE {c} IS NOT NULL AND {_num(c)} IS NULL)"
    missing = f"count(*) FILTER (WHERE {c} IS NULL)"
    return [
        f"CASE WHEN {bad} > 0 THEN 'Column ''{c}'' has ' || {bad} || ' non-numeric value(s).' END",
        f"CASE WHEN {missing} > 0 THEN 'Column ''{c}'' has ' || {missing} || ' missing/blank value(s) "
        f"(this includes cells like ''N/A'' or ''null'').' END",
    ]


def _issue_sql(messages: list[str], source: str) -> str:
    return (
        f"SELECT company_id, list_filter([{', '.join(messages)}], lambda m: m IS NOT NULL) AS issues "
        f"FROM {source} GROUP BY company_id"
    )


_customer_messages = [
    "CASE WHEN count(*) < 10 THEN 'Only ' || count(*) || ' customer rows found; at least 10 are needed for the "
    "churn score to be meaningful.' END"
]
for _c in CHURN_NUMERIC_COLUMNS:
    _customer_messages += _numeric_issue_sql(_c)
_customer_messages += [
    "CASE WHEN count(*) FILTER (WHERE churn_label NOT IN ('0', '1')) > 0 THEN '''churn_label'' must be 0 or 1 where provided.' END",
    f"CASE WHEN count(*) FILTER (WHERE {_num('tenure')} < 0) > 0 THEN '''tenure'' cannot be negative.' END",
]
FRAGMENTS["customer_issues"] = _issue_sql(_customer_messages, "upload_customers")
FRAGMENTS["review_issues"] = _issue_sql([
    "CASE WHEN count(*) < 5 THEN 'Only ' || count(*) || ' reviews found; at least 5 are needed for a usable sentiment signal.' END",
    "CASE WHEN bool_and(review_text IS NULL OR trim(review_text) = '') THEN 'Every ''review_text'' value is empty.' END",
], "upload_reviews")
_bad_dates = "count(*) FILTER (WHERE try_cast(date AS DATE) IS NULL)"
_day_messages = [
    "CASE WHEN count(*) < 14 THEN 'Only ' || count(*) || ' daily rows found; at least 14 are needed for anomaly detection to run.' END",
    f"CASE WHEN {_bad_dates} > 0 THEN '''date'' has ' || {_bad_dates} || ' value(s) that don''t parse as dates.' "
    "WHEN count(DISTINCT date) < count(date) THEN '''date'' has duplicate values -- expected one row per day.' END",
]
for _c in SERIES_COLUMNS:
    _day_messages += _numeric_issue_sql(_c)
    _day_messages.append(
        f"CASE WHEN count(*) FILTER (WHERE {_num(_c)} < 0) > 0 THEN 'Column ''{_c}'' has negative value(s), "
        "which is not a valid count/amount.' END"
    )
FRAGMENTS["day_issues"] = _issue_sql(_day_messages, "upload_days")


def _unnested(source: str) -> str:
    return (
        "SELECT company_id, k - 1 AS issue_no, issues[k] AS issue FROM "
        f"(SELECT company_id, issues, unnest(range(1, len(issues) + 1)) AS k FROM {source}) x"
    )


@check("company_id issue_no:i issue", _unnested("customer_issues"))
def q_validate_customers(spark, d):
    return validation.issue_rows(validation.validate_customers(inputs.raw_customers(spark, d)))


@check("company_id issue_no:i issue", _unnested("review_issues"))
def q_validate_reviews(spark, d):
    return validation.issue_rows(validation.validate_reviews(inputs.raw_reviews(spark, d)))


@check("company_id issue_no:i issue", _unnested("day_issues"))
def q_validate_timeseries(spark, d):
    return validation.issue_rows(validation.validate_timeseries(inputs.raw_daily(spark, d)))


@check("company_id column_name non_numeric:i missing:i", " UNION ALL ".join(
    f"SELECT company_id, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NOT NULL AND {_num(c)} IS NULL) AS non_numeric, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS missing FROM upload_customers GROUP BY company_id"
    for c in CHURN_NUMERIC_COLUMNS))
def q_numeric_column_errors(spark, d):
    return validation.numeric_column_errors(inputs.raw_customers(spark, d), CHURN_NUMERIC_COLUMNS)


FRAGMENTS["customer_years"] = "SELECT o_custkey AS company_id, o_orderdate::DATE AS date FROM orders GROUP BY ALL"
_NOTE = """CASE WHEN n_rows >= 60 THEN 'Using a 30-day backtest (60+ days of history available).'
  WHEN n_rows >= 30 THEN 'Using a 14-day backtest (30-59 days of history available).'
  ELSE 'Only ' || n_rows || ' days of history -- need at least 30 to forecast. The forecast signal is excluded from this company''s risk score.' END"""


@check("company_id:i n_rows:i can_forecast holdout_days:i forecast_note", f"""
  SELECT company_id, n_rows, n_rows >= 30 AS can_forecast,
    CASE WHEN n_rows >= 60 THEN 30 WHEN n_rows >= 30 THEN 14 ELSE 0 END AS holdout_days, {_NOTE} AS forecast_note
  FROM (SELECT o_custkey % 40 + (o_orderkey % 2) * 1000 * (o_custkey % 40) AS company_id, count(DISTINCT o_orderdate::DATE) AS n_rows FROM orders GROUP BY 1) x""")
def q_forecast_readiness(spark, d):
    slot = F.col("o_custkey") % 40
    days = warehouse.table(spark, d, "orders").select(
        (slot + (F.col("o_orderkey") % 2) * 1000 * slot).alias("company_id"),
        F.col("o_orderdate").cast("date").alias("date"),
    ).distinct()
    return validation.forecast_readiness(days)


@check("company_id error", """
  SELECT company_id, 'Invalid customer data: ' || array_to_string(issues, '; ') AS error
  FROM customer_issues WHERE len(issues) > 0""")
def q_gate_scoring(spark, d):
    return validation.gate_scoring(validation.validate_customers(inputs.raw_customers(spark, d)))


@check("company_id error", """
  SELECT company_id, string_agg('Invalid ' || name || ' data: ' || array_to_string(issues, '; '), ' ' ORDER BY place) AS error
  FROM (SELECT company_id, 'customer' AS name, 0 AS place, issues FROM customer_issues
    UNION ALL SELECT company_id, 'review', 1, issues FROM review_issues
    UNION ALL SELECT company_id, 'time-series', 2, issues FROM day_issues) x
  WHERE len(issues) > 0 GROUP BY company_id""")
def q_gate_upload(spark, d):
    return validation.gate_upload(
        inputs.raw_customers(spark, d), inputs.raw_reviews(spark, d), inputs.raw_daily(spark, d))


@check("company_id customers:i reviews:i timeseries_days:i forecast_note", f"""
  SELECT *, {_NOTE.replace('n_rows', 'timeseries_days')} AS forecast_note FROM (
    SELECT d.company_id, (SELECT count(*) FROM customers c WHERE c.company_id = d.company_id) AS customers,
      (SELECT count(*) FROM reviews r WHERE r.company_id = d.company_id) AS reviews,
      (SELECT count(*) FROM daily t WHERE t.company_id = d.company_id) AS timeseries_days
    FROM company_dim d) x""")
def q_data_quality(spark, d):
    return validation.data_quality(
        warehouse.companies(spark, d), warehouse.customers(spark, d), warehouse.reviews(spark, d),
        warehouse.daily_metrics(spark, d),
    )


# ---------------------------------------------------------------- preparation

HOLES = "spend plan"


def holey_customers(spark, d):
    key = F.col("customer_id")
    return warehouse.customers(spark, d).select(
        "customer_id",
        F.when(key % 7 != 0, F.col("monthly_spend")).alias("spend"),
        F.when(key % 5 != 0, F.col("usage_frequency")).alias("usage"),
        F.when(key % 3 != 0, F.col("plan_type")).alias("plan"),
        F.lit(None).cast("string").alias("note"),
    )


FRAGMENTS["holey"] = """
  SELECT customer_id, CASE WHEN customer_id % 7 <> 0 THEN monthly_spend END AS spend,
    CASE WHEN customer_id % 5 <> 0 THEN usage_frequency END AS usage,
    CASE WHEN customer_id % 3 <> 0 THEN plan_type END AS plan, NULL::VARCHAR AS note
  FROM customers"""


def _mode_sql(c: str) -> str:
    return f"(SELECT {c} FROM holey WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@check("customer_id:i spend:f usage:f plan note", f"""
  SELECT customer_id, coalesce(spend, (SELECT quantile_cont(spend, 0.5) FROM holey)) AS spend,
    coalesce(usage, (SELECT quantile_cont(usage, 0.5) FROM holey)) AS usage,
    coalesce(plan, {_mode_sql('plan')}) AS plan, 'unknown' AS note FROM holey""")
def q_fill_missing(spark, d):
    return preparation.fill_missing(holey_customers(spark, d), ["spend", "usage", "plan", "note"], "median")


@check("customer_id:i spend:f usage:f plan", f"""
  SELECT customer_id, coalesce(spend, (SELECT avg(spend) FROM holey)) AS spend,
    coalesce(usage, (SELECT avg(usage) FROM holey)) AS usage, coalesce(plan, {_mode_sql('plan')}) AS plan FROM holey""")
def q_fill_missing_mean(spark, d):
    return preparation.fill_missing(holey_customers(spark, d), ["spend", "usage", "plan"], "mean")


@check("customer_id:i usage:i plan", f"""
  SELECT customer_id, coalesce(usage, {_mode_sql('usage')}) AS usage, coalesce(plan, {_mode_sql('plan')}) AS plan FROM holey""")
def q_fill_missing_mode(spark, d):
    return preparation.fill_missing(holey_customers(spark, d), ["usage", "plan"], "mode")


@check("customer_id:i spend:f", """
  SELECT customer_id, spend FROM holey WHERE spend IS NOT NULL AND usage IS NOT NULL AND plan IS NOT NULL""")
def q_drop_missing(spark, d):
    return preparation.fill_missing(holey_customers(spark, d).drop("note"), [], "drop")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@check("customer_id:i " + " ".join(f"plan_{s}:i" for s in _SEGMENTS), "SELECT customer_id, " + ", ".join(
    f"coalesce((plan = '{s}')::INT, 0) AS plan_{s}" for s in _SEGMENTS) + " FROM holey")
def q_encode_categorical(spark, d):
    return preparation.encode_categorical(holey_customers(spark, d), ["plan"])


@check("customer_id:i tenure:f monthly_spend:f", """
  SELECT customer_id, (tenure - avg(tenure) OVER ()) / nullif(stddev_pop(tenure) OVER (), 0) AS tenure,
    (monthly_spend - avg(monthly_spend) OVER ()) / nullif(stddev_pop(monthly_spend) OVER (), 0) AS monthly_spend
  FROM customers""")
def q_scale_numeric(spark, d):
    return preparation.scale_numeric(warehouse.customers(spark, d), ["tenure", "monthly_spend"])


@check("customer_id:i usage_frequency:f", """
  SELECT customer_id, (usage_frequency - min(usage_frequency) OVER ())::DOUBLE
    / nullif(max(usage_frequency) OVER () - min(usage_frequency) OVER (), 0) AS usage_frequency FROM customers""")
def q_scale_minmax(spark, d):
    return preparation.scale_numeric(warehouse.customers(spark, d), ["usage_frequency"], "minmax")


@check("customer_id:i churn_label:i is_test", """
  SELECT customer_id, churn_label, r <= round_even(n * 0.2::DOUBLE, 0) AS is_test
  FROM (SELECT *, row_number() OVER (PARTITION BY churn_label ORDER BY md5('42:' || customer_id)) AS r,
          count(*) OVER (PARTITION BY churn_label) AS n FROM customers) x""")
def q_split_stratified(spark, d):
    return preparation.split_stratified(warehouse.customers(spark, d), "customer_id", "churn_label", 0.2, 42)


@check("company_id date is_test skipped_reason", """
  SELECT company_id, date, is_test, CASE WHEN n <= 30 THEN 'Need more than 30 rows to split; got ' || n END AS skipped_reason
  FROM days_split""")
def q_split_chronological(spark, d):
    return preparation.split_chronological(warehouse.daily_metrics(spark, d), 30)


@check("company_id date revenue_scaled:f", """
  SELECT company_id, date, (revenue - q[2]) / CASE WHEN q[3] = q[1] THEN 1 ELSE q[3] - q[1] END AS revenue_scaled
  FROM daily JOIN (SELECT company_id, quantile_cont(revenue, [0.25, 0.5, 0.75]) AS q FROM daily GROUP BY company_id) s
    USING (company_id)""")
def q_robust_scale(spark, d):
    return preparation.robust_scale(warehouse.daily_metrics(spark, d), ["revenue"])


@check("churn_label:i n:i weight:f positive_weight:f", """
  SELECT churn_label, n, sum(n) OVER () / (count(*) OVER () * n) AS weight,
    (sum(CASE WHEN churn_label = 0 THEN n ELSE 0 END) OVER ())::DOUBLE
      / sum(CASE WHEN churn_label = 1 THEN n ELSE 0 END) OVER () AS positive_weight
  FROM (SELECT churn_label, count(*) AS n FROM customers GROUP BY churn_label) x""")
def q_class_weights(spark, d):
    return preparation.class_weights(warehouse.customers(spark, d), "churn_label")


# ---------------------------------------------------------------- joins and set operations


@check("user_id:i event_count:i", "SELECT user_id, count(*) AS event_count FROM ticket_events GROUP BY user_id")
def q_event_counts(spark, d):
    return joins.event_counts(warehouse.tickets(spark, d), "user_id")


@check("c_custkey:i support_tickets:i", """
  SELECT c_custkey, coalesce(n, 0) AS support_tickets FROM customer
  LEFT JOIN (SELECT user_id, count(*) AS n FROM ticket_events GROUP BY user_id) t ON t.user_id = c_custkey""")
def q_join_counts(spark, d):
    counts = joins.event_counts(
        warehouse.tickets(spark, d).withColumn("user_id", F.col("user_id").cast("string")),
        "user_id", "support_tickets",
    )
    return joins.join_counts(
        warehouse.table(spark, d, "customer").select("c_custkey"), counts, "c_custkey", "user_id",
        "support_tickets",
    )


@check("company_id customer_id:i profile", """
  SELECT c.company_id, customer_id, CASE company_no % 3 WHEN 0 THEN 'Healthy' WHEN 1 THEN 'Mixed' ELSE 'At Risk' END AS profile
  FROM customers c JOIN company_dim USING (company_id)""")
def q_profile_lookup(spark, d):
    profiles = warehouse.companies(spark, d).select(
        "company_id", inputs.pick(["Healthy", "Mixed", "At Risk"], F.col("company_no") % 3).alias("profile")
    )
    return joins.profile_lookup(warehouse.customers(spark, d), profiles)


@check("company_id", """
  SELECT DISTINCT nation_name AS company_id FROM cust_company
  WHERE nation_name NOT IN (SELECT n_name FROM nation WHERE n_nationkey % 4 <> 0)""")
def q_unknown_companies(spark, d):
    known = warehouse.table(spark, d, "nation").where("n_nationkey % 4 <> 0").select(F.col("n_name").alias("company_id"))
    return joins.unknown_companies(warehouse.customer_company(spark, d, "nation"), known)


@check("company_id step:i date actual:f is_projection", """
  SELECT company_id, step, date, actual, is_projection FROM projected""")
def q_align_backtest(spark, d):
    return inputs.projected(spark, d)


@check("o_orderkey:i urgency:i", """
  SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '5-LOW' THEN 5 ELSE 0 END AS urgency
  FROM orders""")
def q_alias_lookup(spark, d):
    urgency = joins.alias_lookup(F.col("o_orderpriority"), {"1-URGENT": 1, "2-HIGH": 2, "5-LOW": 5}, 0)
    return warehouse.table(spark, d, "orders").withColumn("urgency", urgency)


@check("company_id churn_prob:f sentiment_positivity:f anomaly_flag_ratio:f forecast_deviation:f dominant_sentiment "
       "recent_anomalies:i forecast_trend", "SELECT * FROM signal_table")
def q_combine_signals(spark, d):
    return inputs.signal_table(spark, d)


@check("Customer_ID Churn:i origin", """
  SELECT Customer_ID, Churn, CASE WHEN Churn = 0 THEN 'train' END AS origin FROM saas_rows""")
def q_union_all(spark, d):
    raw = inputs.saas_source(spark, d)
    return joins.union_all(raw.where("Churn = 0").withColumn("origin", F.lit("train")), raw.where("Churn = 1"))


@check("company_id column_name", """
  SELECT c.company_id, r.column_name FROM (SELECT DISTINCT company_id FROM catalog_rows) c
  CROSS JOIN (VALUES ('tenure'), ('Plan'), ('Tickets')) r(column_name)
  LEFT JOIN (SELECT DISTINCT company_id, column_name FROM catalog_rows) h
    ON h.company_id = c.company_id AND h.column_name = r.column_name
  WHERE h.column_name IS NULL""")
def q_missing_fields(spark, d):
    return ingest.missing_fields(inputs.catalog(spark, d), ["tenure", "Plan", "Tickets"])
