"""Spark inputs of the checks: canonical and scored tables of one warehouse folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fragments import CHURN_COEFFICIENTS, CHURN_INTERCEPT, HOLDOUT, SCORE_BY_LABEL
from riskloom.operators import forecast, risk, signals
from riskloom.operators.churn import linear_attribution
from riskloom.operators.joins import alias_lookup
from riskloom.operators.preparation import engineer_features
from riskloom.operators.ranking import top_factors
from riskloom.operators.series import build_features
from riskloom.sources import warehouse

# Headers seen in real exports; which ones an export has follows from its customer key.
HEADERS = [
    "Customer ID", "Email", "Created (UTC)", "Plan Name", "Monthly Recurring Revenue",
    "Login Count (30d)", "Status", "MRR", "Revenue", "tenure", "Signup Date", "Account ID",
    "Tickets", "Usage", "Active Days", "customer_id", "Plan", "Support Requests", "Visits",
    "Notes", "Comments", "Activity Date", "Users", "Sign-ups", "user since", "Amount",
]


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def catalog(spark: SparkSession, d: str) -> DataFrame:
    """One export of eight columns per customer."""
    key = F.col("c_custkey")
    position = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("position")
    k = F.col("position")
    index = (key * 7 + k * (1 + key % 5) + k * k) % len(HEADERS)
    return (
        warehouse.table(spark, d, "customer").select("c_custkey", position)
        .select(key.cast("string").alias("company_id"), "position", pick(HEADERS, index).alias("column_name"))
    )


CATALOG_SQL = (
    "SELECT c_custkey::VARCHAR AS company_id, position, ["
    + ", ".join(f"'{h}'" for h in HEADERS)
    + f"][((c_custkey * 7 + position * (1 + c_custkey % 5) + position * position) % {len(HEADERS)} + 1)::INT] AS column_name "
    "FROM customer CROSS JOIN (SELECT unnest(range(0, 8)) AS position) p"
)


def cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of two date-named columns per customer, some in another layout, some junk."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    value = (
        F.when((key % 3 == 0) & (customer % 2 == 0), "n/a")
        .when(key % 11 == 0, None)
        .when(customer % 4 == 1, F.date_format("o_orderdate", "MM/dd/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return warehouse.table(spark, d, "orders").select(
        customer.cast("string").alias("company_id"),
        F.when(key % 2 == 0, "Activity Date").otherwise("user since").alias("column_name"),
        key.alias("row_no"), value.alias("value"),
    )


CELLS_SQL = """
  SELECT o_custkey::VARCHAR AS company_id,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Activity Date' ELSE 'user since' END AS column_name,
    o_orderkey AS row_no,
    CASE WHEN o_orderkey % 3 = 0 AND o_custkey % 2 = 0 THEN 'n/a' WHEN o_orderkey % 11 = 0 THEN NULL
      WHEN o_custkey % 4 = 1 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS value
  FROM orders"""


def billing_export(spark: SparkSession, d: str) -> DataFrame:
    """A raw billing export: canonical customers under the names a billing tool gives them."""
    return warehouse.customers(spark, d).select(
        "company_id",
        F.col("customer_id").alias("Customer ID"),
        F.date_format("signup_date", "yyyy-MM-dd").alias("Created (UTC)"),
        F.col("plan_type").alias("Plan Name"),
        F.col("monthly_spend").alias("Monthly Recurring Revenue"),
        F.col("usage_frequency").alias("Login Count (30d)"),
    )


def saas_source(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    notes = ["Billing question", "Found a BUG in export", "none", "Please cancel", "Great service", "still waiting"]
    return warehouse.table(spark, d, "customer").select(
        F.col("c_name").alias("Customer_ID"), (key % 900 + 1).alias("Account_Age_Days"),
        pick(["Daily", "Weekly", "Monthly", "Rarely", "Sometimes"], key % 5).alias("Login_Frequency"),
        ((F.col("c_acctbal") + 1000) / 80).alias("Daily_Usage_Mins"),
        F.when(key % 13 != 0, pick(notes, key % 6)).alias("Last_Support_Ticket"),
        (key % 2).alias("Churn"),
    )


SAAS_SQL = """
  SELECT c_name AS Customer_ID, c_custkey % 900 + 1 AS Account_Age_Days,
    ['Daily', 'Weekly', 'Monthly', 'Rarely', 'Sometimes'][(c_custkey % 5 + 1)::INT] AS Login_Frequency,
    (c_acctbal + 1000) / 80 AS Daily_Usage_Mins,
    CASE WHEN c_custkey % 13 <> 0 THEN ['Billing question', 'Found a BUG in export', 'none', 'Please cancel',
      'Great service', 'still waiting'][(c_custkey % 6 + 1)::INT] END AS Last_Support_Ticket,
    c_custkey % 2 AS Churn
  FROM customer"""


def raw_customers(spark: SparkSession, d: str) -> DataFrame:
    """Customer uploads as text with planted faults, per nation."""
    key = F.col("customer_id")
    text = lambda c: F.col(c).cast("string")
    return warehouse.customers(spark, d, "nation").select(
        "company_id", "customer_id",
        F.when(key % 97 == 5, "-5").otherwise(text("tenure")).alias("tenure"),
        F.when(key % 89 == 3, "unknown").when(key % 83 == 4, None)
        .otherwise(F.floor("monthly_spend").cast("string")).alias("monthly_spend"),
        F.when(key % 101 == 7, "5d").otherwise(text("usage_frequency")).alias("usage_frequency"),
        text("support_tickets").alias("support_tickets"), "plan_type",
        F.when(key % 103 == 9, "2").otherwise(text("churn_label")).alias("churn_label"),
    )


RAW_CUSTOMERS_SQL = """
  SELECT company_id, customer_id, CASE WHEN customer_id % 97 = 5 THEN '-5' ELSE tenure::VARCHAR END AS tenure,
    CASE WHEN customer_id % 89 = 3 THEN 'unknown' WHEN customer_id % 83 = 4 THEN NULL
      ELSE floor(monthly_spend)::BIGINT::VARCHAR END AS monthly_spend,
    CASE WHEN customer_id % 101 = 7 THEN '5d' ELSE usage_frequency::VARCHAR END AS usage_frequency,
    support_tickets::VARCHAR AS support_tickets, plan_type,
    CASE WHEN customer_id % 103 = 9 THEN '2' ELSE churn_label::VARCHAR END AS churn_label
  FROM nation_customers"""


def raw_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Reviews of all documents per (source, language); some sources are blank throughout."""
    source = F.substring("source", 4, 9).cast("bigint")
    return warehouse.table(spark, d, "documents").select(
        F.concat_ws("-", "source", "lang", (F.col("doc_id") % 7).cast("string")).alias("company_id"),
        F.when(source % 6 == 0, F.lit("  ")).otherwise(F.col("text")).alias("review_text"),
    )


RAW_REVIEWS_SQL = """
  SELECT source || '-' || lang || '-' || (doc_id % 7) AS company_id,
    CASE WHEN substr(source, 4)::BIGINT % 6 = 0 THEN '  ' ELSE text END AS review_text
  FROM documents"""


def raw_daily(spark: SparkSession, d: str) -> DataFrame:
    """Daily uploads as text with planted faults, per nation; one nation repeats a day."""
    day = F.datediff("date", F.lit("1995-01-01").cast("date"))
    bad = F.length("company_id") % 2 == 0
    daily = warehouse.daily_metrics(spark, d, "nation")
    shifted = F.when((F.col("company_id") == "NATION_3") & (day % 2 == 1), F.date_sub("date", 1)).otherwise(F.col("date"))
    return daily.select(
        "company_id",
        F.when(bad & (day % 401 == 7), "last tuesday").otherwise(F.date_format(shifted, "yyyy-MM-dd")).alias("date"),
        F.when(day % 307 == 5, "-100").otherwise(F.floor("revenue").cast("string")).alias("revenue"),
        F.when(bad & (day % 211 == 2), None).otherwise(F.col("active_users").cast("string")).alias("active_users"),
        F.col("signups").cast("string").alias("signups"),
    )


RAW_DAILY_SQL = """
  SELECT company_id,
    CASE WHEN length(company_id) % 2 = 0 AND day % 401 = 7 THEN 'last tuesday'
      WHEN company_id = 'NATION_3' AND day % 2 = 1 THEN strftime(date - 1, '%Y-%m-%d')
      ELSE strftime(date, '%Y-%m-%d') END AS date,
    CASE WHEN day % 307 = 5 THEN '-100' ELSE floor(revenue)::BIGINT::VARCHAR END AS revenue,
    CASE WHEN length(company_id) % 2 = 0 AND day % 211 = 2 THEN NULL ELSE active_users::VARCHAR END AS active_users,
    signups::VARCHAR AS signups
  FROM (SELECT *, date - DATE '1995-01-01' AS day FROM nation_daily) x"""


def features(spark: SparkSession, d: str) -> DataFrame:
    return engineer_features(warehouse.customers(spark, d))


def scored_customers(spark: SparkSession, d: str) -> DataFrame:
    logit = reduce(
        lambda a, b: a + b,
        [F.lit(w) * F.col(c) for c, w in CHURN_COEFFICIENTS.items()], F.lit(CHURN_INTERCEPT),
    )
    return features(spark, d).withColumn("churn_prob", 1 / (1 + F.exp(-logit)))


def scored_reviews(spark: SparkSession, d: str) -> DataFrame:
    return warehouse.reviews(spark, d).withColumn("label", F.col("sentiment_label")).withColumn(
        "score", alias_lookup(F.col("sentiment_label"), SCORE_BY_LABEL)
    )


def flagged_days(spark: SparkSession, d: str) -> DataFrame:
    odd = F.abs("revenue_zscore_30")
    return build_features(warehouse.daily_metrics(spark, d)).withColumn(
        "is_anomaly", odd > 3
    ).withColumn("anomaly_score", -odd)


def projected(spark: SparkSession, d: str) -> DataFrame:
    return forecast.backtest_and_project(warehouse.daily_metrics(spark, d), "seasonal_naive", HOLDOUT)


def signal_table(spark: SparkSession, d: str) -> DataFrame:
    return risk.combine_signals(
        warehouse.companies(spark, d),
        signals.signal_churn(scored_customers(spark, d)),
        signals.review_signals(scored_reviews(spark, d)),
        signals.anomaly_signals(flagged_days(spark, d)),
        signals.forecast_signals(projected(spark, d)),
    )


def attribution(spark: SparkSession, d: str) -> DataFrame:
    return linear_attribution(features(spark, d), CHURN_COEFFICIENTS)


def assessed(spark: SparkSession, d: str) -> DataFrame:
    factors = top_factors(attribution(spark, d)).withColumn("explanation_source", F.lit("shap"))
    return risk.assess_companies(signal_table(spark, d), factors)
