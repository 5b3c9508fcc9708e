"""Canonical tables derived from the order / event / document warehouse tables.

Every derivation reads its columns once and pre-aggregates before it shuffles on an
entity key, so a customer with a third of all orders costs one row per active day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.operators.joins import event_counts, join_counts

LABEL_WINDOW_DAYS = 180
FIRST_REVIEW_DATE = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "source")


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company dimension: one row per region."""
    region = table(spark, sf_dir, "region")
    return region.select(
        F.col("r_name").alias("company_id"),
        F.col("r_regionkey").cast("bigint").alias("company_no"),
    )


def customer_company(spark: SparkSession, sf_dir: str, grain: str = "region") -> DataFrame:
    """Customer key to company. `grain='nation'` gives five times as many companies."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    if grain == "nation":
        joined = joined.withColumn("company_id", F.col("n_name"))
    else:
        region = table(spark, sf_dir, "region")
        joined = joined.join(region, F.col("n_regionkey") == F.col("r_regionkey")).withColumn(
            "company_id", F.col("r_name")
        )
    return joined.select("c_custkey", "company_id", "c_mktsegment")


def label_cutoff(orders: DataFrame) -> DataFrame:
    """One row: the day that separates feature history from the label window."""
    return orders.agg(
        F.date_sub(F.max("o_orderdate").cast("date"), LABEL_WINDOW_DAYS).alias("cutoff")
    )


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer: what is known up to the cutoff, and whether they ordered after it."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    dated = orders.withColumn("order_day", F.col("o_orderdate").cast("date")).crossJoin(
        F.broadcast(label_cutoff(orders))
    )
    known = F.col("order_day") <= F.col("cutoff")
    return (
        dated.groupBy("o_custkey")
        .agg(
            F.min(F.when(known, F.col("order_day"))).alias("first_order"),
            F.round(F.sum(F.when(known, F.col("o_totalprice"))), 2).alias("spend"),
            F.count_if(known).alias("n_orders"),
            F.count_if(~known).alias("n_later"),
            F.first("cutoff").alias("cutoff"),
        )
        .where("n_orders > 0")
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ticket export: one row per error event."""
    return table(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", "user_id")


def customers(spark: SparkSession, sf_dir: str, grain: str = "region") -> DataFrame:
    history = order_history(spark, sf_dir)
    months = F.bround(F.datediff("cutoff", "first_order") / F.lit(30.44), 0).cast("int")
    base = (
        customer_company(spark, sf_dir, grain)
        .join(history, F.col("c_custkey") == F.col("o_custkey"))
        .select(
            "company_id",
            F.col("c_custkey").alias("customer_id"),
            F.greatest(months, F.lit(1)).alias("tenure"),
            "spend",
            F.col("n_orders").cast("int").alias("usage_frequency"),
            F.col("c_mktsegment").alias("plan_type"),
            F.when(F.col("n_later") == 0, 1).otherwise(0).alias("churn_label"),
            F.col("first_order").alias("signup_date"),
        )
        .withColumn("monthly_spend", F.col("spend") / F.col("tenure"))
    )
    counts = event_counts(tickets(spark, sf_dir), "user_id", "support_tickets")
    return join_counts(base, counts, "customer_id", "user_id", "support_tickets").select(
        "company_id", "customer_id", "tenure", "monthly_spend", "usage_frequency",
        "support_tickets", "plan_type", "churn_label", "signup_date",
    )


def daily_metrics(spark: SparkSession, sf_dir: str, grain: str = "region") -> DataFrame:
    """One row per (company, day with orders)."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    per_day = (
        orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("date"))
        .agg(F.sum("o_totalprice").alias("amount"))
        .withColumn("first_day", F.min("date").over(Window.partitionBy("o_custkey")))
    )
    return (
        per_day.join(
            customer_company(spark, sf_dir, grain).select("c_custkey", "company_id"),
            F.col("o_custkey") == F.col("c_custkey"),
        )
        .groupBy("company_id", "date")
        .agg(
            F.round(F.sum("amount"), 2).alias("revenue"),
            F.count(F.lit(1)).alias("active_users"),
            F.count_if(F.col("date") == F.col("first_day")).alias("signups"),
        )
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as reviews. Text is only read by plans that select it."""
    labels = table(spark, sf_dir, "labels")
    docs = documents(spark, sf_dir)
    label = (
        F.when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 0, "neutral")
        .otherwise("positive")
    )
    parity = (F.col("review_id") % 2).cast("int")
    stars = (
        F.when(F.col("sentiment_label") == "negative", parity + 1)
        .when(F.col("sentiment_label") == "neutral", F.lit(3))
        .otherwise(parity + 4)
    )
    return (
        docs.join(labels, "doc_id")
        .withColumn("company_no", F.substring("source", 4, 9).cast("bigint") % 5)
        .join(companies(spark, sf_dir), "company_no")
        .select(
            "company_id",
            F.col("doc_id").alias("review_id"),
            F.col("text").alias("review_text"),
            label.alias("sentiment_label"),
            F.date_add(
                F.lit(FIRST_REVIEW_DATE).cast("date"), (F.col("doc_id") % 90).cast("int")
            ).alias("review_date"),
        )
        .withColumn("star_rating", stars)
    )
