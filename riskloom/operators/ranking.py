"""Top-k lists, positional slices and seeded samples.

Small k only: Spark trims each map task to k rows per group before it shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.functions.scalars import mask_id, seeded_key
from riskloom.operators.ordering import (
    average_percent_rank, digest_cutoffs, hash_bucket, running_totals,
)
from riskloom.sources.scratch import written


def top_n(rows: DataFrame, by: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    window = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def last_n_rows(daily: DataFrame, n: int, key: str = "company_id", date: str = "date") -> DataFrame:
    return top_n(daily, [key], [F.col(date).desc()], n, "recency")


def rank_customers(scored: DataFrame) -> DataFrame:
    return scored.orderBy(F.col("churn_prob").desc(), "customer_id")


def top_risk_customers(scored: DataFrame, n: int = 25) -> DataFrame:
    top = top_n(scored, ["company_id"], [F.col("churn_prob").desc(), F.col("customer_id")], n)
    return top.withColumn("customer_id", mask_id(F.col("customer_id")))


def worst_reviews(scored: DataFrame, n: int = 15) -> DataFrame:
    negative = scored.where("label = 'negative'")
    return top_n(negative, ["company_id"], [F.col("score"), F.col("review_id")], n)


def worst_days(flagged: DataFrame, n: int = 20) -> DataFrame:
    return top_n(
        flagged.where("is_anomaly"), ["company_id"], [F.col("anomaly_score"), F.col("date")], n
    )


def top_factors(factors: DataFrame, n: int = 3, by: str = "company_id") -> DataFrame:
    """`(company, feature, value)` rows to one array of the n largest by absolute value."""
    top = top_n(factors, [by], [F.abs("value").desc(), F.col("feature")], n)
    entry = F.struct("rank", "feature", "value")
    return top.groupBy(by).agg(
        F.transform(
            F.sort_array(F.collect_list(entry)),
            lambda f: F.struct(f["feature"].alias("feature"), f["value"].alias("value")),
        ).alias("top_factors")
    )


def rank_companies(assessments: DataFrame) -> DataFrame:
    return assessments.orderBy(F.col("risk_score").desc(), "company_id")


def preview(rows: DataFrame, key: str, n: int = 10) -> DataFrame:
    return rows.orderBy(key).limit(n)


def engagement(customers: DataFrame) -> DataFrame:
    """Per (usage, tickets) pair: its customers and 4·n times its engagement, an exact integer.

    Engagement is the usage percent rank minus half the ticket percent rank. The pair table is
    written once; the ranks come from it and not from the customers."""
    pairs = written(
        customers.groupBy("usage_frequency", "support_tickets").agg(
            F.count(F.lit(1)).alias("members")
        ),
        "engagement-pairs",
    )
    usage = average_percent_rank(pairs, [], "usage_frequency", F.col("members")).select(
        "usage_frequency", (2 * F.col("before") + F.col("peers") + 1).alias("usage_x2")
    )
    ticket = average_percent_rank(pairs, [], "support_tickets", F.col("members")).select(
        "support_tickets", (2 * F.col("before") + F.col("peers") + 1).alias("ticket_x2")
    )
    return (
        pairs.join(usage, "usage_frequency")
        .join(ticket, "support_tickets")
        .withColumn("engagement_x4n", 2 * F.col("usage_x2") - F.col("ticket_x2"))
    )


def slice_pairs(customers: DataFrame, portfolios: DataFrame) -> DataFrame:
    """The pairs that overlap a portfolio's slice, with where their tie group starts."""
    pairs = written(engagement(customers), "engagement")
    ties = pairs.groupBy("engagement_x4n").agg(F.sum("members").alias("tie_members"))
    total = pairs.agg(F.sum("members").alias("total"))
    places = ties.crossJoin(F.broadcast(total)).withColumn("place", -F.col("engagement_x4n"))
    bucket = F.floor(F.col("place") / F.col("total") * 256).cast("bigint")
    placed = running_totals(places, [], bucket, [F.col("place")], ["tie_members"])

    n = F.least("n_customers", "total")
    start = (
        F.when(F.col("customer_filter") == "healthy", F.lit(0))
        .when(F.col("customer_filter") == "at_risk", F.col("total") - n)
        .otherwise(F.greatest(F.floor((F.col("total") - n) / 2), F.lit(0)))
    ).cast("bigint")
    wanted = portfolios.crossJoin(F.broadcast(total)).select(
        "portfolio", start.alias("first_pos"), (start + n).alias("end_pos")
    )
    overlap = (F.col("tie_members_before") < F.col("end_pos")) & (
        F.col("tie_members_before") + F.col("tie_members") > F.col("first_pos")
    )
    hits = placed.join(F.broadcast(wanted), overlap).select(
        "portfolio", "first_pos", "end_pos", "engagement_x4n",
        F.col("tie_members_before").alias("tie_start"),
    )
    return written(
        pairs.select("usage_frequency", "support_tickets", "engagement_x4n").join(hits, "engagement_x4n"),
        "slice-pairs",
    )


def portfolio_slice(customers: DataFrame, portfolios: DataFrame, seed: int = 42,
                    id_column: str = "customer_id") -> DataFrame:
    """Customers at the head, middle or tail of the engagement order.

    `portfolios(portfolio, customer_filter, n_customers)` is a setting. Equal engagement is
    ordered by the seeded digest of the id. Only pairs that overlap a slice touch the customer
    table, and inside them rows are ranked per digest bucket."""
    hits = slice_pairs(customers, portfolios)
    members = customers.join(hits, ["usage_frequency", "support_tickets"]).withColumn(
        "__digest", seeded_key(seed, F.col(id_column))
    ).withColumn("__slot", hash_bucket(F.col("__digest")))
    tie = ["portfolio", "engagement_x4n"]
    slots = members.groupBy(*tie, "__slot").agg(
        F.count(F.lit(1)).alias("__m"), F.first("tie_start").alias("__start"),
        F.first("first_pos").alias("__first"), F.first("end_pos").alias("__end"),
    )
    offsets = running_totals(
        slots, tie, F.substring("__slot", 1, 1), [F.col("__slot")], ["__m"]
    ).withColumn("__from", F.col("__start") + F.col("__m_before"))
    useful = offsets.where("__from < __end and __from + __m > __first").select(*tie, "__slot", "__from")
    inside = Window.partitionBy(*tie, "__slot").orderBy("__digest")
    return (
        members.join(useful, [*tie, "__slot"])
        .withColumn("position", F.col("__from") + F.row_number().over(inside) - 1)
        .where("position >= first_pos and position < end_pos")
        .drop("__digest", "__slot", "__from", "tie_start", "first_pos", "end_pos", "engagement_x4n")
    )


def stratified_sample(rows: DataFrame, mix: DataFrame, id_column: str, label: str,
                      seed: int = 42) -> DataFrame:
    """The exact number of rows per (portfolio, label): `mix(portfolio, label, share, total)`.

    A row is taken when its seeded digest is at or below the label's cut. `mix` is a
    setting: portfolios times labels."""
    keyed = rows.withColumn("__digest", seeded_key(seed, F.col(id_column)))
    quota = mix.select(
        "portfolio", F.col("label").alias(label),
        F.bround(F.col("total") * F.col("share"), 0).cast("bigint").alias("n"),
    )
    sizes = quota.select(label, "n").distinct()
    by_size = keyed.select(label, "__digest").join(F.broadcast(sizes), label)
    cuts = digest_cutoffs(
        by_size.withColumn("__want", F.col("n")), [label, "__want"], "__digest",
        sizes.select(label, F.col("n").alias("__want"), "n"),
    )
    limits = quota.join(cuts.withColumnRenamed("__want", "n"), [label, "n"]).select(
        "portfolio", label, "cut_key"
    )
    return (
        keyed.join(F.broadcast(limits), label)
        .where(F.col("__digest") <= F.col("cut_key"))
        .drop("__digest", "cut_key")
    )
