"""The rule table that turns signals into ordered recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import (
    ANOMALY_PRESENT, FORECAST_GAP, HIGH_CHURN, MODERATE_CHURN, NEGATIVE_SENTIMENT,
)
from riskloom.functions.scalars import finite_or, percent_text

# Urgency order.
PRIORITIES = ["critical", "high", "medium", "low", "info"]
# What to do and why, per metric that fell on flagged days.
METRIC_ACTIONS = {
    "revenue": (
        "Investigate the payment and billing pipeline for failed charges.",
        "Revenue showed an unusual drop on recently flagged days.",
    ),
    "active_users": (
        "Check for a product outage or a recent breaking release.",
        "Active users dropped sharply on recently flagged days.",
    ),
    "signups": (
        "Review the signup funnel and any recent marketing or pricing changes.",
        "Signups dropped sharply on recently flagged days.",
    ),
}


def _item(rule_no: int, priority: str, action: str, reason: Column) -> Column:
    return F.struct(
        F.lit(PRIORITIES.index(priority)).alias("urgency"), F.lit(rule_no).alias("rule_no"),
        F.lit(action).alias("action"), reason.alias("reason"), F.lit(priority).alias("priority"),
    )


def _flag_review(ratio: Column) -> Column:
    return _item(
        8, "medium",
        "Review flagged anomalous days against your release and campaign calendar.",
        F.concat(percent_text(ratio), F.lit(" of the last 30 days were flagged as anomalous.")),
    )


def _metric_items(present: Column, dropped: Column) -> list[Column]:
    return [
        F.when(present & F.array_contains(dropped, metric),
               _item(5 + i, "high", action, F.lit(reason)))
        for i, (metric, (action, reason)) in enumerate(METRIC_ACTIONS.items())
    ]


# The texts of actions and reasons below.
def _fired_rules(churn: Column, mood: Column, ratio: Column, gap: Column, dropped: Column) -> Column:
    """All rules that fire, with their urgency and number."""
    unhappy_leavers = (churn > HIGH_CHURN) & (mood < NEGATIVE_SENTIMENT)
    falling_and_leaving = (gap > FORECAST_GAP) & (churn > MODERATE_CHURN)
    critical = unhappy_leavers | falling_and_leaving
    odd_days = ratio > ANOMALY_PRESENT
    items = [
        F.when(unhappy_leavers, _item(
            1, "critical",
            "Prioritize retention outreach for the at-risk segment and review recent negative "
            "feedback themes.",
            F.concat(F.lit("High churn risk ("), percent_text(churn),
                     F.lit(") combined with negative customer sentiment ("), percent_text(mood),
                     F.lit(" positivity).")))),
        F.when(falling_and_leaving, _item(
            2, "critical",
            "Run an immediate pricing and retention review -- revenue decline is compounding "
            "with churn risk.",
            F.concat(F.lit("Revenue is "), percent_text(gap),
                     F.lit(" off forecast while churn risk sits at "), percent_text(churn),
                     F.lit(".")))),
        F.when((churn > HIGH_CHURN) & ~critical, _item(
            3, "high",
            "Launch a targeted win-back campaign for the highest-risk customers.",
            F.concat(F.lit("Mean churn probability across the customer base is "),
                     percent_text(churn), F.lit("."))))
        .when((churn > MODERATE_CHURN) & (churn <= HIGH_CHURN), _item(
            3, "medium",
            "Schedule check-in calls with low-usage accounts before they lapse.",
            F.concat(F.lit("Churn probability is elevated at "), percent_text(churn),
                     F.lit(".")))),
        F.when(mood < NEGATIVE_SENTIMENT, _item(
            4, "high",
            "Triage recent negative reviews and publish a response plan for the most common "
            "complaint themes.",
            F.concat(F.lit("Average review positivity is only "), percent_text(mood),
                     F.lit(".")))),
        *_metric_items(odd_days, dropped),
        F.when(odd_days & (F.size(dropped) == 0), _flag_review(ratio)),
        F.when((gap > FORECAST_GAP) & ~critical, _item(
            9, "medium",
            "Re-forecast the quarter and investigate why actuals are diverging from the model.",
            F.concat(F.lit("Actual revenue is deviating "), percent_text(gap),
                     F.lit(" from forecast.")))),
    ]
    return F.array_compact(F.array(*items))


def recommendations(assessments: DataFrame) -> DataFrame:
    """Add the ordered array `recommendations` of `{action, reason, priority}`, never empty.

    Expects `signals` and `dropped_metrics`. Inputs and fired rules are columns of their own,
    so each is worked out once per row."""
    calm = F.array(_item(
        10, "info", "Healthy -- no immediate action required. Continue monitoring.",
        F.lit("All four risk signals are within normal ranges.")))
    inputs = assessments.withColumns({
        "__churn": finite_or(F.col("signals.churn_prob"), 0.0),
        "__mood": finite_or(F.col("signals.sentiment_positivity"), 1.0),
        "__ratio": finite_or(F.col("signals.anomaly_flag_ratio"), 0.0),
        "__gap": finite_or(F.col("signals.forecast_deviation"), 0.0),
        "__fell": F.coalesce("dropped_metrics", F.expr("array()").cast("array<string>")),
    })
    fired = inputs.withColumn("__fired", _fired_rules(
        F.col("__churn"), F.col("__mood"), F.col("__ratio"), F.col("__gap"), F.col("__fell")
    ))
    ordered = F.array_sort(F.when(F.size("__fired") > 0, F.col("__fired")).otherwise(calm))
    return fired.withColumn("recommendations", F.transform(
        ordered, lambda x: F.struct(x["action"].alias("action"), x["reason"].alias("reason"),
                                    x["priority"].alias("priority"))
    )).drop("__churn", "__mood", "__ratio", "__gap", "__fell", "__fired")


def recommendation_rows(recommended: DataFrame) -> DataFrame:
    return recommended.select(
        "company_id", F.posexplode("recommendations").alias("item_no", "item")
    ).select("company_id", "item_no", "item.action", "item.reason", "item.priority")


def top_recommendations(recommended: DataFrame, n: int = 3) -> DataFrame:
    return recommended.withColumn("recommendations", F.slice("recommendations", 1, n))


def sort_recommendations(items: DataFrame) -> DataFrame:
    """`(company_id, rule_no, priority, action, reason)` rows to one ordered array; an
    unknown priority goes last. A company's items are bounded by the rule table."""
    urgency = F.array_position(F.array(*[F.lit(p) for p in PRIORITIES]), F.col("priority"))
    rank = F.when(urgency > 0, urgency).otherwise(99)
    entry = F.struct(rank.alias("urgency"), "rule_no", "action", "reason", "priority")
    return items.groupBy("company_id").agg(
        F.transform(
            F.sort_array(F.collect_list(entry)),
            lambda x: F.struct(x["action"].alias("action"), x["reason"].alias("reason"),
                               x["priority"].alias("priority")),
        ).alias("recommendations")
    )


def anomaly_recommendations(signals: DataFrame) -> DataFrame:
    """Rows for the fallen metrics of `(company_id, anomaly_flag_ratio, dropped_metrics)`, or
    one general item."""
    ratio = finite_or(F.col("anomaly_flag_ratio"), 0.0)
    dropped = F.coalesce("dropped_metrics", F.expr("array()").cast("array<string>"))
    items = F.array_compact(F.array(
        *_metric_items(F.lit(True), dropped), F.when(F.size(dropped) == 0, _flag_review(ratio))
    ))
    return signals.select("company_id", F.posexplode(items).alias("item_no", "x")).select(
        "company_id", "item_no", "x.action", "x.reason", "x.priority"
    )
