"""Upload checks: one aggregation pass per table, one row of issues per company."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import CHURN_BASE_COLUMNS, CHURN_NUMERIC_COLUMNS, SERIES_COLUMNS
from riskloom.functions.scalars import parse_date, parse_number

# The limits, and the texts of all messages in this file.
MIN_CUSTOMERS = 10
MIN_REVIEWS = 5
MIN_DAILY_ROWS = 14
LONG_HISTORY = 60
SHORT_HISTORY = 30


def _text(value: Column) -> Column:
    return value.cast("string")


def _issues(stats: DataFrame, *messages: Column) -> DataFrame:
    return stats.select("company_id", F.array_compact(F.array(*messages)).alias("issues"))


def _with_empty_companies(issues: DataFrame, companies: DataFrame | None, message: str) -> DataFrame:
    if companies is None:
        return issues
    return (
        companies.select("company_id")
        .join(issues, "company_id", "left")
        .withColumn("issues", F.coalesce("issues", F.array(F.lit(message))))
    )


def _missing_columns(df: DataFrame, required: list[str], what: str) -> DataFrame | None:
    absent = [c for c in required if c not in df.columns]
    if not absent:
        return None
    message = f"{what} file is missing required columns: {', '.join(absent)}."
    return df.select("company_id").distinct().select(
        "company_id", F.array(F.lit(message)).alias("issues")
    )


def numeric_counts(column: str) -> list[Column]:
    value = F.col(column)
    number = parse_number(value)
    return [
        F.count_if(value.isNotNull() & (number.isNull() | F.isnan(number))).alias(f"{column}_bad"),
        F.count_if(value.isNull()).alias(f"{column}_missing"),
        F.count_if(number < 0).alias(f"{column}_negative"),
    ]


def numeric_messages(column: str) -> list[Column]:
    bad, missing = F.col(f"{column}_bad"), F.col(f"{column}_missing")
    return [
        F.when(bad > 0, F.concat(
            F.lit(f"Column '{column}' has "), _text(bad), F.lit(" non-numeric value(s)."))),
        F.when(missing > 0, F.concat(
            F.lit(f"Column '{column}' has "), _text(missing),
            F.lit(" missing/blank value(s) (this includes cells like 'N/A' or 'null')."))),
    ]


def numeric_column_errors(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per company and column: how many cells are not numbers, and how many are missing."""
    stats = df.groupBy("company_id").agg(*[c for n in columns for c in numeric_counts(n)])
    rows = [
        F.struct(
            F.lit(n).alias("column_name"), F.col(f"{n}_bad").alias("non_numeric"),
            F.col(f"{n}_missing").alias("missing"),
        )
        for n in columns
    ]
    return stats.select("company_id", F.inline(F.array(*rows)))


def validate_customers(df: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """`(company_id, issues)`; an empty array means the table can be scored."""
    stopped = _missing_columns(df, CHURN_BASE_COLUMNS, "Customer")
    if stopped is None:
        aggs = [F.count(F.lit(1)).alias("n")]
        for column in CHURN_NUMERIC_COLUMNS:
            aggs += numeric_counts(column)
        has_label = "churn_label" in df.columns
        if has_label:
            label = parse_number(F.col("churn_label"))
            odd = F.col("churn_label").isNotNull() & ~F.coalesce(label.isin(0.0, 1.0), F.lit(False))
            aggs.append(F.count_if(odd).alias("bad_labels"))
        stats = df.groupBy("company_id").agg(*aggs)
        messages = [F.when(F.col("n") < MIN_CUSTOMERS, F.concat(
            F.lit("Only "), _text(F.col("n")),
            F.lit(f" customer rows found; at least {MIN_CUSTOMERS} are needed for the churn "
                  "score to be meaningful.")))]
        for column in CHURN_NUMERIC_COLUMNS:
            messages += numeric_messages(column)
        if has_label:
            messages.append(
                F.when(F.col("bad_labels") > 0, "'churn_label' must be 0 or 1 where provided.")
            )
        messages.append(F.when(F.col("tenure_negative") > 0, "'tenure' cannot be negative."))
        stopped = _issues(stats, *messages)
    return _with_empty_companies(stopped, companies, "Customer file is empty.")


def validate_reviews(df: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    stopped = _missing_columns(df, ["review_text"], "Review")
    if stopped is None:
        text = F.col("review_text")
        blank = text.isNull() | (F.regexp_replace(text, r"\s", "") == "")
        stats = df.groupBy("company_id").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(blank).alias("blank")
        )
        stopped = _issues(
            stats,
            F.when(F.col("n") < MIN_REVIEWS, F.concat(
                F.lit("Only "), _text(F.col("n")),
                F.lit(f" reviews found; at least {MIN_REVIEWS} are needed for a usable "
                      "sentiment signal."))),
            F.when(F.col("blank") == F.col("n"), "Every 'review_text' value is empty."),
        )
    return _with_empty_companies(stopped, companies, "Review file is empty.")


def validate_timeseries(df: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """Duplicate days are found by counting per (company, day) before counting per company,
    so no task has to remember all days of one company."""
    stopped = _missing_columns(df, ["date", *SERIES_COLUMNS], "Time-series")
    if stopped is None:
        counts = [c for n in SERIES_COLUMNS for c in numeric_counts(n)]
        names = [f"{n}_{k}" for n in SERIES_COLUMNS for k in ("bad", "missing", "negative")]
        per_day = (
            df.withColumn("__day", parse_date(F.col("date")))
            .groupBy("company_id", "__day")
            .agg(F.count(F.lit(1)).alias("__rows"), *counts)
        )
        stats = per_day.groupBy("company_id").agg(
            F.sum("__rows").alias("n"),
            F.coalesce(F.sum(F.when(F.col("__day").isNull(), F.col("__rows"))), F.lit(0)).alias(
                "bad_dates"
            ),
            F.count_if(F.col("__day").isNotNull() & (F.col("__rows") > 1)).alias("repeated_days"),
            *[F.sum(c).alias(c) for c in names],
        )
        messages = [
            F.when(F.col("n") < MIN_DAILY_ROWS, F.concat(
                F.lit("Only "), _text(F.col("n")),
                F.lit(f" daily rows found; at least {MIN_DAILY_ROWS} are needed for anomaly "
                      "detection to run."))),
            F.when(F.col("bad_dates") > 0, F.concat(
                F.lit("'date' has "), _text(F.col("bad_dates")),
                F.lit(" value(s) that don't parse as dates.")))
            .when(F.col("repeated_days") > 0,
                  "'date' has duplicate values -- expected one row per day."),
        ]
        for column in SERIES_COLUMNS:
            messages += numeric_messages(column)
            messages.append(F.when(
                F.col(f"{column}_negative") > 0,
                f"Column '{column}' has negative value(s), which is not a valid count/amount."))
        stopped = _issues(stats, *messages)
    return _with_empty_companies(stopped, companies, "Time-series file is empty.")


def issue_rows(issues: DataFrame) -> DataFrame:
    return issues.select("company_id", F.posexplode("issues").alias("issue_no", "issue"))


def readiness_columns(n_rows: Column) -> list[Column]:
    """Can we forecast, with how many held-out days, and the note explaining it."""
    days = (
        F.when(n_rows >= LONG_HISTORY, 30).when(n_rows >= SHORT_HISTORY, 14).otherwise(0)
    )
    note = (
        F.when(n_rows >= LONG_HISTORY, "Using a 30-day backtest (60+ days of history available).")
        .when(n_rows >= SHORT_HISTORY,
              "Using a 14-day backtest (30-59 days of history available).")
        .otherwise(F.concat(
            F.lit("Only "), _text(n_rows),
            F.lit(" days of history -- need at least 30 to forecast. The forecast signal is "
                  "excluded from this company's risk score.")))
    )
    return [(days > 0).alias("can_forecast"), days.alias("holdout_days"), note.alias("forecast_note")]


def forecast_readiness(daily: DataFrame) -> DataFrame:
    rows = daily.groupBy("company_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select("company_id", "n_rows", *readiness_columns(F.col("n_rows")))


def gate_scoring(issues: DataFrame) -> DataFrame:
    """Companies that must not be scored, with all their issues in one message."""
    return issues.where(F.size("issues") > 0).select(
        "company_id",
        F.concat(F.lit("Invalid customer data: "), F.concat_ws("; ", "issues")).alias("error"),
    )


def gate_upload(customers: DataFrame, reviews: DataFrame | None, daily: DataFrame | None) -> DataFrame:
    """Companies whose customers, reviews or daily rows have issues, with all of them in one
    message; a table that was not uploaded has none."""
    tables = [("customer", 0, validate_customers(customers))]
    if reviews is not None:
        tables.append(("review", 1, validate_reviews(reviews)))
    if daily is not None:
        tables.append(("time-series", 2, validate_timeseries(daily)))
    every = None
    for name, place, issues in tables:
        said = issues.where(F.size("issues") > 0).select("company_id", F.lit(place).alias("place"), F.concat(
            F.lit(f"Invalid {name} data: "), F.concat_ws("; ", "issues")).alias("said"))
        every = said if every is None else every.unionByName(said)
    # three rows a company at most
    return every.groupBy("company_id").agg(F.concat_ws(
        " ", F.transform(F.sort_array(F.collect_list(F.struct("place", "said"))), lambda r: r["said"])).alias("error"))


def accepted(rows: DataFrame, blocked: DataFrame) -> DataFrame:
    return rows.join(blocked.select("company_id"), "company_id", "left_anti")


def data_quality(companies: DataFrame, customers: DataFrame, reviews: DataFrame,
                 daily: DataFrame) -> DataFrame:
    """What was usable per company: row counts and the forecast note."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("company_id").agg(F.count(F.lit(1)).alias(name))

    joined = companies.select("company_id")
    for df, name in ((customers, "customers"), (reviews, "reviews"), (daily, "timeseries_days")):
        joined = joined.join(counted(df, name), "company_id", "left")
    joined = joined.na.fill(0, ["customers", "reviews", "timeseries_days"])
    note = F.when(F.col("timeseries_days") == 0, "No time-series data uploaded.").otherwise(
        readiness_columns(F.col("timeseries_days"))[2]
    )
    return joined.withColumn("forecast_note", note)
