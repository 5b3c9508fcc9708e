"""File sources and sinks: CSV and Parquet in; CSV, Parquet and JSON out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scalars import half_even, normalize_na, parse_number
from riskloom.sources.delimited import PIECE_BYTES, column_names, file_headers, multi_line_records
from riskloom.sources.scratch import written

CUSTOMER_SCHEMA = {
    "company_id": "string", "customer_id": "string", "tenure": "int", "monthly_spend": "double",
    "usage_frequency": "int", "support_tickets": "int", "plan_type": "string",
    "churn_label": "int",
}
REVIEW_SCHEMA = {
    "company_id": "string", "review_id": "string", "review_text": "string",
    "star_rating": "int", "sentiment_label": "string", "review_date": "date",
}
DAILY_SCHEMA = {
    "company_name": "string", "date": "date", "revenue": "double", "active_users": "bigint",
    "signups": "bigint", "is_injected_anomaly": "boolean",
}


def read_raw_csv(spark: SparkSession, path: str | list[str], multi_line: bool = False,
                 piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Uploads as text columns, placeholders as NULL; files are matched by column name, and a
    column that a file lacks is NULL there.

    Headers are read from the first bytes of each file; files with the same names in the same order
    are one scan. `multi_line` allows newlines in quoted cells; such files are cut into pieces
    of `piece_bytes` as well, and their records are written once to the shared folder."""
    paths = [path] if isinstance(path, str) else list(path)
    files = file_headers(spark, paths)
    alike: dict[tuple[str, ...], list[str]] = {}
    for row in files.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect():
        alike.setdefault(tuple(column_names(row["header"])), []).extend(row["files"])
    if not alike:
        raise ValueError(f"no file with a header at {path}")
    records = written(multi_line_records(files, piece_bytes), "csv-records") if multi_line else None
    out = None
    for names, own in alike.items():
        if records is None:
            raw = spark.read.csv(own, schema=_ddl(names), header=True, escape='"', enforceSchema=True)
        else:
            mine = records if len(alike) == 1 else records.join(
                spark.createDataFrame([(f,) for f in own], "file string"), "file", "left_semi")
            raw = mine.select(F.from_csv("record", _ddl(names), {"escape": '"'}).alias("r")).select("r.*")
        frame = raw.select([normalize_na(F.col("`" + c.replace("`", "``") + "`")).alias(c) for c in names])
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    return out


def _ddl(names: tuple[str, ...]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in names)


def typed(raw: DataFrame, schema: dict[str, str], fractions: list[str] | None = None) -> DataFrame:
    """Cast the known columns, keep the others; a cell that does not parse becomes NULL. A column
    of whole numbers that holds fractions stays a double: `fractions` names such columns; None looks
    for them in a scan of the whole-number columns alone.

    Run the validators on the raw frame first: they report such cells."""
    whole = [c for c in raw.columns if schema.get(c) in ("int", "bigint")]
    if fractions is None and whole:
        number = {c: parse_number(F.col(f"`{c}`")) for c in whole}
        found = raw.agg(*[F.max(number[c] != F.floor(number[c])).alias(f"f{i}") for i, c in enumerate(whole)]).first()
        fractions = [c for i, c in enumerate(whole) if found[f"f{i}"]]
    out = []
    for name in raw.columns:
        column = F.col(f"`{name}`")
        kind = schema.get(name)
        if kind in ("int", "bigint"):
            column = parse_number(column) if name in fractions else parse_number(column).try_cast(kind)
        elif kind == "double":
            column = parse_number(column)
        elif kind is not None:
            column = column.try_cast(kind)
        out.append(column.alias(name))
    return raw.select(out)


def read_customers(spark: SparkSession, path: str | list[str], fractions: list[str] | None = None) -> DataFrame:
    return typed(read_raw_csv(spark, path), CUSTOMER_SCHEMA, fractions)


def read_reviews(spark: SparkSession, path: str | list[str], fractions: list[str] | None = None) -> DataFrame:
    """Review texts may hold newlines."""
    return typed(read_raw_csv(spark, path, multi_line=True), REVIEW_SCHEMA, fractions)


def read_daily_metrics(spark: SparkSession, path: str | list[str], fractions: list[str] | None = None) -> DataFrame:
    """All files of a glob such as `raw/timeseries_*.csv`; one scan for each order of columns."""
    frame = typed(read_raw_csv(spark, path), DAILY_SCHEMA, fractions)
    if "company_id" not in frame.columns and "company_name" in frame.columns:
        frame = frame.withColumn("company_id", F.col("company_name"))
    return frame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.csv(path, header=True, escape='"')
    elif fmt == "json":
        writer.json(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError("fmt must be one of: csv, json, parquet")


def assessment_summary(assessments: DataFrame) -> DataFrame:
    """The persisted per-company summary with its rounded figures.

    Expects the columns of `operators.risk.assess_companies` plus `recommendations`;
    `profile` and `data_counts` are carried along where present."""
    signals = F.struct(*[
        half_even(F.col(f"signals.{c}"), 4).alias(c)
        for c in ("churn_prob", "sentiment_positivity", "anomaly_flag_ratio", "forecast_deviation")
    ])
    points = F.struct(*[
        half_even(F.col(f"contributions.{c}"), 2).alias(c)
        for c in ("Churn", "Sentiment", "Anomalies", "Forecast")
    ])
    factors = F.transform(
        "top_factors",
        lambda f: F.struct(
            f["feature"].alias("feature"), half_even(f["value"], 4).alias("shap_value")
        ),
    )
    extra = [c for c in ("profile", "recommendations", "data_counts") if c in assessments.columns]
    return assessments.select(
        "company_id",
        half_even(F.col("risk_score"), 2).alias("risk_score"),
        "risk_label",
        signals.alias("signals"),
        points.alias("contributions"),
        factors.alias("top_factors"),
        "explanation_text",
        *extra,
    )


def write_assessment(assessments: DataFrame, path: str) -> None:
    """One JSON document per company below `company_id=...`."""
    write_table(assessment_summary(assessments), path, "json", ["company_id"])


def report_json(assessments: DataFrame) -> DataFrame:
    """The downloadable report: one JSON string per company, unrounded."""
    fields = [
        F.col("company_id").alias("company_name"), "risk_score", "risk_label", "signals",
        "explanation_text", "recommendations", "data_quality",
    ]
    return assessments.select(
        "company_id",
        F.concat(
            F.regexp_replace(F.lower("company_id"), " ", "_"), F.lit("_risk_report.json")
        ).alias("file_name"),
        F.to_json(F.struct(*fields)).alias("report"),
    )


def write_report(assessments: DataFrame, path: str) -> None:
    write_table(report_json(assessments), path, "json", ["company_id"])


def write_metrics(metrics: DataFrame, path: str) -> None:
    write_table(metrics, path, "json")
