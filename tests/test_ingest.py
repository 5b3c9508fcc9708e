import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.functions import scalars
from riskloom.operators import ingest, joins, validation


def catalog(spark, **exports):
    rows = [(c, i, n) for c, names in exports.items() for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "company_id string, position int, column_name string")


def mapping(spark, targets, names):
    rows = ingest.detect_column_mapping(catalog(spark, a=names), targets).collect()
    return {r.field: (r.column_name, r.confidence) for r in rows}


def test_billing_export_is_mapped(spark):
    names = ["Customer ID", "Email", "Created (UTC)", "Plan Name", "Monthly Recurring Revenue",
             "Login Count (30d)", "Status"]
    found = mapping(spark, ingest.CUSTOMER_FIELDS, names)
    assert found == {
        "customer_id": ("Customer ID", "exact"),
        "monthly_spend": ("Monthly Recurring Revenue", "likely"),
        "plan_type": ("Plan Name", "likely"),
        "usage_frequency": ("Login Count (30d)", "guess"),
        "support_tickets": (None, None),
        "tenure": (None, None),
    }


def test_longer_alias_wins_and_columns_are_taken_once(spark):
    found = mapping(spark, ["monthly_spend"], ["Revenue", "Monthly Recurring Revenue"])
    assert found["monthly_spend"][0] == "Monthly Recurring Revenue"
    both = mapping(spark, ["customer_id", "plan_type"], ["customer"])
    assert both == {"customer_id": ("customer", "likely"), "plan_type": (None, None)}


def test_no_match_stays_empty(spark):
    found = mapping(spark, ["tenure", "plan_type"], ["foo", "bar", "baz"])
    assert all(v == (None, None) for v in found.values())


def test_normalize_name(spark):
    row = spark.range(1).select(scalars.normalize_name(F.lit("Created (UTC)")).alias("n")).first()
    assert row.n == "createdutc"


def test_signup_date_column(spark):
    cells = spark.createDataFrame(
        [("a", "activity date", i, f"2025-01-{i + 1:02d}") for i in range(20)]
        + [("b", "activity date", i, "soon") for i in range(20)],
        "company_id string, column_name string, row_no int, value string",
    )
    cat = catalog(spark, a=["cust", "activity date"], b=["cust", "activity date"], c=["Created At", "date"])
    found = dict(ingest.detect_signup_date_column(cat, ingest.looks_like_dates(cells)).collect())
    assert found == {"a": "activity date", "b": None, "c": "Created At"}


def test_tenure(spark):
    rows = spark.createDataFrame(
        [("a", "2025-01-01"), ("a", "2025-07-01"), ("a", "2025-12-01"), ("b", "nope"), ("c", "2025-01-01"),
         ("c", "not a date"), ("c", None)], "company_id string, joined string")
    got = ingest.derive_tenure(rows, "joined").groupBy("company_id").agg(
        F.sort_array(F.collect_list("tenure")).alias("t"))
    assert {r.company_id: r.t for r in got.collect()} == {"a": [1, 5, 11], "b": [1], "c": [1, 1, 1]}


def test_tenure_of_given_date(spark):
    rows = spark.createDataFrame([("a", "2025-01-01")], "company_id string, joined string")
    got = ingest.derive_tenure(rows, "joined", reference_date=F.lit(dt.datetime(2025, 3, 2)))
    assert got.first().tenure == 2


def test_apply_mapping_defaults(spark):
    raw = spark.createDataFrame([("a", 1.0, "2025-01-01")], "company_id string, MRR double, Created string")
    got = ingest.apply_mapping(raw, {"monthly_spend": "MRR", "tenure": None}, "Created", {"support_tickets": 0})
    assert got.columns == ["company_id", "monthly_spend", "tenure", "support_tickets"]
    assert got.first()[1:] == (1.0, 1, 0)


def test_event_counts_and_join(spark):
    events = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    counts = joins.event_counts(events, "k", "n")
    assert dict(counts.collect()) == {"a": 2, "b": 1}
    customers = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "id string")
    got = joins.join_counts(customers, counts, "id", "k", "n")
    assert sorted(got.collect(), key=str) == sorted([("a", 2), ("b", 1), ("c", 0), (None, 0)], key=str)
    with pytest.raises(ValueError):
        joins.event_counts(events, "missing")


def test_repeated_count_keys_do_not_multiply_rows(spark):
    counts = spark.createDataFrame([("1", 2), ("1", 3)], "k string, n int")
    got = joins.join_counts(spark.createDataFrame([(1,)], "id bigint"), counts, "id", "k", "n")
    assert got.collect() == [(1, 5)]


def customer_rows(spark, n=12, **changes):
    base = {"tenure": "5", "monthly_spend": "10.5", "usage_frequency": "3", "support_tickets": "0", "plan_type": "pro",
            "churn_label": "1"}
    rows = [("a", *[changes.get(k, v) if i == 0 else v for k, v in base.items()]) for i in range(n)]
    return spark.createDataFrame(rows, "company_id string, " + ", ".join(f"{k} string" for k in base))


def issues(frame):
    return frame.first().issues


def test_customer_checks(spark):
    assert issues(validation.validate_customers(customer_rows(spark))) == []
    found = issues(validation.validate_customers(customer_rows(spark, monthly_spend="unknown", tenure="-5")))
    assert any("non-numeric" in m for m in found) and any("negative" in m for m in found)
    assert "missing" in issues(validation.validate_customers(customer_rows(spark, tenure=None)))[0]
    assert "churn_label" in issues(validation.validate_customers(customer_rows(spark, churn_label="2")))[0]
    assert "Only 3" in issues(validation.validate_customers(customer_rows(spark, 3)))[0]
    only = customer_rows(spark).select("company_id", "tenure")
    assert issues(validation.validate_customers(only)) == [
        "Customer file is missing required columns: monthly_spend, usage_frequency, support_tickets, plan_type."]


def test_infinity_is_a_number_and_a_suffix_is_not(spark):
    rows = spark.createDataFrame([("a", "inf"), ("a", "5d"), ("a", "5f"), ("a", " 7 ")], "company_id string, x string")
    assert validation.numeric_column_errors(rows, ["x"]).first()[1:] == ("x", 2, 0)


def test_empty_company(spark):
    known = spark.createDataFrame([("z",)], "company_id string")
    got = validation.validate_reviews(spark.createDataFrame([], "company_id string, review_text string"), known)
    assert issues(got) == ["Review file is empty."]


def daily_rows(spark, n=20, dates=None, revenue="10"):
    start = dt.date(2025, 1, 1)
    rows = [("a", str(start + dt.timedelta(days=i)), revenue if i == 0 else "10", "5", "1") for i in range(n)]
    for i, value in (dates or {}).items():
        rows[i] = (rows[i][0], value, *rows[i][2:])
    return spark.createDataFrame(rows, "company_id string, date string, revenue string, active_users string, signups string")


def test_daily_checks(spark):
    assert issues(validation.validate_timeseries(daily_rows(spark))) == []
    found = issues(validation.validate_timeseries(daily_rows(spark, dates={1: "2025-01-01"}, revenue="-100")))
    assert any("duplicate" in m for m in found) and any("negative" in m for m in found)
    found = issues(validation.validate_timeseries(daily_rows(spark, dates={1: "last tuesday", 2: "2025-01-01"})))
    assert any("parse" in m for m in found) and not any("duplicate" in m for m in found)


@pytest.mark.parametrize("n,expected", [(90, (True, 30)), (40, (True, 14)), (20, (False, 0))])
def test_readiness(spark, n, expected):
    row = validation.forecast_readiness(daily_rows(spark, n)).first()
    assert (row.can_forecast, row.holdout_days) == expected
    assert ("need at least 30" in row.forecast_note) == (n < 30)


def test_exports_are_grouped_in_small_parts(spark, monkeypatch):
    """What a task sorts does not grow with the catalog, and no export is split."""
    monkeypatch.setattr(ingest, "PART_ROWS", 20)
    catalog = spark.range(400).selectExpr("cast(id div 4 as string) company_id", "cast(id % 4 as int) position", "concat('Plan', id % 4) column_name").coalesce(1)
    parts = ingest._by_export(catalog).selectExpr("spark_partition_id() p", "company_id").distinct().collect()
    assert len({r.p for r in parts}) > 10 and len(parts) == 100
    assert ingest.unique_columns(catalog).count() == 400


def test_missing_fields_without_name(spark):
    catalog = spark.createDataFrame([("a", "x"), ("a", None), (None, "x"), ("b", "y"), ("b", "y")], "company_id string, column_name string")
    found = sorted(map(tuple, ingest.missing_fields(catalog, ["x", "y"]).collect()), key=str)
    assert found == [("a", "y"), ("b", "x"), (None, "x"), (None, "y")]
    assert ingest.missing_fields(catalog, []).count() == 0
