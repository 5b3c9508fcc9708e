import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.config import RiskWeights
from riskloom.operators import profiling, recommend, risk, signals

# Published signals and the points, score and band they give.
GOLDEN = [
    ((0.2255, 0.7894, 0.0333, 0.0), (7.89, 4.21, 6.67, 0.0), 18.77, "Low"),
    ((0.4387, 0.5007, 0.0, 0.0), (15.36, 9.99, 0.0, 0.0), 25.34, "Low"),
    ((0.9051, 0.2613, 0.0333, 0.0173), (31.68, 14.77, 6.67, 4.31), 57.43, "Medium"),
]


def signal_rows(spark, rows, dropped=None):
    types = ", ".join(f"{s} double" for s in risk.SIGNALS)
    frame = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], f"company_id string, {types}")
    names = F.array(*[F.lit(d) for d in dropped or []]).cast("array<string>")
    return frame.withColumns({
        "dominant_sentiment": F.lit("unknown"), "recent_anomalies": F.lit(0),
        "forecast_trend": F.lit("in line with forecast"), "dropped_metrics": names,
    })


def score(spark, *values, weights=RiskWeights()):
    row = spark.range(1).select(risk.risk_score([F.lit(v) for v in values], weights).alias("s"))
    return row.first().s


def test_published_scores(spark):
    got = risk.assess_companies(signal_rows(spark, [g[0] for g in GOLDEN])).orderBy("company_id").collect()
    for row, (_, points, total, band) in zip(got, GOLDEN):
        assert row.risk_score == pytest.approx(total, abs=0.05) and row.risk_label == band
        assert list(row.contributions) == pytest.approx(points, abs=0.03)
        assert sum(row.contributions) == pytest.approx(row.risk_score, abs=1e-6)


def test_score_is_clipped_and_never_missing(spark):
    assert score(spark, 5.0, -3.0, 9.0, 9.0) == 100
    assert score(spark, None, float("nan"), "text", float("inf")) == 0
    assert score(spark, 0.0, None, 0.0, 0.0) == 0
    assert score(spark, 0.3, 0.0, 0.0, 0.0) - score(spark, 0.3, 1.0, 0.0, 0.0) == pytest.approx(20)
    assert score(spark, 1.0, 1.0, 0.0, 0.0, weights=RiskWeights(churn=0.5)) == pytest.approx(50)


@pytest.mark.parametrize("value,band", [(10, ("Low", "green")), (45, ("Medium", "orange")), (85, ("High", "red")),
                                        (30, ("Medium", "orange")), (60, ("High", "red"))])
def test_bands(spark, value, band):
    s = F.lit(float(value))
    assert tuple(spark.range(1).select(risk.risk_label(s), risk.risk_colour(s)).first()) == band


def forecast_row(spark, pairs):
    rows = spark.createDataFrame([("a", *p) for p in pairs], "company_id string, actual double, forecast double")
    return signals.forecast_signals(rows).first()


def test_forecast_deviation_is_downside_only(spark):
    assert forecast_row(spark, [(120.0, 100.0)] * 3).forecast_deviation == 0
    row = forecast_row(spark, [(80.0, 100.0)] * 3)
    assert row.forecast_deviation == pytest.approx(0.2) and row.forecast_trend == "20% below forecast"
    row = forecast_row(spark, [(80.0, 100.0), (None, 40.0)])
    assert row.forecast_deviation == pytest.approx((0.2 + 0.5) / 2)
    assert forecast_row(spark, [(None, 40.0)]).forecast_deviation == 0
    assert forecast_row(spark, [(112.5, 100.0)]).forecast_trend == "12% above forecast"
    assert forecast_row(spark, [(0.0, 0.0)]).forecast_trend == "in line with forecast"


def test_dominant_sentiment(spark):
    rows = [("a", s, "positive") for s in (0.1, 0.1, 0.1, 0.2, 0.9)] + [("b", None, "neutral"), ("c", 0.59, "x"), ("d", 0.6, "x")]
    frame = spark.createDataFrame(rows, "company_id string, score double, label string")
    got = {r.company_id: r.dominant_sentiment for r in signals.dominant_sentiment(frame).collect()}
    assert got == {"a": "negative", "b": "neutral", "c": "neutral", "d": "positive"}


def test_dropped_metric_is_named(spark):
    start = dt.date(2025, 1, 1)
    rows = [("a", start + dt.timedelta(days=i), i >= 38, 100.0, 40 if i >= 38 else 100, 10) for i in range(40)]
    frame = spark.createDataFrame(
        rows, "company_id string, date date, is_anomaly boolean, revenue double, active_users int, signups int")
    row = signals.anomaly_signals(frame).first()
    assert row.dropped_metrics == ["active_users"] and row.recent_anomalies == 2
    assert row.anomaly_flag_ratio == pytest.approx(2 / 30)


def test_empty_inputs_are_neutral(spark):
    companies = spark.createDataFrame([("a",)], "company_id string")
    empty = lambda ddl: spark.createDataFrame([], "company_id string, " + ddl)
    merged = risk.combine_signals(
        companies, signals.signal_churn(empty("churn_prob double")),
        signals.review_signals(empty("score double, label string")),
        signals.anomaly_signals(empty("date date, is_anomaly boolean")),
        signals.forecast_signals(empty("actual double, forecast double")))
    row = recommend.recommendations(risk.assess_companies(merged)).first()
    assert row.risk_score == 0 and row.top_factors == [] and row.explanation_source == "none"
    assert row.explanation_text == ("Risk driven by overall customer churn signals; customer sentiment is unclear; "
                                    "revenue is trending in line with forecast.")
    assert [r.priority for r in row.recommendations] == ["info"]


def advice(spark, values, dropped=None):
    frame = signal_rows(spark, [values], dropped)
    return recommend.recommendations(risk.assess_companies(frame)).first().recommendations


def test_rules(spark):
    assert [r.priority for r in advice(spark, (0.1, 0.9, 0.0, 0.0))] == ["info"]
    worst = advice(spark, (0.9, 0.2, 0.1, 0.2), ["signups", "revenue"])
    assert [r.priority for r in worst] == ["critical", "critical", "high", "high", "high"]
    assert "billing" in worst[3].action and "signup funnel" in worst[4].action
    assert worst[0].reason == ("High churn risk (90%) combined with negative customer sentiment (20% positivity).")
    assert [r.priority for r in advice(spark, (0.6, 0.9, 0.0, 0.0))] == ["high"]
    assert [r.priority for r in advice(spark, (0.4, 0.9, 0.0, 0.0))] == ["medium"]
    assert "calendar" in advice(spark, (0.1, 0.9, 0.1, 0.0))[0].action
    assert "Re-forecast" in advice(spark, (0.1, 0.9, 0.0, 0.2))[0].action


def test_explanation_sentence(spark):
    factors = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(1.0).alias("value"))
                        for n in ("numeric__usage_frequency", "categorical__plan_type_basic", "x")])
    text = risk.explanation_text(factors, F.lit("negative"), F.lit(1), F.lit("6% below forecast"))
    assert spark.range(1).select(text.alias("t")).first().t == (
        "Risk driven primarily by usage frequency and plan type basic; customer sentiment is mostly negative; "
        "1 anomalous day detected in the last 30 days; revenue is trending 6% below forecast.")


def test_histogram_has_all_bins(spark):
    rows = spark.createDataFrame([("a", 0.0), ("a", 0.2), ("a", 0.21), ("a", 1.0)], "company_id string, churn_prob double")
    got = {r.risk_bin: r.customers for r in profiling.risk_histogram(rows).collect()}
    assert got == {"0-20%": 2, "20-40%": 1, "40-60%": 0, "60-80%": 0, "80-100%": 1}
