import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions.scalars import clean_text, normalize_na, seeded_key
from riskloom.operators import joins, ordering, preparation, ranking, series


def test_clean_text(spark):
    text = " GREAT!!! <br> Visit https://example.com now   "
    rows = spark.createDataFrame([(text,), (None,)], "t string").select(clean_text(F.col("t")).alias("c"))
    assert [r.c for r in rows.collect()] == ["great!!! visit now", ""]


def test_normalize_na(spark):
    rows = spark.createDataFrame([("N/A",), ("null",), ("",), ("x",)], "t string")
    assert [r[0] for r in rows.select(normalize_na(F.col("t"))).collect()] == [None, None, None, "x"]


def test_fill_missing(spark):
    rows = spark.createDataFrame([(1, "basic"), (None, None), (5, "basic")], "tenure int, plan string")
    got = preparation.fill_missing(rows, ["tenure", "plan"], "median").collect()
    assert sorted(r.tenure for r in got) == [1.0, 3.0, 5.0]
    assert {r.plan for r in got} == {"basic"}
    assert preparation.fill_missing(rows, [], "drop").count() == 2
    with pytest.raises(ValueError):
        preparation.fill_missing(rows, ["tenure"], "guess")


def test_scale(spark):
    rows = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0), (3.0, 4.0)], "x double, c double")
    got = preparation.scale_numeric(rows, ["x", "c"]).collect()
    assert np.isclose(np.std([r.x for r in got]), 1) and {r.c for r in got} == {0.0}
    assert sorted(r.x for r in preparation.scale_numeric(rows, ["x"], "minmax").collect()) == [0.0, 0.5, 1.0]


def test_encode(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, p string")
    got = preparation.encode_categorical(rows, ["p"])
    assert got.columns == ["id", "p_a", "p_b"]
    assert sorted(got.collect()) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]


def test_stratified_split(spark):
    rows = spark.createDataFrame([(i, i % 2) for i in range(20)], "id int, y int")
    got = preparation.split_stratified(rows, "id", "y", 0.25).where("is_test").groupBy("y").count().collect()
    assert {r.y: r["count"] for r in got} == {0: 2, 1: 2}


def test_stratified_split_of_hot_label(spark):
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"))
    got = preparation.split_stratified(rows, "id", "y", 0.2).toPandas()
    assert got.groupby("y")["is_test"].sum().to_dict() == {0: 5400, 1: 600}


def days(n, company="a", start=dt.date(2025, 1, 1), values=None):
    values = values if values is not None else np.arange(1.0, n + 1)
    return [(company, start + dt.timedelta(days=i), float(v), 10 + i % 5, 1 + i % 3) for i, v in enumerate(values)]


SCHEMA = "company_id string, date date, revenue double, active_users bigint, signups bigint"


def test_chronological_split(spark):
    rows = spark.createDataFrame(days(240) + days(20, "b"), SCHEMA)
    got = preparation.split_chronological(rows, 30).toPandas()
    a = got[got.company_id == "a"]
    assert a.is_test.sum() == 30 and a[~a.is_test].date.max() < a[a.is_test].date.min()
    assert set(got[got.company_id == "b"].skipped_reason) == {"Need more than 30 rows to split; got 20"}
    with pytest.raises(ValueError):
        preparation.split_chronological(rows, 0)


def test_series_features_match_pandas(spark):
    rng = np.random.default_rng(1)
    rows = days(180, "a", values=rng.uniform(50, 150, 180)) + days(180, "b", values=rng.uniform(50, 150, 180))
    got = series.build_features(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert len(got) == 360 and not got.isna().any().any()
    frame = pd.DataFrame(rows, columns=["company_id", "date", "revenue", "active_users", "signups"])
    a = frame[frame.company_id == "a"].reset_index(drop=True)
    mine = got[got.company_id == "a"].sort_values("date").reset_index(drop=True)
    for width in (7, 30):
        rolled = a.revenue.shift(1).rolling(width, min_periods=max(3, width // 4))
        z = ((a.revenue - rolled.mean()) / rolled.std()).replace([np.inf, -np.inf], np.nan).fillna(0)
        assert np.allclose(mine[f"revenue_zscore_{width}"], z)
    assert np.allclose(mine.revenue_pct_change_1d, a.revenue.pct_change().fillna(0))
    assert mine.day_of_week.tolist() == pd.to_datetime(a.date).dt.dayofweek.tolist()


def test_zero_divisions_become_zero(spark):
    rows = [("a", dt.date(2025, 1, i + 1), 0.0, 0, 0) for i in range(20)]
    got = series.build_features(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert not got.isna().any().any() and (got.revenue_zscore_7 == 0).all()


@pytest.mark.parametrize("kind", ["uniform", "ties", "outliers", "one"])
def test_quantiles_match_numpy(spark, kind):
    rng = np.random.default_rng(3)
    values = {"uniform": rng.uniform(-5, 5, 5000), "ties": rng.integers(0, 4, 5000).astype(float),
              "outliers": rng.standard_cauchy(5000), "one": np.array([2.0])}[kind]
    rows = spark.createDataFrame([(float(v),) for v in values], "x double")
    probs = [0.0, 0.03, 0.25, 0.5, 0.9, 1.0]
    got = ordering.exact_quantiles(rows, [], "x", probs).first()
    assert np.allclose([got[f"q{i}"] for i in range(len(probs))], np.quantile(values, probs))


@pytest.mark.parametrize("n", [2, 3, 7, 10, 39, 41, 399, 401, 4001])
def test_quantiles_of_any_group_size(spark, n):
    values = np.random.default_rng(n).normal(size=n)
    rows = spark.createDataFrame([(float(v),) for v in values], "x double")
    probs = [0.05, 0.5, 0.95, 0.999]
    got = ordering.exact_quantiles(rows, [], "x", probs).first()
    assert np.allclose([got[f"q{i}"] for i in range(4)], np.quantile(values, probs))


def test_quantiles_of_large_group_use_the_bracket(spark):
    rows = spark.range(50_000).select((F.xxhash64("id") % 1_000_003).cast("double").alias("x"))
    values = np.array([r.x for r in rows.collect()])
    probs = [0.001, 0.03, 0.5, 0.97]
    got = ordering.exact_quantiles(rows, [], "x", probs).first()
    assert np.allclose([got[f"q{i}"] for i in range(4)], np.quantile(values, probs))


def test_digest_cutoffs_match_brute_force(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") < 18_000, "hot").otherwise("cold").alias("g"),
                                      seeded_key(1, F.col("id")).alias("k"))
    wanted = spark.createDataFrame([("hot", 5000), ("cold", 1), ("none", 3)], "g string, n bigint")
    got = dict(ordering.digest_cutoffs(rows, ["g"], "k", wanted).collect())
    frame = rows.toPandas()
    keys = {g: sorted(x.k) for g, x in frame.groupby("g")}
    assert got == {"hot": keys["hot"][4999], "cold": keys["cold"][0]}


def test_percent_rank_matches_pandas(spark):
    values = [3, 1, 3, 2, 3, 0, 0, 9]
    rows = spark.createDataFrame([(v,) for v in values], "v int")
    got = {r.v: r.pct_rank for r in ordering.average_percent_rank(rows, [], "v").collect()}
    expected = pd.Series(values).rank(pct=True)
    assert all(np.isclose(got[v], e) for v, e in zip(values, expected))


def test_portfolio_slices_with_one_hot_pair(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("customer_id"), F.when(F.col("id") < 4000, 5).otherwise(F.col("id") % 7).alias("usage_frequency"),
        F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 3).alias("support_tickets"))
    settings = spark.createDataFrame([("h", "healthy", 300), ("m", "mixed", 200), ("r", "at_risk", 100)],
                                     "portfolio string, customer_filter string, n_customers int")
    got = ranking.portfolio_slice(rows, settings).toPandas()
    assert got.groupby("portfolio").size().to_dict() == {"h": 300, "m": 200, "r": 100}
    frame = rows.toPandas()
    frame["e"] = frame.usage_frequency.rank(pct=True) - 0.5 * frame.support_tickets.rank(pct=True)
    ordered = frame.sort_values("e", ascending=False).e.to_numpy()
    merged = got.merge(frame[["customer_id", "e"]], on="customer_id").sort_values(["portfolio", "position"])
    assert np.allclose(merged.e, [ordered[p] for p in merged.position])
    assert merged[merged.portfolio == "m"].position.min() == 2400


def test_union_fills_absent_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "q")], "x int, y string")
    assert sorted(joins.union_all(a, b).collect(), key=str) == [(1, None), (2, "q")]
