import datetime as dt
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.config import EngineConfig
from riskloom.operators import anomaly, boosting, churn, forecast, preparation, text
from riskloom.operators.series import build_features
from riskloom.plans import scoring, training
from riskloom.sources import files

START = dt.date(2024, 1, 1)
SCHEMA = "company_id string, date date, revenue double, active_users bigint, signups bigint, injected boolean"


def series_rows(company, n, seed=0, odd=(), trend=0.5):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    y = 1000 + trend * t + 80 * np.sin(2 * np.pi * t / 7) + rng.normal(0, 10, n)
    for i, factor in odd:
        y[i] *= factor
    flags = {i for i, _ in odd}
    return [(company, START + dt.timedelta(days=i), float(v), int(v / 10), int(v / 100), i in flags) for i, v in enumerate(y)]


def customers(n=240, company=lambda i: "ab"[i % 2]):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        usage = int(rng.integers(0, 30))
        label = int(rng.random() < 1 / (1 + np.exp(0.35 * (usage - 10))))
        rows.append((company(i), f"c{i}", int(rng.integers(1, 60)), float(rng.uniform(10, 200)), usage,
                     int(rng.integers(0, 4)), ["basic", "pro"][i % 2], label))
    return rows


CUSTOMER_SCHEMA = ("company_id string, customer_id string, tenure int, monthly_spend double, usage_frequency int, "
                   "support_tickets int, plan_type string, churn_label int")


@pytest.fixture(scope="module")
def features(spark):
    return preparation.engineer_features(spark.createDataFrame(customers(), CUSTOMER_SCHEMA)).persist()


@pytest.mark.parametrize("family,settings", [("logistic", {}), ("rf", {"numTrees": 20}), ("xgboost", {"maxIter": 5}),
                                             ("lightgbm", {"maxIter": 5})])
def test_families_learn_the_planted_signal(spark, features, family, settings):
    model = churn.train_churn(features, family, **settings)
    scored = churn.score_churn(features, model)
    low, high = scored.agg(F.min("churn_prob"), F.max("churn_prob")).first()
    assert 0 <= low <= high <= 1
    row = churn.evaluate_churn(scored).first()
    assert row.roc_auc > 0.8 and 0 <= row.pr_auc <= 1 and row.tn + row.fp + row.fn + row.tp == 240
    top = churn.explain_factors(features, model).first()
    assert any("usage" in f.feature for f in top.top_factors)
    assert top.explanation_source == "shap"
    if family != "logistic":
        assert churn.importance_fallback(features, model).first().explanation_source == "shap_not_installed:feature_importances"


def test_unknown_family(features):
    with pytest.raises(ValueError):
        churn.train_churn(features, "perceptron")


def test_rungs_grow_to_all_rows():
    assert churn.rungs(16) == [(16, 0.125), (8, 0.25), (4, 0.5), (2, 1.0)]
    assert churn.rungs(9, 3, 0.2) == [(9, 1 / 9), (3, 1 / 3), (1, 1.0)]
    assert churn.rungs(1, 2, 1.0) == [(1, 1.0)]


def test_halving_finds_the_grid_search_winner(spark):
    rows = preparation.engineer_features(spark.createDataFrame(customers(2000), CUSTOMER_SCHEMA))
    # the strongest penalties leave a constant score, so half of the settings are clearly worse
    grid = {"regParam": [50.0, 0.001, 20.0, 0.01], "elasticNetParam": [1.0]}
    out = churn.tune_churn(rows, "logistic", grid, least_rows=300, least_share=0.25).collect()
    by_rung = {n: [r for r in out if r.rung == n] for n in range(3)}
    assert [len(by_rung[n]) for n in range(3)] == [4, 2, 1]
    assert [sum(r.kept for r in by_rung[n]) for n in range(3)] == [2, 1, 1]
    sizes = [by_rung[n][0].n_rows for n in range(3)]
    assert sizes == sorted(sizes) and 400 < sizes[0] < 600 and sizes[-1] == 2000
    plain = churn.tune_churn(rows, "logistic", grid, rate=1).collect()
    assert len(plain) == 4 and {r.n_rows for r in plain} == {2000} and sum(r.kept for r in plain) == 1
    winner = by_rung[2][0]
    assert winner.roc_auc > max(r.roc_auc for r in plain) - 0.005 and winner.roc_auc > 0.8
    # the same rows and folds whatever search they belong to
    assert next(r for r in plain if r.setting == winner.setting).roc_auc == pytest.approx(winner.roc_auc, abs=1e-4)


def test_folds_of_a_setting_are_fitted_side_by_side(spark, monkeypatch):
    """One setting and three folds: all three fits are begun before one ends."""
    rows = preparation.engineer_features(spark.createDataFrame(customers(300), CUSTOMER_SCHEMA))
    begun, fitted = threading.Barrier(3, timeout=120), churn.LogisticRegression._fit

    def fit(self, dataset):
        begun.wait()
        return fitted(self, dataset)

    monkeypatch.setattr(churn.LogisticRegression, "_fit", fit)
    out = churn.tune_churn(rows, "logistic", {"regParam": [0.01]}, rate=1).collect()
    assert len(out) == 1 and out[0].kept and 0.5 < out[0].roc_auc <= 1.0


def test_rows_of_a_tree_get_the_value_of_its_leaf():
    """Growth with and without a row sample moves every margin as a walk down the tree does."""
    rng = np.random.default_rng(2)
    bins, label = rng.integers(0, 8, (3, 4000)).astype(np.uint8), (rng.random(4000) < 0.4).astype(float)
    cuts, keys = [[i + 0.5 for i in range(7)]] * 3, rng.integers(0, 1 << 62, 4000).astype(np.uint64)
    for share in (1.0, 0.7):
        growth = boosting.Growth(4, 0.3, 6, 0, 5, 1.0, 1.0, share, 1.0, 9)
        margin = np.zeros(4000)
        for number, nodes in boosting.grow(bins, keys, label, np.ones(4000), cuts, 0.0, growth, lambda own: own):
            tree, p = boosting.Tree.of([n[:6] for n in nodes]), 1.0 / (1.0 + np.exp(-margin))
            rows = boosting.sampled(keys, growth, number)
            leaf = boosting._leaf(tree, bins, cuts)
            for at in np.unique(leaf[rows]).tolist():
                own = rows[leaf[rows] == at]
                value = -growth.rate * (p - label)[own].sum() / ((p * (1 - p))[own].sum() + growth.penalty)
                assert tree.value[at] == pytest.approx(value, abs=1e-9)
            margin += tree.value[leaf]


def test_millions_of_rows_need_no_meeting():
    assert boosting.tasks_for(0, 12) == 1 and boosting.tasks_for(3_600_000, 12) == 1
    assert boosting.tasks_for(9_000_000, 12) == 3 and boosting.tasks_for(10**9, 12) == 12


def test_tuning_of_one_class_has_no_auc(spark):
    rows = preparation.engineer_features(spark.createDataFrame([(*r[:7], 1) for r in customers(30)], CUSTOMER_SCHEMA))
    out = churn.tune_churn(rows, "xgboost", {"maxIter": [2, 3]}).collect()
    assert {r.roc_auc for r in out} == {None} and [r.setting for r in out if r.kept][-1] == '{"maxIter": 2}'


def test_global_forest_draws_the_same_rate_for_every_tree(spark):
    n, trees, sample = 40_000, 40, 64
    rows = spark.range(n).select(F.col("id").alias("key"), (F.hash("id") % 1000).cast("double").alias("x"))
    forest = anomaly.train_isolation_forest(rows, ["key"], n_trees=trees, sample=sample, columns=["x"]).collect()
    assert sorted(r.tree for r in forest) == list(range(trees)) and {r.sample_size for r in forest} == {sample}
    small = anomaly.train_isolation_forest(rows.limit(20), ["key"], n_trees=trees, sample=sample, columns=["x"]).collect()
    assert len(small) == trees and {r.sample_size for r in small} == {20}


def test_unseen_plans_and_reload(spark, features, tmp_path):
    model = churn.train_churn(features, "logistic")
    odd = features.limit(20).withColumn("plan_type", F.lit("unobtainium"))
    before = [r.churn_prob for r in churn.score_churn(odd, model).orderBy("customer_id").collect()]
    assert all(0 <= p <= 1 for p in before)
    model.save(str(tmp_path / "m"))
    again = churn.ChurnModel.load(spark, str(tmp_path / "m"))
    assert before == [r.churn_prob for r in churn.score_churn(odd, again).orderBy("customer_id").collect()]


def test_auc_matches_pair_counting(spark):
    rng = np.random.default_rng(2)
    scores, labels = np.round(rng.random(300), 2), rng.integers(0, 2, 300)
    rows = spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels)], "churn_prob double, churn_label int")
    got = churn.evaluate_churn(rows).first()
    p, n = scores[labels == 1], scores[labels == 0]
    pairs = (p[:, None] > n[None, :]).mean() + 0.5 * (p[:, None] == n[None, :]).mean()
    assert got.roc_auc == pytest.approx(pairs)
    total, seen, hits, area = labels.sum(), 0, 0, 0.0
    for s in sorted(set(scores), reverse=True):
        mine = labels[scores == s]
        seen, hits = seen + len(mine), hits + mine.sum()
        area += mine.sum() / total * hits / seen
    assert got.pr_auc == pytest.approx(area)


def test_sensitivity_ranks_the_planted_signal(features):
    model = churn.train_churn(features, "logistic")
    got = churn.permutation_sensitivity(features, model).orderBy(F.desc("sensitivity")).collect()
    assert len(got) == len(model.feature_names) and "usage" in got[0].feature


WORDS = {"negative": ["terrible", "awful", "broken"], "neutral": ["average", "okay", "plain"],
         "positive": ["great", "lovely", "superb"]}


def review_rows(n=90):
    rows = []
    for i in range(n):
        label = ["negative", "neutral", "positive"][i % 3]
        words = WORDS[label]
        rows.append(("ab"[i % 2], i, f"The app is {words[i % 2]} and {words[(i + 1) % 3]} today", label))
    return rows


def softmax(logits):
    p = np.exp(logits - logits.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def newton(x, y, weights, penalty, free):
    """The minimum of the weighted log loss plus half the squared coefficients; columns in `free` are not penalised."""
    n, m = x.shape
    k = y.shape[1]
    theta, ridge = np.zeros((m, k)), np.where(np.arange(m) >= free, 1e-12, penalty)

    def objective(t):
        p = softmax(x @ t)
        return -(weights * np.log((p * y).sum(1))).sum() + 0.5 * (ridge[:, None] * t * t).sum()

    for _ in range(60):
        p = softmax(x @ theta)
        g = (x.T @ (weights[:, None] * (p - y)) + ridge[:, None] * theta).T.ravel()
        h = np.zeros((m * k, m * k))
        for a in range(k):
            for b in range(k):
                h[a * m : a * m + m, b * m : b * m + m] = x.T @ ((weights * (p[:, a] * (a == b) - p[:, a] * p[:, b]))[:, None] * x)
        h += np.diag(np.tile(ridge, k)) + 1e-10 * np.eye(m * k)
        step = np.linalg.solve(h, g).reshape(k, m).T
        rate = 1.0
        while objective(theta - rate * step) > objective(theta) and rate > 1e-6:
            rate /= 2
        theta = theta - rate * step
    return objective(theta), theta


def test_sentiment_reaches_the_optimum(spark):
    """The objective is that of a full Newton solver, and the probabilities are the same."""
    labels = ["negative", "neutral", "positive"]
    noisy = [(c, i, t + f" word{i % 7} other{i % 5}", labels[(labels.index(y) + (i % 11 == 0)) % 3]) for c, i, t, y in review_rows()]
    rows = spark.createDataFrame(noisy[:70], "company_id string, review_id bigint, review_text string, sentiment_label string")
    model = text.train_sentiment(rows)
    found = text._vectors(rows, "review_text", model.terms, model.idf).orderBy("review_id").collect()
    x = np.zeros((len(found), len(model.terms) + 1))
    for i, r in enumerate(found):
        x[i, r.slots] = r["values"]
    x[:, -1] = 1.0
    y = np.array([[r.sentiment_label == c for c in labels] for r in found], float)
    weights = (y @ (len(y) / (3 * y.sum(0))))
    theta = model.coefficients
    p = softmax(x @ theta)
    reached = -(weights * np.log((p * y).sum(1))).sum() + 0.5 * (theta[:-1] ** 2).sum()
    best, exact = newton(x, y, weights, 1.0, x.shape[1] - 1)
    assert abs(reached - best) / len(y) < 1e-6
    assert np.abs(p - softmax(x @ exact)).max() < 1e-4


def test_sentiment_model(spark, tmp_path):
    rows = spark.createDataFrame(review_rows(), "company_id string, review_id bigint, review_text string, sentiment_label string")
    model = text.train_sentiment(rows)
    scored = text.score_sentiment(rows, model)
    result = text.evaluate_sentiment(scored).first()
    assert result.accuracy > 0.95 and result.macro_f1 > 0.95
    means = {r.label: r.m for r in scored.groupBy("label").agg(F.avg("score").alias("m")).collect()}
    assert means["negative"] < means["neutral"] < means["positive"]
    model.save(str(tmp_path / "s"))
    again = text.score_sentiment(rows, text.SentimentModel.load(spark, str(tmp_path / "s")))
    assert scored.select("review_id", "score").exceptAll(again.select("review_id", "score")).count() == 0
    with pytest.raises(ValueError):
        text.train_sentiment(rows.where("sentiment_label <> 'neutral'"))
    blank = text.score_sentiment(rows, None).first()
    assert blank.label == blank.sentiment_label and blank.score is None


def test_tfidf_vectors_agree_with_the_long_form(spark):
    rows = spark.createDataFrame(review_rows(30), "company_id string, review_id bigint, review_text string, sentiment_label string")
    vocab = text.build_vocabulary(rows, "review_text")
    long = text.tfidf(rows, vocab, "review_id", "review_text").groupBy("review_id").agg(F.sum(F.col("weight") ** 2).alias("n"))
    assert all(r.n == pytest.approx(1) for r in long.collect())


ODD = [(60, 1.6), (90, 0.4), (120, 1.6), (150, 0.4)]


def test_forest_finds_injected_days(spark):
    rows = spark.createDataFrame(series_rows("a", 200, 1, ODD), SCHEMA)
    days = build_features(rows)
    config = EngineConfig(n_trees=200)
    own = scoring.flag_own_days(days, config)
    result = anomaly.evaluate_anomalies(own, "injected").first()
    assert result.recall > 0.6 and result.detected <= 7
    forest = anomaly.train_isolation_forest(days, ["company_id", "date"], n_trees=200)
    assert forest.count() == 200 and forest.agg(F.max("sample_size")).first()[0] == 200
    flagged = anomaly.contamination_threshold(anomaly.score_global(days, forest))
    assert anomaly.evaluate_anomalies(flagged, "injected").first().recall > 0.6
    with pytest.raises(ValueError):
        anomaly.train_isolation_forest(days, ["date"], contamination=0.7)


def test_trees_are_well_formed():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(120, 3))
    tree = np.repeat([0, 1, 2], 40)
    for feature, threshold, left, right, path in anomaly.grow_trees(points, tree, 3, rng):
        inner = feature >= 0
        assert (left[inner] > 0).all() and (right[inner] == left[inner] + 1).all()
        assert (left[~inner] == -1).all() and len(feature) == 2 * inner.sum() + 1
        assert (path[~inner] > 0).all()


def test_forest_sample_is_exact(spark):
    rows = spark.createDataFrame(series_rows("a", 900, 1), SCHEMA)
    forest = anomaly.train_isolation_forest(build_features(rows), ["company_id", "date"], n_trees=50)
    assert {r.sample_size for r in forest.collect()} == {256}


@pytest.mark.parametrize("backend", ["prophet", "ets", "seasonal_naive"])
def test_forecasts_beat_the_last_value(spark, backend):
    rows = spark.createDataFrame(series_rows("a", 240, 3) + series_rows("b", 20), SCHEMA)
    got = forecast.backtest_and_project(rows, backend, 30).orderBy("step").toPandas()
    assert len(got) == 60 and got.is_projection.sum() == 30 and set(got.company_id) == {"a"}
    assert (got.lower_bound <= got.forecast).all() and (got.forecast <= got.upper_bound).all()
    table = forecast.compare_backends(rows, [backend, "naive"]).toPandas().set_index("backend")
    assert table.loc[backend, "mape"] < table.loc["naive", "mape"]


def test_seasonal_repeat_and_naive(spark):
    rows = spark.createDataFrame(series_rows("a", 50), SCHEMA)
    last = [r.revenue for r in rows.orderBy("date").collect()][-7:]
    got = [r.forecast for r in forecast.forecast_seasonal_naive(rows, 14).orderBy("step").collect()]
    assert got == pytest.approx(last + last)
    assert {r.forecast for r in forecast.forecast_naive(rows, 30).collect()} == {last[-1]}
    short = forecast.forecast_seasonal_naive(rows.orderBy("date").limit(3), 5).collect()
    assert len({r.forecast for r in short}) == 1
    with pytest.raises(ValueError):
        forecast.train_forecast(rows, "crystal ball")


def test_fallback_chain():
    import pandas as pd

    fit = forecast._fit_company(["trend_seasonal", "ets"], "revenue")
    one = fit(("a",), pd.DataFrame({"date": [START], "revenue": [5.0]})).iloc[0]
    assert one.model_type == "seasonal_naive" and one.base == 5.0
    flat = fit(("a",), pd.DataFrame({"date": [START + dt.timedelta(days=i) for i in range(40)], "revenue": [7.0] * 40})).iloc[0]
    assert flat.base + flat.season[0] == pytest.approx(7.0, abs=0.05)


@pytest.fixture(scope="module")
def trained(spark):
    rows = spark.createDataFrame(customers(), CUSTOMER_SCHEMA)
    reviews = spark.createDataFrame(review_rows(), "company_id string, review_id bigint, review_text string, sentiment_label string")
    daily = spark.createDataFrame(series_rows("a", 200, 1, ODD) + series_rows("b", 200, 2), SCHEMA)
    config = EngineConfig(n_trees=100)
    return rows, reviews, daily, config, training.train_all(
        rows, reviews, daily, config, truth="injected", families=["logistic_regression", "lightgbm"],
        settings={"lightgbm": {"maxIter": 3}})


def test_train_save_load_score(spark, trained, tmp_path):
    rows, reviews, daily, config, result = trained
    assert result.best_churn in ("logistic_regression", "lightgbm")
    assert result.anomaly_metrics.first().recall > 0.4
    assert result.forecast_metrics.count() == 2
    training.save_models(result.models, str(tmp_path / "models"))
    training.save_metrics(result, str(tmp_path / "metrics"))
    models = training.load_models(spark, str(tmp_path / "models"))
    companies = spark.createDataFrame([("a",), ("b",), ("c",)], "company_id string")
    scores = []
    for m in (result.models, models):
        bundle = scoring.score_companies(companies, rows, reviews, daily, m, config)
        scores.append({r.company_id: round(r.risk_score, 9) for r in bundle.assessments.collect()})
        bundle.release()
    assert scores[0] == scores[1] and scores[0]["c"] == 0
    nothing = training.load_models(spark, str(tmp_path / "absent"))
    bare = scoring.score_companies(companies, rows, reviews, daily, nothing, config)
    assert {r.explanation_source for r in bare.assessments.collect()} == {"none"}


def test_uploads(spark, trained):
    rows, reviews, daily, config, result = trained
    bad = spark.createDataFrame([("bad", "x", -1, 1.0, 1, 1, "pro", 1)], CUSTOMER_SCHEMA)
    new = rows.withColumn("plan_type", F.lit("platinum")).unionByName(bad)
    short = daily.where((F.col("company_id") == "a") | (F.col("date") < START + dt.timedelta(days=20)))
    bundle = scoring.score_uploaded(new, reviews.drop("sentiment_label"), short, result.models, config)
    got = {r.company_id: r for r in bundle.assessments.collect()}
    assert set(got) == {"a", "b"}
    assert "30" in got["b"].data_quality.forecast_note and got["b"].signals.forecast_deviation == 0
    assert {r.company_id for r in bundle.blocked.collect()} == {"bad"}
    alone = scoring.score_uploaded(rows, None, None, result.models, config).assessments.collect()
    assert all(r.signals.anomaly_flag_ratio == 0 and r.signals.forecast_deviation == 0 for r in alone)
    assert {r.data_quality.forecast_note for r in alone} == {"No time-series data uploaded."}
    with pytest.raises(ValueError):
        scoring.score_uploaded(new, None, None, result.models, config, strict=True)


def test_files_round_trip(spark, tmp_path):
    path = str(tmp_path / "timeseries_a.csv")
    with open(path, "w") as f:
        f.write("company_name,date,revenue,active_users,signups\nA,2025-01-01,1.5,2,N/A\nA,2025-01-02,null,3,4\n")
    got = sorted(files.read_daily_metrics(spark, str(tmp_path / "timeseries_*.csv")).collect())
    assert [(r.revenue, r.active_users, r.signups) for r in got] == [(1.5, 2, None), (None, 3, 4)]


def test_texts_are_dealt_over_the_tasks(spark):
    """One file of one row group does not make one task of all texts."""
    rows = spark.createDataFrame([(i, "alpha beta alpha beta") for i in range(400)], "doc_id long, body string").coalesce(1)
    parts = text.with_terms(rows, "body").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(p["count"] for p in parts) < 150


def test_term_counts_by_group_pass_on_what_they_hold(spark, monkeypatch):
    rows = spark.createDataFrame([(None, "aa bb aa"), ("x", "aa aa"), ("x", "bb"), ("x", None)], "label string, body string")
    want = {(None, "aa", 2, 1), (None, "bb", 1, 1), (None, "aa bb", 1, 1), (None, "bb aa", 1, 1),
            ("x", "aa", 2, 1), ("x", "aa aa", 1, 1), ("x", "bb", 1, 1)}
    for held in (0, 1000):
        monkeypatch.setattr(text, "HELD_TERMS", held)
        assert {tuple(r) for r in text._term_counts(rows, ["label"], text._words("body")).collect()} == want


def test_fit_of_held_rows_and_by_jobs_agree(spark):
    from riskloom.operators.logistic import fit_multinomial

    rows = [([i % 7, 7 + i % 3], [0.6, 0.8], (i // 2) % 3, 1.0 + i % 2) for i in range(200)] + [([], [], 1, 1.0)]
    frame = spark.createDataFrame(rows, "slots array<int>, values array<double>, label int, weight double")
    held, jobs = (fit_multinomial(frame, 10, 3, 1e-2, n) for n in (10_000, 1))
    assert abs(held - jobs).max() < 1e-5 and abs(held).max() > 0.01


def test_a_fit_of_common_and_rare_slots_takes_few_evaluations():
    """Slots from in most rows to in few, as terms are: the steps are scaled by curvatures."""
    import pyarrow as pa

    from riskloom.operators import logistic

    rng, n, slots = np.random.default_rng(7), 1500, 400
    held = [np.flatnonzero(rng.random(slots) < 0.6 / (1 + np.arange(slots)) ** 0.7) for _ in range(n)]
    values = [np.full(len(own), 1.0 / np.sqrt(max(1, len(own)))) for own in held]
    truth = rng.normal(0, 3, (slots, 3))
    label = [int((truth[own].sum(0) + rng.gumbel(size=3)).argmax()) for own in held]
    batch = pa.RecordBatch.from_arrays([pa.array([o.tolist() for o in held], pa.list_(pa.int32())), pa.array([v.tolist() for v in values], pa.list_(pa.float64())),
                                        pa.array(label, pa.int32()), pa.array(np.ones(n))], names=["slots", "values", "label", "weight"])
    rows, calls, penalty = logistic.Rows.of([batch]), [], 1.0 / n

    def evaluate(theta):
        calls.append(1)
        return logistic._objective(logistic._sums_of([rows], theta) / n, theta, penalty)

    theta = rng.normal(0, 0.1, (slots + 1, 3))
    (f, g), move = evaluate(theta), rng.normal(0, 1e-6, theta.shape)
    assert abs(evaluate(theta + move)[0] - f - (g * move).sum()) < 1e-9
    calls.clear()
    found = logistic.minimise(evaluate, np.zeros_like(theta), logistic._curvature(rows.squares(slots), n, 3, penalty))
    assert len(calls) < 100 and abs(evaluate(found)[1]).max() < 1e-7
