"""Text features, trained models and the end-to-end flows."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import inputs
from checks.fragments import FRAGMENTS
from checks.registry import check
from riskloom.config import SENTIMENT_LABELS, EngineConfig
from riskloom.functions import scalars
from riskloom.operators import anomaly, churn, preparation, text
from riskloom.operators.layout import dealt
from riskloom.operators.series import build_features
from riskloom.plans import scoring, training
from riskloom.sources import warehouse
from riskloom.sources.scratch import scratch_path

CONFIG = EngineConfig()

FRAGMENTS["clean_docs"] = """
  SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text),
    'https?://\\S+|www\\.\\S+', ' ', 'g'), '<[^>]+>', ' ', 'g'), '[^a-z0-9\\s!?'']', ' ', 'g'), '\\s+', ' ', 'g')) AS cleaned
  FROM documents"""
FRAGMENTS["doc_words"] = """
  SELECT doc_id, list_filter(regexp_extract_all(cleaned, '[a-z0-9]{2,}'), lambda w: w <> '') AS words FROM clean_docs"""
FRAGMENTS["doc_terms"] = """
  SELECT doc_id, unnest(words) AS term FROM doc_words
  UNION ALL
  SELECT doc_id, unnest(list_transform(list_zip(words[1:len(words) - 1], words[2:len(words)]), lambda p: p[1] || ' ' || p[2])) AS term
  FROM doc_words WHERE len(words) > 1"""
FRAGMENTS["doc_tf"] = "SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY doc_id, term"
FRAGMENTS["vocab"] = """
  SELECT term, sum(tf) AS total, count(*) AS df FROM doc_tf GROUP BY term HAVING count(*) >= 2
  ORDER BY total DESC, term LIMIT 5000"""
FRAGMENTS["doc_weights"] = """
  SELECT t.doc_id, t.term, t.tf, (1 + ln(t.tf)) * (ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + v.df)) + 1) AS raw
  FROM doc_tf t JOIN vocab v USING (term)"""


def documents(spark, d):
    return warehouse.documents(spark, d).select("doc_id", "text")


@check("doc_id:i cleaned", "SELECT doc_id, md5(cleaned) AS cleaned FROM clean_docs")
def q_clean_text(spark, d):
    return documents(spark, d).select("doc_id", F.md5(scalars.clean_text(F.col("text"))).alias("cleaned"))


@check("doc_id:i terms:i distinct_terms:i digest", """
  SELECT doc_id, count(*) AS terms, count(DISTINCT term) AS distinct_terms, md5(string_agg(term, '|' ORDER BY term)) AS digest
  FROM doc_terms GROUP BY doc_id""")
def q_tokenize_ngrams(spark, d):
    terms = text.with_terms(documents(spark, d), "text").where(F.size("terms") > 0)
    return terms.select(
        "doc_id", F.size("terms").alias("terms"), F.size(F.array_distinct("terms")).alias("distinct_terms"),
        F.md5(F.array_join(F.sort_array("terms"), "|")).alias("digest"),
    )


@check("term total:i df:i", "SELECT * FROM vocab")
def q_build_vocabulary(spark, d):
    return text.build_vocabulary(documents(spark, d), "text")


@check("doc_id:i term tf:i weight:f", """
  SELECT doc_id, term, tf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM doc_weights""")
def q_tfidf(spark, d):
    docs = documents(spark, d)
    return text.tfidf(docs, text.build_vocabulary(docs, "text"), "doc_id", "text")


_STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)
FRAGMENTS["class_words"] = f"""
  SELECT review_id, sentiment_label, list_filter(regexp_extract_all(lower(review_text), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
    lambda w: w NOT IN ({_STOP})) AS words FROM reviews"""
FRAGMENTS["class_tf"] = """
  SELECT review_id, sentiment_label, term, count(*) AS tf FROM (
    SELECT review_id, sentiment_label, unnest(words) AS term FROM class_words
    UNION ALL SELECT review_id, sentiment_label, unnest(list_transform(list_zip(words[1:len(words) - 1], words[2:len(words)]),
      lambda p: p[1] || ' ' || p[2])) AS term FROM class_words WHERE len(words) > 1) x GROUP BY ALL"""
FRAGMENTS["class_vocab"] = """
  SELECT * FROM (SELECT sentiment_label, term, sum(tf) AS total, count(*) AS df,
      row_number() OVER (PARTITION BY sentiment_label ORDER BY sum(tf) DESC, term) AS r
    FROM class_tf GROUP BY sentiment_label, term) x WHERE r <= 20"""
FRAGMENTS["class_sizes"] = "SELECT sentiment_label, count(*) AS n_docs FROM reviews GROUP BY sentiment_label"
FRAGMENTS["class_raw"] = """
  SELECT t.review_id, t.sentiment_label, t.term, s.n_docs, t.tf * (ln((1 + s.n_docs)::DOUBLE / (1 + v.df)) + 1) AS raw
  FROM class_tf t JOIN class_vocab v USING (sentiment_label, term) JOIN class_sizes s USING (sentiment_label)"""


@check("sentiment_label rank:i term mean_weight:f", """
  SELECT * FROM (SELECT sentiment_label, term, mean_weight,
      row_number() OVER (PARTITION BY sentiment_label ORDER BY round(mean_weight, 9) DESC, term) AS rank
    FROM (SELECT sentiment_label, term, sum(weight) / any_value(n_docs) AS mean_weight FROM (
        SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY review_id)) AS weight FROM class_raw) x
      GROUP BY sentiment_label, term) y) z WHERE rank <= 10""")
def q_top_terms_by_class(spark, d):
    return text.top_terms_by_class(warehouse.reviews(spark, d), "review_id", "review_text", "sentiment_label")


@check("review_id:i score:f", """
  SELECT review_id, least(greatest(p3 + 0.5 * p2, 0), 1) AS score FROM (
    SELECT review_id, star_rating / 6.0::DOUBLE AS p3, (6 - star_rating) / 12.0::DOUBLE AS p2 FROM reviews) x""")
def q_positivity_formula(spark, d):
    p = F.col("star_rating") / 6.0
    return warehouse.reviews(spark, d).withColumn(
        "score", text.positivity(F.array((1 - p) / 2, (1 - p) / 2, p))
    )


FRAGMENTS["guesses"] = """
  SELECT sentiment_label AS truth, ['negative', 'neutral', 'positive', 'positive', 'positive'][(review_id % 5 + 1)::INT] AS predicted FROM reviews"""


@check("accuracy:f macro_f1:f f1_negative:f f1_neutral:f f1_positive:f", """
  SELECT (SELECT avg((truth = predicted)::INT) FROM guesses) AS accuracy, avg(f1) AS macro_f1,
    max(f1) FILTER (WHERE label = 'negative') AS f1_negative, max(f1) FILTER (WHERE label = 'neutral') AS f1_neutral,
    max(f1) FILTER (WHERE label = 'positive') AS f1_positive
  FROM (SELECT label, 2.0::DOUBLE * (SELECT count(*) FROM guesses WHERE truth = label AND predicted = label)
      / ((SELECT count(*) FROM guesses WHERE truth = label) + (SELECT count(*) FROM guesses WHERE predicted = label)) AS f1
    FROM (VALUES ('negative'), ('neutral'), ('positive')) l(label)) x""")
def q_evaluate_sentiment(spark, d):
    guess = inputs.pick(["negative", "neutral", "positive", "positive", "positive"], F.col("review_id") % 5)
    return text.evaluate_sentiment(warehouse.reviews(spark, d).withColumn("label", guess))


# ---------------------------------------------------------------- trained models: rows only


for _name in ("clean_docs", "doc_words", "doc_terms", "doc_tf", "vocab"):
    _sql = FRAGMENTS[_name]
    for _a, _b in (("clean_docs", "clean_reviews"), ("doc_words", "review_words"), ("doc_terms", "review_terms"), ("doc_tf", "review_tf"),
                   ("doc_id", "review_id"), ("FROM documents", "FROM reviews"), ("lower(text)", "lower(review_text)")):
        _sql = _sql.replace(_a, _b)
    FRAGMENTS[{"clean_docs": "clean_reviews", "doc_words": "review_words", "doc_terms": "review_terms",
               "doc_tf": "review_tf", "vocab": "review_vocab"}[_name]] = _sql


@check("term_no:i term df:i idf:f", """
  SELECT row_number() OVER (ORDER BY total DESC, term) - 1 AS term_no, term, df,
    ln((1 + (SELECT count(*) FROM reviews))::DOUBLE / (1 + df)) + 1 AS idf FROM review_vocab""")
def q_train_sentiment(spark, d):
    return text.train_sentiment(warehouse.reviews(spark, d)).vocabulary


@check("company_id review_id:i label score:f")
def q_score_sentiment(spark, d):
    rows = preparation.split_stratified(warehouse.reviews(spark, d), "review_id", "sentiment_label")
    model = text.train_sentiment(rows.where("not is_test"))
    return text.score_sentiment(rows, model)


@check("label mass:f2", """
  SELECT l.label, n / 3.0 AS mass FROM (SELECT unnest(['negative', 'neutral', 'positive']) AS label) l,
    (SELECT count(*) AS n FROM reviews WHERE sentiment_label IN ('negative', 'neutral', 'positive')) r""")
def q_sentiment_mass(spark, d):
    """At the optimum a free intercept gives each class the probability that its balanced weights ask for."""
    rows = warehouse.reviews(spark, d)
    model = text.train_sentiment(rows)
    weights = preparation.class_weights(rows.where(F.col("sentiment_label").isin(SENTIMENT_LABELS)), "sentiment_label")
    scored = text.sentiment_probabilities(rows.join(F.broadcast(weights.select("sentiment_label", "weight")), "sentiment_label"), model)
    p = F.col("__probability")
    shares = F.array(*[F.struct(F.lit(c).alias("label"), p[i].alias("p")) for i, c in enumerate(SENTIMENT_LABELS)])
    return scored.select("weight", F.explode(shares).alias("s")).groupBy(F.col("s.label").alias("label")).agg(
        F.sum(F.col("weight") * F.col("s.p")).alias("mass"))


@check("customer_id:i plan_type slots:i", f"""
  SELECT customer_id, plan_type, (SELECT count(DISTINCT plan_type) FROM customers) + {len(churn.NUMERIC_FEATURES)} AS slots FROM customers""")
def q_feature_preprocessor(spark, d):
    rows = inputs.features(spark, d)
    stages, names = churn.feature_preprocessor(rows)
    
    return stages.transform(rows).withColumn("slots", F.size(vector_to_array("features")))


@check("feature importance:f family")
def q_train_churn(spark, d):
    model = churn.train_churn(inputs.features(spark, d), "random_forest")
    _, values = churn.importance_table(model)
    return spark.createDataFrame(values, "feature string, importance double").withColumn("family", F.lit(model.family))


@check("company_id customer_id:i churn_prob:f")
def q_score_churn(spark, d):
    rows = preparation.split_stratified(inputs.features(spark, d), "customer_id", "churn_label")
    model = churn.train_churn(rows.where("not is_test"), "logistic_regression")
    return churn.score_churn(rows, model)


@check("model roc_auc:f pr_auc:f f1:f")
def q_train_candidates(spark, d):
    rows = preparation.split_stratified(inputs.features(spark, d), "customer_id", "churn_label")
    candidates = churn.train_candidates(rows.where("not is_test"))
    return churn.candidate_metrics(candidates, rows.where("is_test"))


@check("company_id features:a explanation_source")
def q_explain_model_factors(spark, d):
    rows = inputs.features(spark, d)
    return churn.explain_factors(rows, churn.train_churn(rows, "logistic_regression")).select(
        "company_id", F.col("top_factors.feature").alias("features"), "explanation_source"
    )


@check("company_id features:a explanation_source")
def q_importance_fallback(spark, d):
    rows = inputs.features(spark, d)
    model = churn.train_churn(rows, "random_forest")
    return churn.importance_fallback(rows, model).select(
        "company_id", F.col("top_factors.feature").alias("features"), "explanation_source"
    )


@check("family rows:i exact:i", """
  SELECT family, count(*) AS rows, count(*) AS exact FROM customers, (SELECT unnest(['random_forest', 'xgboost', 'lightgbm']) AS family) GROUP BY family""")
def q_tree_attribution(spark, d):
    """Each row's attributions add up to its margin or probability less the mean of the trees."""
    rows, out = dealt(inputs.features(spark, d)), None
    for family in ("random_forest", "xgboost", "lightgbm"):
        model = churn.train_churn(rows, family)
        scored = model.pipeline.transform(rows)
        reached = F.get(vector_to_array("probability" if family == "random_forest" else "rawPrediction"), F.lit(1))
        start = sum(t.mean() for t in churn.forest_trees(model)) + (0.0 if family == "random_forest" else model.classifier.content()["base"])
        parts = F.aggregate(churn.tree_attribution(model)(vector_to_array("features")), F.lit(0.0), lambda a, x: a + x)
        one = scored.select(F.lit(family).alias("family"), (F.abs(parts - (reached - F.lit(start))) < 1e-6).alias("same")).groupBy("family").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if("same").alias("exact"))
        out = one if out is None else out.unionByName(one)
    return out


@check("feature sensitivity:f proxy_for")
def q_permutation_sensitivity(spark, d):
    rows = inputs.features(spark, d)
    return churn.permutation_sensitivity(rows, churn.train_churn(rows, "logistic_regression"))


@check("rung:i settings:i kept:i all_rows:i", """
  SELECT rung, settings, kept, CASE WHEN rung = 3 THEN (SELECT count(*) FROM customers WHERE churn_label IN (0, 1)) END AS all_rows
  FROM (VALUES (0, 8, 4), (1, 4, 2), (2, 2, 1), (3, 1, 1)) AS plan(rung, settings, kept)""")
def q_tuning_rungs(spark, d):
    """Eight settings of the linear family: half of them go on from each rung, the last is fitted on all rows."""
    grid = {"regParam": [0.0005, 0.005, 0.05, 0.5], "elasticNetParam": [0.0, 0.5]}
    return churn.tune_churn(inputs.features(spark, d), "logistic", grid).groupBy("rung").agg(
        F.count(F.lit(1)).alias("settings"), F.count_if("kept").alias("kept"),
        F.max(F.when(F.col("rung") == 3, F.col("n_rows"))).alias("all_rows"))


@check("rung:i setting n_rows:i roc_auc:f kept")
def q_tune_churn(spark, d):
    """The whole grid of the boosters over whole tables."""
    return churn.tune_churn(inputs.features(spark, d), "xgboost")


@check("group_id tree:i sample_size:i nodes:i")
def q_train_isolation_forest(spark, d):
    features = build_features(warehouse.daily_metrics(spark, d))
    forest = anomaly.train_isolation_forest(features, ["company_id", "date"])
    return forest.withColumn("nodes", F.size("feature"))


@check("group_id trees:i least_sample:i most_sample:i", """
  SELECT 'all' AS group_id, 500 AS trees, least(256, (SELECT count(*) FROM daily)) AS least_sample,
    least(256, (SELECT count(*) FROM daily)) AS most_sample""")
def q_forest_shape(spark, d):
    forest = anomaly.train_isolation_forest(build_features(warehouse.daily_metrics(spark, d)), ["company_id", "date"])
    return forest.groupBy("group_id").agg(
        F.countDistinct("tree").alias("trees"), F.min("sample_size").alias("least_sample"), F.max("sample_size").alias("most_sample"))


@check("company_id days:i share_holds", """
  SELECT company_id, count(*) AS days, true AS share_holds FROM daily GROUP BY company_id""")
def q_company_flag_share(spark, d):
    """Per company the flagged days are the contamination's share, give or take one."""
    flagged = scoring.flag_own_days(build_features(warehouse.daily_metrics(spark, d)), CONFIG)
    n, hits = F.count(F.lit(1)), F.count_if("is_anomaly")
    return flagged.groupBy("company_id").agg(n.alias("days"), (F.abs(hits - n * CONFIG.contamination) <= 1.0 + n * 0.005).alias("share_holds"))


@check("company_id date is_anomaly anomaly_score:f")
def q_score_anomalies(spark, d):
    features = build_features(warehouse.daily_metrics(spark, d))
    forest = anomaly.train_isolation_forest(features, ["company_id", "date"])
    return anomaly.contamination_threshold(anomaly.score_global(features, forest))


@check("company_id date is_anomaly anomaly_score:f")
def q_score_company_anomalies(spark, d):
    return scoring.flag_own_days(build_features(warehouse.daily_metrics(spark, d)), CONFIG)


# ---------------------------------------------------------------- flows


def trained(spark, d):
    """All models: the best of the four churn families, and the default forecast backend."""
    return training.train_all(
        warehouse.customers(spark, d), warehouse.reviews(spark, d), warehouse.daily_metrics(spark, d),
        CONFIG,
    )


ASSESSED = "company_id risk_score:f risk_label explanation_source explanation_text actions:a"


def _shown(assessments):
    return assessments.withColumn("actions", F.col("recommendations.action"))


@check(ASSESSED)
def q_score_companies(spark, d):
    bundle = scoring.score_companies(
        warehouse.companies(spark, d), warehouse.customers(spark, d), warehouse.reviews(spark, d),
        warehouse.daily_metrics(spark, d), trained(spark, d).models, CONFIG,
    )
    return _shown(bundle.assessments)


@check(ASSESSED + " forecast_note")
def q_score_uploaded(spark, d):
    rows = inputs.features(spark, d)
    models = scoring.Models(churn.train_churn(rows, "logistic_regression"), text.train_sentiment(warehouse.reviews(spark, d)))
    bundle = scoring.score_uploaded(
        warehouse.customers(spark, d), warehouse.reviews(spark, d), warehouse.daily_metrics(spark, d), models, CONFIG
    )
    return _shown(bundle.assessments).withColumn("forecast_note", F.col("data_quality.forecast_note"))


@check("name metric value:f")
def q_write_metrics(spark, d):
    path = scratch_path(spark, "metrics")
    training.save_metrics(trained(spark, d), path)
    return spark.read.json(f"{path}/churn_metrics").select(
        F.lit("churn").alias("name"), F.inline(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("roc_auc", "pr_auc", "f1")
        ])),
    )


@check("company_id customer_id:i before:f after:f", None)
def q_save_load_model(spark, d):
    rows = inputs.features(spark, d)
    model = churn.train_churn(rows, "logistic_regression")
    path = scratch_path(spark, "churn-model")
    model.save(path)
    again = churn.ChurnModel.load(spark, path)
    first = churn.score_churn(rows, model).withColumnRenamed("churn_prob", "before")
    return churn.score_churn(first, again).withColumnRenamed("churn_prob", "after")


@check("rows:i largest_difference:f", "SELECT count(*) AS rows, 0.0::DOUBLE AS largest_difference FROM customers")
def q_same_after_load(spark, d):
    scored = q_save_load_model(spark, d)
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("before") - F.col("after"))).alias("largest_difference"))
