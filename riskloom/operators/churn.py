"""Churn model: training families, scoring, metrics and explanations."""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.config import CHURN_NUMERIC_COLUMNS, PROXY_FEATURES
from riskloom.functions.scalars import clip01, seeded_key
from riskloom.operators.boosting import BoostedTrees, BoostedTreesModel
from riskloom.operators.joins import alias_lookup
from riskloom.operators.layout import dealt
from riskloom.operators.ordering import running_totals
from riskloom.operators.preparation import class_weights
from riskloom.operators.trees import Attribution, Tree
from riskloom.shipping import ship
from riskloom.sources.scratch import scratch_path, written

NUMERIC_FEATURES = CHURN_NUMERIC_COLUMNS + [
    "spend_per_login", "tickets_per_tenure", "usage_per_tenure", "low_usage_flag",
    "high_ticket_flag", "early_customer_flag",
]
CATEGORICAL_FEATURES = ["plan_type"]
FAMILIES = ["logistic_regression", "random_forest", "xgboost", "lightgbm"]
FAMILY_ALIASES = {"logistic": "logistic_regression", "baseline": "logistic_regression",
                  "rf": "random_forest", "lgbm": "lightgbm"}
MAX_SENSITIVITY_ROWS = 400
SCORE_BUCKETS = 65_536
TOP_FACTORS = 3
#: Rows that are attributed at once: the tables of a tree are made anew for each such block.
ATTRIBUTED_ROWS = 100_000

# Settings of the four families.
FOREST = dict(numTrees=300, maxDepth=8, minInstancesPerNode=5)
BOOST_A = dict(maxIter=250, maxDepth=3, maxLeaves=8, stepSize=0.05, subsamplingRate=0.9, featureRate=0.9, regLambda=1.0,
               minHessian=1.0)
# no row sample: the second booster draws one only with a frequency, which is not set
BOOST_B = dict(maxIter=150, maxLeaves=7, stepSize=0.03, minInstancesPerNode=40, featureRate=0.85, regLambda=3.0)


# The boosters' search: learning rate, depth, rounds and row sample.
TUNING = {"stepSize": [0.03, 0.05], "maxDepth": [2, 3], "maxIter": [150, 250], "subsamplingRate": [0.85, 0.9]}


@dataclass
class ChurnModel:
    """Preprocessing and classifier as one Spark pipeline, plus what explains it."""

    pipeline: PipelineModel
    family: str
    feature_names: list[str]
    background: list[float] = field(default_factory=list)

    @property
    def classifier(self):
        return self.pipeline.stages[-1]

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        facts = json.dumps({"family": self.family, "feature_names": self.feature_names,
                            "background": self.background})
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(facts,)], "facts string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "ChurnModel":
        facts = json.loads(spark.read.text(f"{path}/facts").first()[0])
        return ChurnModel(PipelineModel.load(f"{path}/pipeline"), **facts)


def feature_preprocessor(features: DataFrame, numeric: list[str] = NUMERIC_FEATURES,
                         categorical: list[str] = CATEGORICAL_FEATURES) -> tuple[PipelineModel, list[str]]:
    """z-scores with the population deviation, one-hot text with unknown values as zeros.

    Returns the fitted stages and the names of the vector's slots."""
    stats = features.agg(*[F.avg(c).alias(f"a_{c}") for c in numeric],
                         *[F.stddev_pop(c).alias(f"b_{c}") for c in numeric]).first()
    scaled = []
    for c in numeric:
        mean, spread = float(stats[f"a_{c}"] or 0.0), float(stats[f"b_{c}"] or 0.0) or 1.0
        scaled.append(
            f"CAST((coalesce({c}, {mean!r}D) - {mean!r}D) / {spread!r}D AS DOUBLE) AS z__{c}"
        )
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")]
    indexer = StringIndexer(
        inputCols=categorical, outputCols=[f"i__{c}" for c in categorical], handleInvalid="keep",
        stringOrderType="alphabetAsc",
    ).fit(features.select(*[F.col(c).cast("string").alias(c) for c in categorical]))
    encoder = OneHotEncoder(
        inputCols=[f"i__{c}" for c in categorical], outputCols=[f"h__{c}" for c in categorical],
        dropLast=True,
    ).fit(indexer.transform(features))
    stages += [indexer, encoder, VectorAssembler(
        inputCols=[f"z__{c}" for c in numeric] + [f"h__{c}" for c in categorical],
        outputCol="features", handleInvalid="keep",
    )]
    names = [f"numeric__{c}" for c in numeric]
    for c, labels in zip(categorical, indexer.labelsArray):
        names += [f"categorical__{c}_{v}" for v in labels]
    return PipelineModel(stages), names


def _tidy(transformed: DataFrame) -> DataFrame:
    return transformed.drop(*[c for c in transformed.columns if c[:3] in ("z__", "i__", "h__")])


def _estimator(family: str, n: int, settings: dict, seed: int):
    common = dict(featuresCol="features", labelCol="churn_label", weightCol="class_weight")
    if family == "logistic_regression":
        return LogisticRegression(**{**common, "regParam": 1.0 / max(n, 1), "elasticNetParam": 0.0,
                                     "standardization": False, "maxIter": 1000, "tol": 1e-4,
                                     **settings})
    if family == "random_forest":
        return RandomForestClassifier(**{**common, "seed": seed, **FOREST, **settings})
    base = BOOST_A if family == "xgboost" else BOOST_B
    return BoostedTrees(**{**common, "seed": seed, **base, **settings})


def resolve_family(model_type: str) -> str:
    family = FAMILY_ALIASES.get(model_type.lower(), model_type.lower())
    if family not in FAMILIES:
        raise ValueError(
            "model_type must be one of: logistic_regression, random_forest, xgboost, lightgbm"
        )
    return family


def weighted_rows(features: DataFrame, family: str) -> tuple[DataFrame, int]:
    """Add `class_weight`: balanced, or negatives per positive for the first booster."""
    labelled = features.where(F.col("churn_label").isin(0, 1)).withColumn(
        "churn_label", F.col("churn_label").cast("double")
    )
    classes = class_weights(labelled.withColumn("l", F.col("churn_label").cast("int")), "l").collect()
    total = sum(r.n for r in classes)
    if family == "xgboost":
        ratio = classes[0].positive_weight if classes else 1.0
        weights = {0.0: 1.0, 1.0: float(ratio)}
    else:
        weights = {float(r["l"]): float(r.weight) for r in classes}
    return labelled.withColumn(
        "class_weight", alias_lookup(F.col("churn_label"), weights, 1.0)
    ), total


def train_churn(features: DataFrame, model_type: str = "xgboost", seed: int = 42,
                **settings) -> ChurnModel:
    """Fit one family on engineered features with `churn_label`."""
    family = resolve_family(model_type)
    own = not features.is_cached
    if own:  # the weights, the scaling, the fit and the centre each read the rows
        features = features.persist()
    try:
        rows, total = weighted_rows(features, family)
        preprocessing, names = feature_preprocessor(rows)
        prepared = preprocessing.transform(rows).select("features", "churn_label", "class_weight")
        classifier = _estimator(family, total, settings, seed).fit(prepared)
        centre = prepared.agg(Summarizer.mean(F.col("features")).alias("m")).first().m
    finally:
        if own:
            features.unpersist()
    return ChurnModel(
        PipelineModel([*preprocessing.stages, classifier]), family, names,
        [float(x) for x in centre.toArray()],
    )


def score_churn(features: DataFrame, model: ChurnModel | None) -> DataFrame:
    """Add `churn_prob` in [0, 1]; NULL without a model."""
    if model is None:
        return features.withColumn("churn_prob", F.lit(None).cast("double"))
    out = _tidy(model.pipeline.transform(features))
    return out.withColumn("churn_prob", clip01(F.get(vector_to_array("probability"), F.lit(1)))).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def evaluate_churn(scored: DataFrame, label: str = "churn_label", prob: str = "churn_prob") -> DataFrame:
    """ROC-AUC, average precision (step sum), F1 and the confusion counts at 0.5.

    Rows are added up per distinct score first; the cumulative sums run per score bucket."""
    p = F.col(prob)
    per_score = scored.where(F.col(label).isNotNull() & p.isNotNull()).groupBy(
        p.alias("score")
    ).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    ).withColumn("place", -F.col("score"))
    bucket = F.floor(F.col("place") * SCORE_BUCKETS).cast("bigint")
    ordered = running_totals(per_score, [], bucket, [F.col("place")], ["pos", "neg"])
    totals = per_score.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    rows = ordered.crossJoin(F.broadcast(totals))
    # from the highest score down: a negative ranks below every positive met so far
    pairs = F.col("neg") * (F.col("pos_before") + F.col("pos") / 2.0)
    seen_pos = F.col("pos_before") + F.col("pos")
    seen = seen_pos + F.col("neg_before") + F.col("neg")
    step = F.col("pos") * F.try_divide(seen_pos, seen)
    high = F.col("score") >= 0.5
    flat = rows.agg(
        F.sum(pairs).alias("pairs"), F.sum(step).alias("steps"),
        F.first("all_pos").alias("p"), F.first("all_neg").alias("n"),
        F.sum(F.when(high, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(high, F.col("neg")).otherwise(0)).alias("fp"),
    )
    fn = F.col("p") - F.col("tp")
    return flat.select(
        F.try_divide(F.col("pairs"), F.col("p") * F.col("n")).alias("roc_auc"),
        F.try_divide(F.col("steps"), F.col("p")).alias("pr_auc"),
        F.coalesce(F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + fn), F.lit(0.0)).alias("f1"),
        (F.col("n") - F.col("fp")).alias("tn"), "fp", fn.alias("fn"), "tp",
    )


def train_candidates(features: DataFrame, seed: int = 42, families: list[str] = FAMILIES,
                     settings: dict[str, dict] | None = None) -> dict[str, ChurnModel]:
    """One model per family on the same cached rows. Families are fitted side by side: a boosted one is few tasks."""
    rows = features.persist()
    fit = inheritable_thread_target(features.sparkSession)(lambda f: train_churn(rows, f, seed, **(settings or {}).get(f, {})))
    try:
        rows.count()
        with ThreadPool(max(1, len(families))) as pool:
            return dict(zip(families, pool.map(fit, families, chunksize=1)))
    finally:
        rows.unpersist()


def candidate_metrics(candidates: dict[str, ChurnModel], test: DataFrame) -> DataFrame:
    out = None
    for name, model in candidates.items():
        row = evaluate_churn(score_churn(test, model)).withColumn("model", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


def select_best(metrics: DataFrame, by: list[str] = ()) -> DataFrame:
    """The model with the highest ROC-AUC, the first name on ties."""
    return metrics.groupBy(*by).agg(
        F.min_by("model", F.struct(-F.col("roc_auc"), F.col("model"))).alias("best_model"),
        F.max("roc_auc").alias("roc_auc"),
    )


def rungs(settings: int, rate: int = 2, least_share: float = 0.125) -> list[tuple[int, float]]:
    """(settings kept, share of the rows) of each rung: shares grow by `rate` up to all rows as settings fall by it."""
    out, share = [], 1.0
    while share > least_share:
        share /= rate
    while True:
        out.append((max(1, settings), min(1.0, share)))
        if share >= 1.0:
            return out
        settings, share = -(-settings // rate), share * rate


def tune_churn(features: DataFrame, model_type: str = "lightgbm", grid: dict[str, list] | None = None,
               folds: int = 3, seed: int = 42, parallelism: int | None = None, rate: int = 2, least_share: float = 0.125,
               least_rows: int = 3_000) -> DataFrame:
    """Search of a grid by successive halving: a row for each setting and rung.

    A rung fits its settings on a sample and passes the best 1 / `rate` of them on to the next, whose sample is `rate` times as
    large; the last rung takes all rows. Samples are nested and drawn by a hash of the row, folds by another: reruns take
    the same rows (sums of doubles may differ in their last digits). A sample has `least_rows` rows at least, or all. `roc_auc` is the mean over the folds (NULL if no fold
    has both classes), ties go to the setting that comes first in the grid. `kept`: it went on to the next rung, or won
    the last one. `rate=1` with `least_share=1` is the plain grid search.

    `parallelism` fits run at a time (as many as there are cores if not given), each fold of a setting on its own.
    Every rung costs about as much, so the whole search costs as many full fits as there are rungs times settings of the last one."""
    family = resolve_family(model_type)
    parallelism = parallelism or features.sparkSession.sparkContext.defaultParallelism
    grid = grid or TUNING
    choices = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    rows, total = weighted_rows(features, family)
    preprocessing, _ = feature_preprocessor(rows)
    place = lambda salt: F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), *_plain(rows)), F.lit(1 << 30))
    prepared = written(preprocessing.transform(rows).select(
        "features", "churn_label", "class_weight", (place("sample") / float(1 << 30)).alias("drawn"),
        F.pmod(place("fold"), F.lit(folds)).cast("int").alias("fold")), "tuning-rows")
    metric = BinaryClassificationEvaluator(labelCol="churn_label", metricName="areaUnderROC")

    def auc(setting: dict, sample: DataFrame, fold: int) -> float:
        model = _estimator(family, total, setting, seed).fit(sample.where(F.col("fold") != fold))
        return metric.evaluate(model.transform(sample.where(F.col("fold") == fold)))

    found, known, before = [], {}, -1
    in_session = inheritable_thread_target(features.sparkSession)
    alive = list(range(len(choices)))
    plan = rungs(len(choices), rate, least_share) if rate > 1 else [(len(choices), 1.0)]
    for number, (_, share) in enumerate(plan):
        share = min(1.0, max(share, least_rows / max(total, 1)))
        sample = prepared.where(F.col("drawn") < share).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sizes = {(r["fold"], r["churn_label"]): r["count"] for r in sample.groupBy("fold", "churn_label").count().collect()}
            n_rows = sum(sizes.values())
            # both classes are needed in a fold and in the rest
            usable = [f for f in range(folds) if all(0 < sizes.get((f, c), 0) < sum(sizes.get((g, c), 0) for g in range(folds)) for c in (0.0, 1.0))]
            if n_rows != before:  # samples are nested: the same number is the same sample
                fits = [(i, fold) for i in alive for fold in usable]
                with ThreadPool(parallelism) as pool:
                    aucs = dict(zip(fits, pool.map(in_session(lambda fit: auc(choices[fit[0]], sample, fit[1])), fits, chunksize=1)))
                known = {i: float(np.mean([aucs[i, fold] for fold in usable])) if usable else None for i in alive}
            before, scores = n_rows, [known[i] for i in alive]
        finally:
            sample.unpersist()
        best = sorted(zip(alive, scores), key=lambda s: (-(s[1] if s[1] is not None else -1.0), s[0]))
        keep = {i for i, _ in best[: plan[number + 1][0] if number + 1 < len(plan) else 1]}
        found += [(number, json.dumps(choices[i], sort_keys=True), n_rows, score, i in keep) for i, score in zip(alive, scores)]
        alive = sorted(keep)
    return features.sparkSession.createDataFrame(found, "rung int, setting string, n_rows bigint, roc_auc double, kept boolean")


def _plain(rows: DataFrame) -> list[Column]:
    return [F.col(f"`{f.name}`") for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant", "udt")]


def _proxy_note(feature: Column) -> Column:
    note = F.when(F.lit(False), "")
    for name, text in PROXY_FEATURES.items():
        note = note.when(feature.contains(name), text)
    return note


def linear_attribution(rows: DataFrame, coefficients: dict[str, float], by: str = "company_id") -> DataFrame:
    """Mean attribution per company and feature of a linear model: coefficient times the
    company's mean distance from the overall mean. Exact for linear models, from averages only."""
    names = list(coefficients)
    overall = rows.agg(*[F.avg(c).alias(f"__o_{c}") for c in names])
    means = rows.groupBy(by).agg(*[F.avg(c).alias(c) for c in names])
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 (F.lit(float(w)) * (F.col(c) - F.col(f"__o_{c}"))).alias("value"))
        for c, w in coefficients.items()
    ])
    return means.crossJoin(F.broadcast(overall)).select(by, F.inline(cells))


def _largest(cells: Column) -> Column:
    """The TOP_FACTORS entries of the greatest absolute value, ties by name."""
    ordered = F.array_sort(F.transform(
        cells, lambda c: F.struct((-F.abs(c["value"])).alias("k"), c["feature"].alias("feature"),
                                  c["value"].alias("value"))
    ))
    return F.transform(F.slice(ordered, 1, TOP_FACTORS), lambda c: F.struct(
        c["feature"].alias("feature"), c["value"].alias("value")))


def forest_trees(model: ChurnModel) -> list[Tree]:
    """The trees of a fitted tree family: margins of a booster, shares of a forest's mean probability."""
    classifier = model.classifier
    if isinstance(classifier, BoostedTreesModel):
        return classifier.arrays()
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "forest-nodes")
    classifier.write().save(path)
    # trees x nodes rows, bounded by the family's settings
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    trees: dict[int, dict[int, tuple]] = {}
    for r in rows:
        stats, cut, left, right = r["impurityStats"], r["split"]["leftCategoriesOrThreshold"], r["leftChild"], r["rightChild"]
        if r["split"]["numCategories"] >= 0:  # a 0/1 slot: the list has the values that go left
            left, right = (left, right) if 0.0 in cut else (right, left)
            cut = [0.5]
        inner = left >= 0
        trees.setdefault(r["treeID"], {})[r["id"]] = (
            r["split"]["featureIndex"] if inner else -1, cut[0] if inner else 0.0, left if inner else -1, right if inner else -1,
            stats[1] / sum(stats) / classifier.getNumTrees, sum(stats))
    out = []
    for nodes in trees.values():
        place = {node: i for i, node in enumerate(sorted(nodes))}
        out.append(Tree.of([(f, t, place.get(left, -1), place.get(right, -1), v, c) for f, t, left, right, v, c in (nodes[n] for n in sorted(nodes))]))
    return out


def tree_attribution(model: ChurnModel):
    """A column function from the feature array to one exact attribution for each feature; they add up to the
    row's margin (booster) or probability (forest) minus its mean over the training weight."""
    ship(SparkSession.getActiveSession())
    attribution = Attribution(forest_trees(model), len(model.feature_names))

    @F.pandas_udf("array<double>")
    def parts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held, n = [], 0
        for xs in batches:
            if len(xs):
                held.append(np.stack(xs.to_numpy()))
                n += len(xs)
            if n >= ATTRIBUTED_ROWS:
                yield pd.Series(list(attribution.of(np.concatenate(held))))
                held, n = [], 0
        if held:
            yield pd.Series(list(attribution.of(np.concatenate(held))))

    return parts


def company_churn(features: DataFrame, model: ChurnModel | None, by: str = "company_id") -> DataFrame:
    """`(company_id, churn_prob, top_factors, explanation_source)` from one pass over the rows.

    Exact attributions: those of the linear family only need each company's mean vector, those of
    trees are computed per row and averaged."""
    if model is None:
        return features.groupBy(by).agg(F.lit(0.0).alias("churn_prob"))
    # few rows after a join are few tasks, and a row's attributions cost much
    scored = model.pipeline.transform(features if model.family == "logistic_regression" else dealt(features))
    aggs = [F.avg(clip01(F.get(vector_to_array("probability"), F.lit(1)))).alias("churn_prob")]
    if model.family != "logistic_regression":
        scored = scored.withColumn("__parts", tree_attribution(model)(vector_to_array("features")))
        cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.avg(F.get("__parts", F.lit(i))).alias("value")) for i, n in enumerate(model.feature_names)])
        return scored.groupBy(by).agg(*aggs, cells.alias("__cells")).withColumns(
            {"top_factors": _largest(F.col("__cells")), "explanation_source": F.lit("shap")}
        ).drop("__cells")
    aggs.append(vector_to_array(Summarizer.mean(F.col("features"))).alias("__mean"))
    weights = [float(x) for x in model.classifier.coefficients]
    cells = F.array(*[
        F.struct(F.lit(n).alias("feature"), (F.lit(w) * (F.get("__mean", F.lit(i)) - F.lit(b))).alias("value"))
        for i, (n, w, b) in enumerate(zip(model.feature_names, weights, model.background))
    ])
    return scored.groupBy(by).agg(*aggs).withColumns(
        {"top_factors": _largest(cells), "explanation_source": F.lit("shap")}
    ).drop("__mean")


def explain_factors(features: DataFrame, model: ChurnModel, by: str = "company_id") -> DataFrame:
    """`(company_id, top_factors, explanation_source)`."""
    return company_churn(features, model, by).drop("churn_prob")


def importance_table(model: ChurnModel, sensitivity: DataFrame | None = None) -> tuple[str, list[tuple[str, float]]]:
    """Method name and one value per feature of a fitted model."""
    classifier = model.classifier
    if hasattr(classifier, "featureImportances"):
        values = classifier.featureImportances.toArray()
        return "feature_importances", list(zip(model.feature_names, map(float, values)))
    if hasattr(classifier, "coefficients"):
        values = classifier.coefficients.toArray()
        return "coefficients", [(n, abs(float(v))) for n, v in zip(model.feature_names, values)]
    if sensitivity is not None:
        return "permutation", [(r.feature, r.sensitivity) for r in sensitivity.collect()]
    return "none", []


def _own_importances(model: ChurnModel, reason: str) -> tuple[str, Column]:
    method, values = importance_table(model)
    ranked = sorted(values, key=lambda v: (-abs(v[1]), v[0]))[:TOP_FACTORS]
    entries = [F.struct(F.lit(n).alias("feature"), F.lit(v).alias("value")) for n, v in ranked]
    empty = F.expr("array()").cast("array<struct<feature:string,value:double>>")
    return f"{reason}:{method}", F.array(*entries) if entries else empty


def importance_fallback(features: DataFrame, model: ChurnModel, by: str = "company_id",
                        reason: str = "shap_not_installed") -> DataFrame:
    """The model's own importances as every company's factors, tagged `reason:method`."""
    tag, entries = _own_importances(model, reason)
    return features.select(by).distinct().withColumns(
        {"top_factors": entries, "explanation_source": F.lit(tag)}
    )


def permutation_sensitivity(features: DataFrame, model: ChurnModel, id_column: str = "customer_id",
                            max_rows: int = MAX_SENSITIVITY_ROWS, seed: int = 42) -> DataFrame:
    """Mean absolute move of the probability when one slot is shuffled, over a seeded sample.

    One transform scores the sample with every slot shuffled in turn; the shuffle pairs the
    sample's rows with themselves in a second digest order."""
    prepared = PipelineModel(model.pipeline.stages[:-1]).transform(features)
    sample = (
        prepared.select(id_column, vector_to_array("features").alias("x"))
        .withColumn("k", seeded_key(seed, F.col(id_column)))
        .orderBy("k")
        .limit(max_rows)
    )
    here = sample.withColumn("row_no", F.row_number().over(Window.partitionBy().orderBy("k")))
    slots = F.explode(F.sequence(F.lit(0), F.lit(len(model.feature_names) - 1)))
    spread = here.withColumn("slot", slots)
    other = Window.partitionBy("slot").orderBy(
        F.md5(F.concat_ws(":", F.col("slot").cast("string"), F.col("k")))
    )
    donors = spread.select(
        "slot", F.row_number().over(other).alias("row_no"),
        F.get("x", F.col("slot")).alias("donated"),
    )
    shuffled = spread.join(donors, ["slot", "row_no"]).select(
        "row_no", "slot",
        F.transform("x", lambda v, i: F.when(i == F.col("slot"), F.col("donated")).otherwise(v)).alias("x"),
    )
    base = here.select("row_no", F.lit(-1).alias("slot"), "x")
    classifier = model.classifier
    scored = classifier.transform(
        base.unionByName(shuffled).withColumn("features", array_to_vector("x"))
    ).select("row_no", "slot", F.get(vector_to_array("probability"), F.lit(1)).alias("p"))
    plain = scored.where("slot = -1").select("row_no", F.col("p").alias("p0"))
    names = F.array(*[F.lit(n) for n in model.feature_names])
    return (
        scored.where("slot >= 0").join(plain, "row_no")
        .groupBy("slot").agg(F.avg(F.abs(F.col("p") - F.col("p0"))).alias("sensitivity"))
        .select(F.get(names, F.col("slot")).alias("feature"), "sensitivity")
        .withColumn("proxy_for", _proxy_note(F.col("feature")))
    )
