"""Isolation forest on daily features: sample, grow and score as Spark jobs.

Trees are grown where their sample lands (`groupBy(group, tree block)`), so no task sees
more than block x sample rows. Global and per-company forests differ only in the group."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import DETECTOR_FEATURES
from riskloom.operators.layout import spread
from riskloom.operators.ordering import exact_quantiles

TREES_PER_BLOCK = 25
OVERSAMPLE = 1.5
EULER_GAMMA = 0.5772156649015329

FOREST_SCHEMA = (
    "group_id string, tree int, sample_size int, feature array<int>, threshold array<double>, "
    "left array<int>, right array<int>, path array<double>"
)


def expected_depth(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    big = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + EULER_GAMMA) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def grow_trees(points: np.ndarray, tree: np.ndarray, n_trees: int, rng: np.random.Generator) -> list[tuple]:
    """Random axis-parallel splits for several trees at once, one level after the other.

    `tree` numbers each point's tree from 0. Returns per tree the arrays feature (-1 at a
    leaf), threshold, left, right and path; a leaf's path counts its unsplit points."""
    sizes = np.bincount(tree, minlength=n_trees)
    limits = np.ceil(np.log2(np.maximum(sizes, 2))).astype(int)
    owner, feature, threshold, left, right, path = (
        [np.arange(n_trees)], [np.full(n_trees, -1)], [np.zeros(n_trees)], [np.full(n_trees, -1)],
        [np.full(n_trees, -1)], [np.zeros(n_trees)],
    )
    total, depth, first = n_trees, 0, 0
    alive, node = np.arange(len(points)), tree.copy()
    while len(alive):
        by_node = alive[np.argsort(node[alive], kind="stable")]
        starts = np.flatnonzero(np.r_[True, np.diff(node[by_node]) != 0])
        ids = node[by_node][starts]
        counts = np.diff(np.r_[starts, len(by_node)])
        block = points[by_node]
        low = np.minimum.reduceat(block, starts, axis=0)
        high = np.maximum.reduceat(block, starts, axis=0)
        usable = high > low
        local = ids - first
        split = (counts > 1) & usable.any(axis=1) & (depth < limits[owner[-1][local]])
        path[-1][local] = depth + expected_depth(counts)
        axis = np.argmax(np.where(usable, rng.random(usable.shape), -1.0), axis=1)
        pick = np.arange(len(ids))
        cut = low[pick, axis] + rng.random(len(ids)) * (high[pick, axis] - low[pick, axis])
        n_split = int(split.sum())
        child = np.full(len(ids), -1)
        child[split] = total + 2 * np.arange(n_split)
        feature[-1][local] = np.where(split, axis, -1)
        threshold[-1][local] = np.where(split, cut, 0.0)
        left[-1][local] = child
        right[-1][local] = np.where(split, child + 1, -1)
        position = np.repeat(pick, counts)
        goes_on = split[position]
        alive, position = by_node[goes_on], position[goes_on]
        is_right = points[alive, axis[position]] > cut[position]
        node[alive] = child[position] + is_right
        heirs = np.repeat(owner[-1][local][split], 2)
        owner.append(heirs)
        feature.append(np.full(len(heirs), -1))
        threshold.append(np.zeros(len(heirs)))
        left.append(np.full(len(heirs), -1))
        right.append(np.full(len(heirs), -1))
        path.append(np.full(len(heirs), depth + 1.0))
        first, total, depth = total, total + len(heirs), depth + 1
    owners = np.concatenate(owner)
    columns = [np.concatenate(c) for c in (feature, threshold, left, right, path)]
    out = []
    for t in range(n_trees):
        mine = np.flatnonzero(owners == t)
        renumber = np.full(total, -1)
        renumber[mine] = np.arange(len(mine))
        f, c, l, r, p = (column[mine] for column in columns)
        inner = f >= 0
        out.append((f, c, np.where(inner, renumber[l], -1), np.where(inner, renumber[r], -1), p))
    return out


def _grow_block(columns: list[str], seed: int, sample: int):
    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tree", "draw"])
        pdf = pdf[pdf.groupby("tree").cumcount() < sample]
        numbers, codes = np.unique(pdf["tree"].to_numpy(), return_inverse=True)
        points = pdf[columns].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, int(key[1])])
        sizes = np.bincount(codes)
        trees = grow_trees(points, codes, len(numbers), rng)
        return pd.DataFrame(
            [(key[0], int(n), int(s), *t) for n, s, t in zip(numbers, sizes, trees)],
            columns=["group_id", "tree", "sample_size", "feature", "threshold", "left", "right", "path"],
        )

    return grow


def _grow_calendar(columns: list[str], seed: int, sample: int, n_trees: int):
    """A block of trees from one company's calendar: the samples are drawn inside the group."""

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        points = pdf.sort_values("row_hash")[columns].to_numpy(dtype=float)
        numbers = np.arange(key[1] * TREES_PER_BLOCK, min(n_trees, (key[1] + 1) * TREES_PER_BLOCK))
        rng = np.random.default_rng([seed, int(key[1]), int(pdf["group_hash"].iloc[0]) & (2**63 - 1)])
        size = min(sample, len(points))
        drawn = np.concatenate([rng.permutation(len(points))[:size] for _ in numbers])
        trees = grow_trees(points[drawn], np.repeat(np.arange(len(numbers)), size), len(numbers), rng)
        return pd.DataFrame(
            [(key[0], int(n), size, *t) for n, t in zip(numbers, trees)],
            columns=["group_id", "tree", "sample_size", "feature", "threshold", "left", "right", "path"],
        )

    return grow


def train_isolation_forest(features: DataFrame, id_columns: list[str], contamination: float = 0.03,
                           n_trees: int = 500, sample: int = 256, seed: int = 42,
                           columns: list[str] = DETECTOR_FEATURES, group: str | None = None) -> DataFrame:
    """Forest table, one row per (group, tree); `group=None` grows one global forest.

    With a group (one company's calendar, one row a day) each block of trees gets the calendar and
    draws from it. For the global forest every row draws, by its hash, the gap to the first tree that takes it; only rows that
    some tree takes draw a number for each later tree as well. The rate aims above the sample size, and each tree keeps exactly its lowest draws, so a tree sees
    `sample` rows or the whole group if that is smaller."""
    if not 0 < contamination < 0.5:
        raise ValueError("contamination must be between 0 and 0.5")
    group_id = F.col(group).cast("string") if group else F.lit("all")
    data = features.select(
        group_id.alias("group_id"),
        F.xxhash64(F.lit(seed), *[F.col(c) for c in id_columns]).alias("row_hash"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns],
    )
    if group is not None:
        blocks = F.sequence(F.lit(0), F.lit((n_trees - 1) // TREES_PER_BLOCK))
        placed = data.withColumn("group_hash", F.xxhash64("group_id")).withColumn("block", F.explode(blocks))
        return spread(placed, "group_id", "block").groupBy("group_id", "block").applyInPandas(
            _grow_calendar(columns, seed, sample, n_trees), FOREST_SCHEMA
        )
    sizes = data.groupBy("group_id").agg(F.count(F.lit(1)).alias("n_rows"))
    rated = data.join(F.broadcast(sizes), "group_id").withColumn(
        "rate", F.least(F.lit(1.0), F.lit(sample * OVERSAMPLE + 64.0) / F.col("n_rows"))
    )
    uniform = lambda h: (F.pmod(h, F.lit(1 << 53)) + 1) / float(1 << 53)
    # the first tree that takes a row comes after a geometric gap: one draw settles most rows of a large table
    gap = F.floor(F.log(uniform(F.xxhash64("row_hash", F.lit("first")))) / F.log1p(-F.col("rate")))
    rated = rated.withColumn("first", F.when(F.col("rate") >= 1, F.lit(0)).otherwise(F.least(gap, F.lit(n_trees))).cast("int"))
    rated = rated.where(F.col("first") < n_trees)
    drawn = lambda t: uniform(F.xxhash64(F.col("row_hash"), t))
    later = F.when(F.col("first") < n_trees - 1, F.filter(
        F.transform(F.sequence(F.col("first") + 1, F.lit(n_trees - 1)), lambda t: F.struct(t.alias("tree"), drawn(t).alias("draw"))),
        lambda s: s["draw"] <= F.col("rate")))
    own = F.struct(F.col("first").alias("tree"), (drawn(F.col("first")) * F.col("rate")).alias("draw"))
    trees = F.concat(F.array(own), F.coalesce(later, F.array().cast("array<struct<tree:int,draw:double>>")))
    placed = rated.select("group_id", *columns, F.explode(trees).alias("s")).select(
        "group_id", F.col("s.tree").alias("tree"), F.col("s.draw").alias("draw"), *columns,
        F.floor(F.col("s.tree") / TREES_PER_BLOCK).alias("block"),
    )
    return spread(placed, "group_id", "block").groupBy("group_id", "block").applyInPandas(
        _grow_block(columns, seed, sample), FOREST_SCHEMA
    )


def mean_paths(points: np.ndarray, trees: list[tuple]) -> np.ndarray:
    """Average path length of every point over the trees, all points walking at once."""
    total = np.zeros(len(points))
    rows = np.arange(len(points))
    for feature, threshold, left, right, path in trees:
        node = np.zeros(len(points), dtype=np.int64)
        while True:
            axis = feature[node]
            active = axis >= 0
            if not active.any():
                break
            smaller = points[rows, np.maximum(axis, 0)] <= threshold[node]
            node = np.where(active, np.where(smaller, left[node], right[node]), node)
        total += path[node]
    return total / max(len(trees), 1)


def _unpack(forest: pd.DataFrame) -> tuple[list[tuple], float]:
    trees = [
        (np.asarray(r.feature), np.asarray(r.threshold, dtype=float), np.asarray(r.left),
         np.asarray(r.right), np.asarray(r.path, dtype=float))
        for r in forest.itertuples()
    ]
    size = int(forest["sample_size"].max()) if len(forest) else 2
    return trees, float(max(expected_depth(np.array([size]))[0], 1e-9))


def _score(points: np.ndarray, trees: list[tuple], scale: float) -> np.ndarray:
    return -np.exp2(-mean_paths(points, trees) / scale)


def score_global(features: DataFrame, forest: DataFrame, columns: list[str] = DETECTOR_FEATURES) -> DataFrame:
    """Add `raw_score` with one forest for all rows. The forest is bounded by its settings
    (trees x 2 x sample nodes), so it travels as a broadcast variable."""
    packed = features.sparkSession.sparkContext.broadcast(_unpack(forest.toPandas()))

    @F.pandas_udf("double")
    def raw(*series: pd.Series) -> pd.Series:
        trees, scale = packed.value
        points = np.column_stack([s.fillna(0.0).to_numpy(dtype=float) for s in series])
        return pd.Series(_score(points, trees, scale))

    return features.withColumn("raw_score", raw(*[F.col(c).cast("double") for c in columns]))


def score_per_group(features: DataFrame, forest: DataFrame, group: str = "company_id",
                    columns: list[str] = DETECTOR_FEATURES) -> DataFrame:
    """Add `raw_score` with each group's own forest. A group is one company's calendar."""

    def score(key: tuple, rows: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return rows.assign(raw_score=pd.Series(dtype=float))
        points = rows[columns].fillna(0.0).to_numpy(dtype=float)
        unpacked, scale = _unpack(trees)
        return rows.assign(raw_score=_score(points, unpacked, scale))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in features.schema.fields)
    schema = fields + ", raw_score double"
    trees = spread(forest.withColumnRenamed("group_id", group), group)
    return spread(features, group).groupBy(group).cogroup(trees.groupBy(group)).applyInPandas(score, schema)


def contamination_threshold(scored: DataFrame, contamination: float = 0.03, group: str | None = None,
                            raw: str = "raw_score") -> DataFrame:
    """Add `anomaly_score` (raw minus the contamination quantile) and `is_anomaly`."""
    by = [group] if group else []
    cut = exact_quantiles(scored, by, raw, [contamination]).select(*by, F.col("q0").alias("__offset"))
    joined = scored.join(cut, by, "left") if by else scored.crossJoin(F.broadcast(cut))
    return (
        joined.withColumn("anomaly_score", F.col(raw) - F.col("__offset"))
        .withColumn("is_anomaly", F.coalesce(F.col("anomaly_score") < 0, F.lit(False)))
        .drop("__offset")
    )


def without_detector(features: DataFrame) -> DataFrame:
    """What scoring gives when no forest is there."""
    return features.withColumn("is_anomaly", F.lit(False)).withColumn(
        "anomaly_score", F.lit(None).cast("double")
    )


def evaluate_anomalies(flagged: DataFrame, truth: str, predicted: str = "is_anomaly") -> DataFrame:
    """Precision, recall and F1 of the flags, 0 where undefined, with both counts."""
    t, p = F.col(truth), F.col(predicted)
    counts = flagged.agg(
        F.count_if(t & p).alias("tp"), F.count_if(p).alias("detected"), F.count_if(t).alias("injected")
    )
    tp, detected, injected = F.col("tp"), F.col("detected"), F.col("injected")
    return counts.select(
        F.coalesce(F.try_divide(tp, detected), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, injected), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2.0 * tp, detected + injected), F.lit(0.0)).alias("f1"),
        "detected", "injected",
    )
