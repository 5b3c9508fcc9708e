"""Exact top-k inner products by pivot-table elimination.

Vectors become whole numbers, floor(scale * x). Distances of every vector to a fixed number of
pivots are tabled once, and rows are kept in blocks by their nearest pivot. For a query q and a candidate x each
pivot p gives a lower bound |d(q, p) - d(x, p)| of their distance, and the largest of these an upper bound of
their score, as score = (|q|^2 + |x|^2 - d(q, x)^2) / 2.

First every query searches its own block; the k-th best score found is a score it has to beat. Then it is sent to
those other blocks that may hold one: the least and greatest distances of a block to each pivot bound all its
scores. Candidates never move again. In a block short vectors are scored as a matrix product with many queries
at a time. Long ones are evaluated in the order of their bounds, until the next bound is below the k-th best score:
then no other can be among the k, ties included."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.layout import spread
from riskloom.shipping import ship
from riskloom.sources.scratch import written

#: Rows of a block; pivots; candidates evaluated at a time; blocks of a length whose bounds one task compares at a time.
ROWS, PIVOTS, STEP, BOUNDS = 8192, 24, 64, 4096
#: Up to so many dimensions a block's scores cost less than its bounds; scores that are held at a time.
SHORT, CELLS = 512, 1 << 20
#: Components up to this size keep all sums exact in a double for 2^12 dimensions.
EXACT = float(1 << 20)
#: Scores beyond a long are given as its ends.
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, dims, v): vectors of whole numbers; those null or with null or non-finite parts go."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    good = F.col(vector_col).isNotNull() & ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    taken = rows.select(F.col(id_col).alias("vec_id"), x.alias("x"), F.col(vector_col)).filter(good & F.col("vec_id").isNotNull())
    return taken.select("vec_id", F.size("x").alias("dims"), F.transform("x", lambda c: F.when(
        F.abs(c * scale) < 2.0**53, F.floor(c * scale).cast("double")).otherwise(c * scale)).alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), dims)


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squared = (rows**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(squared, 0))


def _score(a: list[int], b: list[int]) -> int:
    """Exact, or the end of the longs that it is beyond."""
    return min(max(sum(x * y for x, y in zip(a, b)), LEAST), MOST)


class Block:
    """Candidates with their pivot table. Those beyond EXACT (`huge`) have no bounds and are scored in whole
    numbers of any size."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, table: np.ndarray):
        huge = np.abs(v).max(axis=1, initial=0) > EXACT
        self.ids, self.v, self.table = ids[~huge], v[~huge], table[~huge]
        self.norms = (self.v**2).sum(1)
        self.huge = [(i, [int(c) for c in row]) for i, row in zip(ids[huge].tolist(), v[huge])]

    def search(self, own: int, q: np.ndarray, to_pivots: np.ndarray, k: int, beat: float) -> list[tuple[int, int]]:
        """[(-score, id)] of the k best that score `beat` or more, the query's own id left out."""
        whole = [int(c) for c in q] if self.huge or np.abs(q).max(initial=0) > EXACT else None
        best = [(-_score(whole, row), i) for i, row in self.huge if i != own]
        if whole is not None and np.abs(q).max(initial=0) > EXACT:
            best += [(-_score(whole, [int(c) for c in row]), i) for i, row in zip(self.ids.tolist(), self.v) if i != own]
            return sorted(best)[:k]
        best = sorted(best)[:k]
        nearest = np.abs(self.table - to_pivots).max(1, initial=0)
        bound = (float((q**2).sum()) + self.norms - nearest**2) / 2
        bound += 1e-9 * (1 + np.abs(bound) + self.norms)  # distances are rounded
        able = np.flatnonzero(bound >= beat)
        order = able[np.argsort(-bound[able], kind="stable")]
        at, step = 0, STEP
        while at < len(order) and not (len(best) == k and bound[order[at]] < -best[-1][0]):
            part = order[at : at + step]
            scores = self.v[part] @ q
            best = sorted(best + [(-int(s), j) for s, j in zip(scores.tolist(), self.ids[part].tolist()) if j != own])[:k]
            at, step = at + step, step * 2
        return best

    def search_all(self, own: np.ndarray, q: np.ndarray, k: int, beat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's place, ids, scores) of the k best of each query among those that score `beat` or more, its own id left
        out. Neither queries nor candidates are huge, so all sums are exact."""
        found = [(np.empty(0, np.int64),) * 3]
        order = np.argsort(self.ids)
        step = max(1, CELLS // max(1, len(self.ids)))
        for at in range(0, len(q) if len(self.ids) else 0, step):
            scores = q[at : at + step] @ self.v.T
            place = order[np.minimum(np.searchsorted(self.ids, own[at : at + step], sorter=order), len(order) - 1)]
            here = np.flatnonzero(self.ids[place] == own[at : at + step])
            scores[here, place[here]] = -np.inf
            least = beat[at : at + step].copy()
            hits = (scores >= least[:, None]) & (scores > -np.inf)
            many = np.flatnonzero(hits.sum(1) > k)
            if len(many):
                least[many] = np.partition(scores[many], -k, axis=1)[:, -k]
                hits[many] &= scores[many] >= least[many, None]
            row, column = np.nonzero(hits)
            score, name = scores[row, column], self.ids[column]
            best = np.lexsort((name, -score, row))
            row, score, name = row[best], score[best], name[best]
            top = np.arange(len(row)) - np.searchsorted(row, row) < k
            found.append((row[top] + at, name[top], score[top].astype(np.int64)))
        return tuple(np.concatenate(parts) for parts in zip(*found))


_FOUND = "query_id bigint, vec_id bigint, score bigint"


def _found(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


def top_k(rows: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores among all other ids, ties to
    the smaller id, fewer if there are fewer.

    Ids are whole numbers; rows with a null id take no part, of a repeated id the vector that
    sorts first does. Vectors of different lengths are not compared. Scores of large components are exact; those beyond a
    long count as its ends, so that they tie. `is_query` is an expression over `vec_id`. No rows give no rows."""
    spark = ship(rows.sparkSession)
    vectors = whole_vectors(rows, id_col, vector_col, scale).groupBy("vec_id").agg(F.min(F.struct("dims", "v")).alias("s"))
    vectors = written(vectors.select("vec_id", "s.*"), "topk-vectors")
    # PIVOTS rows of each length, whatever the size of the table
    usual = F.forall("v", lambda c: F.abs(c) <= EXACT)
    mixed = Window.partitionBy("dims").orderBy(F.xxhash64("vec_id"), "vec_id")
    chosen = vectors.filter(usual).withColumn("r", F.row_number().over(mixed)).filter(F.col("r") <= PIVOTS).collect()
    pivots: dict[int, np.ndarray] = {}
    for dims in {r["dims"] for r in chosen}:
        own = [r["v"] for r in chosen if r["dims"] == dims]
        pivots[dims] = np.array(own, float).reshape(len(own), dims)

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            for dims in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == dims)))
                v = _matrix(part.column(2), dims)
                own = pivots.get(dims, np.zeros((0, dims)))
                huge = np.abs(v).max(axis=1, initial=0) > EXACT
                far = _distances(np.where(huge[:, None], 0.0, v), own)
                cell = far.argmin(1) if len(own) else np.zeros(len(v), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell, pa.int64()), pa.array(huge), pa.array((v**2).sum(1)), pa.array(list(far), pa.list_(pa.float64()))],
                    names=["vec_id", "dims", "v", "cell", "huge", "norm", "far"])

    tabled = vectors.mapInArrow(table, "vec_id bigint, dims int, v array<double>, cell bigint, huge boolean, norm double, far array<double>")
    tabled = written(tabled.withColumn("query", F.coalesce(is_query, F.lit(False))), "topk-pivots")
    cells = tabled.groupBy("dims", "cell").agg(F.ceil(F.count(F.lit(1)) / ROWS).alias("parts"))  # PIVOTS rows a length
    placed = tabled.join(F.broadcast(cells), ["dims", "cell"])
    placed = placed.withColumn("block", F.col("cell") * F.lit(1 << 32) + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).drop("cell", "parts")
    deals = ["dims", "block"]
    placed = written(placed.repartition(*deals).sortWithinPartitions(*deals), "topk-blocks")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Candidates of a block come before its queries; a block is held, queries pass by."""
        at, held, block = None, [], None

        def asked(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            v, far = _matrix(batch.column("v"), at[0]), _matrix(batch.column("far"), len(pivots.get(at[0], ())))
            ids = batch.column("vec_id").to_numpy()
            beat = batch.column("beat").fill_null(-np.inf).to_numpy(zero_copy_only=False)
            usual = np.abs(v).max(axis=1, initial=0) <= EXACT if at[0] <= SHORT and not block.huge else np.zeros(len(v), bool)
            place, names, scores = block.search_all(ids[usual], v[usual], k, beat[usual])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[usual][place], names, scores)], names=["query_id", "vec_id", "score"])
            out = []
            for n in np.flatnonzero(~usual).tolist():
                found = block.search(int(ids[n]), v[n], far[n], k, float(beat[n]))
                out += [(int(ids[n]), j, -s) for s, j in found]
            yield _found(out)

        for batch in batches:
            dims, blocks = batch.column("dims").to_numpy(), batch.column("block").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            new = np.flatnonzero(np.concatenate([[True], (dims[1:] != dims[:-1]) | (blocks[1:] != blocks[:-1]) | (asks[1:] != asks[:-1])])).tolist()
            for start, end in zip(new, [*new[1:], batch.num_rows]):
                part, here = batch.slice(start, end - start), (int(dims[start]), int(blocks[start]))
                if here != at:
                    at, held, block = here, [], None
                if not asks[start]:
                    held.append(part)
                    continue
                if block is None:
                    every = pa.Table.from_batches(held).combine_chunks().to_batches() if held else []
                    block = Block(every[0].column("vec_id").to_numpy(), _matrix(every[0].column("v"), at[0]),
                                  _matrix(every[0].column("far"), len(pivots.get(at[0], ())))) if every else Block(
                                      np.empty(0, np.int64), np.zeros((0, at[0])), np.zeros((0, len(pivots.get(at[0], ())))))
                yield from asked(part)

    slim = placed.select(*deals, F.lit(False).alias("asks"), "vec_id", "v", "far", F.lit(None).cast("double").alias("beat"))
    asking = placed.filter("query").select(*deals, F.lit(True).alias("asks"), "vec_id", "v", "far", F.lit(None).cast("double").alias("beat"))

    def search(queries: DataFrame) -> DataFrame:
        work = spread(slim.unionByName(queries), *deals).sortWithinPartitions(*deals, "asks")
        return written(work.mapInArrow(searched, _FOUND), "topk-found")

    own = search(asking)
    kth = own.groupBy("query_id").agg(F.array_sort(F.collect_list(F.col("score"))).alias("s"))  # at most k a query
    kth = kth.select("query_id", F.when(F.size("s") >= k, F.get("s", F.size("s") - k).cast("double")).alias("beat"))
    # what bounds the scores of a block: one row each, a thousandth of the table and less
    bounds = placed.filter("not huge").groupBy(*deals).agg(F.max("norm").alias("norm"), *(
        f(F.get("far", F.lit(i))).alias(f"{f.__name__}{i}") for i in range(PIVOTS) for f in (F.min, F.max)))
    every = placed.groupBy(*deals).agg(F.max("huge").alias("huge"))
    bounds = every.join(bounds, deals, "left").select(
        *deals, "huge", "norm", F.array(*(F.col(f"min{i}") for i in range(PIVOTS))).alias("low"), F.array(*(F.col(f"max{i}") for i in range(PIVOTS))).alias("high"))
    bounds = written(bounds.withColumn("page", F.floor(F.pmod(F.xxhash64("block"), F.lit(1 << 20)) * F.ceil(
        F.count(F.lit(1)).over(Window.partitionBy("dims")) / BOUNDS) / (1 << 20))), "topk-bounds")
    pages = bounds.groupBy("dims", "page").agg(F.collect_list(F.struct("block", "huge", "norm", "low", "high")).alias("blocks"))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The blocks that may hold a score to beat, for each query and page of bounds."""
        seen, page, known = None, None, None
        for batch in batches:
            for i, row in enumerate(batch.select(["dims", "block", "page", "beat", "norm", "huge"]).to_pylist()):
                if (row["dims"], row["page"]) != seen:
                    seen, page = (row["dims"], row["page"]), batch.column("blocks")[i].as_py()
                    low, high = (np.array([[np.nan if x is None else x for x in b[c]] for b in page], float) for c in ("low", "high"))
                    norm = np.array([np.nan if b["norm"] is None else b["norm"] for b in page])
                    known = np.array([b["block"] for b in page]), np.array([b["huge"] for b in page]), norm, low, high
                names, huge, norm, low, high = known
                far = np.array(batch.column("far")[i].as_py(), float)
                n = len(far)
                gap = np.maximum(np.maximum(far - high[:, :n], low[:, :n] - far), 0).max(axis=1, initial=0)
                bound = (row["norm"] + norm - gap**2) / 2
                bound += 1e-9 * (1 + np.abs(bound) + norm)
                with np.errstate(invalid="ignore"):
                    able = huge | row["huge"] | (row["beat"] is None) | (bound >= (row["beat"] if row["beat"] is not None else 0.0))
                able &= names != row["block"]
                goes = names[able]
                part = batch.slice(i, 1).select(["dims", "vec_id", "v", "far", "beat"])
                if len(goes):
                    part = part.take(pa.array(np.zeros(len(goes), np.int64)))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(goes)], names=["dims", "vec_id", "v", "far", "beat", "block"])

    asks = placed.filter("query").join(kth, F.col("vec_id") == F.col("query_id"), "left").drop("query", "query_id")
    asks = asks.join(pages, "dims").sortWithinPartitions("dims", "page")
    sent = asks.mapInArrow(routed, "dims int, vec_id bigint, v array<double>, far array<double>, beat double, block bigint")
    other = search(sent.select(*deals, F.lit(True).alias("asks"), "vec_id", "v", "far", "beat"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return own.union(other).withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


TOPK_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
