"""A Merkle manifest of a table as postorder append logs.

Leaves are numbered in order within each tree. An aligned builder takes RUN ** HEIGHT consecutive
leaves and appends every node of their subtree to its log when it is complete: leaves as they come, a
parent right after its last child. The builders' last nodes are the leaves of the next tier, until a tree
has one. The trees' roots, in order, are the leaves of one more tree.

A log needs no pointers: the place of a node follows from its level and number (`postorder`), as
the subtrees completed before it have known sizes. Proofs read a leaf's siblings from the logs by these
places, from the top tier down, each log once for all of its leaves. Builders and proofs work on
blocks of bounded size, so no task holds more than a few blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.llm.whole_groups import group_starts, whole_groups
from riskloom.shipping import ship
from riskloom.sources.scratch import written

#: Children of a node; levels of a builder.
RUN, HEIGHT = 8, 3
BLOCK = RUN**HEIGHT
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(columns: list[Column]) -> Column:
    """The digest of a row: each value as its UTF-8 byte count, `:` and itself, `-` where null."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def height_of(n: int) -> int:
    """Levels above n leaves."""
    height = 0
    while n > 1:
        n, height = -(-n // RUN), height + 1
    return height


def postorder(level: int, number: np.ndarray, leaves: int, height: int) -> np.ndarray:
    """Where the log of a subtree with so many leaves holds the nodes of a level.

    Up to a node's last leaf `end`, all nodes of its own and lower levels are complete, and of higher levels
    those that ended before."""
    end = np.minimum((number + 1) * RUN**level, leaves)
    done = sum(-(-end // RUN**k) for k in range(level + 1))
    return done + sum((end - 1) // RUN**k for k in range(level + 1, height + 1)) - 1


def append_log(leaves: list[str], height: int) -> list[str]:
    """All nodes of a subtree in the order in which they are complete."""
    log: list[str] = []
    open_nodes: list[list[str]] = [[] for _ in range(height + 1)]
    for count, node in enumerate(leaves, 1):
        log.append(node)
        open_nodes[0].append(node)
        level = 0
        while level < height and (len(open_nodes[level]) == RUN or count == len(leaves)):
            node = sha("".join(open_nodes[level]))
            open_nodes[level] = []
            level += 1
            log.append(node)
            open_nodes[level].append(node)
    return log


def siblings(log: str, leaves: int, height: int) -> list[tuple[list[str], list[str]]]:
    """For each level below the top the (left, right) siblings of its nodes, as joined digests; `log` in hex."""
    out = []
    for level in range(height):
        number = np.arange(-(-leaves // RUN**level))
        nodes = [log[64 * at : 64 * at + 64] for at in postorder(level, number, leaves, height).tolist()]
        left = ["".join(nodes[i - i % RUN : i]) for i in range(len(nodes))]
        right = ["".join(nodes[i + 1 : i - i % RUN + RUN]) for i in range(len(nodes))]
        out.append((left, right))
    return out


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add `position` (from 0) and `total` within each group, null being a group, in the order of the columns, nulls first.

    Rows are dealt out by ranges, so neither a large group nor a repeated key lands in one task: equal
    rows are told apart by where they came from. The runs of a group in the ranges are added up on a table of one
    row for each range and group."""
    keys = [group, *order, "came"]
    ordered = rows.withColumn("came", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    kept = written(ordered.drop("came").select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq")), "merkle-order")
    runs = kept.groupBy("part", F.col(group).alias("of")).agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    every, earlier = Window.partitionBy("of"), Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("part").alias("in_part"), "of", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                       F.sum("n").over(every).alias("total"))
    found = kept.join(runs, (F.col("part") == F.col("in_part")) & F.col(group).eqNullSafe(F.col("of")))
    return found.withColumn("position", F.col("before") + F.col("seq") - F.col("first")).drop("part", "seq", "in_part", "of", "first", "before")


_LOG = "tree bigint, block bigint, total bigint, leaves int, height int, log binary, top binary, payload array<struct<{payload}>>"


def _build(nodes: DataFrame, payload: str) -> DataFrame:
    """One log for each block of (tree, position, total, digest); `payload` (a struct column) goes along in order."""
    kind = nodes.schema["payload"].dataType.simpleString()[len("struct<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["tree", "block"], rows=4 * BLOCK):
            starts = group_starts(table, ["tree", "block"]).tolist() + [table.num_rows]
            digests, totals = table.column("digest").to_pylist(), table.column("total").to_pylist()
            out: dict[str, list] = {k: [] for k in ("leaves", "height", "log", "top")}
            for a, b in zip(starts, starts[1:]):
                height = min(HEIGHT, height_of(totals[a]))
                log = append_log([d.hex() for d in digests[a:b]], height)
                for key, value in zip(out, (b - a, height, bytes.fromhex("".join(log)), bytes.fromhex(log[-1]))):
                    out[key].append(value)
            first = table.select(["tree", "block", "total"]).take(starts[:-1]).combine_chunks()
            held = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.concat_arrays(table.column("payload").chunks))
            yield pa.RecordBatch.from_arrays(
                [*(c.chunk(0) for c in first.columns), pa.array(out["leaves"], pa.int32()), pa.array(out["height"], pa.int32()),
                 pa.array(out["log"], pa.binary()), pa.array(out["top"], pa.binary()), held],
                names=["tree", "block", "total", "leaves", "height", "log", "top", "payload"])

    cut = nodes.select("tree", F.expr(f"position div {BLOCK}").alias("block"), "position", "total", "digest", "payload")
    dealt = cut.repartition("tree", "block").sortWithinPartitions("tree", "block", "position").drop("position")
    return written(dealt.mapInArrow(run, _LOG.format(payload=kind)), f"merkle-log-{payload}")


def build(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(logs of each tier, roots as (tree, root)) of the trees over (tree, position, total, digest, payload)."""
    tiers = [_build(nodes, "0")]
    while (most := tiers[-1].agg(F.max("total")).first()[0]) is not None and most > BLOCK:
        below = tiers[-1].filter(F.col("total") > BLOCK)
        upper = below.select("tree", F.col("block").alias("position"), F.expr(f"(total + {BLOCK - 1}) div {BLOCK}").alias("total"),
                             F.col("top").alias("digest"), F.struct(F.lit(0).alias("none")).alias("payload"))
        tiers.append(_build(upper, str(len(tiers))))
    roots = [tier.filter(F.col("total") <= BLOCK).select("tree", F.col("top").alias("root")) for tier in tiers]
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return tiers, found


_PATH = "tree bigint, position bigint, lefts array<string>, rights array<string>"


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[list[str]], list[list[str]]]]:
    """(log row, left siblings, right siblings) of each log, for each of its leaves from its own level to the root."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            levels = siblings(row["log"].hex(), row["leaves"], row["height"])
            above = row["up_lefts"], row["up_rights"]
            paths = [[[level[side][j // RUN**k] for k, level in enumerate(levels)] + above[side] for j in range(row["leaves"])] for side in (0, 1)]
            yield row, paths[0], paths[1]


def _placed(tier: DataFrame, known: DataFrame) -> DataFrame:
    """The logs of a tier with the path from their top to the root: that of their tree if it ends here, else of a node above."""
    up = known.select(F.col("tree").alias("up_tree"), F.col("position").alias("up_block"), "ends", F.col("lefts").alias("up_lefts"), F.col("rights").alias("up_rights"))
    same = (F.col("tree") == F.col("up_tree")) & (F.col("block") == F.col("up_block")) & ((F.col("total") <= BLOCK) == F.col("ends"))
    return tier.join(up, same).drop("up_tree", "up_block", "ends")


def paths(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest tier's logs, each with the path from its top to the root; `above` has the path of each tree's own root
    at position 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, lefts, rights in _entries(batches):
            first = row["block"] * BLOCK
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["tree"]] * len(lefts), pa.int64()), pa.array(range(first, first + len(lefts)), pa.int64()),
                 pa.array(lefts, pa.list_(pa.string())), pa.array(rights, pa.list_(pa.string()))], names=["tree", "position", "lefts", "rights"])

    roots = above.withColumn("ends", F.lit(True))
    known = roots
    for tier in reversed(tiers[1:]):
        known = roots.unionByName(_placed(tier, known).drop("payload").mapInArrow(run, _PATH).withColumn("ends", F.lit(False)))
    return _placed(tiers[0], known)


@dataclass
class Manifest:
    """Logs of the documents' trees, one for each language, and of the tree of their roots; `root` is None for an empty table."""

    tiers: list[DataFrame]
    languages: list[DataFrame]
    subroots: DataFrame
    root: str | None


def manifest(docs: DataFrame, columns: list[str] = ("doc_id", "source", "lang", "n_chars", "text"), tree: str = "lang",
             key: str = "doc_id", text: str = "text") -> Manifest:
    """Build the logs. Within a tree leaves ascend by key, nulls first; equal keys by leaf, so that repeated rows may
    stand in any order. Other columns take no part. The second digest of a row is that of its tampered copy: the text's
    A-Z in lower case where 3 divides the CRC-32 of the key as text (a null key counts as empty)."""
    ship(docs.sparkSession)
    plain = {c: F.col(c) for c in columns}
    hit = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 3 == 0
    changed = leaf_digest(list((plain | {text: F.translate(F.col(text), UPPER, LOWER)}).values()))
    leaves = docs.select(F.col(tree).alias("tree_key"), F.col(key).alias("key"), leaf_digest(list(plain.values())).alias("digest"),
                         F.when(hit, changed).alias("changed"))
    leaves = written(leaves, "merkle-leaves").withColumn("changed", F.coalesce("changed", "digest"))
    placed = numbered(leaves, "tree_key", ["key", "digest"])
    names = written(placed.filter(F.col("position") == 0).select("tree_key", F.lit(0).alias("all")), "merkle-trees")
    names = numbered(names, "all", ["tree_key"]).select(F.col("tree_key").alias("name"), F.col("position").alias("tree"), F.col("total").alias("trees"))
    names = written(names, "merkle-names")
    nodes = placed.join(names, F.col("tree_key").eqNullSafe(F.col("name"))).select(
        "tree", "position", "total", "digest", F.struct("key", "changed").alias("payload"))
    tiers, subroots = build(nodes)
    tops = subroots.join(names, "tree").select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("position"),
                                               F.col("trees").alias("total"), F.col("root").alias("digest"), F.struct(F.lit(0).alias("none")).alias("payload"))
    languages, roots = build(tops)
    root = roots.first()
    return Manifest(tiers, languages, subroots, bytes(root["root"]).hex() if root else None)


def proofs(found: Manifest) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row: the digest of its siblings, and
    the root that its tampered copy gives with them."""
    spark, root = found.subroots.sparkSession, found.root
    none = spark.createDataFrame([(0, 0, [], [])], _PATH)

    languages = paths(found.languages, none).drop("payload")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, lefts, rights in _entries(batches):
            first = row["block"] * BLOCK
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(first, first + len(lefts)), pa.int64()), pa.array([0] * len(lefts), pa.int64()),
                 pa.array(lefts, pa.list_(pa.string())), pa.array(rights, pa.list_(pa.string()))], names=["tree", "position", "lefts", "rights"])

    above = written(languages.mapInArrow(spread, _PATH), "merkle-language-paths")
    placed = paths(found.tiers, above).join(found.subroots.select("tree", F.hex("root").alias("subroot")), "tree")
    own = found.tiers[0].schema["payload"].dataType.elementType["key"].dataType
    kind, key = own.simpleString(), to_arrow_type(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, lefts, rights in _entries(batches):
            log, proof, folded = row["log"].hex(), [], []
            at = postorder(0, np.arange(row["leaves"]), row["leaves"], row["height"]).tolist()
            for entry, left, right in zip(row["payload"], lefts, rights):
                node = entry["changed"].hex()
                for a, b in zip(left, right):
                    node = sha(a + node + b)
                folded.append(node)
                proof.append(sha("".join(a + b for a, b in zip(left, right))))
            n = len(proof)
            yield pa.RecordBatch.from_pydict({
                "key": [e["key"] for e in row["payload"]], "leaf": [log[64 * i : 64 * i + 64] for i in at], "subroot": [row["subroot"].lower()] * n,
                "root": [root] * n, "proof_sha256": proof, "folded_root": folded, "verified": [x == root for x in folded]},
                pa.schema([("key", key), *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_())]))

    return placed.mapInArrow(run, f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
