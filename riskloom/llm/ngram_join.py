"""Word n-gram Jaccard join by blocked sparse products of the document by n-gram incidence.

`100 * |A and B| >= percent * |A or B|` links two documents. The result holds the groups that
links form, exactly: no link is estimated, and none between different sets is left out.

1. Documents with the same set are one class, named by a hash of the set.
2. Blocks by size-derived bounds. Linked sets have sizes within the ratio `percent / 100`, so sizes
   fall into bands and only equal and neighbouring bands can link. In a band two linked sets differ
   in at most `d` n-grams, so of more than `d` segments of the hash range that hold something one is
   equal in both: each class gives a key for each segment's content. Segments are cut after leaving
   out frequent n-grams, which keeps the bound (a difference can only shrink) and stops a common
   passage from tying documents together. A class of which too few segments are left gives the keys
   of its full set as well, and where even those are too few, the empty ones.
3. Classes that share a key are tied; tied classes form clusters (connected components).
4. A cluster is a matrix, in blocks of rows; tiles of bands that cannot link are never made. In a
   tile the incidence product is taken row by row: overlap counts add up over the columns of a row,
   and pairs below the size-derived bound go. Rows that are already in the row's group are skipped,
   so a tile returns a spanning forest and not all pairs. Sets are shuffled once, to their block;
   blocks of a cluster above TILE rows are files that tiles read, and a tile whose rows are joined
   already is not made.
5. Links form the groups; classes pass them to their documents.

Within a map task keys that meet there already send one row on, so a key that a third of all rows
share costs one row per batch and not one per document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.graph import components
from riskloom.llm.shared import let_go, read_mapped, write_mapped
from riskloom.llm.whole_groups import group_starts, whole_groups
from riskloom.llm.words import WordHashes, mixed, parts, shingles, signed, text_bytes, word_hashes
from riskloom.operators.layout import spread
from riskloom.shipping import ship
from riskloom.sources.scratch import release, scratch_path, written

#: Classes of a cluster that is one block; columns times rows that are gathered at once; n-grams of a block.
TILE, GATHER, BLOCK_GRAMS = 1024, 2_000_000, 1 << 20
#: Frequent n-grams: in so many documents of a batch at least, and no more than so many.
FREQUENT_IN_BATCH, FREQUENT_MOST = 8, 65_536


def gram_set(text: bytes, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the n-grams; fewer words than `width` are one n-gram."""
    words = hashes.of(text.lower().split())
    return np.unique(shingles(words, min(width, len(words)) or 1))


def set_name(grams: np.ndarray) -> int:
    """A class's name: the signed 64-bit hash of its sorted n-grams."""
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes())).astype(np.int64))


class Bands:
    """Size bands and the number of segments of each, for one similarity."""

    def __init__(self, percent: int):
        self.percent, self.starts = percent, [1, 2]

    def differences(self, band: int) -> int:
        """The most n-grams in which two linked sets of this band, or of it and the next, differ."""
        self._reach(band + 1)
        most = self.starts[band + 1] - 1
        return (100 - self.percent) * (most + most * 100 // self.percent) // (100 + self.percent)

    def _reach(self, band: int) -> None:
        while len(self.starts) <= band:
            self.starts.append(self.starts[-1] * 100 // self.percent + 1)

    def of(self, size: int) -> int:
        while self.starts[-1] <= size:
            self._reach(len(self.starts))
        return int(np.searchsorted(self.starts, size, "right")) - 1

    def linked(self, overlap, a, b):
        return (100 + self.percent) * overlap >= self.percent * (a + b)


def _segments(grams: np.ndarray, count: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(key of each segment, how many n-grams it holds); n-grams are sorted."""
    edges = (np.arange(1, count, dtype=np.float64) / count * 2.0**64).astype(np.uint64)
    at = np.concatenate([[0], np.searchsorted(grams, edges), [len(grams)]])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(grams))])
    place = mixed(np.arange(count, dtype=np.uint64) + np.uint64(salt << 32))
    return mixed(sums[at[1:]] - sums[at[:-1]] + place), np.diff(at)


def block_keys(grams: np.ndarray, bands: Bands, frequent: np.ndarray) -> np.ndarray:
    """The keys under which a set meets every set it is linked with."""
    if not len(grams):
        return np.empty(0, np.uint64)
    rare = grams
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
        rare = grams[frequent[at] != grams]
    found, own = [], bands.of(len(grams))
    for band in (own, own - 1):
        if band < 0 or not (d := bands.differences(band)):
            continue  # sets that may not differ are of one class
        count = d + 1 + -(-(d + 1) // 16)
        keys, held = _segments(rare, count, 4 * band)
        found.append(keys[held > 0])
        if np.count_nonzero(held) <= d:
            keys, held = _segments(grams, count, 4 * band + 1)
            found.append(keys[held > 0] if np.count_nonzero(held) > d else keys)
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _scan(docs: DataFrame, width: int) -> DataFrame:
    """A row per document (doc_id, text_hash, class, n_grams), and a row per n-gram that is frequent in a batch
    (gram, n), told apart by `gram`."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        hashes = word_hashes()
        for batch in parts(batches):
            names, sizes, distinct = [], [], {}
            for text in text_bytes(batch.column(1)):
                grams = gram_set(text, width, hashes)
                names.append(set_name(grams) if len(grams) else None)
                sizes.append(len(grams))
                distinct[names[-1]] = grams
            grams, counts = np.unique(np.concatenate(list(distinct.values()) or [np.empty(0, np.uint64)]), return_counts=True)
            often = counts >= FREQUENT_IN_BATCH
            grams, counts = grams[often], counts[often]
            n, m = batch.num_rows, len(grams)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([batch.column(0), pa.nulls(m, batch.column(0).type)]),
                pa.concat_arrays([batch.column(2), pa.nulls(m, pa.int64())]),
                pa.array(names + [None] * m, pa.int64()), pa.array(sizes + [0] * m, pa.int64()),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(signed(grams), pa.int64())]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(counts, pa.int64())])],
                names=["doc_id", "text_hash", "class", "n_grams", "gram", "n"])

    return docs.mapInArrow(run, f"doc_id {kind}, text_hash bigint, class bigint, n_grams bigint, gram bigint, n bigint")


def _ties(docs: DataFrame, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """(a, b): classes that share a key, each tied to the least class of the key."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        hashes, bands = word_hashes(), Bands(percent)
        for batch in parts(batches):
            found: dict[int, np.ndarray] = {}
            for text in text_bytes(batch.column(0)):
                grams = gram_set(text, width, hashes)
                if len(grams) and (name := set_name(grams)) not in found:
                    found[name] = block_keys(grams, bands, frequent)
            names = np.repeat(np.array(list(found), np.int64), [len(k) for k in found.values()])
            all_keys = np.concatenate(list(found.values()) or [np.empty(0, np.uint64)])
            order = np.lexsort((names, all_keys))
            all_keys, names = all_keys[order], names[order]
            first = np.ones(len(names), bool)
            first[1:] = all_keys[1:] != all_keys[:-1]
            least = names[np.maximum.accumulate(np.where(first, np.arange(len(names)), 0))]
            pairs = np.unique(np.stack([least[~first], names[~first]], 1), axis=0) if (~first).any() else np.empty((0, 2), np.int64)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            spread = signed(mixed(pairs[:, 0].view(np.uint64) ^ mixed(pairs[:, 1].view(np.uint64))))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([signed(all_keys[first]), spread])),
                pa.array(np.concatenate([names[first], pairs[:, 0]])),
                pa.concat_arrays([pa.nulls(int(first.sum()), pa.int64()), pa.array(pairs[:, 1], pa.int64())])],
                names=["key", "a", "b"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = least = None  # of the group that a batch ended in
        for batch in batches:
            known = np.asarray(batch.column(2).is_valid())
            k, a = batch.column(0).to_numpy()[~known], batch.column(1).to_numpy()[~known]
            tied = pa.RecordBatch.from_arrays([batch.column(1).filter(pa.array(known)), batch.column(2).filter(pa.array(known))], names=["a", "b"])
            if len(k):
                first = np.ones(len(k), bool)
                first[1:] = k[1:] != k[:-1]
                start = a[np.maximum.accumulate(np.where(first, np.arange(len(k)), 0))]
                if key is not None and k[0] == key:
                    start = np.where(np.cumsum(first) == 1, least, start)
                key, least = k[-1], start[-1]
                more = start != a
                new = pa.RecordBatch.from_arrays([pa.array(start[more]), pa.array(a[more])], names=["a", "b"])
                tied = pa.Table.from_batches([tied, new]).combine_chunks()
                yield from tied.to_batches()
            else:
                yield tied

    raw = docs.select("text").mapInArrow(keys, "key bigint, a bigint, b bigint")
    return raw.repartition("key").sortWithinPartitions("key", "a").mapInArrow(meet, "a bigint, b bigint").distinct()


def spanning_links(sets: list[np.ndarray], bands: Bands, labels: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links in a tile, by rows of the incidence product.

    Rows of one label are joined already: only links between labels are looked for, and rows of the label that most
    rows have are found by the others."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    root = np.arange(m) if labels is None else np.unique(labels, return_inverse=True)[1].ravel()
    anchor = int(np.flatnonzero(root == np.bincount(root).argmax())[0]) if m else 0
    if not m or (root == root[anchor]).all():
        return []
    row, grams = np.repeat(np.arange(m), sizes), np.concatenate(sets)
    if labels is None:
        _, column, held = np.unique(grams, return_inverse=True, return_counts=True)
    else:
        wanted = np.unique(grams[(root != root[anchor])[row]])
        column = np.minimum(np.searchsorted(wanted, grams), len(wanted) - 1)
        known = wanted[column] == grams
        column, row = column[known], row[known]
        held = np.bincount(column, minlength=len(wanted))
    shared = held[column] > 1
    column, row = column[shared], row[shared]
    by_column = row[np.argsort(column, kind="stable")]
    ends = np.cumsum(np.bincount(column, minlength=len(held)))
    starts = ends - np.bincount(column, minlength=len(held))
    bounds = np.searchsorted(row, np.arange(m + 1))
    found = []
    for x in range(m):
        if root[x] == root[anchor]:
            continue
        mine = column[bounds[x] : bounds[x + 1]]
        overlap = np.zeros(m, np.int64)
        step = max(1, GATHER // m)
        for at in range(0, len(mine), step):
            part = mine[at : at + step]
            length = ends[part] - starts[part]
            begin = np.repeat(starts[part] - (np.cumsum(length) - length), length)
            overlap += np.bincount(by_column[begin + np.arange(len(begin))], minlength=m)
        hit = np.flatnonzero((root != root[x]) & bands.linked(overlap, sizes, sizes[x]))
        if len(hit):
            joined, first = np.unique(root[hit], return_index=True)
            found += [(x, int(y)) for y in hit[first]]
            root[np.isin(root, joined)] = root[x]
    return found


def _placed(members: DataFrame, percent: int) -> DataFrame:
    """`members` with band, block and `large`, one row each: a cluster of up to TILE classes is one block, a larger one
    has some for each band."""
    bands = Bands(percent)
    bands.of(int(members.agg(F.max("n_grams")).first()[0] or 0))
    starts = F.array(*[F.lit(s) for s in bands.starts])
    placed = members.withColumn("band", F.array_size(F.filter(starts, lambda s: s <= F.col("n_grams"))) - 1)
    most = F.least(F.lit(4 * TILE), F.greatest(F.lit(max(1, TILE // 16)), F.floor(BLOCK_GRAMS / F.get(starts, F.col("band")))))
    whole = Window.partitionBy("cluster")
    sizes = placed.groupBy("cluster", "band").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("large", F.sum("n").over(whole) > TILE).withColumn("blocks", F.ceil(F.col("n") / most))
    sizes = sizes.withColumn("first", F.sum("blocks").over(whole.orderBy("band")) - F.col("blocks")).drop("n")
    block = F.when(F.col("large"), F.col("first") + F.pmod(F.xxhash64("class"), F.col("blocks"))).otherwise(0).cast("bigint")
    return placed.join(sizes, ["cluster", "band"]).select("rep_id", "rep_hash", "class", "cluster", "band", block.alias("block"), "large")


_PAIRS = "a bigint, b bigint"


def _pairs(names: np.ndarray, found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(names[pairs[:, 0]]), pa.array(names[pairs[:, 1]])], names=["a", "b"])


def _links(docs: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): links that join the classes of each cluster as all its links do. members: (class, n_grams, rep_id, rep_hash,
    cluster), the id and text hash of one row of the class; docs: (doc_id, text, text_hash).

    Each set is shuffled once, to its block. Blocks of large clusters are kept as files, which tiles read: first those of the
    first block of each band, then, with what is joined by then as labels, those that hold more than one label."""
    spark = docs.sparkSession
    path = scratch_path(spark, "gram-sets")
    placed = written(_placed(members, percent), "gram-blocks")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last = word_hashes(), None
        for batch in parts(batches):
            names, sets, first = batch.column(1).to_pylist(), [], []
            for name, text in zip(names, text_bytes(batch.column(0))):
                # repeated rows come one after the other: one of them is enough
                sets.append(gram_set(text, width, hashes) if name != last else np.empty(0, np.uint64))
                first.append(name != last and set_name(sets[-1]) == name)
                last = name if first[-1] else last
            right = pa.array(first, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).filter(right) for k in range(1, 5)), pa.array([s.tobytes() for s in sets], pa.binary()).filter(right)],
                names=["class", "cluster", "block", "large", "grams"])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, keys = Bands(percent), ["cluster", "block"]
        for table in whole_groups(batches, keys):
            names, found = table.column("class").to_numpy(), []
            sets = [np.frombuffer(s, np.uint64) for s in table.column("grams").to_pylist()]
            starts = group_starts(table, keys).tolist()
            for start, end in zip(starts, [*starts[1:], table.num_rows]):
                found += [(start + a, start + b) for a, b in spanning_links(sets[start:end], bands)]
                if table.column("large")[start].as_py():
                    cluster, block = (table.column(k)[start].as_py() for k in keys)
                    own = table.slice(start, end - start).select(["class", "grams"]).combine_chunks()
                    write_mapped(f"{path}/sets-{cluster}-{block}", own.to_batches()[0])
            yield _pairs(names, found)

    # a merge join at every size: the plan does not turn on how many members there are
    own = placed.drop("band").hint("merge")
    rows = docs.join(own, F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_hash") == F.col("rep_hash")))
    sets = rows.select("text", "class", "cluster", "block", "large").mapInArrow(
        fetch, "class bigint, cluster bigint, block bigint, large boolean, grams binary")
    within = written(sets.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "class").mapInArrow(multiply, _PAIRS), "gram-links")
    blocks = written(placed.filter("large").select("cluster", "band", "block").distinct(), "gram-block-names")
    if blocks.isEmpty():
        return within
    release(spark)
    left = blocks.withColumn("first", F.min("block").over(Window.partitionBy("cluster", "band")) == F.col("block"))
    left = left.select("cluster", F.col("band").alias("x_band"), F.col("block").alias("x"), "first")
    right = blocks.select("cluster", F.col("band").alias("y_band"), F.col("block").alias("y"))
    beside = ((F.col("y_band") == F.col("x_band")) & (F.col("y") > F.col("x"))) | (F.col("y_band") == F.col("x_band") + 1)
    tiles = left.join(right, "cluster").filter(beside)

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, at, held = Bands(percent), None, None
        for batch in batches:
            for row in batch.to_pylist():
                if at != (row["cluster"], row["x"]):
                    at = row["cluster"], row["x"]
                    held = _read_block(path, *at, row["labels"])
                other = _read_block(path, row["cluster"], row["y"], row["labels"])
                names = np.concatenate([held[0], other[0]])
                labels = np.concatenate([held[2], other[2]]) if row["labels"] else None
                yield _pairs(names, spanning_links(held[1] + other[1], bands, labels))

    def compared(some: DataFrame, labels: bool) -> DataFrame:
        dealt_out = spread(some.select("cluster", "x", "y", F.lit(labels).alias("labels")), "cluster", "x", "y")
        return written(dealt_out.sortWithinPartitions("cluster", "x", "y").mapInArrow(tile, _PAIRS), "gram-links")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["cluster", "block"]):
            starts = group_starts(table, ["cluster", "block"]).tolist()
            for start, end in zip(starts, [*starts[1:], table.num_rows]):
                own = table.slice(start, end - start).combine_chunks()
                cluster, block = own.column("cluster")[0].as_py(), own.column("block")[0].as_py()
                found = own.column("label").to_numpy()
                write_mapped(f"{path}/labels-{cluster}-{block}", own.select(["class", "label"]).to_batches()[0])
                only = int(found[0]) if (found == found[0]).all() else None
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (cluster, block, only)], names=["cluster", "block", "only"])

    joined = within.union(compared(tiles.filter("first"), False))
    named = placed.filter("large").join(components(joined).withColumnRenamed("node", "class"), "class", "left")
    named = named.select("class", "cluster", "block", F.coalesce("component", "class").alias("label"))
    only = written(named.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "class").mapInArrow(
        label, "cluster bigint, block bigint, only bigint"), "gram-labels")
    rest = tiles.filter("not first").join(only.select("cluster", F.col("block").alias("x"), F.col("only").alias("x_only")), ["cluster", "x"])
    rest = rest.join(only.select("cluster", F.col("block").alias("y"), F.col("only").alias("y_only")), ["cluster", "y"])
    rest = rest.filter(F.col("x_only").isNull() | F.col("y_only").isNull() | (F.col("x_only") != F.col("y_only")))
    return joined.union(compared(rest, True))


def _read_block(path: str, cluster: int, block: int, labels: bool) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(classes, sets, labels) of a block of a large cluster."""
    batch = read_mapped(f"{path}/sets-{cluster}-{block}")
    names = batch.column("class").to_numpy()
    found = np.empty(0, np.int64)
    if labels:
        known = read_mapped(f"{path}/labels-{cluster}-{block}")
        found = known.column("label").to_numpy()[np.searchsorted(known.column("class").to_numpy(), names)]
    return names, [np.frombuffer(s, np.uint64) for s in batch.column("grams").to_pylist()], found


def similar_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, class) for every row of `docs`.

    Uses doc_id and text; other columns are ignored. A text without words, or null, has an empty
    set, is linked with nothing and is its own component. Repeated rows and equal texts share a
    component; a component's id is its least non-null doc_id. No rows give no rows."""
    spark = ship(docs.sparkSession)
    # rows of one id, or without any, are told apart by their texts
    slim = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    scan = written(_scan(slim, width), "gram-scan")
    often = scan.filter("gram IS NOT NULL").groupBy("gram").agg(F.sum("n").alias("n"))
    top = often.orderBy(F.desc("n"), "gram").limit(FREQUENT_MOST).select("gram").toPandas()["gram"].to_numpy(np.int64)
    frequent = np.sort(top.view(np.uint64))
    documents = scan.filter("gram IS NULL").select("doc_id", "class", "n_grams", "text_hash")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    classes = documents.filter("class IS NOT NULL").groupBy("class", "n_grams").agg(F.min("doc_id").alias("doc_id"), one.alias("one"))
    classes = written(classes.select("class", "n_grams", "doc_id", F.col("one.doc_id").alias("rep_id"), F.col("one.text_hash").alias("rep_hash")), "gram-classes")
    ties = written(_ties(slim.select("text"), width, percent, frequent), "gram-ties")
    release(spark)
    clusters = components(ties)
    members = written(classes.join(clusters.withColumnRenamed("node", "class").withColumnRenamed("component", "cluster"), "class"), "gram-members")
    release(spark)
    groups = components(written(_links(slim, members, width, percent), "gram-links"))
    named = classes.join(groups.withColumnRenamed("node", "class"), "class")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = named.join(least, "component").select("class", "component_id")
    alone = classes.select("class", "doc_id").join(linked, "class", "left").select(
        "class", F.coalesce("component_id", "doc_id").alias("component_id"))
    return documents.join(alone, "class", "left").select(
        "doc_id", F.col("n_grams").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "class")


def one_of_each_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those of which a group member has a smaller id, with the columns of
    `docs`. Texts without words stay, and so do rows without an id, which nothing can refer to.
    Rows that repeat an id are one document and stay or go together: they stay if one of them is
    its group's smallest."""
    groups = written(similar_groups(docs, width, percent).select("doc_id", "component_id"), "gram-groups")
    release(docs.sparkSession)
    gone = groups.groupBy("doc_id").agg(F.min(F.col("doc_id") != F.col("component_id")).alias("goes")).filter("goes")
    gone = gone.select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, F.col("doc_id") == F.col("gone_id"), "left_anti")
