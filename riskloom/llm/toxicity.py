"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Fit, on a bounded sample of the labelled rows that may be learnt from (EXAMPLES rows and EXAMPLE_BYTES
of text of each class, those with the least hashes; equal texts are one example): terms are words and
beginnings of words, known by 64-bit hashes, and all terms of the examples are kept. Documents
with a term are counted over all documents. A term's weight is its IDF times `1 + SIGN * phi`, with phi the
correlation of term and class over the examples; no term weighs nothing. Terms that stand in no
example add nothing to any cosine with one.

Examples, terms and frequencies are tables in the shared folder, written by tasks. From them a task builds
the inverted index, cut into blocks of examples, and writes it as one file; the driver holds neither
terms nor vectors. Tasks that search map that file, so that the workers of a machine share its pages.
Terms in more than one of COMMON examples are held as columns, with the greatest weight of each in each
block; the others as lists of examples.

Scoring, over all documents in Arrow tasks: the lists give each example's exact sum over the rare
terms. A block's bound is its best such sum plus the query's common weights times the block's greatest.
The blocks of the highest bounds are read first, then those whose bound reaches the k-th best sum of
these, so the k nearest are exact. Their labels vote, weighted by cosine.

Calibration, in tasks too: the examples of a fold vote under the index of the other folds, whose phi
has not seen their labels. Votes are turned into probabilities by the shares of toxic examples among equal
votes, weighted to the classes' shares among all labelled rows and made monotone. Documents with none of
the terms have no neighbour and get the share of toxic rows among such examples."""

from __future__ import annotations

import ast
import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.shared import held, let_go, read_batches, read_mapped, read_table, trim, write_mapped
from riskloom.llm.words import byte_parts, mixed
from riskloom.shipping import ship
from riskloom.sources.scratch import scratch_path, written

#: Bounds of the fit for each class: rows, and bytes of text (a row beyond a sixteenth of them is no example).
EXAMPLES, EXAMPLE_BYTES = 4000, 32_000_000
SIGN = 10.0
NEIGHBOURS, BLOCK, COMMON, PREFIXES, BINS = 15, 64, 16, (5,), 50
#: Documents searched together; blocks read at first for each.
QUERIES, FIRST = 128, 4
#: Beyond what rounding to 32 bits can do to a cosine of non-negative terms.
MARGIN = 1e-4
FOLDS = 5
#: Bytes of text whose terms are hashed together, and of text scored together.
PART, SCORED = 1 << 18, 1 << 20
#: An entry of a term's list: example and weight.
POST = np.dtype([("row", np.int32), ("weight", np.float32)])
_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter, for the first 65,536."""
    return np.array([_WORD.match(chr(c)) is not None for c in range(1 << 16)])


def term_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each term: every word, a run of letters in lower case, and its beginnings of PREFIXES letters.

    A hash is the mixed sum of a random number for each (place, letter). Works on the code points of
    all texts at once; no word becomes an object."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[np.minimum(codes, (1 << 16) - 1)]
    for c in np.unique(codes[codes >= 1 << 16]).tolist():
        letter |= (codes == c) & (_WORD.match(chr(c)) is not None)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8)))
    begin, sizes = edges[::2], edges[1::2] - edges[::2]
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in lowered]), begin, "right")
    ends = np.cumsum(sizes)
    starts = ends - sizes
    place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(starts, sizes)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(codes[letter] + (place.astype(np.uint64) << np.uint64(21)) + np.uint64(1)))])
    there = np.stack([np.ones(len(sizes), bool), *(sizes > k for k in PREFIXES)], axis=1)
    upto = np.stack([sizes, *(np.minimum(sizes, k) for k in PREFIXES)], axis=1)
    sums = total[starts[:, None] + upto] - total[starts][:, None]
    whole = np.array([[1] + [0] * len(PREFIXES)], np.uint64)
    return mixed(sums + (upto.astype(np.uint64) << np.uint64(1)) + whole)[there], np.repeat(text, there.sum(1))


def count_terms(texts: list[str | None], hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, how often, the terms' hashes), ordered by text and term. Terms are numbered by their place in the
    sorted `hashes`, others are left out; without `hashes` all are numbered. A null text has none."""
    found, text = term_hashes(texts)
    unique, term = np.unique(found, return_inverse=True)
    if hashes is None:
        hashes = unique
    else:
        place = np.searchsorted(hashes, unique)
        known = place < len(hashes)
        known[known] = hashes[place[known]] == unique[known]
        term, known = place[term], known[term]
        term, text = term[known], text[known]
    key = text * max(len(hashes), 1) + term
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    text, term = np.divmod(key[first], max(len(hashes), 1))
    return text, term, np.diff(np.append(first, len(key))), hashes


def term_vectors(texts: list[str | None], hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(terms, how often each) of each text."""
    text, term, times, _ = count_terms(texts, hashes)
    cut = np.searchsorted(text, np.arange(1, len(texts)))
    return list(zip(np.split(term, cut), np.split(times, cut)))


@dataclass
class Index:
    """Examples as an inverted index in blocks; bounded by EXAMPLES and EXAMPLE_BYTES."""

    hashes: np.ndarray
    idf: np.ndarray
    ids: list
    labels: np.ndarray
    #: Terms and weights of all examples, one after the other, and how many each has; empty in an index that was read.
    vectors: tuple[np.ndarray, np.ndarray, np.ndarray]
    folds: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def build(self) -> Index:
        self.terms, self.weights, sizes = self.vectors
        n, m = len(sizes), len(self.idf)
        self.blocks = max(1, -(-n // BLOCK))
        rows = np.repeat(np.arange(n, dtype=np.int32), sizes)
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        steps = [slice(at, at + (1 << 18)) for at in range(0, len(rows), 1 << 18)]
        common = sum((np.bincount(self.terms[step], minlength=m) for step in steps), np.zeros(m, np.int64)) * COMMON > n
        self.place = np.where(common, np.cumsum(common) - 1, -1).astype(np.int32)
        often = common[self.terms]
        cols = self.terms[~often]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(cols, minlength=m))])
        order = np.argsort(cols, kind="stable").astype(np.int32)
        del cols
        self.posts = np.empty(len(order), POST)
        self.posts["row"] = rows[~often][order]
        self.posts["weight"] = self.weights[~often][order]
        del order
        self.columns = np.zeros((self.blocks * BLOCK, int(common.sum())), np.float32)
        for step in steps:
            here = often[step]
            self.columns[rows[step][here], self.place[self.terms[step][here]]] = self.weights[step][here]
        self.greatest = self.columns.reshape(self.blocks, BLOCK, -1).max(1).T.copy()
        self.vectors = ()
        return self

    def save(self, path: str, kind: pa.DataType) -> None:
        """All that a search needs, each array a column of one row."""
        fields, columns = [pa.field("ids", pa.list_(kind))], [pa.array([self.ids], pa.list_(kind))]
        for name in _SAVED:
            x = np.ascontiguousarray(getattr(self, name))
            about = {"dtype": repr(x.dtype.descr if x.dtype.names else x.dtype.str), "shape": repr(x.shape)}
            fields.append(pa.field(name, pa.large_binary(), metadata=about))
            parts = [None, pa.py_buffer(np.array([0, x.nbytes], np.int64)), pa.py_buffer(x.reshape(-1).view(np.uint8))]
            columns.append(pa.Array.from_buffers(pa.large_binary(), 1, parts))
        write_mapped(path, pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields)))

    @staticmethod
    def read(path: str) -> Index:
        batch, found = read_mapped(path), {}
        for name in _SAVED:
            about, value = batch.schema.field(name).metadata, batch.column(name).buffers()[2]
            dtype, shape = (ast.literal_eval(about[key].decode()) for key in (b"dtype", b"shape"))
            found[name] = np.frombuffer(value, np.uint8).view(np.dtype(dtype)).reshape(shape)
        index = Index(found.pop("hashes"), found.pop("idf"), batch.column("ids")[0].as_py(), found.pop("labels"), ())
        for name, value in found.items():
            setattr(index, name, value)
        index.blocks = len(index.columns) // BLOCK
        return index

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights are 32-bit floats; cosines of them are exact to the 64-bit sum."""
        weights = (1 + np.log(counts)) * self.idf[terms]
        return terms, (weights / (np.linalg.norm(weights) or 1.0)).astype(np.float32)

    def example(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.terms[self.begin[i] : self.begin[i + 1]], self.weights[self.begin[i] : self.begin[i + 1]]

    def nearest_all(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: np.ndarray | None = None) -> list[list[tuple[float, int]]]:
        """For each query the k examples of the highest positive cosine, ties to the earlier example; those of `without` take no part.

        Blocks are bounded and read in 32-bit floats with a margin for their rounding; what comes within it of the k-th best
        is summed again in 64 bits."""
        n, width = len(queries), self.blocks * BLOCK
        rare, common = np.empty((n, width)), np.zeros((n, self.columns.shape[1]), np.float32)
        for i, (terms, weights) in enumerate(queries):
            place = self.place[terms]
            often = place >= 0
            common[i, place[often]] = weights[often]
            terms, weights = terms[~often], weights[~often].astype(float)
            begin = self.starts[terms]
            size = self.starts[terms + 1] - begin
            entry = np.repeat(begin - (np.cumsum(size) - size), size)
            entry += np.arange(len(entry))
            posts = self.posts.take(entry)
            rare[i] = np.bincount(posts["row"], weights=np.repeat(weights, size) * posts["weight"], minlength=width)
        sums = rare.astype(np.float32)
        if without is not None:
            sums[:, without] = -np.inf
        by_block = sums.reshape(n, self.blocks, BLOCK)
        bounds = by_block.max(2) + common @ self.greatest
        read = np.zeros(bounds.shape, bool)

        def read_blocks(chosen: np.ndarray) -> None:
            for block in np.flatnonzero(chosen.any(0)).tolist():
                rows, part = np.flatnonzero(chosen[:, block]), slice(block * BLOCK, (block + 1) * BLOCK)
                sums[rows, part] += common[rows] @ self.columns[part].T

        first = min(max(FIRST, -(-k // BLOCK)), self.blocks)
        best = np.argpartition(-bounds, first - 1, axis=1)[:, :first]
        np.put_along_axis(read, best, True, axis=1)
        read_blocks(read)
        # the k-th best of whole sums; where there are fewer, all of them count
        whole = np.take_along_axis(by_block, best[:, :, None], axis=1).reshape(n, -1)
        low = np.partition(whole, max(whole.shape[1] - k, 0), axis=1)[:, max(whole.shape[1] - k, 0), None] - MARGIN
        read_blocks(~read & (bounds >= low))
        found = []
        for i, least in enumerate(low[:, 0].tolist()):
            row = sums[i]
            hit = np.flatnonzero(row >= least) if least > 0 else np.flatnonzero(row > 0)
            if len(hit) > k:
                hit = hit[row[hit] >= np.partition(row[hit], len(hit) - k)[len(hit) - k] - MARGIN]
            place = np.flatnonzero(common[i])
            exact = rare[i, hit] + (self.columns[hit[:, None], place] * common[i, place].astype(float)).sum(1)
            exact = np.round(exact, 12)
            top = np.lexsort((hit, -exact))[:k]
            found.append(list(zip(exact[top].tolist(), hit[top].tolist())))
        return found

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> list[tuple[float, int]]:
        """`nearest_all` of one query."""
        return self.nearest_all([(terms, weights)], k, np.array([without]) if without >= 0 else None)[0]

    def vote(self, near: list[tuple[float, int]]) -> float:
        """The share of toxic neighbours, by cosine."""
        return sum(s * self.labels[i] for s, i in near) / sum(s for s, _ in near)


@functools.lru_cache(maxsize=1)
def known_hashes(folder: str) -> np.ndarray:
    """The sorted hashes of the examples' terms."""
    return np.sort(read_table(f"{folder}/terms").column("hash").to_numpy().view(np.uint64))


#: What a search reads of an index.
_SAVED = ("hashes", "folds", "idf", "labels", "place", "starts", "posts", "columns", "greatest")


def index_of(folder: str, without: int = -1) -> Index:
    """The index of a fit, from its file; with a fold, built as if its labels were not known."""
    return held((folder, without), lambda: Index.read(f"{folder}/index.arrow") if without < 0 else _index(folder, without))


def _packed(folder: str, column: str, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of the examples in turn: all numbers of a column of packed numbers, and how many each row has."""
    for batch in read_batches(f"{folder}/examples", [column]):
        _, offsets, data = batch.column(0).buffers()
        at = batch.column(0).offset
        ends = np.frombuffer(offsets, np.int32)[at : at + batch.num_rows + 1]
        values = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind) if data is not None else np.empty(0, kind)
        yield values, np.diff(ends).astype(np.int64) // np.dtype(kind).itemsize


def _index(folder: str, without: int = -1) -> Index:
    """Built from the tables of a fit; with a fold, as if its labels were not known. Tables are read in parts, so that
    little more than the result is held."""
    hashes = read_table(f"{folder}/terms", ["hash"]).column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes = hashes[order]
    # documents with each term over all documents; a null hash counts the documents
    frequencies, total = np.zeros(len(hashes)), 0.0
    for seen in read_batches(f"{folder}/frequencies", rows=1 << 16):
        number, n = seen.column("hash"), seen.column("n").to_numpy()
        there = np.asarray(number.is_valid())
        frequencies[np.searchsorted(hashes, number.drop_null().to_numpy().view(np.uint64))] = n[there]
        total += float(n[~there].sum())
    examples = read_table(f"{folder}/examples", ["doc_id", "label", "fold"])
    fold, label = (examples.column(c).to_numpy().astype(np.int64) for c in ("fold", "label"))
    clean, toxic = np.zeros(len(hashes)), np.zeros(len(hashes))
    for into, c in ((clean, "clean"), (toxic, "toxic")):
        for f in range(FOLDS):
            if f != without:
                into += read_table(f"{folder}/terms", [f"{c}{f}"]).column(0).to_numpy()[order]
    t0, t1 = (float(((label == y) & (fold != without)).sum()) for y in (0, 1))
    both = clean + toxic
    spread = np.sqrt(np.maximum(t0 * t1 * both * (t0 + t1 - both), 1.0))
    phi = np.abs(toxic * (t0 - clean) - clean * (t1 - toxic)) / spread
    idf = (np.log((1 + total) / (1 + frequencies)) + 1) * (1 + SIGN * phi)
    # like examples beside each other, so that blocks differ in their greatest weights: common terms first
    rank = np.empty(len(hashes), np.int32)
    rank[np.lexsort((hashes, -both))] = np.arange(len(hashes), dtype=np.int32)
    del clean, toxic, both, spread, phi, frequencies, order
    trim()
    parts, sizes = [], [np.empty(0, np.int64)]
    for names, n in _packed(folder, "terms", np.uint64):
        parts.append(np.searchsorted(hashes, names).astype(np.int32))
        sizes.append(n)
    terms, sizes = np.concatenate([np.empty(0, np.int32), *parts]), np.concatenate(sizes)
    del parts
    begin, ids = np.cumsum(sizes) - sizes, examples.column("doc_id").to_pylist()
    place = sorted(range(len(ids)), key=lambda i: (np.sort(rank[terms[begin[i] : begin[i] + sizes[i]]]).astype(">i4").tobytes(), ids[i]))
    del rank
    own = np.repeat((begin[place] - (np.cumsum(sizes[place]) - sizes[place])).astype(np.int32), sizes[place])
    own += np.arange(len(terms), dtype=np.int32)
    sizes, terms = sizes[place], terms[own]
    counts = np.concatenate([np.empty(0, np.uint32), *(values for values, _ in _packed(folder, "counts", np.uint32))])[own]
    del own
    rows, norms, weights = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), np.zeros(len(sizes)), np.empty(len(terms), np.float32)
    steps = [slice(at, at + (1 << 18)) for at in range(0, len(terms), 1 << 18)]
    for step in steps:
        weight = (1 + np.log(counts[step])) * idf[terms[step]]
        norms += np.bincount(rows[step], weights=weight * weight, minlength=len(sizes))
    norms = np.sqrt(norms)
    for step in steps:
        weights[step] = (1 + np.log(counts[step])) * idf[terms[step]] / norms[rows[step]]
    del counts, rows
    trim()
    return Index(hashes, idf, [ids[i] for i in place], label[place], (terms, weights, sizes), fold[place]).build()


@dataclass(frozen=True)
class Fitted:
    """Where the index lies, and how votes become probabilities."""

    folder: str
    edges: tuple[float, ...]
    rates: tuple[float, ...]
    alone: float

    def score(self, texts: list[str | None]) -> list[tuple[float, list[tuple[float, int]]]]:
        """(score, nearest examples) of each text; inside tasks."""
        index, out, counted, begun, size = index_of(self.folder), [], [], 0, 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if size >= PART or i + 1 == len(texts):
                counted += term_vectors(texts[begun : i + 1], index.hashes)
                begun, size = i + 1, 0
        for at in range(0, len(counted), QUERIES):
            queries = [index.vector(*c) for c in counted[at : at + QUERIES]]
            for near in index.nearest_all(queries, NEIGHBOURS):
                out.append((float(np.interp(index.vote(near), self.edges, self.rates)) if near else self.alone, near))
        return out


def _examples(docs: DataFrame, labels: DataFrame, label: str) -> tuple[DataFrame, tuple[int, int]]:
    """(doc_id, text, label, fold) of the distinct texts, and the rows of each class that could be learnt from."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("labelled_id")).agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("labelled_id"), F.col("labelled_id")]
    chosen = [known.filter(F.col("label") == c).orderBy(*order).limit(EXAMPLES) for c in (0, 1)]
    # at most EXAMPLES rows of each class
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen[0].union(chosen[1])), F.col("doc_id") == F.col("labelled_id"))
    rows = rows.select("labelled_id", "label", F.coalesce("text", F.lit("")).alias("text")).filter(F.octet_length("text") <= EXAMPLE_BYTES // 16)
    # of a repeated id the text of the least hash, found before the shuffle
    rows = rows.groupBy("labelled_id", "label").agg(F.min(F.struct(F.xxhash64("text"), F.col("text"))).alias("first"))
    rows = written(rows.select(F.col("labelled_id").alias("doc_id"), "label", F.col("first.text").alias("text")), "toxicity-rows")
    by_hash = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")  # at most EXAMPLES rows each
    sizes = rows.select("doc_id", F.sum(F.octet_length("text")).over(by_hash).alias("bytes"))
    rows = rows.join(sizes.filter(F.col("bytes") <= EXAMPLE_BYTES), "doc_id")
    # a text counts once, so that words of a much copied document are no sign and copies have one vote
    texts = rows.groupBy("text").agg(F.min("doc_id").alias("doc_id"), (F.avg("label") >= 0.5).cast("int").alias("label"))
    texts = texts.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int"))
    return written(texts, "toxicity-texts"), (counts.get(0, 0), counts.get(1, 0))


def _write_examples(texts: DataFrame, folder: str) -> None:
    """`examples`: one row a text with the hashes of its terms; `terms`: distinct texts with each term by class and fold."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_parts(batches, "text", PART):
            text, term, times, hashes = count_terms(batch.column("text").to_pylist())
            cut = np.searchsorted(text, np.arange(1, batch.num_rows))
            packed = [pa.array([x.tobytes() for x in np.split(column, cut)], pa.binary()) for column in (hashes[term], times.astype(np.uint32))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "label", "fold")), *packed],
                                             names=["doc_id", "label", "fold", "terms", "counts"])

    found = texts.mapInArrow(run, f"doc_id {kind}, label int, fold int, terms binary, counts binary")
    found.write.parquet(f"{folder}/examples")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [np.frombuffer(t, np.int64) for t in batch.column("terms").to_pylist()]
            cell = np.asarray(batch.column("label")).astype(np.int64) * FOLDS + np.asarray(batch.column("fold"))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(terms or [np.empty(0, np.int64)]), pa.int64()),
                                              pa.array(np.repeat(cell, [len(t) for t in terms]), pa.int64())], names=["hash", "cell"])

    cells = texts.sparkSession.read.parquet(f"{folder}/examples").select("label", "fold", "terms").mapInArrow(spread, "hash bigint, cell bigint")
    names = [f"{c}{f}" for c in ("clean", "toxic") for f in range(FOLDS)]
    cells.groupBy("hash").agg(*(F.count_if(F.col("cell") == i).alias(name) for i, name in enumerate(names))).write.parquet(f"{folder}/terms")


def _write_frequencies(docs: DataFrame, folder: str) -> None:
    """`frequencies`: over all documents, how many have each term; the null hash counts the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        hashes, n = known_hashes(folder), 0
        seen = np.zeros(len(hashes), np.int64)
        for batch in byte_parts(batches, "text", PART):
            n += batch.num_rows
            seen += np.bincount(count_terms(batch.column("text").to_pylist(), hashes)[1], minlength=len(seen))
        there = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(hashes[there].view(np.int64)), pa.array(seen[there])], names=["hash", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([n], pa.int64())], names=["hash", "n"])

    found = docs.select("text").mapInArrow(run, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))
    found.write.parquet(f"{folder}/frequencies")


def _votes(spark: SparkSession, folder: str) -> list:
    """(level of the vote or null without a neighbour, label, examples) over all examples, each under
    the index of the other folds. One task more writes the index of all folds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for fold in batch.column(0).to_pylist():
                index = None
                trim()
                index = _index(folder, fold if fold < FOLDS else -1)
                if fold == FOLDS:
                    index.save(f"{folder}/index.arrow", read_table(f"{folder}/examples", ["doc_id"]).schema.field(0).type)
                    continue
                own = np.flatnonzero(index.folds == fold)
                levels = []
                for at in range(0, len(own), QUERIES):
                    near = index.nearest_all([index.example(i) for i in own[at : at + QUERIES]], NEIGHBOURS, own)
                    levels += [round(index.vote(found) * BINS) if found else None for found in near]
                yield pa.RecordBatch.from_arrays([pa.array(levels, pa.int32()), pa.array(index.labels[own], pa.int32())], names=["level", "label"])
        index = None
        trim()

    # few tasks, as each holds an index of its own
    voted = spark.range(0, FOLDS + 1, 1, (FOLDS + 1) // 2).mapInArrow(run, "level int, label int")
    return voted.groupBy("level", "label").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 2 * (BINS + 2) rows


def calibrated(votes: list[tuple[int | None, int, int]], class_weights: tuple[float, float]) -> tuple[list[float], list[float], float]:
    """(votes ascending, toxic share at each, share without a neighbour), monotone, from (level, label, examples)."""

    def share(level: int | None) -> tuple[float, float]:
        """(toxic share, weight), with half a row of each class for prior."""
        weigh = [class_weights[y] * sum(n for at, label, n in votes if at == level and label == y) for y in (0, 1)]
        return (weigh[1] + 0.5) / (sum(weigh) + 1.0), sum(weigh) + 1.0

    pools: list[list[float]] = []  # [share, weight, middle of the votes], votes ascending
    for level in sorted({at for at, _, _ in votes if at is not None}):
        pools.append([*share(level), level / BINS])
        while len(pools) > 1 and pools[-2][0] > pools[-1][0]:
            (r1, w1, m1), (r2, w2, m2) = pools[-2:]
            pools[-2:] = [[(r1 * w1 + r2 * w2) / (w1 + w2), w1 + w2, (m1 * w1 + m2 * w2) / (w1 + w2)]]
    alone = share(None)[0]
    return [p[2] for p in pools] or [0.0], [p[0] for p in pools] or [alone], alone


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Fitted:
    """Learn from labelled rows that are not held out; null ids and labels are left out, a repeated
    label counts by its mean, and of a repeated id the text of the least hash is learnt. Without
    labelled rows every score is one half."""
    spark = ship(docs.sparkSession)
    texts, totals = _examples(docs, labels, label)
    folder = scratch_path(spark, "toxicity-index")
    _write_examples(texts, folder)
    _write_frequencies(docs, folder)
    votes = [(r["level"], r["label"], r["n"]) for r in _votes(spark, folder)]
    sizes = [sum(n for _, label, n in votes if label == y) for y in (0, 1)]
    edges, rates, alone = calibrated(votes, (totals[0] / max(sizes[0], 1), totals[1] / max(sizes[1], 1)))
    return Fitted(folder, tuple(edges), tuple(rates), alone)


def score(docs: DataFrame, fitted: Fitted) -> DataFrame:
    """(doc_id, score, predicted, evidence) of every row; the evidence lists the ids of the nearest
    examples, nearest first. Only the text is scored: null and empty texts have no neighbour and get
    the base score. Other columns are ignored, repeated rows are scored each, no rows give no rows."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_parts(batches, "text", SCORED):
            results, ids = fitted.score(batch.column("text").to_pylist()), index_of(fitted.folder).ids
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r[0] for r in results], pa.float64()),
                 pa.array([[ids[i] for _, i in r[1][:3]] for r in results], pa.list_(batch.column("doc_id").type))],
                names=["doc_id", "score", "evidence"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, evidence array<{kind}>")
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def without_toxic(docs: DataFrame, fitted: Fitted) -> DataFrame:
    """The documents that are not predicted toxic, with the columns of `docs`; no shuffle."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_parts(batches, "text", SCORED):
            stays = [found < 0.5 for found, _ in fitted.score(batch.column("text").to_pylist())]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
