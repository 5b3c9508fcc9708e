"""Language identification by sparse multinomial logistic regression on TF-IDF of character n-grams.

Texts are lower-cased, what is no letter becomes a word boundary, and n-grams of 1 to 3 characters are hashed to
BUCKETS numbers. Documents with each are counted over all documents; a document's weights are
`(1 + ln count) * IDF`, of length one, and a constant.

The weights are learnt on a bounded sample (EXAMPLES distinct texts of each language, those with the least
hashes, none beyond EXAMPLE_BYTES) by follow-the-regularised-leader with an elastic net: a weight is zero until its summed
gradients exceed L1, and shrinks by L2. The sample is dealt to SHARDS; in each of ROUNDS rounds every shard goes on from the
mean of all shards' sums. A fifth of the sample is not trained on: on it the temperature is chosen that gives the
least log loss. Counts, sums and weights are tables in the shared folder; nothing passes through the driver but the names of
the languages and the losses of the temperatures."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.shared import read_table
from riskloom.llm.toxicity import held_out
from riskloom.llm.words import byte_parts, mixed
from riskloom.shipping import ship
from riskloom.sources.scratch import scratch_path, written

#: Bounds of the sample, for each language.
EXAMPLES, EXAMPLE_BYTES = 2000, 100_000
BUCKETS, SIZES = 1 << 16, (1, 2, 3)
#: The learner: rate, its smoothing, penalties; shards and rounds; every CALIBRATES-th example sets the temperature.
RATE, SMOOTH, L1, L2 = 2.0, 1.0, 0.02, 0.1
SHARDS, ROUNDS, CALIBRATES = 4, 3, 5
TEMPERATURES = np.exp(np.linspace(np.log(0.05), np.log(20.0), 121))
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter, for the first 65,536."""
    return np.array([chr(c).isalpha() for c in range(1 << 16)])


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) of every n-gram, ordered by text and bucket, and whether each text has a letter.

    Boundaries stand around each text, and an n-gram with two of them side by side is none."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer(("\n" + "\n\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    letter = _letters()[np.minimum(codes, (1 << 16) - 1).astype(np.int64)]
    for c in np.unique(codes[codes >= 1 << 16]).tolist():
        letter[codes == c] = chr(c).isalpha()
    codes = np.where(letter, codes + np.uint64(1), np.uint64(1))
    sizes = np.array([len(t) + 2 for t in lowered])
    text = np.repeat(np.arange(len(texts)), sizes)
    has = np.bincount(text, weights=letter, minlength=len(texts)) > 0
    keys = []
    for n in SIZES:
        length = len(codes) - n + 1
        if length <= 0:
            continue
        gram, bad = np.zeros(length, np.uint64), np.zeros(length, bool)
        for k in range(n):
            gram += codes[k : k + length] << np.uint64(21 * k)
            if k:
                bad |= ~(letter[k - 1 : k - 1 + length] | letter[k : k + length])
        good = ~bad if n > 1 else letter[:length].copy()
        keys.append(text[:length][good] * BUCKETS + (mixed(gram[good]) % np.uint64(BUCKETS)).astype(np.int64))
    key = np.sort(np.concatenate(keys or [np.empty(0, np.int64)]))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    text, bucket = np.divmod(key[first], BUCKETS)
    return text, bucket, np.diff(np.append(first, len(key))), has


def weighed(text: np.ndarray, bucket: np.ndarray, count: np.ndarray, n: int, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, weight) with a constant in bucket BUCKETS for each of the n texts, ordered by text."""
    weight = (1 + np.log(count)) * idf[bucket]
    norm = np.sqrt(np.bincount(text, weights=weight * weight, minlength=n))
    text, bucket = np.concatenate([text, np.arange(n)]), np.concatenate([bucket, np.full(n, BUCKETS)])
    weight = np.concatenate([weight / norm[text[: len(weight)]], np.ones(n)])
    order = np.argsort(text, kind="stable")
    return text[order], bucket[order], weight[order]


@functools.lru_cache(maxsize=1)
def idf_of(folder: str) -> np.ndarray:
    """The inverse document frequency of each bucket over all documents; the row of bucket -1 has their number."""
    table = read_table(f"{folder}/frequencies")
    bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    seen, total = np.zeros(BUCKETS), float(n[bucket < 0].sum())
    seen[bucket[bucket >= 0]] = n[bucket >= 0]
    return np.log((1 + total) / (1 + seen)) + 1


def leading(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that follow the regularised leader: zero up to L1, else shrunk by L1 and L2."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((SMOOTH + np.sqrt(n)) / RATE + L2))


def learn(z: np.ndarray, n: np.ndarray, buckets: np.ndarray, weights: np.ndarray, label: int) -> None:
    """One example: `z` and `n` (buckets x classes) take its gradients."""
    zs, ns = z[buckets], n[buckets]
    w = leading(zs, ns)
    logits = weights @ w
    p = np.exp(logits - logits.max())
    p /= p.sum()
    p[label] -= 1.0
    g = weights[:, None] * p[None]
    grown = ns + g * g
    z[buckets] = zs + g - (np.sqrt(grown) - np.sqrt(ns)) / RATE * w
    n[buckets] = grown


def _state(path: str | None, classes: int) -> tuple[np.ndarray, np.ndarray]:
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))
    if path is not None:
        table = read_table(path)
        at = table.column("bucket").to_numpy(), table.column("class").to_numpy()
        z[at], n[at] = table.column("z").to_numpy(), table.column("n").to_numpy()
    return z, n


@functools.lru_cache(maxsize=1)
def weights_of(path: str, classes: int) -> np.ndarray:
    """The weights (buckets x classes) of the last round."""
    return leading(*_state(path, classes)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Where frequencies and sums lie, the languages, and the temperature."""

    folder: str
    state: str | None
    languages: tuple[str, ...]
    temperature: float = 1.0

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(logits of each text, whether it has a letter); inside tasks."""
        text, bucket, count, has = ngrams(texts)
        text, bucket, weight = weighed(text, bucket, count, len(texts), idf_of(self.folder))
        gain = weights_of(self.state, len(self.languages))[bucket] * weight[:, None]
        return np.add.reduceat(gain, np.searchsorted(text, np.arange(len(texts)))), has

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.languages or not texts:
            return [(UNKNOWN, 0.0)] * len(texts)
        logits, has = self.logits(texts)
        best = logits.argmax(1)
        scaled = (logits - logits.max(1, keepdims=True)) / self.temperature
        score = 1.0 / np.exp(scaled).sum(1)
        return [(self.languages[b], s) if h else (UNKNOWN, 0.0) for b, s, h in zip(best.tolist(), score.tolist(), has.tolist())]


def _sample(docs: DataFrame, text: str, label: str) -> DataFrame:
    """(label, text, hash) of the examples: of each language the distinct texts with the least hashes."""
    known = docs.select(F.col("doc_id").alias("key"), F.col(text).alias("text"), F.col(label).cast("string").alias("label"))
    known = known.filter(F.col("label").isNotNull() & (F.octet_length("text") <= EXAMPLE_BYTES) & F.rlike("text", F.lit(r"\p{L}")) & ~held_out(F.col("key")))
    known = known.select("label", "text", F.xxhash64("text").alias("hash"))
    # a sketch of each language's distinct texts gives a cut of the hashes that leaves a little more than EXAMPLES; only these
    # are ranked. One row a language, as in the model
    share = F.least(F.lit(1.0), F.lit(1.2 * EXAMPLES) / F.approx_count_distinct("hash", 0.02))
    cuts = known.groupBy("label").agg(share.alias("share")).withColumnRenamed("label", "of")
    below = (F.col("hash").cast("double") + 2.0**63) / 2.0**64 <= F.col("share")
    chosen = known.join(F.broadcast(cuts), (F.col("label") == F.col("of")) & below).groupBy("label", "hash").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("label").orderBy("hash"))
    return written(chosen.withColumn("place", place).filter(F.col("place") <= EXAMPLES).drop("place"), "language-examples")


def _write_frequencies(docs: DataFrame, text: str, folder: str) -> None:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for batch in byte_parts(batches, "text"):
            n += batch.num_rows
            seen += np.bincount(ngrams(batch.column("text").to_pylist())[1], minlength=BUCKETS)
        there = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(there, -1)), pa.array(np.append(seen[there], n))], names=["bucket", "n"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    found.groupBy("bucket").agg(F.sum("n").alias("n")).write.parquet(f"{folder}/frequencies")


def _round(spark: SparkSession, folder: str, examples: DataFrame, classes: int, before: str | None, number: int) -> str:
    """Each shard learns on from the sums of the round before; the mean of the shards' sums is written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in byte_parts(batches, "text"):
            if state is None:
                state = _state(before, classes)
            text, bucket, count, _ = ngrams(batch.column("text").to_pylist())
            text, bucket, weight = weighed(text, bucket, count, batch.num_rows, idf_of(folder))
            cuts = np.searchsorted(text, np.arange(1, batch.num_rows))
            for label, b, w in zip(batch.column("class").to_pylist(), np.split(bucket, cuts), np.split(weight, cuts)):
                learn(*state, b, w, label)
        if state is not None:
            at = np.nonzero(state[1])
            yield pa.RecordBatch.from_arrays([*(pa.array(i) for i in at), *(pa.array(s[at]) for s in state)], names=["bucket", "class", "z", "n"])

    # the order of the examples is fixed, so that reruns agree
    dealt = examples.select("class", "text", "hash", F.pmod(F.xxhash64("hash"), F.lit(SHARDS)).alias("shard"))
    dealt = dealt.repartition(SHARDS, "shard").sortWithinPartitions("shard", "hash", "class").select("class", "text")
    sums = dealt.mapInArrow(run, "bucket bigint, class bigint, z double, n double")
    path = f"{folder}/sums-{number}"
    # a shard that has not met an n-gram has learnt nothing of it
    sums.groupBy("bucket", "class").agg(F.avg("z").alias("z"), F.avg("n").alias("n")).write.parquet(path)
    return path


def _temperature(model: Model, examples: DataFrame) -> float:
    """The temperature of the least log loss; 1 without examples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_parts(batches, "text"):
            logits, _ = model.logits(batch.column("text").to_pylist())
            logits = (logits - logits.max(1, keepdims=True))[None] / TEMPERATURES[:, None, None]
            right = logits[:, np.arange(batch.num_rows), np.asarray(batch.column("class"))]
            loss = (np.log(np.exp(logits).sum(2)) - right).sum(1)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(TEMPERATURES)), pa.int32()), pa.array(loss)], names=["at", "loss"])

    losses = examples.select("class", "text").mapInArrow(run, "at int, loss double").groupBy("at").agg(F.sum("loss").alias("loss"))
    found = [(round(r["loss"], 9), r["at"]) for r in losses.collect()]  # one row a temperature
    return float(TEMPERATURES[min(found)[1]]) if found else 1.0


def fit(docs: DataFrame, label: str = "lang", text: str = "text") -> Model:
    """Learn from rows that are not held out and have a label and a letter. Equal texts of a language are one example;
    without any, nothing is learnt and every prediction is `und`."""
    spark = ship(docs.sparkSession)
    folder = scratch_path(spark, "language")
    sample = _sample(docs, text, label)
    languages = tuple(sorted((r["label"] for r in sample.select("label").distinct().collect()), key=str.encode))
    model = Model(folder, None, languages)
    if not languages:
        return model
    _write_frequencies(docs, text, folder)
    names = spark.createDataFrame(list(enumerate(languages)), "class bigint, name string")
    examples = written(sample.join(names, F.col("label") == F.col("name")).select("class", "text", "hash"), "language-classes")
    calibrates = F.pmod(F.col("hash"), F.lit(CALIBRATES)) == 0
    state = None
    for number in range(ROUNDS):
        state = _round(spark, folder, examples.filter(~calibrates), len(languages), state, number)
    model = Model(folder, state, languages)
    return Model(folder, state, languages, _temperature(model, examples.filter(calibrates)))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from the text alone. A null text and one without a letter are `und` with
    score 0; ties go to the first language in code-point order. Repeated rows are judged each, other columns are ignored,
    no rows give no rows."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_parts(batches, "text"):
            found = model.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
