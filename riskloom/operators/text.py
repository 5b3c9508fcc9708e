"""TF-IDF features and the sentiment model."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructType
from pyspark.sql.window import Window

from riskloom.config import SENTIMENT_LABELS
from riskloom.functions.scalars import clean_text, clip01
from riskloom.operators.joins import alias_lookup
from riskloom.operators.layout import dealt
from riskloom.operators.logistic import fit_multinomial, logits_of, softmax
from riskloom.operators.preparation import class_weights
from riskloom.shipping import ship

WORD = "[a-z0-9]{2,}"
ANY_WORD = r"[\p{L}\p{N}_]{2,}"
#: Terms that a task counts before it passes the counts on, and rows of a batch then.
HELD_TERMS, FLUSHED_ROWS = 1_000_000, 20_000
SLICE_ROWS, VECTOR_ROWS = 256, 1_000
# A small default; callers with a fuller list pass their own.
STOP_WORDS = [
    "a", "about", "after", "all", "also", "am", "an", "and", "any", "are", "as", "at", "be",
    "because", "been", "before", "but", "by", "can", "could", "did", "do", "does", "for", "from",
    "had", "has", "have", "he", "her", "him", "his", "how", "if", "in", "into", "is", "it", "its",
    "me", "more", "most", "my", "no", "not", "of", "on", "or", "our", "out", "over", "she", "so",
    "some", "such", "than", "that", "the", "their", "them", "then", "there", "these", "they",
    "this", "those", "to", "too", "under", "up", "very", "was", "we", "were", "what", "when",
    "where", "which", "while", "who", "why", "will", "with", "would", "you", "your",
]


def _small(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of few rows: a list of words takes several times its text in Python."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def with_terms(docs: DataFrame, text: str, out: str = "terms") -> DataFrame:
    """Words of two or more characters of the cleaned text, then their adjacent pairs. Rows are dealt evenly over the tasks."""
    kept = [c for c in (ship(docs.sparkSession) and docs.columns) if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            terms = [[*own, *map(" ".join, pairwise(own))] for own in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(terms, pa.list_(pa.string()))], names=[*kept, out])

    schema = StructType([docs.schema[c] for c in kept]).add(out, ArrayType(StringType()))
    return dealt(docs).select(*kept, _words(text).alias("__words")).mapInArrow(run, schema)


def tokenize_ngrams(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return with_terms(docs.select(id_column, text), text).select(
        id_column, F.explode("terms").alias("term")
    )


@dataclass
class _Words:
    """The words of some rows as numbers: `row` and `code` of each word, and the words that codes stand for."""

    row: np.ndarray
    code: np.ndarray
    known: pa.Array

    @staticmethod
    def of(joined: pa.Array) -> _Words:
        """From words with a space in between; no row and an empty one have none."""
        lists = pc.split_pattern(pc.fill_null(joined, ""), " ")
        flat = lists.flatten()
        row = np.repeat(np.arange(len(joined)), np.diff(np.asarray(lists.offsets)))
        found = flat.dictionary_encode()
        code, known = np.asarray(found.indices), found.dictionary
        real = np.asarray(pc.not_equal(known, ""))[code]
        return _Words(row[real], code[real], known)

    def pairs(self) -> np.ndarray:
        """Places of words that another one of their row follows."""
        return np.flatnonzero(self.row[1:] == self.row[:-1])


class _Counts:
    """Corpus and document frequency of terms: a word's key is its number, a pair's has the first word's, plus one, in its upper half."""

    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, words: _Words) -> None:
        number = np.fromiter((self.numbers.setdefault(w, len(self.numbers)) for w in words.known.to_pylist()), np.int64, len(words.known))[words.code]
        at = words.pairs()
        keys = np.concatenate([number, (number[at] + 1) << 32 | number[at + 1]])
        rows = np.concatenate([words.row, words.row[at]])
        known, place, total = np.unique(keys, return_inverse=True, return_counts=True)
        df = np.bincount(np.unique(rows * len(known) + place) % max(1, len(known)), minlength=len(known))
        self.parts.append((known, total, df))
        self.held += len(known)

    def compact(self) -> None:
        self.parts = [self.merged()]
        self.held = len(self.parts[0][0])

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, total, df = (np.concatenate([np.empty(0, np.int64), *column]) for column in zip(*self.parts or [((),) * 3]))
        known, place = np.unique(keys, return_inverse=True)
        return known, *(np.bincount(place, weights=c, minlength=len(known)).astype(np.int64) for c in (total, df))

    def taken(self) -> Iterator[list[pa.Array]]:
        """[terms, totals, document frequencies], after which nothing is held."""
        keys, total, df = self.merged()
        words = pa.array(self.numbers, pa.string())
        for at in range(0, len(keys), FLUSHED_ROWS):
            some, own = keys[at : at + FLUSHED_ROWS], slice(at, at + FLUSHED_ROWS)
            last, first = words.take(pa.array(some & 0xFFFFFFFF)), (some >> 32) - 1
            both = pc.binary_join_element_wise(words.take(pa.array(np.maximum(first, 0))), last, " ")
            yield [pc.if_else(pa.array(first >= 0), both, last), pa.array(total[own]), pa.array(df[own])]
        self.__init__()


def _joined(words: Column) -> Column:
    """Words as one text: lists of texts cost much more on their way to Python."""
    return F.array_join(words, " ")


def _term_counts(docs: DataFrame, by: list[str], words: Column) -> DataFrame:
    """Corpus and document frequency of the words and their adjacent pairs in the array column `words`.

    A task adds up the counts of its own rows and passes them on when it holds `HELD_TERMS` terms, so a word in
    every document costs a few rows per task."""
    ship(docs.sparkSession)
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in by]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, types = defaultdict(_Counts), []
        for batch in _small(batches):
            types = [batch.schema.field(i).type for i in range(len(by))]
            groups = list(zip(*(batch.column(i).to_pylist() for i in range(len(by))))) if by else [()] * batch.num_rows
            for group in dict.fromkeys(groups):
                own = batch.column(len(by)) if len(by) == 0 else batch.column(len(by)).filter(pa.array([g == group for g in groups]))
                counts[group].add(_Words.of(own))
            if sum(one.held for one in counts.values()) > 2 * HELD_TERMS:
                for one in counts.values():
                    one.compact()
                if sum(one.held for one in counts.values()) > HELD_TERMS:
                    yield from flushed(counts, types)
        yield from flushed(counts, types)

    def flushed(counts: dict, types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
        for group, one in counts.items():
            for columns in one.taken():
                keys = [pa.array([value] * len(columns[0]), kind) for value, kind in zip(group, types)]
                yield pa.RecordBatch.from_arrays([*keys, *columns], names=[*by, "term", "total", "df"])
        counts.clear()

    schema = ", ".join([*kinds, "term string, total bigint, df bigint"])
    return docs.select(*by, _joined(words).alias("__words")).mapInArrow(run, schema).repartition(*by, "term").groupBy(*by, "term").agg(
        F.sum("total").alias("total"), F.sum("df").alias("df"))


def build_vocabulary(docs: DataFrame, text: str, max_features: int = 5000, min_df: int = 2) -> DataFrame:
    """The most frequent terms found in at least `min_df` documents, ties by term."""
    counts = _term_counts(dealt(docs.select(text)), [], _words(text))
    return counts.where(F.col("df") >= min_df).orderBy(F.col("total").desc(), "term").limit(
        max_features
    )


def tfidf(docs: DataFrame, vocabulary: DataFrame, id_column: str, text: str) -> DataFrame:
    """Long form `(id, term, tf, weight)`, L2-normalised per row of `docs`.

    Texts are dealt evenly over the tasks; words, counts, weights and norm follow in the same task. The vocabulary is bounded by `max_features` and goes along with the function."""
    n_docs = ship(docs.sparkSession) and docs.count()
    idf = {r.term: math.log((1 + n_docs) / (1 + r.df)) + 1 for r in vocabulary.select("term", "df").collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, terms, counts, weights = [], [], [], []
            for row, words in enumerate(batch.column(1).to_pylist()):
                words = words or []
                found = Counter(t for t in chain(words, map(" ".join, pairwise(words))) if t in idf)
                raw = [(1 + math.log(n)) * idf[t] for t, n in found.items()]
                norm = math.sqrt(sum(w * w for w in raw))
                rows += [row] * len(raw)
                terms += found.keys()
                counts += found.values()
                weights += [w / norm for w in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(terms, pa.string()), pa.array(counts, pa.int64()), pa.array(weights, pa.float64())],
                names=[id_column, "term", "tf", "weight"])

    kind = docs.schema[id_column].dataType.simpleString()
    return dealt(docs.select(id_column, text)).select(id_column, _words(text).alias("words")).mapInArrow(run, f"`{id_column}` {kind}, term string, tf bigint, weight double")


def top_terms_by_class(docs: DataFrame, id_column: str, text: str, label: str, features: int = 20,
                       keep: int = 10, stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """Per class the terms with the highest mean TF-IDF among its most frequent ones."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(ANY_WORD), F.lit(0))
    kept = F.filter(words, lambda w: ~w.isin(stop_words)) if stop_words else words
    prepared = dealt(docs.select(id_column, label, text))
    window = Window.partitionBy(label).orderBy(F.col("total").desc(), "term")
    vocabulary = _term_counts(prepared, [label], kept).withColumn(
        "r", F.row_number().over(window)
    ).where(F.col("r") <= features)
    sizes = docs.groupBy(label).agg(F.count(F.lit(1)).alias("n_docs"))
    # classes x features rows
    weights = vocabulary.join(F.broadcast(sizes), label).select(
        label, "term", "n_docs",
        (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1).alias("idf"),
    )
    found = weights.collect()
    known = {r[0]: {} for r in found}
    for r in found:
        known[r[0]][r.term] = (r.idf, r.n_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            rows, hits = [], []
            for row, (group, own) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                facts, own = known.get(group, {}), own or ()
                for term, n in Counter(t for t in chain(own, map(" ".join, pairwise(own))) if t in facts).items():
                    rows.append(row)
                    hits.append((term, n, *facts[term]))
            at = pa.array(rows, pa.int64())
            columns = list(zip(*hits)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.int64())],
                names=[id_column, label, "term", "tf", "idf", "n_docs"])

    schema = StructType([docs.schema[id_column], docs.schema[label]])
    for name, kind in (("term", StringType()), ("tf", LongType()), ("idf", DoubleType()), ("n_docs", LongType())):
        schema = schema.add(name, kind)
    # rows of one id count as one text
    tf = (
        prepared.select(id_column, label, kept.alias("__words")).mapInArrow(run, schema)
        .groupBy(id_column, label, "term")
        .agg(F.sum("tf").alias("tf"), F.first("idf").alias("idf"), F.first("n_docs").alias("n_docs"))
        .withColumn("raw", F.col("tf") * F.col("idf"))
    )
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_column)))
    means = (
        tf.withColumn("weight", F.col("raw") / norm)
        .groupBy(label, "term")
        .agg((F.sum("weight") / F.first("n_docs")).alias("mean_weight"))
    )
    best = Window.partitionBy(label).orderBy(F.round("mean_weight", 9).desc(), "term")
    return means.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)


@dataclass
class SentimentModel:
    """A fitted vocabulary `(term_no, term, df, n_docs, idf)` and a three-class linear model: one row of
    coefficients for each term, and the intercepts."""

    vocabulary: DataFrame
    terms: list[str]
    idf: np.ndarray
    coefficients: np.ndarray

    def save(self, path: str) -> None:
        self.vocabulary.coalesce(1).write.mode("overwrite").parquet(f"{path}/vocabulary")
        spark = self.vocabulary.sparkSession
        rows = [(i, *map(float, row)) for i, row in enumerate(self.coefficients)]
        spark.createDataFrame(rows, _COEFFICIENTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/classifier")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "SentimentModel":
        vocabulary = spark.read.parquet(f"{path}/vocabulary")
        found = vocabulary.orderBy("term_no").select("term", "idf").collect()
        rows = spark.read.schema(_COEFFICIENTS).parquet(f"{path}/classifier").orderBy("slot").collect()
        return SentimentModel(vocabulary, [r.term for r in found], np.array([r.idf for r in found]), np.array([r[1:] for r in rows]))


_COEFFICIENTS = "slot int, " + ", ".join(f"{c} double" for c in SENTIMENT_LABELS)


class _Vocabulary:
    """Terms by number: words, and pairs of words as sorted keys."""

    def __init__(self, terms: list[str], idf: np.ndarray):
        self.idf = np.asarray(idf, float)
        split = [t.split(" ") for t in terms]
        self.words = {own[0]: i for i, own in enumerate(split) if len(own) == 1}
        self.members = {w: n for n, w in enumerate(dict.fromkeys(w for own in split if len(own) == 2 for w in own))}
        keys = np.array([self.members[own[0]] * len(self.members) + self.members[own[1]] for own in split if len(own) == 2], np.int64)
        order = np.argsort(keys)
        self.keys, self.numbers = keys[order], np.array([i for i, own in enumerate(split) if len(own) == 2], np.int64)[order]

    def weigh(self, joined: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sizes, slots, weights) of the known terms of rows of words, normalised TF-IDF."""
        found, known = _Words.of(joined), len(self.idf)
        names = found.known.to_pylist()
        word = np.fromiter((self.words.get(w, -1) for w in names), np.int64, len(names))[found.code]
        member = np.fromiter((self.members.get(w, -1) for w in names), np.int64, len(names))[found.code]
        at = found.pairs()
        at = at[(member[at] >= 0) & (member[at + 1] >= 0)]
        keys = member[at] * len(self.members) + member[at + 1]
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[place] == keys) if len(self.keys) else np.empty(0, np.int64)
        own = np.flatnonzero(word >= 0)
        cells = np.concatenate([found.row[own] * known + word[own], found.row[at[hit]] * known + (self.numbers[place[hit]] if len(hit) else hit)])
        cells, count = np.unique(cells, return_counts=True)
        row, slot = np.divmod(cells, max(1, known))
        raw = (1 + np.log(count)) * self.idf[slot]
        norm = np.sqrt(np.bincount(row, weights=raw * raw, minlength=len(joined)))
        return np.bincount(row, minlength=len(joined)), slot, raw / np.where(norm, norm, 1.0)[row]


def _words(text: str) -> Column:
    return F.regexp_extract_all(clean_text(F.col(text)), F.lit(WORD), F.lit(0))


def _vectors(docs: DataFrame, text: str, terms: list[str], idf: np.ndarray) -> DataFrame:
    """`docs` with sparse normalised TF-IDF as `slots` and `values`; row by row, nothing is shuffled.

    The vocabulary is bounded by `max_features` and goes along with the function."""
    vocabulary = _Vocabulary(ship(docs.sparkSession) and terms, idf)
    kept = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches, VECTOR_ROWS):
            sizes, slots, values = vocabulary.weigh(batch.column(batch.num_columns - 1))
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(slots, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(values))],
                names=[*kept, "slots", "values"])

    schema = docs.select(*kept).schema.add("slots", ArrayType(IntegerType())).add("values", ArrayType(DoubleType()))
    return docs.select(*kept, _joined(_words(text)).alias("__words")).mapInArrow(run, schema)


def train_sentiment(reviews: DataFrame, text: str = "review_text", label: str = "sentiment_label",
                    max_features: int = 5000, min_df: int = 2) -> SentimentModel:
    """Balanced multinomial logistic regression on TF-IDF of words and word pairs: the summed weighted
    log loss plus half the squared raw coefficients, with free intercepts."""
    labelled = reviews.where(F.col(label).isin(SENTIMENT_LABELS))
    vocab = build_vocabulary(labelled, text, max_features, min_df)
    found = vocab.select("term", "df").collect()  # at most max_features rows
    n_docs = labelled.count()
    spark = reviews.sparkSession
    vocabulary = spark.createDataFrame(
        [(i, r.term, r.df, n_docs) for i, r in enumerate(found)],
        "term_no int, term string, df bigint, n_docs bigint",
    ).withColumn("idf", F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1)
    terms = [r.term for r in found]
    idf = np.array([math.log((1 + n_docs) / (1 + r.df)) + 1 for r in found])
    weights = {r[label]: r.weight for r in class_weights(labelled, label).collect()}
    missing = [c for c in SENTIMENT_LABELS if c not in weights]
    if missing:
        raise ValueError(f"model is missing sentiment classes: {missing}")
    index = {c: float(i) for i, c in enumerate(SENTIMENT_LABELS)}
    rows = _vectors(dealt(labelled.select(F.col(text).alias("text"), F.col(label).alias("name"))), "text", terms, idf).select(
        "slots", "values", alias_lookup(F.col("name"), index).cast("int").alias("label"),
        alias_lookup(F.col("name"), weights).alias("weight"),
    )
    return SentimentModel(vocabulary, terms, idf, fit_multinomial(rows, len(terms), len(SENTIMENT_LABELS), 1.0 / n_docs))


def sentiment_probabilities(reviews: DataFrame, model: SentimentModel, text: str = "review_text") -> DataFrame:
    """`reviews` with `__probability`, an array in label order. Rows are dealt evenly over the tasks."""
    vocabulary, theta = _Vocabulary(model.terms, model.idf), model.coefficients
    names, words = ship(reviews.sparkSession) and reviews.columns, _joined(_words(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches, VECTOR_ROWS):
            sizes, slot, values = vocabulary.weigh(batch.column(batch.num_columns - 1))
            row = np.repeat(np.arange(batch.num_rows), sizes)
            p = softmax(logits_of(row, slot, values, batch.num_rows, theta) + theta[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(list(p), pa.list_(pa.float64()))], names=[*names, "__probability"])

    return dealt(reviews).select("*", words.alias("__words")).mapInArrow(run, StructType([*reviews.schema.fields]).add("__probability", ArrayType(DoubleType())))


def positivity(probabilities: Column) -> Column:
    """Positive plus half the neutral probability; classes in label order."""
    neutral, positive = F.get(probabilities, F.lit(1)), F.get(probabilities, F.lit(2))
    return clip01(positive + 0.5 * neutral)


def score_sentiment(reviews: DataFrame, model: SentimentModel | None, text: str = "review_text") -> DataFrame:
    """Add `label` and `score`; without a model the given label, and no score."""
    if model is None:
        label = F.col("sentiment_label") if "sentiment_label" in reviews.columns else F.lit("unknown")
        return reviews.withColumn("label", label).withColumn("score", F.lit(None).cast("double"))
    p = F.col("__probability")
    names = F.array(*[F.lit(c) for c in SENTIMENT_LABELS])
    return (
        sentiment_probabilities(reviews, model, text)
        .withColumn("label", F.get(names, F.array_position(p, F.array_max(p)).cast("int") - 1))
        .withColumn("score", positivity(p))
        .drop("__probability")
    )


def confusion(scored: DataFrame, truth: str, predicted: str) -> DataFrame:
    return scored.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def evaluate_sentiment(scored: DataFrame, truth: str = "sentiment_label", predicted: str = "label") -> DataFrame:
    """Accuracy, macro F1 over the labels that occur, F1 per class; 0 where undefined."""
    cells = confusion(scored, truth, predicted)
    n = F.col("n")
    hit = F.col("truth") == F.col("predicted")
    aggs = [F.sum(n).alias("total"), F.sum(F.when(hit, n).otherwise(0)).alias("hits")]
    for c in SENTIMENT_LABELS:
        aggs += [
            F.sum(F.when(hit & (F.col("truth") == c), n).otherwise(0)).alias(f"tp_{c}"),
            F.sum(F.when(F.col("truth") == c, n).otherwise(0)).alias(f"t_{c}"),
            F.sum(F.when(F.col("predicted") == c, n).otherwise(0)).alias(f"p_{c}"),
        ]
    f1 = {
        c: F.coalesce(F.try_divide(2.0 * F.col(f"tp_{c}"), F.col(f"t_{c}") + F.col(f"p_{c}")), F.lit(0.0))
        for c in SENTIMENT_LABELS
    }
    present = [
        F.when(F.col(f"t_{c}") + F.col(f"p_{c}") > 0, 1).otherwise(0) for c in SENTIMENT_LABELS
    ]
    return cells.agg(*aggs).select(
        F.try_divide(F.col("hits"), F.col("total")).alias("accuracy"),
        F.try_divide(sum(f1.values(), F.lit(0.0)), sum(present, F.lit(0))).alias("macro_f1"),
        *[f1[c].alias(f"f1_{c}") for c in SENTIMENT_LABELS],
    )
