"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to SYMBOLS symbols. All strings within one edit of a reduced word (each symbol deleted,
replaced by each symbol, each symbol put in at each place, and the word itself) are looked up among
the reduced words. An edit in one half of a word leaves the other half's letters as they are: these, unreduced, are part
of what is looked up, so that short reduced words do not bring together all words of a language. What is found is
verified on the words themselves.

A reduced word's hash is a polynomial, so that the hash of each of its neighbours is a sum of a beginning and
an end; equal strings have equal hashes, so none is missed. Words under a key with more than HOT words are looked
up by the words with one letter left out instead: few words share such a string, whatever the reduced alphabet does."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.words import byte_parts, mixed, signed
from riskloom.shipping import ship
from riskloom.sources.scratch import written

SYMBOLS, HOT = 3, 256
#: Words a task counts before it hands them on; neighbours it makes at a time; words of a task that makes them.
HELD, MADE, TASK_WORDS = 200_000, 1 << 20, 20_000
_RUN = re.compile("[a-zÀ-ÿ]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def counted_words(docs: DataFrame, slip: int = 97, shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, n): words of `shortest` letters that occur `least` times over all documents.

    A word is a run of letters with A-Z in lower case. Where `slip` divides the CRC-32 of `<doc_id>:<word>`, the
    letter at the CRC modulo the length is left out. A null text has no words, a null id counts as empty; other columns
    are ignored. Counts are added up in the task before they are shuffled."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def packed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return batch

        for batch in byte_parts(batches, "text"):
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if not text:
                    continue
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                # bytes lower-case A-Z alone
                for word, n in Counter(_RUN.findall(text.encode().lower().decode())).items():
                    crc = zlib.crc32(word.encode(), start)
                    if crc % slip == 0:
                        at = crc % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= shortest:
                        seen[word] += n
            if len(seen) > HELD:
                yield packed()
        yield packed()

    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE)]))


def _reduced(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of each letter's symbol, code of each symbol)."""
    symbols = mixed(np.arange(1, SYMBOLS + 1, dtype=np.uint64))
    return symbols[(mixed(codes) % np.uint64(SYMBOLS)).astype(np.int64)], symbols


def _key(hashes: np.ndarray, length: int, half: np.ndarray) -> np.ndarray:
    return mixed(mixed(hashes + np.uint64(length)) + half)


def _halves(codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers for the letters that words of `length` have in their first half, and in the rest, if these ends are of such a word."""
    before, after = length // 2, length - length // 2
    powers = _powers(max(before, after))
    first = (mixed(codes[:, :before]) * powers[:before]).sum(1, dtype=np.uint64)
    last = (mixed(codes[:, codes.shape[1] - after :]) * powers[:after]).sum(1, dtype=np.uint64) if after <= codes.shape[1] else np.zeros(len(codes), np.uint64)
    return mixed(first + np.uint64(1)), mixed(last + np.uint64(2))


def own_keys(codes: np.ndarray) -> np.ndarray:
    """The two keys of each word of one length: its reduced form with its first letters, and with its last."""
    reduced, _ = _reduced(codes)
    hashes = (reduced * _powers(codes.shape[1])[:-1]).sum(1, dtype=np.uint64)
    return np.stack([_key(hashes, codes.shape[1], half) for half in _halves(codes, codes.shape[1])], axis=1)


def neighbour_keys(codes: np.ndarray) -> np.ndarray:
    """The keys of everything within one edit of the reduced form of each word; of equal keys all but one are 0."""
    n, length = codes.shape
    reduced, symbols = _reduced(codes)
    powers = _powers(length + 1)
    total = np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(reduced * powers[:length], axis=1, dtype=np.uint64)], axis=1)
    whole = total[:, -1:]

    def keys(hashes: np.ndarray, size: int) -> np.ndarray:
        """Of edits at each place that give words of `size`: an edit in the first half leaves the other letters alone."""
        first, last = _halves(codes, size)
        half = np.where(np.arange(hashes.shape[1]) >= size // 2, first[:, None], last[:, None])
        return _key(hashes, size, half if hashes.ndim == 2 else half[:, :, None]).reshape(n, -1)

    deleted = total[:, :-1] + (whole - total[:, 1:]) * _INVERSE
    replaced = (whole - reduced * powers[:length])[:, :, None] + (powers[:length, None] * symbols)[None]
    put_in = (total + (whole - total) * _BASE)[:, :, None] + (powers[: length + 1, None] * symbols)[None]
    found = [keys(deleted, length - 1), keys(replaced, length), keys(put_in, length + 1)]
    found = np.sort(np.concatenate(found, axis=1), axis=1)
    found[:, :-1][found[:, 1:] == found[:, :-1]] = 0
    return found


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, code points) of the words of one length, so many that their neighbours stay bounded."""
    words = batch.column("word").to_pylist()
    sizes = np.array([len(w) for w in words], np.int64)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        step = max(1, MADE // (size * (2 * SYMBOLS + 1)))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            codes = np.frombuffer("".join(words[i] for i in part).encode("utf-32-le"), np.uint32).reshape(len(part), size)
            yield part, codes.astype(np.uint64)


def _keys(batches: Iterator[pa.RecordBatch], make) -> Iterator[pa.RecordBatch]:
    """(key, side, and the columns of the words): one row for each key, `side` being its column."""
    for batch in batches:
        for rows, codes in _by_length(batch):
            keys = make(codes)
            row, side = np.nonzero(keys)
            own = batch.take(pa.array(rows[row]))
            yield pa.RecordBatch.from_arrays([pa.array(signed(keys[row, side])), pa.array(side.astype(np.int32)), *own.columns],
                                             names=["key", "side", *batch.schema.names])


def _variants(words: DataFrame, column: str) -> DataFrame:
    """Each word whole and with each letter left out once."""
    word = F.col(column)
    left_out = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(
        F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return words.select("*", F.explode(F.array_distinct(F.concat(F.array(word), left_out))).alias("variant"))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best) of every word of (word, n) with a word one edit away: how many there are, and (-n, word) of the one
    with the greatest count, the first of those in code-point order."""
    ship(words.sparkSession)
    made = words.select("word").repartition(max(1, words.count() // TASK_WORDS), "word")
    made = made.mapInArrow(lambda b: _keys(b, neighbour_keys), "key bigint, side int, word string").drop("side")
    own = written(words.mapInArrow(lambda b: _keys(b, own_keys), "key bigint, side int, word string, n bigint"), "spelling-keys")
    crowded = own.groupBy("key").agg(F.count(F.lit(1)).alias("words")).filter(F.col("words") > HOT)
    hot = written(own.join(crowded, "key", "left_semi").select("word").distinct(), "spelling-hot")
    any_hot = not hot.isEmpty()
    targets = (own.join(hot, "word", "left_anti") if any_hot else own).select("key", "side", F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    # the reduced vocabulary, two rows a word, is the smaller side by far. A pair that agrees in the whole first half is
    # found by its first letters, any other by its last: so once
    begins = F.expr("substring(word, 1, length(near_word) div 2)") == F.expr("substring(near_word, 1, length(near_word) div 2)")
    once = (F.col("side") == 0) == begins
    pairs = made.join(targets.hint("shuffle_hash"), "key").filter((F.levenshtein("word", "near_word", 1) == 1) & once)
    pairs = pairs.select("word", "near_word", "near_n")
    if any_hot:
        side = _variants(words.join(hot, "word", "left_semi").select(F.col("word").alias("near_word"), "n"), "near_word")
        side = side.select("variant", "near_word", F.col("n").alias("near_n"))
        more = _variants(words.select("word"), "word").join(side, "variant").filter(F.levenshtein("word", "near_word", 1) == 1)
        pairs = pairs.unionByName(more.select("word", "near_word", "near_n").distinct())
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near_word").alias("word")))
    return pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain of (word, form) ends. Each round doubles what a pointer spans; a chain is
    short, as counts at least double with each step."""
    pointers = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = pointers.select(F.col("word").alias("via"), F.col("root").alias("further"))
        pointers = written(pointers.join(ahead, F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if pointers.filter("moved").isEmpty():
            return pointers.select("word", "root")
        pointers = pointers.select("word", "root")


def spelling_groups(docs: DataFrame, slip: int = 97, shortest: int = 5, least: int = 3, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every counted word.

    Two words are near if one letter is put in, left out or replaced. A word's form is its near word of the greatest
    count (ties: the first in code-point order) if that is `ratio` times its own or more, else null; its root is where its forms lead to,
    the word itself without a form. No rows or only null texts give no rows."""
    words = written(counted_words(docs, slip, shortest, least), "spelling-words")
    near = written(near_words(words), "spelling-near")
    judged = words.join(near, "word", "left").withColumn("has", F.coalesce(-F.col("best.less") >= ratio * F.col("n"), F.lit(False)))
    judged = written(judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("has"), F.col("best.word")).alias("form"),
        F.when(F.col("has"), -F.col("best.less")).alias("form_n")), "spelling-forms")
    ends = roots(judged.filter(F.col("form").isNotNull()))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
