"""Token ids in binary shards, with constant-time access by document key.

A shard is two files. `<name>.ids` holds the ids of its documents one after the other, two or
four little-endian bytes each. `<name>.index` is an `.npz` table: a minimal perfect hash from
keys to slots, and for each slot a 32-bit fingerprint of its key, the offset of its first id and
its number of ids. A key is a document id and how often the id came before, so repeated ids keep
all their rows; a null id is a key of its own. Documents are range-partitioned and sorted by id,
null first, so shard after shard the ids ascend.

A task names its files after its attempt and returns them in a manifest row, which Spark commits:
files of lost or repeated attempts are never listed."""

from __future__ import annotations

import functools
import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.perfect_hash import PerfectHash, fingerprint, key_hash
from riskloom.llm.words import text_bytes
from riskloom.shipping import ship
from riskloom.sources.scratch import scratch_path, written

#: A character that is a word and a token of its own; words in a call; texts whose words are learnt at once.
_MARK, _GROUP, _LEARN = b"\x7f", 20_000, 1024
#: Ids that are read from a file at once; words a worker remembers, about 200 bytes each.
_READ, _KNOWN = 1 << 20, 300_000
#: Signs that may end a word; "<" may begin a special token.
_STOPS = b"!\"#$%&'()*+,-./:;=>?@[\\]^_`{|}~"
_MANIFEST = "shard int, path string, width int, n_docs bigint, n_ids bigint"
_FOUND = "shard int, doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint"


class Encoder:
    """Ids of whole texts. If the tokenizer drops white space, words are encoded on their own,
    remembered, and put together again."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[bytes, bytes] = {}
        self.ends = np.zeros(self.library.get_vocab_size(), bool)
        for token, i in self.library.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        mark = self._ids(_MARK.decode())
        self.mark = mark[0] if len(mark) == 1 else None
        self.by_word = self.mark is not None and self._ids(" a \n b\t") == self._ids("a") + self._ids("b")

        #: ASCII letters go to the model itself if that gives the same ids as the whole way.
        self.direct = self.by_word and all(self._word(w) == self._ids(w) for w in ("Worthily", "a", "xqz", "lettersofaword"))

    def _word(self, word: str) -> list[int]:
        return [token.id for token in self.library.model.tokenize(word.lower())]

    def _ids(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, self.dtype).tobytes()

    def _split(self, group: list[bytes], ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> bool:
        """Share the ids out to the words; False if they are not as many stretches as words."""
        if len(start) != len(group):
            return False
        whole, width = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
        self.known.update(zip(group, [whole[s:e] for s, e in zip((start * width).tolist(), (end * width).tolist())]))
        return True

    def _learn(self, words: set[bytes]) -> None:
        """Many words in one call: words of letters are one token run each, and its last id is a
        word end; between other words stands a mark. Letters and the signs that end them never
        merge, so those are put together from their parts."""
        plain: list[bytes] = []
        tails: set[bytes] = set()
        cores: set[bytes] = set()
        ended, marked, odd = [], [], []
        for word in words:
            core = word.rstrip(_STOPS)
            if core.isalpha() or (not core.isascii() and core.decode().lower().isalpha()):
                if len(core) == len(word):
                    plain.append(word)
                else:
                    ended.append((word, core, word[len(core) :]))
                    cores.add(core)
                    tails.add(ended[-1][2])
            else:
                (odd if _MARK in word or b"<" in word else marked).append(word)
        plain += [c for c in cores if c not in words and c not in self.known]
        marked += [t for t in tails if t not in words and t not in self.known]
        if self.direct:
            tokenize, pack = self.library.model.tokenize, struct.Struct
            kind = self.dtype.char
            for word in filter(bytes.isascii, plain):
                ids = [token.id for token in tokenize(word.lower().decode())]
                self.known[word] = pack(f"<{len(ids)}{kind}").pack(*ids)
            plain = [w for w in plain if not w.isascii()]
        for at in range(0, len(plain), _GROUP):
            group = plain[at : at + _GROUP]
            ids = np.array(self._ids(b" ".join(group).decode()), np.int64)
            end = np.flatnonzero(self.ends[ids]) + 1
            if not self._split(group, ids, np.concatenate([[0], end[:-1]]), end):
                marked += group
        for at in range(0, len(marked), _GROUP):
            group = marked[at : at + _GROUP]
            ids = np.array(self._ids((b" " + _MARK + b" ").join(group).decode()), np.int64)
            stop = np.flatnonzero(ids == self.mark)
            if not self._split(group, ids, np.concatenate([[0], stop + 1]), np.append(stop, len(ids))):
                odd += group
        for word in odd:  # may hold a special token
            self.known[word] = self._bytes(self._ids(word.decode()))
        known = self.known
        for word, core, tail in ended:
            known[word] = known[core] + known[tail]

    @staticmethod
    def _words(text: bytes) -> list[bytes]:
        """Words in lower case as the tokenizer does it; letters beyond ASCII are left to it, and so are words that may
        hold a special token, which is matched as it is written."""
        if not text.isascii():
            return text.split()
        if b"<" not in text:
            return text.lower().split()
        return [w if b"<" in w else w.lower() for w in text.split()]

    def encode(self, text: bytes) -> bytes:
        if not self.by_word:
            return self._bytes(self._ids(text.decode()))
        words = self._words(text)
        known = self.known
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            if len(known) > _KNOWN:
                known.clear()
            self._learn({w for w in words if w not in known})
            return b"".join(map(known.__getitem__, words))

    def learn(self, texts: list[bytes]) -> None:
        """Look up the new words of many texts at once."""
        if self.by_word:
            if len(self.known) > _KNOWN:
                self.known.clear()
            new: set[bytes] = set()
            for text in texts:
                new.update(self._words(text))
            self._learn(new.difference(self.known))


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """A worker reads the tokenizer once and remembers words from task to task."""
    return Encoder(path)


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the shards; returns the manifest (shard, path, width, n_docs, n_ids).

    Whole texts are encoded, a null text as an empty one, and each document ends with `end_id`.
    Uses doc_id and text; other columns are ignored. Rows with the same id keep each its place,
    ordered by their text: one id, even if a third of all rows have it, may fill several shards, and in each of them
    its rows are counted anew. An empty table gives an empty manifest."""
    spark = ship(docs.sparkSession)
    folder = folder or scratch_path(spark, "token-files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard = None, TaskContext.get().partitionId()
        ids, absent, lengths = [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            if encoder is None:
                encoder = encoder_of(tokenizer)
                end = encoder._bytes([end_id])
                width = encoder.dtype.itemsize
                fs, base = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
                fs.create_dir(base, recursive=True)
                name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
                out = fs.open_output_stream(f"{base}/{name}.ids")
            column = batch.column(0)
            absent.append(np.asarray(column.is_null()))
            ids.append(np.asarray(column.fill_null(0).cast(pa.int64())))
            texts = text_bytes(batch.column(1))
            for at in range(0, len(texts), _LEARN):
                encoder.learn(texts[at : at + _LEARN])
                for text in texts[at : at + _LEARN]:
                    payload = encoder.encode(text)
                    out.write(payload + end)
                    lengths.append(len(payload) // width + 1)
        if encoder is None:
            return
        out.close()
        ids, absent, counts = np.concatenate(ids), np.concatenate(absent), np.array(lengths, np.int64)
        first = np.concatenate([[True], (ids[1:] != ids[:-1]) | (absent[1:] != absent[:-1])])
        place = np.arange(len(ids))
        occurrence = place - np.maximum.accumulate(np.where(first, place, 0))
        hashes = key_hash(ids, occurrence, absent)
        index = PerfectHash.build(hashes)
        slot = index.find(hashes)
        table = {k: np.empty(len(ids), kind) for k, kind in (("prints", np.uint32), ("offsets", np.int64), ("lengths", np.int64))}
        for name_, value in (("prints", fingerprint(hashes)), ("offsets", np.cumsum(counts) - counts), ("lengths", counts)):
            table[name_][slot] = value
        packed = io.BytesIO()
        np.savez(packed, **index.to_arrays(), **table, ids=ids, absent=absent, occurrence=occurrence)
        with fs.open_output_stream(f"{base}/{name}.index") as sink:
            sink.write(packed.getvalue())
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "path": [f"{folder}/{name}"], "width": pa.array([width], pa.int32()),
            "n_docs": pa.array([len(ids)], pa.int64()), "n_ids": pa.array([int(counts.sum())], pa.int64())})

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    # an id is dealt out by how its texts begin, and equal rows by where they came from
    begin = slim.withColumn("begins", F.substring("text", 1, 64)).withColumn("came", F.monotonically_increasing_id())
    ordered = begin.repartitionByRange("doc_id", "begins", "came").sortWithinPartitions("doc_id", "text").select("doc_id", "text")
    return written(ordered.mapInArrow(run, _MANIFEST), "token-manifest")


class Shard:
    """One shard, opened for reading by key."""

    def __init__(self, path: str, width: int):
        fs, base = pyarrow.fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        with fs.open_input_stream(f"{base}.index") as source:
            table = np.load(io.BytesIO(source.read()))
            self.table = {k: table[k] for k in table.files}
        self.index = PerfectHash(self.table["sizes"], self.table["words"], self.table["before"])
        self.payload = fs.open_input_file(f"{base}.ids")
        self.dtype = np.dtype(f"<u{width}")

    def locate(self, ids, occurrence, absent) -> tuple[np.ndarray, np.ndarray]:
        """Offset and number of ids of each key; -1 and 0 for keys that are not in the shard."""
        hashes = key_hash(np.asarray(ids, np.int64), np.asarray(occurrence), np.asarray(absent, bool))
        slot = self.index.find(hashes)
        known = slot >= 0
        known[known] = self.table["prints"][slot[known]] == fingerprint(hashes[known])
        at = np.where(known, slot, 0)
        return np.where(known, self.table["offsets"][at], -1), np.where(known, self.table["lengths"][at], 0)

    def read(self, offset: int, length: int) -> np.ndarray:
        width = self.dtype.itemsize
        return np.frombuffer(self.payload.read_at(length * width, offset * width), self.dtype)


def checksums(shard: Shard, offsets: list[int], lengths: list[int]) -> list[int]:
    """CRC32 of each stretch of ids as 32-bit numbers; stretches that follow each other are read together, `_READ` ids at a time."""
    out, at = [], 0
    while at < len(offsets):
        first, stop = offsets[at], offsets[at] + lengths[at]
        end = at + 1
        while end < len(offsets) and offsets[end] == stop and stop + lengths[end] - first <= _READ:
            stop += lengths[end]
            end += 1
        block = memoryview(shard.read(first, stop - first).astype("<u4")).cast("B")
        for o, n in zip(offsets[at:end], lengths[at:end]):
            out.append(zlib.crc32(block[4 * (o - first) : 4 * (o - first + n)]))
        at = end
    return out


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, looked up by key in the files.

    `start` counts the ids of all documents before it, over all shards."""
    ship(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["path"], row["width"])
                ids, absent = shard.table["ids"], shard.table["absent"]
                offsets, lengths = shard.locate(ids, shard.table["occurrence"], absent)
                if (offsets < 0).any():
                    raise ValueError(f"{row['path']}: a key of the shard is not found by its index")
                for at in range(0, len(ids), 10_000):
                    part = slice(at, at + 10_000)
                    crc = checksums(shard, offsets[part].tolist(), lengths[part].tolist())
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array([row["shard"]] * len(crc), pa.int32()),
                        "doc_id": pa.array(ids[part], pa.int64(), mask=absent[part]),
                        "local_start": pa.array(offsets[part]), "n_tokens": pa.array(lengths[part]),
                        "ids_crc32": pa.array(crc, pa.int64())})

    # one row a shard: the running total runs over the manifest alone
    starts = manifest.select("shard", (F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids")).alias("base"))
    spread = manifest.repartition(max(1, manifest.count()), "shard")
    found = spread.mapInArrow(run, _FOUND)
    return found.join(F.broadcast(starts), "shard").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
