"""SentencePiece encoding by the best-scoring segmentation, and decoding.

Pieces and scores are those of a model file; a text's encoding is the segmentation with the highest
sum of scores, of equal ones that with the fewest pieces. Characters that are no piece become
byte pieces. (For a model trained as BPE this objective is not the merge order of the library.)

Texts of more than CHUNK characters are split: each chunk yields a max-plus transfer matrix, whose entry
(i, j) is the best score from a cut i characters after the chunk's start to a cut j characters after its
end (a piece may reach over the end by less than its length). Matrices combine associatively; scanned from
the right they give every boundary's best score to the end, and then, from the left, its state. With
its two states known each chunk is traced back on its own.

No piece has a space mark after another character, so a chunk's matrix is made of the part before its
first such boundary, the words between, which are looked up, and the part after the last."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.shared import held
from riskloom.llm.whole_groups import group_starts, whole_groups
from riskloom.llm.words import REMEMBERED, parts
from riskloom.shipping import ship
from riskloom.sources.scratch import written

#: Characters of a chunk; a step that outweighs any number of pieces in a word; no way.
CHUNK, STEP, NONE = 32_768, 1 << 16, -(1 << 60)
#: Chunks of a giant text that are handed on at a time.
CUT = 32
_WORD = re.compile(" +[^ ]*|^[^ ]+")


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


class Pieces:
    """The pieces of a model with whole-number scores, the space mark written as a space."""

    def __init__(self, model: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model)
        self.pieces: dict[str, tuple[int, int]] = {}
        self.bytes_: dict[int, int] = {}
        self.content: dict[int, bytes] = {}
        for i in range(library.get_piece_size()):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.bytes_[int(piece[3:5], 16)] = i
                self.content[i] = bytes([int(piece[3:5], 16)])
            elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
                text = piece.replace("▁", " ")
                self.pieces[text] = (i, round(library.get_score(i)) * STEP - 1)
                self.content[i] = text.encode()
        if any(" " in p.lstrip(" ") for p in self.pieces):
            raise ValueError("a piece has a space mark after another character")
        self.longest = max(map(len, self.pieces))
        #: A tree of the pieces by character; under "" a piece's id and score.
        self.tree: dict = {}
        for piece, own in self.pieces.items():
            node = self.tree
            for letter in piece:
                node = node.setdefault(letter, {})
            node[""] = own
        # a byte costs more than any plain piece
        self.byte_score = (min(round(s / STEP) for _, s in self.pieces.values() if s > -(10**8) * STEP) - 10) * STEP - 1
        self.words: dict[str, tuple[int, bytes]] = {}

    def arcs(self, text: str, at: int) -> list[tuple[int, int, list[int]]]:
        """(length, score, ids) of what can begin at a place, the longest first."""
        found = []
        if text[at] not in self.pieces:
            raw = text[at].encode()
            found.append((1, self.byte_score * len(raw), [self.bytes_[b] for b in raw]))
        node = self.tree
        for end in range(at + 1, min(at + self.longest, len(text)) + 1):
            node = node.get(text[end - 1])
            if node is None:
                break
            if "" in node:
                found.append((end - at, node[""][1], [node[""][0]]))
        return found[::-1]

    def trace(self, text: str, start: int, end: int) -> tuple[int, list[int]]:
        """The best way from start to end: (score, ids); of equal ones, long pieces first."""
        best, step = {end: 0}, {}
        for at in range(end - 1, start - 1, -1):
            top = None
            for size, score, ids in self.arcs(text, at):
                rest = best.get(at + size)
                if rest is not None and (top is None or score + rest > top):
                    top, step[at] = score + rest, (size, ids)
            if top is not None:
                best[at] = top
        ids, at = [], start
        while at < end:
            size, own = step[at]
            ids += own
            at += size
        return best[start], ids

    def word(self, text: str) -> tuple[int, bytes]:
        """A word's best score and its ids in bytes."""
        found = self.words.get(text)
        if found is None:
            if len(self.words) >= 2 * REMEMBERED:
                self.words.clear()
            found = self.words[text] = self._word(text)
        return found

    def _word(self, text: str) -> tuple[int, bytes]:
        """What `trace` gives for the whole of a text, without its lists."""
        n, tree = len(text), self.tree
        best, stop, own = [0] * (n + 1), [0] * n, [-1] * n
        for at in range(n - 1, -1, -1):
            node = tree.get(text[at])
            if node is None or "" not in node:
                top, stop[at] = self.byte_score * len(text[at].encode()) + best[at + 1], at + 1
            else:
                top = NONE
            end = at + 1
            while node is not None:
                hit = node.get("")
                if hit is not None:
                    total = hit[1] + best[end]
                    if total >= top:
                        top, stop[at], own[at] = total, end, hit[0]
                if end == n:
                    break
                node = node.get(text[end])
                end += 1
            best[at] = top
        ids, at = array("i"), 0
        while at < n:
            if own[at] >= 0:
                ids.append(own[at])
            else:
                ids.extend(self.bytes_[b] for b in text[at].encode())
            at = stop[at]
        return best[0], ids.tobytes()

    def reach(self, text: str, start: int, end: int) -> np.ndarray:
        """Best scores from a cut at `start` to the first cut at `end` or up to a piece after it."""
        out = np.full(self.longest, NONE, np.int64)
        best = {start: 0}
        for at in range(start, end):
            if at in best:
                for size, score, _ in self.arcs(text, at):
                    to, value = at + size, best[at] + score
                    if value > best.get(to, NONE):
                        best[to] = value
        for at in range(end, end + self.longest):
            out[at - end] = best.get(at, NONE)
        return out

    def matrix(self, text: str, end: int) -> np.ndarray:
        """The transfer matrix of the first `end` characters; the rest is what follows them."""
        cuts = [m.start() for m in re.finditer("(?<=[^ ]) ", text[:end])]
        states = min(self.longest, end)
        out = np.full((self.longest, self.longest), NONE, np.int64)
        if not cuts:
            for i in range(states):
                out[i] = self.reach(text, i, end)
        else:
            first, last = cuts[0], cuts[-1]
            middle = sum(self.word(w)[0] for w in _WORD.findall(text[first:last]))
            after = self.reach(text, last, end)
            for i in range(min(states, first + 1)):
                before = self.reach(text, i, first)[0]
                out[i] = np.where((after > NONE) & (before > NONE), before + middle + after, NONE)
        for i in range(end, self.longest):  # a piece over the whole of a short chunk
            out[i, i - end] = 0
        return out

    def encode(self, text: str) -> bytes:
        return b"".join([self.word(w)[1] for w in _WORD.findall(" " + text)]) if text else b""

    def between(self, text: str, start: int, end: int) -> bytes:
        """Ids of the best way between two cuts, word by word where it can be."""
        cuts = [m.start() + start + 1 for m in re.finditer("(?<=[^ ]) ", text[start + 1 : end])] if end > start else []
        # a space right after the start is a boundary unless the start is one too
        if end > start + 1 and text[start + 1] == " " and text[start] != " ":
            cuts = [start + 1, *cuts]
        if not cuts:
            return packed(self.trace(text, start, end)[1]) if end > start else b""
        middle = [self.word(w)[1] for w in _WORD.findall(text[cuts[0] : cuts[-1]])]
        return b"".join([packed(self.trace(text, start, cuts[0])[1]), *middle, packed(self.trace(text, cuts[-1], end)[1])])

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.content.__getitem__, np.frombuffer(ids, "<i4").tolist())).decode()[1:]


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product: first `a`, then `b`."""
    total = a[:, :, None] + b[None]
    return np.where((a[:, :, None] > NONE) & (b[None] > NONE), total, NONE).max(axis=1)


def states(matrices: list[np.ndarray]) -> list[int]:
    """The state at every chunk's start and at the text's end, which is 0 like the first."""
    n = matrices[0].shape[0]
    ahead = np.full((n, 1), NONE, np.int64)
    ahead[0] = 0
    behind = [ahead]  # best score from each state to the end
    for m in reversed(matrices):
        behind.append(combine(m, behind[-1]))
    behind.reverse()
    at, out = 0, [0]
    for m, rest in zip(matrices, behind[1:]):
        total = np.where((m[at] > NONE) & (rest[:, 0] > NONE), m[at] + rest[:, 0], NONE)
        at = int(np.flatnonzero(total == total.max())[-1])
        out.append(at)
    return out


def pieces_of(model: str) -> Pieces:
    """A worker reads the model once and remembers words from task to task."""
    return held(("pieces", model), lambda: Pieces(model))


def encode(docs: DataFrame, model: str, check: bool = False) -> DataFrame:
    """(doc_id, ids) of every row; ids are little-endian 32-bit whole numbers. With `check` also
    `decoded`, whether decoding them gives the text back.

    Uses doc_id and text, whatever else there is. Null and empty texts have no ids. Repeated rows
    are encoded each, no rows give no rows."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # the text with its first mark is what is split
    long = F.length("text") >= CHUNK

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in parts(batches):
            texts = batch.column(1).to_pylist()
            ids = [pieces.encode(t) for t in texts]
            same = [pieces.decode(i) == t for t, i in zip(texts, ids)] if check else [None] * len(ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(same, pa.bool_())], names=["doc_id", "ids", "decoded"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in parts(batches, 256):
            same = [pieces.decode(i) == t for t, i in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(same, pa.bool_())], names=["doc_id", "ids", "decoded"])

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            found = [pieces.matrix(t, min(len(t), CHUNK)).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["h", "k", "matrix"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["h"]):
            h, k, raw = table.column("h").to_numpy(), table.column("k").to_numpy(), table.column("matrix").to_pylist()
            begin, end = np.zeros(len(h), np.int32), np.zeros(len(h), np.int32)
            starts = group_starts(table, ["h"]).tolist()
            for s, e in zip(starts, [*starts[1:], len(h)]):
                found = [np.frombuffer(m, np.int64) for m in raw[s:e]]
                side = int(len(found[0]) ** 0.5)
                at = states([m.reshape(side, side) for m in found])
                begin[s:e], end[s:e] = at[:-1], at[1:]
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(k), pa.array(begin), pa.array(end)], names=["h", "k", "begin", "end"])

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            found = [pieces.between(t, b, min(len(t), CHUNK) + e) for t, b, e in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["h", "k", "ids"])

    longest = pieces_of(model).longest

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text once through: the cost is its length, not its length times its chunks."""
        for batch in batches:
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                marked = " " + text
                for at in range(0, len(marked), CHUNK * CUT):
                    places = range(at, min(at + CHUNK * CUT, len(marked)), CHUNK)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([h] * len(places), pa.int64()), pa.array([p // CHUNK for p in places], pa.int64()),
                         pa.array([marked[p : p + CHUNK + longest] for p in places], pa.string())], names=["h", "k", "part"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["h"]):
            starts, found = group_starts(table, ["h"]).tolist(), table.column("ids").to_pylist()
            ends = [*starts[1:], table.num_rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(table.column("h").to_numpy()[starts]), pa.array([b"".join(found[s:e]) for s, e in zip(starts, ends)], pa.binary())], names=["h", "ids"])

    giants = rows.filter(long).select("doc_id", "text", F.xxhash64("text").alias("h"))
    split = giants.select("h", "text").dropDuplicates(["h"]).mapInArrow(cut, "h bigint, k bigint, part string")
    chunks = written(split.repartition("h", "k"), "unigram-chunks")
    matrices = chunks.mapInArrow(transfer, "h bigint, k bigint, matrix binary")
    cuts = matrices.repartition("h").sortWithinPartitions("h", "k").mapInArrow(scan, "h bigint, k bigint, begin int, end int")
    traced = chunks.join(cuts, ["h", "k"]).select("h", "k", "part", "begin", "end").mapInArrow(trace, "h bigint, k bigint, ids binary")
    whole = traced.repartition("h").sortWithinPartitions("h", "k").mapInArrow(joined, "h bigint, ids binary")
    done = f"doc_id {kind}, ids binary, decoded boolean"
    plain = rows.filter(~long).mapInArrow(short, done)
    pairs = giants.join(whole, "h")
    rest = pairs.select("doc_id", "text", "ids").mapInArrow(compare, done) if check else pairs.select(
        "doc_id", "ids", F.lit(None).cast("boolean").alias("decoded"))
    out = plain.union(rest)
    return out if check else out.drop("decoded")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of encoded rows; null ids are an empty text."""
    ship(encoded.sparkSession)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in parts(batches):
            texts = [pieces.decode(i or b"") for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, decoded) of every row: the number and checksum of its ids, and
    whether decoding them gives the text back."""
    return encode(docs, model, check=True).select(
        "doc_id", (F.length("ids") / 4).cast("bigint").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), "decoded")
