"""Token counts: lengths of encoded texts, without keeping the tokens.

Arrow batches arrive bounded by bytes. Every text, however long, is cut before each run of
spaces: no piece of the model has a space mark after another character, so no merge crosses
such a cut, and the cuts' counts add up to the library's count of the whole text. The cuts of
a batch are gathered, those not seen before are encoded in groups of about the same number of
bytes, and only their lengths are kept."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.words import REMEMBERED, parts
from riskloom.shipping import ship

#: Cut texts are handed to the library in groups of so many characters.
GROUP_CHARS = 1 << 18
_CUT = re.compile(" +[^ ]*")


class PieceCounter:
    """Lengths of encodings under a SentencePiece model, by safe cuts."""

    def __init__(self, model: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = (self.library.id_to_piece(i) for i in range(self.library.get_piece_size()))
        #: False if some piece spans a cut: then texts go to the library whole.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.known: dict[str, int] = {}

    def _encode(self, parts: list[str]) -> list[int]:
        """Groups balanced by characters; a part beyond a group's size is alone in it."""
        counts, group, held = [], [], 0
        for part in parts:
            if group and held + len(part) > GROUP_CHARS:
                counts += map(len, self.library.encode(group, num_threads=1))
                group, held = [], 0
            group.append(part)
            held += len(part)
        return counts + list(map(len, self.library.encode(group, num_threads=1))) if group else counts

    def count(self, texts: list[str]) -> list[int]:
        if not self.cuts:
            return self._encode(texts)
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        totals = []
        for text in texts:
            if not text:
                totals.append(0)
                continue
            # the model puts one space mark before a text, so each cut gives up its first space;
            # a mark that stands in the text is a space to the model
            cuts = _CUT.findall(" " + text.replace("▁", " "))
            new = [c for c in set(cuts) if c not in known]
            if new:
                known.update(zip(new, self._encode([c[1:] for c in new])))
                known[" "] = 1  # a lone mark; as a text it would be empty
            totals.append(sum(map(known.__getitem__, cuts)))
        return totals


@functools.lru_cache(maxsize=1)
def counter_of(model: str) -> PieceCounter:
    """A worker reads the model once and remembers cuts from task to task."""
    return PieceCounter(model)


def count_tokens(docs: DataFrame, model: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row for each input row, ids as given.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows are counted each; a null id
    stays null; other columns are ignored, whatever their names; no rows give no rows."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(model)
        for batch in parts(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts = counter.count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    counted = slim.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
