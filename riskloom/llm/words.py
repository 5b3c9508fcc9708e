"""Words and hashed word shingles of whole texts, inside Arrow tasks.

A word is a run of bytes other than ASCII white space (`[^\\x20\\x09-\\x0D]+`), which is what
`bytes.split()` gives. Hashes are 64 bits wide."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from riskloom.llm.shared import trim

#: How many distinct words a worker remembers before it starts anew.
REMEMBERED = 100_000


class WordHashes(dict):
    """The hash of a word, remembered while the same words keep coming."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


@functools.lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    """A worker's own, kept from task to task."""
    return WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each window of `width` words; none if there are fewer words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = mixed(total + hashes[k : k + n] + np.uint64(0x9E3779B97F4A7C15))
    return total


def parts(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what a task builds for one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    trim()


def byte_parts(batches: Iterator[pa.RecordBatch], column: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Smaller batches of about `size` bytes in a text column; a text beyond that is alone in its batch."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at, n = 0, batch.num_rows
        total = np.cumsum(sizes)
        while at < n:
            before = int(total[at - 1]) if at else 0
            end = max(int(np.searchsorted(total, before + size, "right")), at + 1)
            yield batch.slice(at, end - at)
            at = end
    trim()


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    return pc.fill_null(column, "").cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's bigint."""
    return x.view(np.int64)
