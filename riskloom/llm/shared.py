"""Tables in the shared folder, read whole inside tasks, and what a worker holds of them from task to task; for
tables of a bounded size."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq

from riskloom.sources.mapped import located, read_mapped, write_mapped  # noqa: F401


def read_table(path: str, columns: list[str] | None = None) -> pa.Table:
    """All rows of a folder that Spark has written; columns that are read one by one have the same order."""
    fs, base = located(path)
    return pq.read_table(base, columns=columns, filesystem=fs)


def read_batches(path: str, columns: list[str] | None = None, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The rows of `read_table` in its order, a few at a time."""
    fs, base = located(path)
    for file in sorted(pq.ParquetDataset(base, filesystem=fs).files):
        with fs.open_input_file(file) as source:
            yield from pq.ParquetFile(source).iter_batches(rows, columns=columns)


_HELD: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], object]):
    """A worker's large object, made once; it holds one at a time."""
    if key not in _HELD:
        let_go()
        _HELD[key] = make()
        gc.collect()
        trim()
    return _HELD[key]


def let_go() -> None:
    """Give back what another operator's tasks have left in this worker: workers outlive their stages."""
    if _HELD:
        _HELD.clear()
        gc.collect()
        trim()


def trim() -> None:
    """Give freed memory back to the system: idle workers stay for a while."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass
