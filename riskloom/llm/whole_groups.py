"""Whole groups out of a sorted stream of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where each run of equal keys begins."""
    n = table.num_rows
    new = np.zeros(n, bool)
    if n:
        new[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 1) -> Iterator[pa.Table]:
    """Tables that hold whole groups only, of `rows` rows or a little more, from batches sorted
    by non-null number keys. What is kept back is one unfinished group and one batch."""
    held: list[pa.Table] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.concat_tables(held)
        last = int(group_starts(table, keys)[-1])
        held, count = [table.slice(last)], table.num_rows - last
        if last:
            yield table.slice(0, last)
    if held:
        yield pa.concat_tables(held)
