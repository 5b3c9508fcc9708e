"""Multinomial logistic regression with a penalty on raw coefficients and a free intercept.

The minimiser is a limited-memory quasi-Newton method, scaled by the curvature of each coefficient. Rows are packed into files of
the shared folder, which tasks map. Few rows are fitted in one task. Otherwise each evaluation is one Spark job: every task sums
loss and gradient of its files, many sums are added up in steps, and the driver gets a bounded number of vectors of the
size of the coefficients."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from riskloom.shipping import ship
from riskloom.sources.mapped import read_mapped, write_mapped
from riskloom.sources.scratch import scratch_path

MEMORY, MAX_STEPS, GRADIENT = 100, 500, 1e-8
#: Partial sums that may be added up at once.
SUMS = 64
#: Values of sparse rows that one task fits, and those of a file (24 bytes each).
HELD_VALUES, FILE_VALUES = 4_000_000, 250_000


def softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def logits_of(row: np.ndarray, slot: np.ndarray, value: np.ndarray, n: int, theta: np.ndarray) -> np.ndarray:
    """Products of sparse rows with slots x classes coefficients; a row without slots has zeros."""
    return np.stack([np.bincount(row, weights=theta[slot, k] * value, minlength=n) for k in range(theta.shape[1])], axis=1)


def minimise(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    """The minimum of a smooth convex function given as (value, gradient); `curvature`: about its second derivatives."""
    x, (f, g) = start, evaluate(start)
    scale = curvature.ravel() ** -0.5  # half way: whole, the rare slots would lead the steps
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(MAX_STEPS):
        if np.abs(g).max() <= GRADIENT * max(1.0, abs(f)):
            break
        q, kept = g.ravel().copy(), []
        for s, y in reversed(pairs):
            a = s @ q / (y @ s)
            kept.append(a)
            q -= a * y
        if pairs:
            s, y = pairs[-1]
            q *= s @ y / (y @ (scale * y)) * scale
        else:
            q *= scale
        for (s, y), a in zip(pairs, reversed(kept)):
            q += (a - y @ q / (y @ s)) * s
        step, slope, rate = -q.reshape(x.shape), -float(q @ g.ravel()), 1.0
        while True:
            found, gradient = evaluate(x + rate * step)
            if found <= f + 1e-4 * rate * slope or rate < 1e-10:
                break
            # the minimum of the parabola through what is known, within bounds
            rate *= min(0.5, max(0.1, -slope * rate / (2 * (found - f - slope * rate))))
        if not found < f:
            break  # no further progress in floating point
        move, turn = (rate * step).ravel(), (gradient - g).ravel()
        if turn @ move > 1e-16:
            pairs = [*pairs, (move, turn)][-MEMORY:]
        x, f, g = x + rate * step, found, gradient
    return x


@dataclass
class Rows:
    """Some sparse rows: their sizes, slots and values, their labels and weights; then by slot: the slots that occur, where
    each begins, and its rows and values."""

    sizes: np.ndarray
    slot: np.ndarray
    value: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    used: np.ndarray
    begins: np.ndarray
    rows: np.ndarray
    values: np.ndarray

    KINDS = (np.int32, np.int32, float, np.int32, float, np.int64, np.int64, np.int32, float)

    @staticmethod
    def of(batches: list[pa.RecordBatch]) -> Rows:
        """From `(slots, values, label, weight)`."""
        table = pa.Table.from_batches(batches).combine_chunks()
        slots, values, label, weight = (table.column(i).combine_chunks() for i in range(4))
        slot, value = np.asarray(slots.flatten(), np.int32), np.asarray(values.flatten(), float)
        sizes, order = np.diff(np.asarray(slots.offsets)).astype(np.int32), np.argsort(slot, kind="stable")
        used, begins = np.unique(slot[order], return_index=True)
        row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        return Rows(sizes, slot, value, np.asarray(label, np.int32), np.asarray(weight, float), used.astype(np.int64), begins.astype(np.int64), row[order], value[order])

    def write(self, path: str) -> None:
        parts = (self.sizes, self.slot, self.value, self.label, self.weight, self.used, self.begins, self.rows, self.values)
        write_mapped(path, pa.RecordBatch.from_arrays([pa.array([part.tobytes()], pa.large_binary()) for part in parts], names=[f"c{i}" for i in range(len(parts))]))

    @staticmethod
    def read(path: str) -> Rows:
        batch = read_mapped(path)
        return Rows(*(np.frombuffer(batch.column(i)[0].as_buffer(), kind) for i, kind in enumerate(Rows.KINDS)))

    def add_to(self, sums: np.ndarray, theta: np.ndarray) -> None:
        """Adds the gradient, and last the loss, of these rows."""
        classes, each = theta.shape[1], np.arange(len(self.sizes))
        filled = np.flatnonzero(self.sizes)
        starts = (np.cumsum(self.sizes) - self.sizes)[filled]
        logits = np.repeat(theta[-1][:, None], len(each), axis=1)
        for k in range(classes if len(filled) else 0):
            products = np.ascontiguousarray(theta[:, k]).take(self.slot)
            products *= self.value
            logits[k, filled] += np.add.reduceat(products, starts)
        p = np.ascontiguousarray(softmax(logits.T).T)
        sums[-1] -= float(self.weight @ np.log(np.maximum(p[self.label, each], 1e-300)))
        p[self.label, each] -= 1.0
        p *= self.weight
        gradient = sums[:-1].reshape(theta.shape)
        gradient[-1] += p.sum(1)
        for k in range(classes if len(filled) else 0):
            products = p[k].take(self.rows)
            products *= self.values
            gradient[self.used, k] += np.add.reduceat(products, self.begins)

    def squares(self, slots: int) -> np.ndarray:
        """Sums of the weighted squares of each slot."""
        out = np.zeros(slots)
        if len(self.used):
            out[self.used] = np.add.reduceat(self.values**2 * self.weight[self.rows], self.begins)
        return out


def _sums_of(batches: Iterable[Rows], theta: np.ndarray) -> np.ndarray:
    sums = np.zeros(theta.size + 1)
    for rows in batches:
        rows.add_to(sums, theta)
    return sums


def _objective(sums: np.ndarray, theta: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    free = theta.copy()
    free[-1] = 0.0
    return float(sums[-1] + 0.5 * penalty * (free * free).sum()), sums[:-1].reshape(theta.shape) + penalty * free


def _curvature(squares: np.ndarray, total: float, classes: int, penalty: float) -> np.ndarray:
    """Second derivatives where all classes are as likely."""
    shares = (classes - 1) / classes**2
    return np.repeat(np.append(shares * squares / total + penalty, shares)[:, None], classes, axis=1)


def _fit_files(files: list[str], total: float, shape: tuple[int, int], penalty: float) -> np.ndarray:
    held = [Rows.read(file) for file in files]
    squares = sum(rows.squares(shape[0] - 1) for rows in held)
    return minimise(lambda theta: _objective(_sums_of(held, theta) / total, theta, penalty), np.zeros(shape), _curvature(squares, total, shape[1], penalty))


def fit_multinomial(rows: DataFrame, slots: int, classes: int, penalty: float, held_values: int = HELD_VALUES) -> np.ndarray:
    """Coefficients (slots + 1) x classes of rows `(slots array<int>, values array<double>, label int, weight double)`.

    Minimises the weighted mean log loss plus half the penalty times the squared coefficients; the last row
    holds the intercepts, which are free. Up to `held_values` values are fitted in one task."""
    spark, shape = ship(rows.sparkSession), (slots + 1, classes)
    path = scratch_path(spark, "packed-rows")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def put() -> pa.RecordBatch:
            own, file = Rows.of(held), f"{path}/{uuid.uuid4().hex}"
            own.write(file)
            return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([float(own.weight.sum())]), pa.array([len(own.slot)], pa.int64())],
                                              names=["file", "total", "n_values"])

        for batch in batches:
            held.append(batch)
            count += len(batch.column(0).flatten())
            if count >= FILE_VALUES:
                yield put()
                held, count = [], 0
        if held:
            yield put()

    # a row for each quarter million values
    files = rows.select("slots", "values", "label", "weight").mapInArrow(pack, "file string, total double, n_values bigint").collect()
    total, values = sum(f["total"] for f in files), sum(f["n_values"] for f in files)
    names = [f["file"] for f in files]
    if values > held_values:
        return _by_jobs(spark, names, total, shape, penalty)
    return spark.sparkContext.parallelize([names], 1).map(lambda own: _fit_files(own, total, shape, penalty)).collect()[0]


def _by_jobs(spark: SparkSession, files: list[str], total: float, shape: tuple[int, int], penalty: float) -> np.ndarray:
    """The minimum, with value and gradient by one Spark job over the files for each step."""
    context = spark.sparkContext
    placed = context.parallelize(files, max(1, min(len(files), 4 * context.defaultParallelism)))

    def summed(part: Callable[[Iterator[str]], np.ndarray]) -> np.ndarray:
        sums = placed.mapPartitions(lambda own: [part(own)])
        return sums.treeReduce(np.add, 2) if placed.getNumPartitions() > SUMS else sum(sums.collect())

    def evaluate(theta: np.ndarray) -> tuple[float, np.ndarray]:
        sent = context.broadcast(theta)  # bounded by slots x classes
        sums = summed(lambda own: _sums_of(map(Rows.read, own), sent.value)) / total
        sent.destroy()
        return _objective(sums, theta, penalty)

    squares = summed(lambda own: sum((Rows.read(file).squares(shape[0] - 1) for file in own), np.zeros(shape[0] - 1)))
    return minimise(evaluate, np.zeros(shape), _curvature(squares, total, shape[1], penalty))
