"""Suffix sort by hash comparison.

Prefix sums of a polynomial hash (modulo 2^64) give the hash of any stretch, and a binary search
over the length finds how far two suffixes agree, so one comparison takes a logarithmic number of
steps. Groups of suffixes are sorted by a bottom-up mergesort: at each level every suffix finds its
place in the run beside its own by binary search, all of them at once. Afterwards the bytes of
neighbours are compared: a collision is seen, and that part is sorted by its bytes instead."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 12), base, np.uint64)
        have[0] = 1
        have = _POWERS[base] = np.cumprod(have)
    return have[:n]


class PrefixHashes:
    """Hashes of any stretch of `data`."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=self.sums[1:])
        self.back = _powers(_INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]


def common(hashes: PrefixHashes, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How far the suffixes at x and y agree, up to `most` each."""
    found = np.zeros(len(x), np.int64)
    step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
    while step:
        # beyond `most` the comparison is with the stretch before it, which can only be equal if all is
        fits = found + step <= most
        at = np.where(fits, found, 0)
        size = np.where(fits, step, 0)
        same = fits & (hashes.of(x + at, x + at + size) == hashes.of(y + at, y + at + size))
        found += np.where(same, step, 0)
        step >>= 1
    return found


def _agree(data: np.ndarray, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The same by bytes, in blocks."""
    found = np.zeros(len(x), np.int64)
    width = int(most.max(initial=0))
    reach = np.arange(width)
    for at in range(0, len(x) if width else 0, 1 << 14):
        part = slice(at, at + (1 << 14))
        inside = reach < most[part, None]
        same = data[np.where(inside, x[part, None] + reach, 0)] == data[np.where(inside, y[part, None] + reach, 0)]
        found[part] = np.cumprod(same & inside, axis=1).sum(axis=1)
    return found


def sorted_suffixes(data: np.ndarray, group: np.ndarray, start: np.ndarray, length: np.ndarray,
                    hashes: PrefixHashes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): the suffixes `data[start : start + length]`, sorted within each group, and how far
    each agrees with the one before it, -1 at the first of a group. `group` ascends."""
    n = len(group)
    hashes = hashes or PrefixHashes(data)
    order = np.arange(n)
    if not n:
        return order, np.zeros(0, np.int64)
    new = np.ones(n, bool)
    new[1:] = group[1:] != group[:-1]
    first = np.maximum.accumulate(np.where(new, order, 0))
    starts = np.flatnonzero(new)
    size = np.repeat(np.diff(np.append(starts, n)), np.diff(np.append(starts, n)))

    def less(x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """x < y, or x <= y where asked."""
        most = np.minimum(length[x], length[y])
        k = common(hashes, start[x], start[y], most)
        ended = k == most
        at = np.where(ended, 0, k)
        byte = data[np.minimum(start[x] + at, len(data) - 1)].astype(np.int64) - data[np.minimum(start[y] + at, len(data) - 1)]
        rest = np.where(ended, length[x] - length[y], byte)
        return (rest < 0) | (or_equal & (rest == 0))

    width = 1
    largest = int(size.max())
    while width < largest:
        slot = np.flatnonzero(size > width)  # places of groups that are not yet one run
        within = slot - first[slot]
        run = within // width
        left = run % 2 == 0
        low = np.minimum((run ^ 1) * width, size[slot])
        high = np.minimum(low + width, size[slot])
        begin, own = low.copy(), order[slot]
        while True:  # how many of the other run go before
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            other = order[first[slot[open_]] + middle]
            before = less(other, own[open_], ~left[open_])
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        place = first[slot] + (run // 2) * 2 * width + within % width + (low - begin)
        merged = order.copy()
        merged[place] = own
        order = merged
        width *= 2

    x, y = order[:-1], order[1:]
    together = group[x] == group[y]
    most = np.where(together, np.minimum(length[x], length[y]), 0)
    lcp = np.full(n, -1, np.int64)
    lcp[1:] = np.where(together, common(hashes, start[x], start[y], most), -1)
    exact = _agree(data, start[x], start[y], most)
    if (together & (exact != lcp[1:])).any():  # two different stretches share a hash
        texts = [data[s : s + k].tobytes() for s, k in zip(start.tolist(), length.tolist())]
        order = np.array(sorted(range(n), key=lambda i: (int(first[i]), texts[i], i)), np.int64)
        x, y = order[:-1], order[1:]
        lcp[1:] = np.where(together, _agree(data, start[x], start[y], np.where(together, np.minimum(length[x], length[y]), 0)), -1)
    return order, lcp
