"""Removal of repeated byte strings by suffix sorting.

A byte goes if a string of `window` bytes that covers it also starts earlier, in a document with a
smaller id or at an earlier place of the same one. The steps, each a Spark job over all documents:

1. Anchors. In each window the GRAM-byte string with the least hash is its anchor, so equal windows
   have equal anchors at equal places. An anchor stands for a run of windows; the bytes that those
   cover are its block. Within a map task a block that has come before is removed at once (its
   bytes are compared), and one row goes on, so copies cost a row per batch.
2. Anchors meet by hash. What is alone repeats nothing; the others ask their text for the blocks.
3. Blocks of one anchor are sorted twice by the hash-compared suffix sort: to the right of the
   anchor, and to the left read backwards. Two windows with `d` bytes before the anchor are equal
   if their blocks agree in `d` bytes on the left and the rest on the right, that is if they
   stand in the same stretch of both orders. The earliest of each class of equals stays.
   An anchor with more than HOT blocks (a passage within very many different texts) is no group:
   its windows go out one by one, keyed by a 128-bit hash of their own content.
4. The removed runs of a document are merged and cut out of its text.

Documents are told apart by (doc_id, 64 bits of a hash of the text), the `tie`, in every join and group."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.shared import let_go
from riskloom.llm.suffix_sort import PrefixHashes, _agree, sorted_suffixes
from riskloom.llm.whole_groups import whole_groups
from riskloom.llm.words import mixed, parts, signed, text_bytes
from riskloom.shipping import ship
from riskloom.sources.scratch import release, written

GRAM, HOT, PIECE = 32, 4096, 1 << 19
#: A place: the position, and the least and most bytes that a window of the run has before the anchor.
_AT, _FIELD = 14, 127
#: Rows sorted at once; bytes hashed at once.
_ROWS = 16_384
_NULL_ID = (1 << 63) - 1


def anchors(data: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first window, last window) of each run of windows with one anchor."""
    grams = window - GRAM + 1
    out = []
    for base in range(0, max(0, len(data) - window + 1), PIECE):
        part = data[base : base + PIECE + window - 1].astype(np.uint64)
        h = part * np.uint64(0xC2B2AE3D27D4EB4F)
        for k in (1, 2, 4, 8, 16):
            h = h[:-k] * np.uint64(0x9E3779B97F4A7C15) + h[k:]
            h ^= h >> np.uint64(29)
        h = mixed(h)
        least = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
        reach = 1
        while reach < grams:  # the leftmost least of `grams` in a row
            step = min(reach, grams - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        place = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        last = np.append(first[1:], len(place)) - 1
        at = place[first]
        out.append((h[at], at + base, first + base, last + base))
    kinds = (np.uint64, np.int64, np.int64, np.int64)
    return tuple(np.concatenate([o[k] for o in out]) if out else np.empty(0, kinds[k]) for k in range(4))


def _pack(at, least, most):
    return (np.asarray(at, np.int64) << _AT) | (least << 7) | most


def _unpack(packed: np.ndarray):
    """(position, least, most)"""
    return packed >> _AT, (packed >> 7) & _FIELD, packed & _FIELD


def _merged(ids: np.ndarray, ties: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a document that touch, put together."""
    order = np.lexsort((start, ties, ids))
    ids, ties, start, end = ids[order], ties[order], start[order], end[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    return ids[first], ties[first], start[first], np.maximum.reduceat(end, first) if len(first) else end


def _spread(ids: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """A key that deals out runs that only pass."""
    return signed(mixed(ids.view(np.uint64) ^ ties.view(np.uint64)))


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, and where each begins."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    return data, np.cumsum(sizes) - sizes


def _earliest(keys: tuple[np.ndarray, ...], ids: np.ndarray, ties: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): rows sorted by the keys and then by document and place; for each the place in
    that order of the earliest with its keys."""
    order = np.lexsort((at, ties, ids, *keys))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        ranked = key[order]
        new[1:] |= ranked[1:] != ranked[:-1]
    return order, np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))


def _find_anchors(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    let_go()
    for batch in parts(batches):
        texts = text_bytes(batch.column(2))
        data, begin = _flat(texts)
        ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        found = [anchors(data[b : b + len(t)], window) for b, t in zip(begin.tolist(), texts)]
        count = [len(f[0]) for f in found]
        if not sum(count):
            continue
        h, at, first, last = (np.concatenate([f[k] for f in found]) for k in range(4))
        ids, ties, base = np.repeat(ids, count), np.repeat(ties, count), np.repeat(begin, count)
        packed = _pack(at, at - last, at - first)
        start, size = base + first, last - first + window
        # hashes of whole blocks, text by text: sums of one text at a time keep the arrays short
        block, row = np.empty(len(h), np.uint64), 0
        for b, t, n in zip(begin.tolist(), texts, count):
            if n:
                part = slice(row, row + n)
                block[part] = _block_hashes(data[b : b + len(t)], first[part], size[part])
                row += n
        order, lead = _earliest((block, h), ids, ties, packed)
        same = order[lead] != order
        again, source = order[same], order[lead][same]
        whole = (size[again] == size[source])
        whole &= _agree(data, start[again], start[source], np.minimum(size[again], size[source])) == size[again]
        gone = again[whole]
        keep = np.ones(len(h), bool)
        keep[gone] = False
        # a repeated row stands at its own place and is no copy
        gone = again[whole & ((ids[again] != ids[source]) | (ties[again] != ties[source]) | (packed[again] != packed[source]))]
        r_id, r_tie, r_start, r_end = _merged(ids[gone], ties[gone], first[gone], last[gone] + window)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([signed(h[keep]), _spread(r_id, r_tie)])),
            pa.array(np.concatenate([ids[keep], r_id])), pa.array(np.concatenate([ties[keep], r_tie])),
            pa.array(np.concatenate([packed[keep], r_start])),
            pa.concat_arrays([pa.nulls(int(keep.sum()), pa.int64()), pa.array(r_end, pa.int64())])],
            names=["h", "id", "tie", "at", "upto"])


def _block_hashes(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    found = np.empty(len(first), np.uint64)
    low = 0
    while low < len(first):  # a very long text goes in parts
        high = int(np.searchsorted(first, first[low] + PIECE, "left"))
        start, end = int(first[low]), int((first[low:high] + size[low:high]).max())
        sums = PrefixHashes(data[start:end])
        found[low:high] = mixed(sums.of(first[low:high] - start, first[low:high] + size[low:high] - start))
        low = high
    return found


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors that are not alone, marked if there are many; removed runs pass. At most HOT rows
    of an unfinished group are held."""
    held, hot = None, None
    names = ["h", "id", "tie", "at", "upto", "hot"]

    def out(table: pa.Table, many) -> pa.RecordBatch:
        rows = table.combine_chunks()
        columns = [rows.column(k).combine_chunks() if rows.num_rows else pa.array([], pa.int64()) for k in range(5)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.broadcast_to(many, rows.num_rows), pa.bool_())], names=names)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        known = table.column("upto").is_valid()
        yield out(table.filter(known), np.False_)
        table = table.filter(pc.invert(known))
        if held is not None:
            table = pa.concat_tables([held, table])
            held = None
        if hot is not None and table.num_rows:
            others = np.flatnonzero(table.column("h").to_numpy() != hot)
            more = int(others[0]) if len(others) else table.num_rows
            yield out(table.slice(0, more), np.True_)
            table = table.slice(more)
            hot = None if len(others) else hot
        if not table.num_rows:
            continue
        h = table.column("h").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        sizes = np.diff(np.append(starts, len(h)))
        per_row = np.repeat(sizes, sizes)
        end = int(starts[-1])
        chosen = np.flatnonzero(per_row[:end] > 1)
        yield out(table.take(pa.array(chosen)), per_row[chosen] > HOT)
        rest = table.slice(end)
        if rest.num_rows > HOT:
            hot = int(h[-1])
            yield out(rest, np.True_)
        else:
            held = rest
    if held is not None and held.num_rows > 1:
        yield out(held, np.False_)


def _cut_blocks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(key, id, tie, at, upto, block): blocks of anchors; single windows of hot ones, by their digest."""
    let_go()
    for batch in parts(batches):
        keys, ids, ties, places, blocks = [], [], [], [], []
        hot: dict[bytes, tuple[int, int, int]] = {}
        gone = []
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2)), batch.column(3).to_pylist())
        for own, tie, text, wanted in rows:
            for a in wanted:
                at, least, most = (int(v) for v in _unpack(np.int64(a["at"])))
                if not a["hot"]:
                    keys.append(a["h"])
                    ids.append(own)
                    ties.append(tie)
                    places.append(a["at"])
                    blocks.append(text[at - most : at - least + window])
                    continue
                for d in range(least, most + 1):
                    digest = xxhash.xxh128_digest(text[at - d : at - d + window])
                    here = (own, tie, int(_pack(at, d, d)))
                    there = hot.setdefault(digest, here)
                    if here != there:
                        hot[digest], (late_id, late_tie, late) = min(here, there), max(here, there)
                        late_at, _, late_d = (int(v) for v in _unpack(np.int64(late)))
                        gone.append((late_id, late_tie, late_at - late_d, late_at - late_d + window))
        for digest, (own, tie, place) in hot.items():
            keys.append(int.from_bytes(digest[:8], "little", signed=True))
            ids.append(own)
            ties.append(tie)
            places.append(place)
            blocks.append(digest)
        removed = np.array(gone, np.int64).reshape(-1, 4)
        r_id, r_tie, r_start, r_end = _merged(*removed.T)
        n, m = len(keys), len(r_id)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([np.array(keys, np.int64), _spread(r_id, r_tie)])),
            pa.array(np.concatenate([np.array(ids, np.int64), r_id])), pa.array(np.concatenate([np.array(ties, np.int64), r_tie])), pa.array(np.concatenate([np.array(places, np.int64), r_start])),
            pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(r_end, pa.int64())]),
            pa.array(blocks + [None] * m, pa.binary())], names=["key", "id", "tie", "at", "upto", "block"])


def repeated_windows(group: np.ndarray, blocks: list[bytes], least: np.ndarray, most: np.ndarray, window: int) -> np.ndarray:
    """For each block (rows in order of group, document and place) and number of bytes before the
    anchor: whether that window stands in an earlier row of the group."""
    n = len(group)
    removed = np.zeros((n, window - GRAM + 1), bool)
    data, begin = _flat(blocks)
    anchor = begin + most
    right, left = window - least, most
    r_order, r_lcp = sorted_suffixes(data, group, anchor, right)
    l_order, l_lcp = sorted_suffixes(data[::-1], group, len(data) - anchor, left)

    def classes(order: np.ndarray, lcp: np.ndarray, reach: int) -> np.ndarray:
        named = np.empty(n, np.int64)
        named[order] = np.cumsum(lcp < reach)
        return named

    # equal blocks first: all but the earliest go whole
    def whole(order: np.ndarray, lcp: np.ndarray, length: np.ndarray) -> np.ndarray:
        named = np.empty(n, np.int64)
        named[order] = np.cumsum((lcp < length[order]) | (np.concatenate([[-1], length[order][:-1]]) != length[order]))
        return named

    pair = whole(r_order, r_lcp, right) * (n + 1) + whole(l_order, l_lcp, left)
    _, first, which = np.unique(pair, return_index=True, return_inverse=True)
    copy = first[which] != np.arange(n)
    reach = np.arange(removed.shape[1])
    removed[copy] = (least[copy, None] <= reach) & (reach <= most[copy, None])
    # then window by window among different blocks of one anchor
    own = np.flatnonzero(~copy)
    several = np.bincount(group[own], minlength=int(group.max(initial=0)) + 1) > 1
    own = own[several[group[own]]]
    for d in range(removed.shape[1]):
        rows = own[(least[own] <= d) & (d <= most[own])]
        if len(rows) > 1:
            pair = classes(r_order, r_lcp, window - d)[rows] * (n + 1) + classes(l_order, l_lcp, d)[rows]
            _, first, which = np.unique(pair, return_index=True, return_inverse=True)
            removed[rows[first[which] != np.arange(len(rows))], d] = True
    return removed


def _sort_blocks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    names = ["id", "tie", "start", "upto"]

    def passing() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = np.asarray(batch.column(4).is_valid())
            if known.any():
                runs.append(pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(known)) for k in (1, 2, 3, 4)], names=names))
            yield batch.filter(pa.array(~known))

    runs: list[pa.RecordBatch] = []
    for table in whole_groups(passing(), ["key"], _ROWS):
        yield from runs
        runs.clear()
        key, ids, tie, places = (table.column(k).to_numpy() for k in ("key", "id", "tie", "at"))
        twice = np.zeros(len(key), bool)  # from a repeated row
        twice[1:] = (key[1:] == key[:-1]) & (ids[1:] == ids[:-1]) & (tie[1:] == tie[:-1]) & (places[1:] == places[:-1])
        table = table.filter(pa.array(~twice))
        key, ids, tie, places = key[~twice], ids[~twice], tie[~twice], places[~twice]
        blocks = table.column("block").to_pylist()
        at, least, most = _unpack(places)
        group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if len(key) else key
        digest = np.array([len(b) == 16 for b in blocks], bool)
        removed = np.zeros((len(key), window - GRAM + 1), bool)
        plain = np.flatnonzero(~digest)
        removed[plain] = repeated_windows(np.unique(group[plain], return_inverse=True)[1], [blocks[i] for i in plain.tolist()],
                                          least[plain], most[plain], window)
        seen: set[bytes] = set()
        for i in np.flatnonzero(digest).tolist():
            removed[i, least[i]] = blocks[i] in seen
            seen.add(blocks[i])
        # runs of neighbouring windows of a row
        wide = np.zeros((len(key), removed.shape[1] + 2), np.int8)
        wide[:, 1:-1] = removed
        step = np.diff(wide, axis=1)
        row, low = np.nonzero(step == 1)
        _, high = np.nonzero(step == -1)
        first, last = at[row] - (high - 1), at[row] - low
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _merged(ids[row], tie[row], first, last + window)], names=names)
    yield from runs


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches):
        out = []
        for text, runs in zip(text_bytes(batch.column(1)), batch.column(2).to_pylist()):
            kept, at, spans, end = [], 0, 0, -1
            for run in sorted((r["start"], r["upto"]) for r in runs or []):
                if run[0] > end:
                    spans += 1
                    kept.append(text[at : run[0]])
                end = at = max(end, run[1])
            kept.append(text[max(at, 0) :])
            rest = b"".join(kept)
            out.append((len(text), len(text) - len(rest), spans, hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore")))
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(columns[k], pa.int64()) for k in range(3)), pa.array(columns[3], pa.string()), pa.array(columns[4], pa.string())],
            names=["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])


def without_repeats(docs: DataFrame, window: int = 100) -> DataFrame:
    """The rows of `docs` as a struct `row` of all their columns, with n_bytes, n_removed, n_spans,
    kept_sha256 (of the bytes that stay) and kept_text (these as text; cut characters are left out).

    Needs doc_id and text; columns of other names may be there and pass in `row`. A null text is
    empty. Null ids come after all others. Rows of one id with different texts follow each other by a
    hash of the text; rows that are equal in both are one document, and have the same result each.
    Texts shorter than a window lose nothing. No rows give no rows."""
    spark = ship(docs.sparkSession)
    if not 2 * GRAM <= window <= GRAM + _FIELD:
        raise ValueError(f"the window must be between {2 * GRAM} and {GRAM + _FIELD} bytes")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
                       F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NULL_ID)).alias("id"),
                       F.xxhash64(text).alias("tie"), text.alias("text"))
    slim = rows.select("id", "tie", "text")
    found = slim.mapInArrow(lambda b: _find_anchors(b, window), "h bigint, id bigint, tie bigint, at bigint, upto bigint")
    met = written(found.repartition("h").sortWithinPartitions("h", "id", "tie", "at").mapInArrow(
        _meet, "h bigint, id bigint, tie bigint, at bigint, upto bigint, hot boolean"), "repeat-anchors")
    release(spark)
    wanted = met.filter("upto IS NULL").groupBy("id", "tie").agg(
        F.collect_list(F.struct("h", "at", "hot")).alias("wanted"))
    cut = slim.join(wanted, ["id", "tie"]).select("id", "tie", "text", "wanted").mapInArrow(
        lambda b: _cut_blocks(b, window), "key bigint, id bigint, tie bigint, at bigint, upto bigint, block binary")
    runs = written(cut.repartition("key").sortWithinPartitions("key", "id", "tie", "at").mapInArrow(
        lambda b: _sort_blocks(b, window), "id bigint, tie bigint, start bigint, upto bigint"), "repeat-runs")
    release(spark)
    all_runs = runs.union(met.filter("upto IS NOT NULL").select("id", "tie", F.col("at").alias("start"), "upto"))
    per_document = all_runs.groupBy("id", "tie").agg(
        F.collect_list(F.struct("start", "upto")).alias("runs"))
    done = rows.join(per_document, ["id", "tie"], "left").select("row", "text", "runs")
    kind = done.schema["row"].dataType.simpleString()
    return done.mapInArrow(_cut_out, f"row {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string")


def deduplicated(docs: DataFrame, window: int = 100) -> DataFrame:
    """The documents with what is left of their texts, with the columns of `docs`; `n_chars`, if
    there is one, counts the new text. Documents that lost all their text go; others stay."""
    out = without_repeats(docs, window).filter("n_removed = 0 OR n_removed < n_bytes")
    changed = F.col("n_removed") > 0

    def column(name: str):
        if name == "text":
            return F.col("kept_text").alias("text")
        own = F.col("row").getField(name)
        if name == "n_chars":
            own = F.when(changed, F.length("kept_text").cast("bigint")).otherwise(own)
        return own.alias(name)

    return out.select(*[column(c) for c in docs.columns])
