"""CSV files in pieces: headers from their first bytes, and newlines in quoted cells without one task a file.

A file is cut where a line begins, every `PIECE_BYTES` or so. Whether such a line begins a record or continues a
quoted cell depends on all bytes before it, so each piece is summarised by what it does to either state, the
summaries are combined along the file, and each piece then gives the records that begin in it. Spark's own CSV parser
reads the records."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.shipping import ship
from riskloom.sources.scratch import written

PIECE_BYTES = 32 << 20
_LOOK = 64 << 10
_BATCH_BYTES = 4 << 20
_PACKED = re.compile(r"\.(gz|bz2|zst|lz4)$", re.IGNORECASE)

# A cell is quoted only if it begins with a quote; signs between a closing quote and the comma belong to it.
_CELL = rb'(?:"(?:[^"]++|"")*+"[^,\n]*+|[^",\n][^,\n]*+|)'
_RECORD = re.compile(_CELL + rb"(?:," + _CELL + rb")*+\n")
_REST_OF_QUOTED = re.compile(rb'(?:[^"]++|"")*+"[^,\n]*+(?:,' + _CELL + rb")*+\n")

_HEADERS = "file string, bytes bigint, header string"
_PIECES = "file string, begin bigint, stop bigint, from_record boolean, from_quoted boolean"


def _opened(file: str):
    """(file system, path, packed): packed files are read from their beginning only."""
    local = re.match(r"file:/+", file)
    uri = f"file:///{file[local.end():]}" if local else file
    if local:  # Spark escapes names as a URI does
        from urllib.parse import unquote

        return pyarrow.fs.LocalFileSystem(), unquote(uri[len("file://"):]), bool(_PACKED.search(file))
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    return fs, path, bool(_PACKED.search(file))


def _unpacked(fs, path: str, packed: bool) -> Iterator[bytes]:
    with fs.open_input_stream(path, compression="detect" if packed else None) as source:
        while chunk := source.read(_LOOK):
            yield chunk


def first_record(chunks: Iterator[bytes]) -> bytes:
    """The first record that is not blank, without its line end; a quoted cell of it may hold newlines."""
    text = b""
    for chunk in chunks:
        text += chunk
        at = 0
        while found := _RECORD.match(text, at):
            if found.group().strip():
                return found.group().rstrip(b"\r\n")
            at = found.end()
    return text[at:].rstrip(b"\r\n") if text else b""


def column_names(header: str) -> list[str]:
    """Names as Spark gives them: an empty name is `_c` and its place, repeated names get their place as well."""
    cells = next(csv.reader([header]), [])
    seen: dict[str, int] = {}
    for cell in cells:
        seen[cell.lower()] = seen.get(cell.lower(), 0) + 1
    return [f"_c{i}" if not c else f"{c}{i}" if seen[c.lower()] > 1 else c for i, c in enumerate(cells)]


def file_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, bytes, header) of every file of the paths or globs that is not empty.

    Spark lists the files; of each only the first bytes are read, up to the end of its first record."""
    ship(spark)
    # `content` is not selected, so Spark does not read the files here
    listed = spark.read.format("binaryFile").load(paths).select("path", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            heads = [first_record(_unpacked(*_opened(f))).removeprefix(b"\xef\xbb\xbf").decode("utf-8", "replace") for f in rows["path"]]
            yield pa.RecordBatch.from_pydict({
                "file": pa.array(rows["path"], pa.string()), "bytes": pa.array(rows["length"], pa.int64()),
                "header": pa.array(heads, pa.string())})

    return listed.mapInArrow(run, _HEADERS).where("header <> ''")


def line_start(source, at: int, stop: int) -> int | None:
    """Place of the first line that begins in [at, stop); a line begins after a newline and at 0."""
    if at == 0:
        return 0
    at -= 1
    while at < stop - 1:
        chunk = source.read_at(min(_LOOK, stop - 1 - at), at)
        if not chunk:
            return None
        found = chunk.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(chunk)
    return None


def ends_quoted(text: bytes, quoted: bool) -> bool:
    """Whether the lines of `text` end inside a quoted cell, if they begin so (`quoted`) or at a record."""
    if b'"' not in text:
        return quoted
    if not text.endswith(b"\n"):  # the end of the file
        text += b"\n"
    at = 0
    if quoted:
        found = _REST_OF_QUOTED.match(text)
        if not found:
            return True
        at = found.end()
    while found := _RECORD.match(text, at):
        at = found.end()
    return at < len(text)


def records(source, begin: int, stop: int, size: int, quoted: bool) -> Iterator[bytes]:
    """The records that begin in [begin, stop), each with its line end; the last may reach beyond."""
    text = source.read_at(stop - begin, begin)
    reach, step = stop, _LOOK
    whole = reach >= size

    def more() -> bool:
        nonlocal text, reach, step, whole
        if whole:
            return False
        chunk = source.read_at(min(step, size - reach), reach)
        text, reach, step = text + chunk, reach + len(chunk), step * 2
        whole = reach >= size or not chunk
        return True

    at = 0
    if quoted:
        found = _REST_OF_QUOTED.match(text)
        if not found:  # the record that began before takes all of it
            return
        at = found.end()
    while at < stop - begin:
        found = _RECORD.match(text, at)
        if found:
            yield found.group()
            at = found.end()
        elif not more():
            yield text[at:]
            return


def _packed_records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    text, wanted = b"", 0
    for chunk in chunks:
        text += chunk
        if len(text) < wanted:
            continue
        at = 0
        while found := _RECORD.match(text, at):
            yield found.group()
            at = found.end()
        text = text[at:]
        wanted = 2 * len(text)
    at = 0
    while found := _RECORD.match(text, at):
        yield found.group()
        at = found.end()
    if text[at:]:
        yield text[at:]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            fs, path, packed = _opened(row["file"])
            if packed:
                out.append((row["file"], 0, row["bytes"], False, True))
                continue
            with fs.open_input_file(path) as source:
                size = source.size()
                begin = line_start(source, row["at"], min(row["at"] + row["size"], size))
                if begin is None:
                    continue
                stop = line_start(source, min(row["at"] + row["size"], size), size) or size
                text = source.read_at(stop - begin, begin)
            out.append((row["file"], begin, stop, ends_quoted(text, False), ends_quoted(text, True)))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
        names = ("file", "begin", "stop", "from_record", "from_quoted")
        columns = list(zip(*out)) if out else [()] * len(names)
        yield pa.RecordBatch.from_pydict({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds)})


def pieces(files: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(file, begin, stop, quoted) of every piece; `quoted`: its first line continues a quoted cell.

    What a piece does to the two states is to keep, to swap or to set them. So the state before a piece is the one set last,
    swapped as often as pieces swap it since; the window's rows are the pieces of one file, not its records."""
    spark = ship(files.sparkSession)
    cut = files.select("file", "bytes", F.explode(F.sequence(
        F.lit(0).cast("bigint"),
        F.when(F.col("file").rlike(f"(?i){_PACKED.pattern[:-1]}$"), F.lit(0)).otherwise(F.greatest(F.col("bytes") - 1, F.lit(0))).cast("bigint"),
        F.lit(piece_bytes).cast("bigint"))).alias("at"), F.lit(piece_bytes).cast("bigint").alias("size"))
    cut = written(cut, "csv-cuts")
    summed = written(cut.repartition(max(1, cut.count()), "file", "at").mapInArrow(_summaries, _PIECES), "csv-pieces")
    keeps_or_swaps = F.col("from_record") != F.col("from_quoted")
    swaps = F.when(keeps_or_swaps & F.col("from_record"), 1).otherwise(0)
    along = Window.partitionBy("file").orderBy("begin")
    marked = summed.withColumn("swapped", F.sum(swaps).over(along))
    fixed = F.when(~keeps_or_swaps, F.struct(F.col("from_record").cast("int").alias("state"), "swapped"))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    marked = marked.withColumn("set", F.last(fixed, ignorenulls=True).over(before)).withColumn("so_far", F.lag("swapped", 1, 0).over(along))
    state = F.coalesce(F.col("set.state"), F.lit(0)) + F.col("so_far") - F.coalesce(F.col("set.swapped"), F.lit(0))
    return written(marked.select("file", "begin", "stop", (F.pmod(state, F.lit(2)) == 1).alias("quoted")), "csv-states")


def multi_line_records(files: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(file, record) of every record after the header that is not blank; lines end in a newline, or that and a carriage return.

    An unclosed quote makes the rest of its file one cell. A file without newlines and a packed file are one task."""
    ship(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path, packed = _opened(row["file"])
                source = None if packed else fs.open_input_file(path)
                found = _packed_records(_unpacked(fs, path, True)) if packed else records(
                    source, row["begin"], row["stop"], source.size(), row["quoted"])
                header, held, size = row["begin"] == 0, [], 0
                for record in found:
                    record = record.rstrip(b"\r\n")
                    if not record.strip():
                        continue
                    if header:
                        header = False
                        continue
                    held.append(record.decode("utf-8", "replace"))
                    size += len(record)
                    if size > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pydict({"file": [row["file"]] * len(held), "record": pa.array(held, pa.string())})
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pydict({"file": [row["file"]] * len(held), "record": pa.array(held, pa.string())})
                if source is not None:
                    source.close()

    cut = pieces(files, piece_bytes)
    return cut.repartition(max(1, cut.count()), "file", "begin").mapInArrow(run, "file string, record string")
