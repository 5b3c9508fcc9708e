"""Single Arrow batches as files in the shared folder, which workers map."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.fs


def located(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_mapped(path: str, batch: pa.RecordBatch) -> None:
    """One file for `read_mapped`, there whole or not at all; one that is there is kept."""
    fs, base = located(path)
    if fs.get_file_info(base).type == pyarrow.fs.FileType.NotFound:
        own = f"{base}.{uuid.uuid4().hex}"
        fs.create_dir(base.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(own) as sink, pa.ipc.new_file(sink, batch.schema) as out:
            out.write_batch(batch)
        fs.move(own, base)


def read_mapped(path: str) -> pa.RecordBatch:
    """What `write_mapped` has written. A local file is mapped: its pages are shared by all workers of the machine."""
    fs, base = located(path)
    source = pa.memory_map(base) if isinstance(fs, pyarrow.fs.LocalFileSystem) else fs.open_input_file(base)
    return pa.ipc.open_file(source).get_batch(0)
