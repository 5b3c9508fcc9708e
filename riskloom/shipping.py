"""The package itself on the workers: Python functions sent to executors import it there."""

from __future__ import annotations

import os
import tempfile
import weakref
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: weakref.WeakSet = weakref.WeakSet()


def _archive() -> str:
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="riskloom-code-"), "riskloom.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("riskloom", os.path.relpath(full, root)))
    return path


#: Rows of an Arrow batch where the session leaves Spark's own number: texts are long, and a task
#: holds a batch several times.
_BATCH, _OWN, _ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to every executor, once per Spark context, and keep Arrow batches small."""
    if spark.conf.get(_BATCH) == _OWN:
        spark.conf.set(_BATCH, _ROWS)
    context = spark.sparkContext
    if context not in _SHIPPED:
        context.addPyFile(_archive())
        _SHIPPED.add(context)
    return spark
