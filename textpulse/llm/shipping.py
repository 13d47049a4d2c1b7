"""Makes this package importable in Python workers."""

from __future__ import annotations

import ctypes
import pathlib
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import SparkSession

import textpulse

# Rows of an Arrow batch at most: batches here carry whole texts, and two or three columns of them.
BATCH_ROWS = 500
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

_SENT: set[str] = set()


def ship(spark: SparkSession | None = None) -> SparkSession:
    """Sends the package's source to the executors through Spark's own file server, once per application;
    workers then import it whether or not it is installed on their machine. A function for workers must be
    made after this call: it then carries the archive's name.

    Lowers the session's Arrow batches to BATCH_ROWS rows and leaves them so: plans run after the operator has
    returned them, and the setting is read when they do.
    """
    spark = spark or SparkSession.active()
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId not in _SENT:
        root = pathlib.Path(textpulse.__file__).resolve().parent
        target = pathlib.Path(tempfile.mkdtemp(prefix="textpulse-")) / "textpulse.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for source in sorted(root.rglob("*.py")):
                archive.write(source, pathlib.Path(root.name) / source.relative_to(root))
        context.addPyFile(str(target))
        _SENT.add(context.applicationId)
    return spark


def tidy() -> None:
    """Gives memory that a worker has freed back to the machine; allocators would keep it for later."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
