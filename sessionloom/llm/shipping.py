"""What the operators need of a session: the package in its tasks, Arrow batches of bounded size, and Python workers
that hold no memory when they wait."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Spark's own 64 MB are held by a task's JVM and by its Python at the same time, whole texts in one buffer.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Send about ``BATCH_BYTES`` to Python at a time; a size that the session was given stays."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, BATCH_BYTES)


def give_back() -> None:
    """Return what this process has freed to the machine.

    Spark keeps a task's Python worker for later tasks.  Arrow's pool and the C library keep freed memory, so a waiting
    worker would hold the most that it ever used, beside stages that run in the JVM alone.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(step: Callable[..., pa.Table], *tables: pa.Table) -> pa.Table:
    """The step's table; what the step has used meanwhile is given back."""
    made = step(*tables)
    give_back()
    return made


def ship_package(spark: SparkSession) -> None:
    """Add the package's source to the session's Python files, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
