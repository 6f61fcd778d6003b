"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import contextlib
import ctypes
import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import shared_dir


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write `df` under the shared folder and read it back.

    The work behind it is done once; a lost executor costs a read, not a rerun.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Remove the files of a staged table that no later step reads."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        with contextlib.suppress(Exception):  # an executor's store may already be gone; the folder is scratch
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


_caches: dict[str, Callable[[], None]] = {}


def claim(name: str, clear: Callable[[], None]) -> None:
    """Called where a task starts: this operator's caches stay in the worker for
    its next task, those that another operator left there go, and what the last
    task freed goes back to the machine."""
    for other in [n for n in _caches if n != name]:
        _caches.pop(other)()
    _caches[name] = clear
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every libc has it
        ctypes.CDLL(None).malloc_trim(0)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the executors import this package, once per application."""
    if spark.sparkContext.applicationId in _shipped:
        return
    top, zipped = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(zipped, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, file.relative_to(top.parent))
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/{top.name}-{uuid.uuid4().hex}.zip")
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(at)
    out.write(zipped.getvalue())
    out.close()
    spark.sparkContext.addPyFile(files.makeQualified(at).toString())
    _shipped.add(spark.sparkContext.applicationId)


def in_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def encoded(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()
