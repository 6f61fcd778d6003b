"""Session defaults and lineage cuts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The wide feature table has 192 columns; the stock limit of 100 would take
    # its projections out of generated code.
    "spark.sql.codegen.maxFields": "250",
}


def session(master: str | None = None, app: str = "tidemark", **extra: str) -> SparkSession:
    """Build a session with the library defaults; `extra` uses `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that outlives an executor: `spark.checkpoint.dir`, or, where it
    is unset, a folder of the warehouse, which the cluster shares as well."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


_owners: list[list[tuple[str, str | None]]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove on leaving whatever `stage` wrote inside.

    Results that read staged tables must be written before.
    """
    _owners.append([])
    try:
        yield
    finally:
        for path, table in _owners.pop():
            if table:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stage(df: DataFrame, name: str, bucket_by: str | None = None, schema: StructType | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back (runs a job).

    Used where one result feeds several branches: the work is done once, a lost
    executor does not recompute it, and later joins know its true size. With
    `bucket_by` it is a table with a bucket per shuffle partition, and joins and
    groupings by that column leave it where it is. `schema` names user-defined types
    over the stored ones. The files stay until the
    surrounding `staging` block ends, or for good without one.
    """
    spark = df.sparkSession
    unique = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark).rstrip('/')}/{unique}"
    if _owners:
        _owners[-1].append((path, unique if bucket_by else None))
    if bucket_by is None:
        df.write.parquet(path)
        return spark.read.schema(schema or df.schema).parquet(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(buckets, bucket_by).write.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    dealt.option("path", path).saveAsTable(unique)
    return spark.table(unique)
