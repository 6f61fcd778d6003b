"""Readers with declared schemas, and report writers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.scalar import nan_to_null, quoted
from tidemark.sources.schemas import TABLES


def read_table(
    spark: SparkSession, name: str, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Scan one warehouse table with its declared schema.

    A stored NaN is read as null: it compares as larger than any number, so it would
    pass a test like `value >= 0` and turn every total it enters into NaN.
    """
    declared = TABLES[name] if schema is None else schema
    if fmt == "csv":
        return nan_to_null(read_csv(spark, path, declared))
    return nan_to_null(spark.read.schema(declared).format(fmt).load(path))


def null_violations(df: DataFrame, name: str | None = None, required: Sequence[str] = ()) -> DataFrame:
    """(column, violations) for each NOT NULL column.

    File scans report every column as nullable, so the constraint is a query.
    """
    required = list(required) or [f.name for f in TABLES[name].fields if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], required, "column", "violations")


def require_not_null(df: DataFrame, name: str | None = None, required: Sequence[str] = ()) -> DataFrame:
    """Raise when a NOT NULL column holds a null (runs a job)."""
    broken = [r.column for r in null_violations(df, name, required).collect() if r.violations]
    if broken:
        raise ValueError(f"null in {', '.join(broken)}")
    return df


# Quotes inside quoted text are doubled, text may hold line breaks, an empty text
# is told from a null by its quotes. Quoted line breaks make a file unsplittable.
# A reader that took the empty text for its null value could not tell them apart.
CSV = {"nullValue": "\0", "header": True, "quote": '"', "escape": '"', "multiLine": True, "mode": "FAILFAST", "enforceSchema": False}
CSV_OUT = {"header": True, "quote": '"', "escape": '"', "emptyValue": '""', "nullValue": ""}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The declared columns, found by the names in the header.

    Other columns of the file are left out; a declared one that the file lacks,
    and a cell that does not fit its type, are errors.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # Only the head of a file is read for its names.
    present = spark.read.options(**CSV).option("inferSchema", False).csv(path).columns
    if absent := [f.name for f in declared.fields if f.name not in present]:
        raise ValueError(f"{path} lacks the columns {', '.join(absent)}")
    kinds = {f.name: f.dataType for f in declared.fields}
    in_file = T.StructType([T.StructField(name, kinds.get(name, T.StringType())) for name in present])
    read = spark.read.options(**CSV).schema(in_file).csv(path)
    return read.select(*[F.col(quoted(f.name)) for f in declared.fields])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OUT).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_split(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Split membership as written by `write_json`: entity key and `split`."""
    return spark.read.schema(schema).json(path)


def register(df: DataFrame, name: str) -> DataFrame:
    """Give a relation a name SQL can use."""
    df.createOrReplaceTempView(name)
    return df


def write_table(
    df: DataFrame,
    target: str,
    as_table: bool = False,
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Replace a table. Bucketing needs a catalog table; joins on the bucket
    columns then need no shuffle.

    The new table is written beside the old one and takes its place when it is
    whole, by a rename of the folder or in the catalog. A job that fails leaves the
    old table as it was; so `df` may read the table that it replaces.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    if not (as_table or bucket_by):
        _swap_folder(df, target, mark)
        return
    new, old = f"{target}_new_{mark}", f"{target}_old_{mark}"
    writer = df.write.bucketBy(buckets, *bucket_by).sortBy(*bucket_by) if bucket_by else df.write
    try:
        writer.saveAsTable(new)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    if spark.catalog.tableExists(target):
        spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {target}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def _swap_folder(df: DataFrame, target: str, mark: str) -> None:
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path
    goal = at(target.rstrip("/"))
    files = goal.getFileSystem(spark._jsc.hadoopConfiguration())
    # Names that Spark's readers pass over.
    new, old = (at(goal.getParent(), f"_{goal.getName()}_{kind}_{mark}") for kind in ("new", "old"))
    try:
        df.write.parquet(new.toString())
        if files.exists(goal) and not files.rename(goal, old):
            raise OSError(f"{target} cannot be replaced")
        if not files.rename(new, goal):
            files.rename(old, goal)
            raise OSError(f"{target} cannot be replaced")
    finally:
        files.delete(new, True)
    files.delete(old, True)
