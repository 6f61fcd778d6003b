"""Random shards of equal row counts by a two-pass external shuffle.

Pass one scatters rows by a seeded hash into buckets that fit a task's memory. Pass
two takes a bucket at a time, puts it in the order of its hashes (so that a task run
again sees the same rows), shuffles it by Fisher-Yates from a generator seeded with
the bucket, and writes it. Buckets one after the other are a random permutation of
all rows; shards are its even cuts, so their row counts differ by one at most.

Texts cross the network once and are written once, in their shard's folder. The
driver gets one row count a bucket. A bucket holds BUCKET_BYTES on average; a row
goes by its own place in the input, so that no group of equal rows or identifiers
can fill one.

Defined results: a null text has no bytes; repeated rows are rows of their own; an
empty table has no shards; with fewer rows than shards the last ones are empty.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import claim, in_arrow, staged

BUCKET_BYTES = 64 << 20
ROWS_OUT = 2_000


def row_place() -> tuple[Column, Column]:
    """What tells the rows of a Parquet table apart, however it is read."""
    return F.col("_metadata.file_name"), F.col("_metadata.row_index")


def row_size(text: Column) -> Column:
    """Bytes of a text in UTF-8, and 8 for its row."""
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 8


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of `n` rows: from the last row to the first, swap with a row
    drawn from those up to it."""
    draws = np.random.Generator(np.random.PCG64([seed, bucket])).integers(0, np.arange(n, 0, -1)).tolist()
    order = list(range(n))
    for last, drawn in zip(range(n - 1, -1, -1), draws):
        order[last], order[drawn] = order[drawn], order[last]
    return np.array(order, np.int64)


def _shuffler(first: np.ndarray, bounds: np.ndarray, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("sharding", lambda: None)
        held = pa.Table.from_batches(kept) if (kept := list(batches)) else None
        if held is None or not held.num_rows:
            return
        bucket = TaskContext.get().partitionId()
        order = fisher_yates(held.num_rows, seed, bucket)
        for at in range(0, len(order), ROWS_OUT):
            rows = held.take(order[at : at + ROWS_OUT]).combine_chunks().to_batches()[0]
            place = first[bucket] + np.arange(at, at + rows.num_rows)
            shard = np.searchsorted(bounds, place, side="right") - 1
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(shard.astype(np.int32)), pa.array(place - bounds[shard])], ["doc", "shard", "slot"])

    return run


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = 24,
    seed: int = 2024,
    text: str = "text",
    place: Sequence[Column] | None = None,
    bucket_bytes: int = BUCKET_BYTES,
    buckets: int | None = None,
) -> DataFrame:
    """Write `docs` as `shards` folders of Parquet files under `path`, each in the
    order of its slots, and return what is read from there: struct `doc` of all
    columns, slot (gapless from 0) and shard.

    `place` are columns that tell rows apart and are the same each time the rows are
    read; without them the rows are numbered and written first. Buckets are as many
    as the bytes ask for and at least the session's shuffle partitions, unless
    given. Same rows, places, seed and buckets: same shards.
    """
    spark = docs.sparkSession
    whole = F.struct(*docs.columns).alias("doc")
    if place is None:
        rows = staged(docs.select(whole, F.monotonically_increasing_id().alias("place")), "numbered")
        place, body, whole = [F.col("place")], F.col("doc")[text], F.col("doc")
    else:
        rows, body = docs, F.col(text)
    if buckets is None:
        held = rows.agg(F.sum(row_size(body))).first()[0] or 0
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // bucket_bytes))
    key = F.xxhash64(F.lit(seed), *place)
    bucket = F.pmod(key, F.lit(buckets)).cast("int")
    counts = np.zeros(buckets, np.int64)
    for r in rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.bucket] = r.n
    total = int(counts.sum())
    bounds = np.array([s * total // shards for s in range(shards)], np.int64)
    scattered = rows.select(whole, key.alias("key"), bucket.alias("bucket"), F.struct(*place).alias("place"))
    scattered = scattered.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("key", "place").select("doc")
    kind = scattered.schema[0].dataType.simpleString()
    shuffled = in_arrow(scattered, _shuffler(np.cumsum(counts) - counts, bounds, seed), f"doc {kind}, shard int, slot long")
    written = shuffled.sortWithinPartitions("shard", "slot")
    written.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return spark.read.schema(f"doc {kind}, slot long, shard int").parquet(path)
