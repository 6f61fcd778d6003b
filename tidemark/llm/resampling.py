"""Target-distribution importance resampling over hashed n-grams.

Documents are weighed by how much likelier their features are in a target set than
in the documents themselves, and drawn without replacement by the largest sum of
weight and seeded Gumbel noise. Texts are worked on a batch at a time by Arrow
kernels: lower-cased, split, flattened, dictionary-encoded; shifted indices form
n-grams, only distinct ones are hashed, and their gains are taken and summed up by
document.

Two passes over the texts: one counts features by bucket, one adds up gains. The
driver gets one pair of counts a bucket. Ranks come from a distributed sort of
(score, identifier) and the sizes of its ranges.

Defined results: a null or empty text has no features, weight 0 and takes no part
in the draw; a null identifier is written as an empty one in the seed and goes
last among ties; repeated rows are rows of their own.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import claim, encoded, in_arrow, staged
from tidemark.llm.words import in_pieces, words_of

# Fixed value: what lies between words, once A-Z are lower-cased.
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000


def features(texts: pa.Array, max_n: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For n from 1 to `max_n`: the row of every run of n words, the index of its
    distinct run, and the bucket of each distinct run."""
    row, index, dictionary = words_of(texts, APART)
    spelled = encoded(dictionary)
    sums = [zlib.crc32(w) for w in spelled]
    run, size = index.astype(np.int64), len(spelled)
    starts = np.arange(len(row))
    yield row, run, np.array(sums, np.int64) % buckets
    for n in range(2, max_n + 1):
        # A run of n words is one of n - 1 words and the word behind it, in the same text.
        whole = starts + n - 1 < len(row)
        starts, run = starts[whole], run[whole]
        same = row[starts] == row[starts + n - 1]
        starts, run = starts[same], run[same]
        pairs, run = np.unique(run * size + index[starts + n - 1], return_inverse=True)
        sums = [zlib.crc32(b" " + spelled[word], sums[head]) for head, word in zip((pairs // max(size, 1)).tolist(), (pairs % max(size, 1)).tolist())]
        yield row[starts], run, np.array(sums, np.int64) % buckets


def _counter(max_n: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("resampling", lambda: None)
        held = np.zeros(buckets, np.int64)
        for piece in in_pieces(batches, 0):
            for _, index, bucket in features(piece.column(0), max_n, buckets):
                held += np.bincount(bucket, np.bincount(index, minlength=len(bucket)), buckets).astype(np.int64)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(held[used])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, text: str = "text", max_n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features of all texts by bucket; empty buckets are left out."""
    read = texts.select(F.col(text).cast("string")).where(F.col(text).isNotNull())
    return in_arrow(read, _counter(max_n, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def fit_gains(docs: DataFrame, target: DataFrame, text: str = "text", max_n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket: a thousand times the logarithm of its share in
    `target` over its share in `docs`, both with one feature more a bucket."""
    sides = [bucket_counts(side, text, max_n, buckets).withColumn("side", F.lit(i)) for i, side in enumerate((docs, target))]
    counts = np.zeros((2, buckets), np.int64)
    for r in sides[0].unionByName(sides[1]).collect():
        counts[r.side, r.bucket] = r.n
    (s, t), (s_all, t_all) = counts.tolist(), counts.sum(axis=1).tolist()
    more = float(s_all + buckets), float(t_all + buckets)
    return np.array([math.floor(1000 * math.log((b + 1.0) * more[0] / ((a + 1.0) * more[1]))) for a, b in zip(s, t)], np.int64)


def _weigher(gains: np.ndarray, max_n: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("resampling", lambda: None)
        for piece in in_pieces(batches, 0):
            counted = np.zeros((3, piece.num_rows), np.int64)
            for n, (row, index, bucket) in enumerate(features(piece.column(0), max_n, len(gains))):
                if len(row):
                    first = np.flatnonzero(np.diff(row, prepend=-1))
                    at, size = row[first], np.diff(first, append=len(row))
                    counted[0, at] += size if n == 0 else 0
                    counted[1, at] += size
                    counted[2, at] += np.add.reduceat(gains[bucket][index], first)
            yield pa.RecordBatch.from_arrays([*piece.columns[1:], *map(pa.array, counted)], names)

    return run


def noise(id: Column, seed: int) -> Column:
    """A thousand times Gumbel noise that follows from seed and identifier alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Adds `place`, from 1 in the order given. Ranges are sorted on their own;
    a written table keeps each row's range and place in it."""
    at = F.monotonically_increasing_id()
    cut = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", at), "placed")
    cut = cut.withColumns({"range": F.shiftright("at", 33), "inside": F.col("at").bitwiseAND((1 << 33) - 1)})
    sizes = cut.groupBy("range").agg(F.count(F.lit(1)).alias("size"))
    # One row a range.
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("range").alias("of"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    placed = cut.join(offsets, F.col("range") == F.col("of"))
    return placed.select(*rows.columns, (F.col("offset") + F.col("inside") + 1).alias("place"))


def importance_ranks(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    max_n: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    id: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """struct `doc` of the columns `carry` (all by default), n_words, n_features,
    weight, score and rank. `percent` of the documents with `least_words` words are
    drawn, by largest score and smallest `id`; rank counts them from 1 and is null
    for the others. Both tables have their texts in `text`."""
    gains = fit_gains(docs, target, text, max_n, buckets)
    carry = docs.columns if carry is None else carry
    read = docs.select(F.col(text).cast("string").alias("body"), F.struct(*carry).alias("doc"), F.col(id).alias("id"))
    kinds = {f.name: f.dataType.simpleString() for f in read.schema}
    schema = f"doc {kinds['doc']}, id {kinds['id']}, n_words long, n_features long, weight long"
    weighed = in_arrow(read, _weigher(gains, max_n, ["doc", "id", "n_words", "n_features", "weight"]), schema)
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = staged(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    able = scored.where(F.col("n_words") >= least_words).select("score", "id", "row")
    wanted = percent * able.count() // 100
    drawn = _placed(able, [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]).where(F.col("place") <= wanted)
    ranks = drawn.select(F.col("row").alias("of_row"), F.col("place").cast("long").alias("rank"))
    return scored.join(ranks, F.col("row") == F.col("of_row"), "left").select("doc", "n_words", "n_features", "weight", "score", "rank")


def importance_resample(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The documents that `importance_ranks` draws, with the columns of `docs`."""
    return importance_ranks(docs, target, **how).where("rank IS NOT NULL").select("doc.*")
