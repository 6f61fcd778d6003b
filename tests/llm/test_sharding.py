"""The external shuffle: laws, repetition, and rows against a plain version."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries
from tidemark.llm.sharding import fisher_yates, row_place, write_shards


def documents(spark, path):
    return spark.read.parquet(f"{path}/documents.parquet")


def shards_of(rows):
    found = defaultdict(list)
    for r in rows:
        found[r.shard].append(r.slot)
    return found


@pytest.mark.parametrize("shards, buckets", [(24, None), (7, 3), (1000, 5)])
def test_every_row_once_in_even_shards(spark, awkward, awkward_rows, tmp_path, shards, buckets):
    docs = documents(spark, awkward)
    placed = write_shards(docs, str(tmp_path / "out"), shards=shards, buckets=buckets)
    rows = placed.select("doc.doc_id", "doc.text", "shard", "slot").collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((i, t) for i, t, *_ in awkward_rows)
    assert placed.schema["doc"].dataType.names == docs.columns
    found = shards_of(rows)
    sizes = [len(found[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in found.values())


def test_rows_equal_a_plain_shuffle(spark, sf, tmp_path):
    """Buckets by hash, sorted by hash, permuted, one after the other, cut evenly."""
    docs = documents(spark, sf)
    key = F.xxhash64(F.lit(11), *row_place())
    rows = docs.select("doc_id", key.alias("key"), F.struct(*row_place()).alias("place")).collect()
    buckets = defaultdict(list)
    for r in rows:
        buckets[r.key % 6].append(r)
    order = []
    for b in range(6):
        own = sorted(buckets[b], key=lambda r: (r.key, tuple(r.place)))
        order += [own[i].doc_id for i in fisher_yates(len(own), 11, b)]
    bounds = [s * len(order) // 4 for s in range(5)]
    expected = {(d, s, p - bounds[s]) for s in range(4) for p, d in enumerate(order) if bounds[s] <= p < bounds[s + 1]}
    for k in range(2):  # the same again, however the table is read
        placed = write_shards(documents(spark, sf).coalesce(1 + k), str(tmp_path / f"out{k}"), shards=4, seed=11, place=row_place(), buckets=6)
        assert {(r.doc.doc_id, r.shard, r.slot) for r in placed.collect()} == expected


def test_permutations_are_uniform_and_seeded():
    seen = Counter(tuple(fisher_yates(4, seed, 0).tolist()) for seed in range(12_000))
    assert len(seen) == 24 and max(seen.values()) < 1.25 * 500 and min(seen.values()) > 0.75 * 500
    assert (fisher_yates(50, 1, 2) == fisher_yates(50, 1, 2)).all() and (fisher_yates(50, 1, 2) != fisher_yates(50, 1, 3)).any()
    assert fisher_yates(0, 1, 1).tolist() == []


def test_equal_rows_do_not_fill_a_bucket(spark, tmp_path):
    """A third of all rows alike in every column still fall into all buckets."""
    rows = [(7, "the very same text")] * 600 + [(i, f"text {i}") for i in range(1200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "in"))
    key = F.pmod(F.xxhash64(F.lit(2024), *row_place()), F.lit(16))
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "in")).where("doc_id = 7").groupBy(key).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 600 / 16


def test_query_digests_come_from_the_files(spark, sf):
    texts = {r.doc_id: r.text or "" for r in documents(spark, sf).select("doc_id", "text").collect()}
    rows = queries.op12_sharding(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
    # Neighbours in the input do not stay neighbours.
    order = np.array([r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))])
    assert (np.diff(order) == 1).mean() < 0.05


def test_empty_table(spark, empty, tmp_path):
    assert write_shards(documents(spark, empty), str(tmp_path / "out")).collect() == []
    assert queries.op12_sharding(spark, empty).collect() == []
