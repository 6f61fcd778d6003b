"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from tidemark.llm.resampling import features, importance_ranks, importance_resample


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def grams(text, max_n):
    found = words(text)
    return [" ".join(found[i : i + n]) for n in range(1, max_n + 1) for i in range(len(found) - n + 1)]


def bucket(gram, buckets):
    return zlib.crc32(gram.encode()) % buckets


def by_hand(rows, target, max_n, buckets, percent, least, seed):
    """(id, n_features, weight, score) of each row, and the drawn ones in order."""
    s, t = (Counter(bucket(g, buckets) for x in side for g in grams(x, max_n)) for side in ([r[1] for r in rows], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (t_more := float(s_all + buckets)) / ((s[b] + 1) * float(t_all + buckets)))) for b in range(buckets)]
    assert t_more
    out = []
    for doc_id, text, *_ in rows:
        own = grams(text, max_n)
        weight = sum(gain[bucket(g, buckets)] for g in own)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return out, able[: percent * len(able) // 100]


def test_features_of_odd_texts():
    texts = ["Ab cd\x00ab, Cd-é x", None, "", "!!", "q" * 5000 + " AB CD", "É é× 漢字a9"]
    got = Counter()
    for row, index, buckets in features(pa.array(texts), 3, 997):
        got.update(zip(row.tolist(), buckets[index].tolist()))
    assert got == Counter((i, bucket(g, 997)) for i, t in enumerate(texts) for g in grams(t, 3))


@pytest.mark.parametrize("max_n, percent, least", [(1, 10, 20), (3, 35, 2), (2, 100, 0)])
def test_ranks_equal_brute_force(spark, awkward, awkward_rows, sf, max_n, percent, least):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    target = [r.text for r in bench.select("text").collect()]
    how = dict(max_n=max_n, buckets=500, percent=percent, least_words=least, seed=7)
    got = importance_ranks(docs, bench, **how).collect()
    every, drawn = by_hand(awkward_rows, target, max_n, 500, percent, least, 7)
    assert Counter((r.doc.doc_id, r.n_features, r.weight, r.score, r.n_words) for r in got) == Counter(every)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc.doc_id, r.score) for r in ranked] == [(r[0], r[3]) for r in drawn]
    assert got[0].doc.asDict().keys() == set(docs.columns)


def test_drawn_documents_keep_their_columns(spark, awkward, sf):
    docs, bench = spark.read.parquet(f"{awkward}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    drawn = importance_resample(docs, bench, percent=50)
    assert drawn.columns == docs.columns and drawn.count() > 0


def test_like_documents_come_first(spark, sf):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    texts = [r.text for r in bench.select("text").collect()]
    other = ["zzq yyw xxv " * 12] * 40
    docs = spark.createDataFrame(list(enumerate(texts + other)), "doc_id long, text string")
    drawn = importance_resample(docs, bench, percent=30, least_words=5)
    assert all(r.doc_id < len(texts) for r in drawn.collect())


def test_empty_tables(spark, empty, sf):
    docs = spark.read.parquet(f"{empty}/documents.parquet")
    assert importance_ranks(docs, docs).collect() == []
    some = spark.createDataFrame([(1, "a b " * 20), (2, None)], "doc_id long, text string")
    got = {r.doc.doc_id: r for r in importance_ranks(some, docs, percent=100).collect()}
    assert got[1]["rank"] == 1 and got[1].n_features == 40 and (got[2].weight, got[2]["rank"]) == (0, None)
