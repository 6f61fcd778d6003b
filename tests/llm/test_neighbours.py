"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries
from tidemark.llm.neighbours import nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(rows, k=10, every=100):
    """query -> [(vec_id, distance)]."""
    good = [(i, np.array(v, np.float64)) for i, v, *_ in rows if i is not None and v and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    size = max({len(v) for _, v in good}, key=lambda n: sum(len(v) == n for _, v in good)) if good else 0
    good = [(i, np.float32(v).astype(np.float64)) for i, v in good if len(v) == size]
    out = {}
    for i, v in good:
        if i % every == 0:
            far = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in good if j != i)[:k]
            out[i] = [(j, d) for d, j in far]
    return out


def recall(got, expected):
    found, hit, wanted = {}, 0, 0
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == {q for q, e in expected.items() if e}
    for q, e in expected.items():
        own = sorted(found.get(q, []))
        assert [r for r, _, _ in own] == list(range(1, len(e) + 1))
        assert [(s, i) for _, i, s in own] == sorted((s, i) for _, i, s in own)
        hit += len({i for _, i, _ in own} & {i for i, _ in e})
        wanted += len(e)
    return hit / max(wanted, 1)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_recall_on_real_rows(spark, size):
    sf = f"/root/testdata/{size}"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.op10_nearest(spark, sf).collect()
    expected = by_hand(rows)
    assert recall(got, expected) >= 0.95
    exact = {(q, i): d for q, e in expected.items() for i, d in e}
    assert all(abs(exact[r.query_id, r.vec_id] - r.score) < 1e-9 for r in got if (r.query_id, r.vec_id) in exact)


def test_copies_ties_and_bad_vectors(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 700)]  # one vector holds more than half
    rows += [(700, None), (701, []), (800, [0.0] * 8), (900, [float("nan")] * 8), (1000, [1.0, None] * 4), (1100, [float("inf")] * 8), (1200, [1.0, 2.0]), (None, rows[0][1])]
    table = spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], SCHEMA + ", node string, score double").repartition(6)
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op10_nearest(spark, str(tmp_path)).collect()
    expected = by_hand(rows)
    assert set(expected) == {0, 100, 200, 300, 400, 500, 600}
    assert recall(got, expected) == 1.0
    own = sorted((r.rank, r.vec_id) for r in got if r.query_id == 400)
    assert own == list(enumerate([7, 300, 301, 302, 303, 304, 305, 306, 307, 308], 1))


@pytest.mark.parametrize("n", [1, 2, 5])
def test_fewer_candidates_than_wanted(spark, n):
    rows = [(100 * i, [1.0 + i, 2.0]) for i in range(n)]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0).collect()
    assert recall(got, by_hand(rows)) == 1.0 or n == 1
    assert len(got) == n * (n - 1)


def test_empty_table(spark, empty):
    assert queries.op10_nearest(spark, empty).collect() == []


@pytest.mark.parametrize("noise", [1e-3, 1e-4])
def test_recall_within_a_dense_group(spark, tmp_path, noise):
    """A third of all rows differ from one vector by less than a hundredth of a component."""
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(64)
    rows = [(i, (centre + noise * rng.standard_normal(64) if i % 3 == 0 else rng.standard_normal(64)).astype(np.float32).tolist(), 0) for i in range(3000)]
    spark.createDataFrame(rows, SCHEMA).repartition(6).write.parquet(f"{tmp_path}/embeddings.parquet")
    expected = by_hand(rows)
    assert sum(q % 3 == 0 for q in expected) == 10
    assert recall([r for r in queries.op10_nearest(spark, str(tmp_path)).collect() if r.query_id % 3 == 0], {q: e for q, e in expected.items() if q % 3 == 0}) >= 0.95
