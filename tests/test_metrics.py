"""Metrics against direct formulas in numpy."""

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import explain as ex, metrics as me, ranking
from tidemark.operators.ranking import exact_quantiles, hash_order, running_totals, with_rank
from pyspark.sql import functions as F


def auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    d = pos[:, None] - neg[None, :]
    return ((d > 0).sum() + (d == 0).sum() / 2) / d.size


def ap(y, p):
    total, out = y.sum(), 0.0
    for s in np.unique(p):
        at = p >= s
        out += y[p == s].sum() / total * y[at].sum() / at.sum()
    return out


def frames():
    rng = np.random.default_rng(3)
    n = 400
    y = rng.integers(0, 2, n)
    return {
        "spread": (y, rng.random(n)),
        "ties": (y, np.round(rng.random(n), 1)),
        "crowded": (y, 0.3 + rng.random(n) * 1e-7),
        "constant": (y, np.full(n, 0.25)),
        "edges": (y, rng.choice([0.0, 1.0, 0.5], n)),
        "outside": (y, rng.normal(0, 3, n)),
    }


@pytest.fixture(scope="module")
def long(spark):
    parts = [pd.DataFrame({"model": m, "y": y, "p": p}) for m, (y, p) in frames().items()]
    return spark.createDataFrame(pd.concat(parts)).cache()


def test_ranking_metrics(long):
    got = {r.model: r for r in me.ranking_metrics(long).collect()}
    for m, (y, p) in frames().items():
        assert got[m].roc_auc == pytest.approx(auc(y, p), abs=1e-12)
        assert got[m].average_precision == pytest.approx(ap(y, p), abs=1e-12)
    y = frames()["constant"][0]
    assert got["constant"].roc_auc == 0.5
    assert got["constant"].average_precision == pytest.approx(y.mean())


@pytest.mark.parametrize("rows, cuts", [(50, 64), (1, 4096)])
def test_crowded_cells_are_cut(spark, long, monkeypatch, rows, cuts):
    """Scores crowded around any place are cut by counts, and nothing else changes."""
    monkeypatch.setattr(ranking, "CELL_ROWS", rows)
    monkeypatch.setattr(ranking, "CELL_CUTS", cuts)
    got = {r.model: r for r in me.ranking_metrics(long).collect()}
    for m, (y, p) in frames().items():
        assert got[m].roc_auc == pytest.approx(auc(y, p), abs=1e-12)
        assert got[m].average_precision == pytest.approx(ap(y, p), abs=1e-12)


def test_no_window_holds_a_crowd(spark, monkeypatch):
    """40,000 scores in one cell next to 0.3, and 40,000 next to 0.5: every window that
    orders scores is keyed by cell and cut, and none is crowded."""
    monkeypatch.setattr(ranking, "CELL_ROWS", 1000)
    at = F.when(F.col("id") % 2 == 0, 0.3).otherwise(0.5)
    df = spark.range(80_000).select(F.lit("m").alias("m"), (at + F.col("id") * 1e-12).alias("s"), F.lit(1).alias("n"))
    out = running_totals(df, ["m"], "s", ["n"])
    rows = out.orderBy(F.desc("s")).collect()
    assert [r.n_above for r in rows] == list(range(80_000))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_cut" in plan
    assert df.groupBy(ranking._score_cell(F.col("s"))).count().agg(F.max("count")).first()[0] > 10_000


def test_auroc_ignores_monotone_transforms(long):
    bent = long.withColumn("p", F.pow(F.least(F.greatest("p", F.lit(0.0)), F.lit(1.0)), 3))
    a = {r.model: r.roc_auc for r in me.auroc(long).collect()}
    b = {r.model: r.roc_auc for r in me.auroc(bent).collect()}
    for m in ("spread", "ties", "edges"):
        assert a[m] == pytest.approx(b[m])


def test_single_class_is_null(spark):
    df = spark.createDataFrame([("m", 1, 0.2), ("m", 1, 0.9)], "model string, y int, p double")
    r = me.ranking_metrics(df).first()
    assert r.roc_auc is None and r.average_precision == 1.0


def test_sweep_equals_single_thresholds(long):
    sweep = {(r.model, r.threshold): r for r in me.threshold_sweep(long).collect()}
    assert len(sweep) == 19 * len(frames())
    for t in (0.05, 0.05 + 2 * 0.05, 0.05 + 18 * 0.05):
        for r in me.threshold_metrics(long, t).collect():
            assert sweep[r.model, t].asDict() == r.asDict()


def test_calibration_curve(long):
    with pytest.raises(Exception, match="no probability"):
        me.calibration_curve(long).collect()
    got = me.calibration_curve(long.filter("model <> 'outside'")).collect()
    for m, (y, p) in frames().items():
        if m == "outside":
            continue
        edges = np.percentile(p, np.linspace(0, 100, 11))[1:-1]
        bins = np.searchsorted(edges, p)
        want = {b: (p[bins == b].mean(), y[bins == b].mean()) for b in np.unique(bins)}
        mine = {r.bin: (r.mean_predicted, r.fraction_positive) for r in got if r.model == m}
        assert mine.keys() == want.keys()
        for b in want:
            assert mine[b] == pytest.approx(want[b])


def test_calibration_slope_recovers_a_known_line(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1.5, 20000)
    y = (rng.random(x.size) < 1 / (1 + np.exp(-(0.4 + 0.7 * x)))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"model": "m", "y": y, "p": 1 / (1 + np.exp(-x))}))
    r = me.calibration_slope(df, ["m"]).first()
    assert r.calibration_intercept == pytest.approx(0.4, abs=0.06)
    assert r.calibration_slope == pytest.approx(0.7, abs=0.06)


@pytest.mark.parametrize("short", [0, 100, 1_000_000])
def test_exact_quantiles(spark, short, monkeypatch):
    monkeypatch.setattr(ranking, "SHORT_RANGE", short)
    monkeypatch.setattr(ranking, "VALUE_CELLS", 16)
    rng = np.random.default_rng(1)
    groups = {
        "wide": np.concatenate([rng.lognormal(0, 4, 3000), [1e12, -1e9]]),
        "same": np.full(100, 7.5),
        "few": np.array([1.0, 2.0, 10.0]),
        "one": np.array([-3.0]),
        "ties": rng.integers(-3, 4, 500).astype(float),
        "tiny": rng.random(1000) * 1e-300,
        "infinite": np.array([1.0, 2.0, 3.0, np.inf]),
    }
    pdf = pd.concat([pd.DataFrame({"g": g, "v": v}) for g, v in groups.items()])
    fractions = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    df = spark.createDataFrame(pdf).unionByName(
        spark.createDataFrame([("few", None), ("empty", None)], "g string, v double")
    )
    got = {(r.g, r.fraction): r["quantile"] for r in exact_quantiles(df, ["g"], "v", fractions).collect()}
    assert len(got) == len(groups) * len(fractions)
    for g, v in groups.items():
        for f in fractions:
            if g == "infinite" and f >= 0.75:
                assert got[g, f] == np.inf
            else:
                assert got[g, f] == pytest.approx(np.quantile(v, f), rel=1e-12, abs=0)


def test_running_totals_and_ranks(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": "a", "s": rng.permutation(np.concatenate([rng.random(500), 0.5 + np.arange(500) * 1e-12]))})
    pdf["n"] = rng.integers(1, 9, len(pdf))
    got = running_totals(spark.createDataFrame(pdf), ["g"], "s", ["n"]).toPandas().sort_values("s", ascending=False)
    assert (got.n_above.to_numpy() == np.concatenate([[0], got.n.cumsum().to_numpy()[:-1]])).all()

    ids = spark.range(1000).withColumn("g", F.col("id") % 2)
    ranks = with_rank(ids, ["g"], hash_order("id", 1), "id", hex_digits=1).toPandas()
    for _, part in ranks.groupby("g"):
        assert sorted(part["rank"]) == list(range(500))


def test_subgroups_need_size_and_both_classes(spark):
    rows = [("m", i % 2, 0.01 * i, 30, "F") for i in range(49)]
    rows += [("m", 1, 0.5, 70, "M") for _ in range(60)]
    rows += [("m", i % 2, 0.5, 85, None) for i in range(50)]
    df = spark.createDataFrame(rows, "model string, y int, p double, age_at_icu_admission int, gender string")
    rules = {k: v for k, v in ex.SUBGROUPS.items() if k.startswith(("age", "gender"))}
    got = {r.subgroup: (r.n, r.events, r.roc_auc) for r in ex.subgroup_performance(df, rules).collect()}
    assert got == {"age_80+": (50, 25, 0.5)}


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_missing_scores_raise(spark, bad):
    df = spark.createDataFrame([("m", 1, 0.5), ("m", 0, bad)], "model string, y int, p double")
    for metric in (me.ranking_metrics, me.brier, me.confusion, me.threshold_sweep, me.calibration_curve, me.roc_curve):
        with pytest.raises(Exception, match="score is null"):
            metric(df).collect()


def test_probabilities_are_asked_for_where_needed(spark):
    df = spark.createDataFrame([("m", 1, 1.5), ("m", 0, -0.5)], "model string, y int, p double")
    assert me.auroc(df).first().roc_auc == 1.0
    for metric in (me.brier, me.calibration_curve):
        with pytest.raises(Exception, match="no probability"):
            metric(df).collect()


@pytest.mark.parametrize("near", ["zero", "one", "outside"])
def test_crowded_scores_spread_over_cells_and_rank_right(spark, near):
    rng = np.random.default_rng(3)
    p = {"zero": rng.random(20_000) * 4e-8, "one": 1 - rng.random(20_000) * 4e-8, "outside": rng.normal(0, 50, 20_000)}[near]
    y = (rng.random(20_000) < 0.3).astype(int)
    df = spark.createDataFrame([("m", int(a), float(b)) for a, b in zip(y, p)], "model string, y int, p double")
    cells = df.groupBy(ranking._score_cell(F.col("p")).alias("c")).count()
    assert cells.agg(F.max("count")).first()[0] < 100
    order = np.argsort(p, kind="stable")
    _, inverse, counts = np.unique(p, return_inverse=True, return_counts=True)
    ranks = (np.cumsum(counts) - (counts - 1) / 2)[inverse]
    auc = (ranks[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert abs(me.auroc(df).first().roc_auc - auc) < 1e-9 and len(order) == len(p)


def test_score_cells_never_fall(spark):
    edges = [-1e300, -2.0, -1e-300, -0.0, 0.0, 5e-324, 1e-9, 0.49999999999999994, 0.5, 0.75, 1 - 2**-53, 1.0, 1 + 2**-52, 2.0, 1e300]
    df = spark.createDataFrame([(float(x),) for x in edges], "p double")
    cells = [r.c for r in df.select(ranking._score_cell(F.col("p")).alias("c")).collect()]
    assert cells == sorted(cells)
