"""Statistics of many columns at once, calibration lines and replaced tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import events as ev, metrics as me, profile as pr, train as tr, wide
from tidemark.operators.asof import as_of_last
from tidemark.operators.ranking import resolved
from tidemark.session import stage
from tidemark.sources.io import write_table


def columns():
    rng = np.random.default_rng(2)
    n = 3000
    made = {
        "spread": rng.lognormal(0, 4, n),
        "same": np.full(n, 7.5),
        "few": rng.integers(-2, 3, n).astype(float),
        "tiny": rng.random(n) * 1e-300,
        "gaps": np.where(rng.random(n) < 0.9, np.nan, rng.normal(size=n)),
        "none": np.full(n, np.nan),
        "infinite": np.where(rng.random(n) < 0.01, np.inf, rng.random(n)),
        "crowded": 0.3 + rng.random(n) * 1e-9,
    }
    return pd.DataFrame(made).assign(side=rng.choice(["a", "b's"], n))


@pytest.mark.parametrize("accuracy", [1000, 5])
def test_statistics_equal_numpy(spark, monkeypatch, accuracy):
    """Also where the brackets are coarse."""
    monkeypatch.setattr(wide, "ACCURACY", accuracy)
    pdf = columns()
    df, names, fractions = spark.createDataFrame(pdf), [c for c in pdf if c != "side"], [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for by in ([], ["side"]):
        rows = wide.column_statistics(df, names, fractions, by).collect()
        assert len(rows) == len(names) * (2 if by else 1)
        for r in rows:
            part = pdf if not by else pdf[pdf.side == r.side]
            known = part[r.column].dropna().to_numpy()
            assert (r.n, r["count"]) == (len(part), len(known))
            if not len(known):
                assert r.quantiles is None and r.mean is None
                continue
            assert (r.min, r.max) == pytest.approx((known.min(), known.max()), rel=1e-12)
            ends = [known.min(), known.max()]
            inner = np.quantile(known, fractions[1:-1]).tolist()
            assert r.quantiles == pytest.approx([ends[0], *inner, ends[1]], rel=1e-12)
            if np.isfinite(known).all():
                assert r["mean"] == pytest.approx(known.mean()) and r.std == pytest.approx(known.std(ddof=1), rel=1e-6, abs=1e-12)


def test_brackets_that_miss_are_widened(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    found = [wide._Column((), "v", (1000, 1000, 0.0, 0.0, 0.0, 0.0, 999.0), (10.0, 20.0))]
    assert wide._quantiles(df, found, [0.5], []) == {((), "v"): [499.5]}


def test_no_columns_and_no_rows(spark):
    df = spark.createDataFrame([], "a double, b int")
    assert wide.column_statistics(df, ["a", "b"], [0.5]).collect() == []
    assert wide.column_statistics(df, [], [0.5]).collect() == []


def test_three_scans_of_a_wide_table(spark, tmp_path):
    """Moments, counts below brackets, and the open values: then the table is left alone."""
    path = str(tmp_path / "wide")
    spark.range(2000).select(*[F.rand(i).alias(f"c{i}") for i in range(60)]).write.parquet(path)
    df = spark.read.parquet(path)
    seen = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(wide, "stage", lambda d, name: seen.append(("staged", d.columns)) or stage(d, name))
        m.setattr(wide, "resolved", lambda d, *a: seen.append(("resolved", d.inputFiles())) or resolved(d, *a))
        got = wide.column_statistics(df, df.columns, [0.25, 0.5, 0.75]).collect()
    assert len(got) == 60
    assert [s[0] for s in seen] == ["staged", "resolved"]
    assert seen[0][1] == ["id", "_v"] and not any(path in f for f in seen[1][1])


def test_plans_of_first_last_and_as_of(spark):
    """Hash aggregates on a plain timestamp, no sort by group."""
    events = spark.createDataFrame([], "subject_id long, hadm_id long, stay_id long, charttime timestamp_ntz, variable string, valuenum double")
    cohort = spark.createDataFrame([], "subject_id long, hadm_id long, stay_id long, prediction_time timestamp_ntz")
    for df in (ev.summarise(events), as_of_last(events, cohort)):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_null_values_are_no_first_value(spark):
    rows = [("k", 1, None), ("k", 2, 5.0), ("k", 3, 7.0), ("k", 4, None), ("n", 1, None)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    got = {r.k: r for r in ev.summarise(df, ["k"], "v", "t").collect()}
    assert (got["k"].value_first, got["k"].value_last, got["k"].value_mean, got["k"].measurement_count) == (5.0, 7.0, 6.0, 4)
    assert (got["n"].value_first, got["n"].value_mean, got["n"].measurement_count) == (None, None, 1)


def test_calibration_lines(spark):
    """Newton from far away, several models at once, and scores without a line."""
    rng = np.random.default_rng(5)
    x = rng.normal(0, 6, 5000)
    y = (rng.random(x.size) < 1 / (1 + np.exp(-(2 - 0.3 * x)))).astype(int)
    p = 1 / (1 + np.exp(-x))
    parts = [
        pd.DataFrame({"model": "turned", "y": y, "p": p}),
        pd.DataFrame({"model": "right", "y": (rng.random(x.size) < p).astype(int), "p": p}),
        pd.DataFrame({"model": "constant", "y": y, "p": 0.25}),
        pd.DataFrame({"model": "one class", "y": 1, "p": p}),
        pd.DataFrame({"model": "apart", "y": (p > 0.5).astype(int), "p": p}),
    ]
    names = [d.model.iloc[0] for d in parts] + ["absent"]
    got = {r.model: (r.calibration_intercept, r.calibration_slope) for r in me.calibration_slope(spark.createDataFrame(pd.concat(parts)), names).collect()}
    for d in parts[:2]:
        z = np.log(np.clip(d.p, 1e-6, 1 - 1e-6) / (1 - np.clip(d.p, 1e-6, 1 - 1e-6)))
        a, b = got[d.model.iloc[0]]
        off = d.y - 1 / (1 + np.exp(-(a + b * z)))
        assert abs(off.sum()) < 1e-6 and abs((off * z).sum()) < 1e-5
    assert all(got[m] == (None, None) for m in ("constant", "one class", "apart", "absent"))


def test_gradient_names_every_feature(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 2))
    y = (rng.random(500) < 1 / (1 + np.exp(-x[:, 0]))).astype(int)
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(int(b), Vectors.dense(a)) for a, b in zip(x.tolist(), y)], ["y", "features"])
    model = tr.train_logistic(df, "y")
    at_fit = {r.feature: r.gradient for r in tr.logistic_gradient(model, df, "y", ["a", "b"]).collect()}
    assert at_fit.keys() == {"a", "b", "intercept"} and all(abs(g) < 1e-5 for g in at_fit.values())
    elsewhere = tr.train_logistic(df, "y", max_iter=0)
    assert max(abs(r.gradient) for r in tr.logistic_gradient(elsewhere, df, "y", ["a", "b"]).collect()) > 1e-2


def test_boosting_stops_early_on_noise_alone(spark):
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(3)
    rows = [(i, int(rng.random() < 0.5), Vectors.dense(rng.normal(size=3).tolist())) for i in range(400)]
    df = spark.createDataFrame(rows, ["id", "y", "features"])
    stopped = tr.train_boosting(df, "y", rounds=60, depth=3, validation=0.3, key="id")
    assert stopped.getNumTrees < 60
    plain = tr.train_boosting(df, "y", rounds=3, depth=3)
    assert plain.getNumTrees == 3
    with pytest.raises(ValueError):
        tr.train_boosting(df, "y", validation=0.3)


def test_clean_vectors(spark):
    from pyspark.ml.linalg import Vectors

    rows = [("a", Vectors.dense([1.0, float("nan")])), ("a", Vectors.sparse(3, [1], [float("inf")])), ("b", None), ("b", Vectors.dense([0.0]))]
    got = {r.s: (r.rows, r.null_n, r.infinite_n) for r in pr.clean_vectors(spark.createDataFrame(rows, ["s", "features"]), by=["s"]).collect()}
    assert got == {"a": (2, 1, 1), "b": (2, 1, 0)}


def test_distinct_counts_expand_no_rows(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 6, 0), (None, 6, 1)], "a int, b int, y int")
    report = pr.cohort_summary(df, "y", ["a", "b"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "gid" not in plan and "distinct" not in plan
    got = {r.metric: r.value for r in report.collect()}
    assert got["unique_a"] == 1 and got["unique_b"] == 2 and got["rows"] == 3 and got["event_rate"] == pytest.approx(2 / 3)


@pytest.mark.parametrize("how", ["folder", "table", "buckets"])
def test_failed_replacement_leaves_the_old_table(spark, tmp_path, how):
    target = str(tmp_path / "table") if how == "folder" else f"replaced_{how}"
    options = {"folder": {}, "table": {"as_table": True}, "buckets": {"bucket_by": ["k"], "buckets": 2}}[how]

    def rows():
        table = spark.read.parquet(target) if how == "folder" else spark.table(target)
        return sorted(r.k for r in table.collect())

    spark.sql(f"DROP TABLE IF EXISTS {target}") if how != "folder" else None
    write_table(spark.range(3).select(F.col("id").alias("k")), target, **options)
    broken = spark.range(1000).repartition(8).select(F.when(F.col("id") == 900, F.raise_error(F.lit("half way"))).otherwise(F.col("id")).cast("long").alias("k"))
    with pytest.raises(Exception, match="half way"):
        write_table(broken, target, **options)
    assert rows() == [0, 1, 2]
    write_table(spark.range(5, 7).select(F.col("id").alias("k")), target, **options)
    assert rows() == [5, 6]
    left = [f.name for f in tmp_path.iterdir()] if how == "folder" else [t.name for t in spark.catalog.listTables() if t.name.startswith("replaced")]
    assert [n for n in left if n.endswith(("_new", "_old")) or "_new_" in n or "_old_" in n] == []
    if how == "folder":  # a table may be replaced by what is read from it
        write_table(spark.read.parquet(target).where("k > 5"), target)
        assert rows() == [6]
    else:
        spark.sql(f"DROP TABLE {target}")
