"""Split, preprocessing, fits and importance."""

from hashlib import md5

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import explain as ex, metrics as me, prep as pp, train as tr
from tidemark.operators.profile import assert_clean, require_valid_target
from tidemark.plans import modelling


@pytest.fixture(scope="module")
def raw(spark):
    rng = np.random.default_rng(2)
    n = 600
    x = rng.normal(0, 1, n)
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "x": x,
            "gap": np.where(rng.random(n) < 0.3, np.nan, rng.integers(0, 5, n)),
            "flat": 3.0,
            "void": np.full(n, np.nan),
            "color": rng.choice(["red", "green", "blue"], n),
            "y": (rng.random(n) < 1 / (1 + np.exp(-2 * x))).astype(int),
        }
    )
    df = spark.createDataFrame(pdf)
    return df.withColumn("color", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("color"))).cache()


NUMBERS, TEXTS = ["x", "gap", "flat", "void"], ["color"]


@pytest.fixture(scope="module")
def split(raw):
    return pp.stratified_split(raw, "y", "id").cache()


@pytest.fixture(scope="module")
def fitted(split):
    return pp.Preprocessor.fit(split.filter("split = 'train'"), NUMBERS, TEXTS)


def test_split_sizes_and_repeatability(raw, split):
    sizes = {(r.y, r.split): r["count"] for r in split.groupBy("y", "split").count().collect()}
    for y in (0, 1):
        total = sizes[y, "test"] + sizes[y, "train"]
        assert sizes[y, "test"] == round(total * 0.2)
    again = pp.stratified_split(raw.repartition(7, "x"), "y", "id")
    assert again.select("id", "split").exceptAll(split.select("id", "split")).isEmpty()
    other = pp.stratified_split(raw, "y", "id", seed=1)
    assert not other.select("id", "split").exceptAll(split.select("id", "split")).isEmpty()
    assert pp.stratified_split(raw, "y", "id", fraction=0.0).filter("split = 'test'").isEmpty()
    assert pp.stratified_split(raw, "y", "id", fraction=1.0).filter("split = 'train'").isEmpty()


def test_preprocessor_matches_numpy(split, fitted):
    train = split.filter("split = 'train'").toPandas().sort_values("id")
    got = fitted.transform(split.filter("split = 'train'"), ["id"]).toPandas().sort_values("id")
    assert fitted.feature_names == [
        "x", "gap", "flat", "missingindicator_gap", "missingindicator_void", "color_blue", "color_green", "color_red",
    ]
    gap = train.gap.fillna(train.gap.median())
    assert np.allclose(got.gap, (gap - gap.mean()) / gap.std(ddof=0))
    assert np.allclose(got.x, (train.x - train.x.mean()) / train.x.std(ddof=0))
    missing = train.gap.isna().astype(float)
    assert np.allclose(got.missingindicator_gap, (missing - missing.mean()) / missing.std(ddof=0))
    assert (got.flat == 0).all() and (got.missingindicator_void == 0).all()
    mode = train.color.mode().min()
    assert (got.color_red == (train.color.fillna(mode) == "red")).all()


def test_unseen_category_is_all_zero(spark, fitted):
    row = spark.createDataFrame([(1, 0.0, 1.0, 3.0, None, "pink")], "id int, x double, gap double, flat double, void double, color string")
    r = fitted.transform(row).first()
    assert (r.color_blue, r.color_green, r.color_red) == (0.0, 0.0, 0.0)


def test_fit_ignores_test_rows(split, fitted):
    broken = split.withColumn("x", F.when(F.col("split") == "test", 1e9).otherwise(F.col("x")))
    assert pp.Preprocessor.fit(broken.filter("split = 'train'"), NUMBERS, TEXTS) == fitted


def test_fit_tables_agree_with_the_fitted_object(split, fitted):
    train = split.filter("split = 'train'")
    scale = {r.feature: (r["mean"], r.scale) for r in pp.fit_scale(train, NUMBERS).collect()}
    for f in fitted.numeric:
        if f.median is not None:
            assert scale[f.column] == pytest.approx((f.mean, f.scale))
    assert {r.column: r["mode"] for r in pp.fit_mode(train, TEXTS).collect()} == {"color": fitted.categorical[0].mode}
    assert {r.column for r in pp.fit_indicators(train, NUMBERS).collect()} == {"gap", "void"}


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert pp.fit_mode(df, ["c"]).first()["mode"] == "a"


def test_save_and_load(spark, fitted, split, tmp_path):
    fitted.save(spark, str(tmp_path / "prep"))
    assert pp.Preprocessor.load(spark, str(tmp_path / "prep")) == fitted
    assert_clean(fitted.transform(split), fitted.feature_names)


def test_many_categories_are_one_entry_a_row(spark):
    df = spark.range(12_000).select(F.concat(F.lit("v"), "id").alias("c"), F.col("id").alias("_text0"))
    model = pp.Preprocessor.fit(df, [], ["c"])
    assert len(model.feature_names) == 12_000
    rows = model.transform_vector(df.limit(50), ["_text0"]).collect()
    assert all(r.features.numNonzeros() == 1 for r in rows)
    for r in rows:
        assert model.feature_names[int(r.features.indices[0])] == f"c_v{r['_text0']}"
    unseen = spark.createDataFrame([("new", 1)], "c string, _text0 int")
    assert model.transform_vector(unseen, ["_text0"]).first().features.numNonzeros() == 0


def test_vectors_equal_the_named_columns(spark, fitted, split):
    named = fitted.transform(split, ["id"]).collect()
    vectors = {r.id: r.features.toArray() for r in fitted.transform_vector(split, ["id"]).collect()}
    for r in named:
        np.testing.assert_allclose(vectors[r.id], [r[n] for n in fitted.feature_names])


def test_categories_of_different_number(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "z"), (None, "x")], "two string, three string")
    model = pp.Preprocessor.fit(df, [])
    rows = [r.features.toArray().tolist() for r in model.transform_vector(df).collect()]
    assert rows == [[1, 0, 1, 0, 0], [0, 1, 0, 1, 0], [1, 0, 0, 0, 1], [1, 0, 1, 0, 0]]


def test_empty_lists_mean_no_column(spark):
    df = spark.createDataFrame([(1, 0, "a", 2.0), (2, 1, "b", 3.0)], "stay_id long, y int, s string, x double")
    assert pp.Preprocessor.fit(df, [], ["s"]).feature_names == ["s_a", "s_b"]
    assert pp.Preprocessor.fit(df, ["x"], []).feature_names == ["x"]
    assert pp.Preprocessor.fit(df, [], []).feature_names == []
    assert set(pp.Preprocessor.fit(df, exclude=["stay_id", "y"]).feature_names) == {"x", "s_a", "s_b"}
    with pytest.raises(ValueError, match="y"):
        pp.Preprocessor.fit(df, ["x", "y"], [], exclude=["stay_id", "y"])


@pytest.mark.parametrize("kept", ["s", "x"])
def test_one_kind_of_column_leaks_nothing(spark, kept):
    rows = [(i, i % 2, "ab"[i % 3 % 2], float(i % 5)) for i in range(60)]
    wide = spark.createDataFrame(rows, "stay_id long, y int, s string, x double").select("stay_id", "y", kept)
    names = modelling.prepare(wide, "stay_id", "y", exclude=[]).preprocessor.feature_names
    assert names == (["s_a", "s_b"] if kept == "s" else ["x"])


def test_subgroup_rules_of_any_form(spark):
    rows = [(i, i % 2, float(i % 7), "MF"[i % 2], 20 + i % 60) for i in range(400)]
    wide = spark.createDataFrame(rows, "stay_id long, y int, x double, gender string, age int")
    prepared = modelling.prepare(wide, "stay_id", "y", exclude=[])
    scores = prepared.test.select("stay_id", F.col("y").alias("y_true"), (F.col("stay_id") % 10 / 10).alias("a_probability"))
    groups = {"not M": "NOT gender = 'M'", "young": "(age < 50)", "lower": "lower(gender) = 'm'", "both": "age >= 30 AND gender = 'F'"}

    def table(rules):
        return modelling.subgroups_of(prepared, scores, rules, min_n=0)

    sizes = {r.subgroup: r.n for r in table({**groups, "all": "age > 0"}).collect()}
    test = [wide_row for wide_row in wide.join(prepared.test.select("stay_id"), "stay_id").collect()]
    assert sizes["young"] == sum(r.age < 50 for r in test) and sizes["all"] == len(test)
    assert set(sizes) <= {*groups, "all"}
    with pytest.raises(Exception, match="nothing_like_it"):
        table({"x": "nothing_like_it = 1"}).collect()


def test_invalid_target_is_refused(spark):
    for rows in ([(2,)], [(None,)]):
        with pytest.raises(ValueError):
            require_valid_target(spark.createDataFrame(rows, "y int"), "y")


@pytest.fixture(scope="module")
def vectors(split, fitted):
    return fitted.transform_vector(split, ["id", "y", "split"]).cache()


def test_logistic_is_at_its_optimum(vectors, fitted):
    """Gradient of C x weighted loss + |w|^2 / 2 vanishes."""
    model = tr.train_logistic(vectors, "y")
    rows = vectors.select("y", "features").collect()
    x = np.array([r.features.toArray() for r in rows])
    y = np.array([r.y for r in rows])
    w = np.where(y == 1, y.size / (2 * y.sum()), y.size / (2 * (y.size - y.sum())))
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    assert np.abs(x.T @ (w * (p - y)) + model.coefficients.toArray()).max() < 1e-2
    assert abs((w * (p - y)).sum()) < 1e-2


@pytest.fixture(scope="module")
def models(vectors):
    train = vectors.filter("split = 'train'")
    return tr.train_all(train, "y", random_forest={"trees": 20}, gradient_boosting={"rounds": 10})


def test_models_beat_chance_and_reload(spark, vectors, models, tmp_path):
    test = vectors.filter("split = 'test'")
    scored = tr.score(models, test, ["id", "y"])
    assert scored.columns == ["id", "y"] + [f"{m}_probability" for m in models]
    assert scored.count() == test.count()
    for r in tr.model_summary(scored, "y").collect():
        assert r.roc_auc > 0.7
    for name, model in models.items():
        tr.save_model(model, str(tmp_path / name))
        again = tr.score({name: tr.load_model(name, str(tmp_path / name))}, test, ["id"])
        assert again.exceptAll(scored.select("id", f"{name}_probability")).isEmpty()


def test_forest_repeats_with_a_seed(vectors):
    one, two = (tr.train_forest(vectors, "y", trees=5, depth=4) for _ in range(2))
    assert one.toDebugString.split("\n", 1)[1] == two.toDebugString.split("\n", 1)[1]


def test_shuffles_are_permutations(spark):
    n = 97
    base = spark.range(n).select(F.col("id").alias("_row"), F.array(F.col("id").cast("double")).alias("_x"))
    plan = ex._shuffles([0], 5, n, 1)
    rows = ex.shuffled_values(base, plan, n).collect()
    assert sorted(r["_row"] for r in rows) == list(range(n))
    for slot, s in enumerate(plan):
        got = {r["_row"]: r.replaced[slot].value for r in rows}
        assert sorted(got.values()) == list(range(n))
        assert all(v == (ex.PRIME * i + s.shift) % n for i, v in got.items())


def test_permutation_importance(vectors, models, fitted):
    test = vectors.filter("split = 'test'")
    names = fitted.feature_names
    got = {}
    for name in ("logistic_regression", "random_forest"):
        table = ex.permutation_importance(models[name], test, "y", "id", names, n_repeats=3, chunk=5)
        got[name] = {r.feature: (r.importance_mean, r.importance_std) for r in table.collect()}
        assert set(got[name]) == set(names)
        assert max(got[name], key=lambda f: got[name][f][0]) == "x"
        assert got[name]["flat"] == (0.0, 0.0)
    rows = test.collect()
    x = np.array([r.features.toArray() for r in rows])
    y = np.array([r.y for r in rows])
    w, b = models["logistic_regression"].coefficients.toArray(), models["logistic_regression"].intercept
    rng = np.random.default_rng(0)

    def auc(p):
        d = p[y == 1][:, None] - p[y == 0][None, :]
        return ((d > 0).sum() + (d == 0).sum() / 2) / d.size

    drops = []
    for _ in range(50):
        z = x.copy()
        z[:, 0] = rng.permutation(z[:, 0])
        drops.append(auc(x @ w + b) - auc(z @ w + b))
    assert abs(got["logistic_regression"]["x"][0] - np.mean(drops)) < 4 * np.std(drops)


def test_trees_score_changed_rows_only(vectors, models, fitted, monkeypatch):
    test, names = vectors.filter("split = 'test'"), fitted.feature_names
    asked, scored = [], ex._scored

    def counted(model, frame):
        asked.append(frame.count())
        return scored(model, frame)

    monkeypatch.setattr(ex, "_scored", counted)
    chosen = ["missingindicator_gap", "x"]
    table = ex.permutation_importance(models["random_forest"], test, "y", "id", names, n_repeats=2, chunk=4, features=chosen)
    got = {r.feature: r.importance_mean for r in table.collect()}
    # A flag stays what it was in most rows.
    n = test.count()
    assert len(asked) == 1 and 2 * n <= asked[0] < 3.4 * n
    # The same drops as when every row is asked.
    rows = {r.id: (r.y, r.features.toArray()) for r in test.collect()}
    order = [i for i in sorted(rows, key=lambda i: (md5(f"42:{i}".encode()).hexdigest(), i))]
    y = np.array([rows[i][0] for i in order])
    x = np.array([rows[i][1] for i in order])

    def auc(z):
        p = np.array([models["random_forest"].predictProbability(Vectors.dense(v))[1] for v in z])
        d = p[y == 1][:, None] - p[y == 0][None, :]
        return ((d > 0).sum() + (d == 0).sum() / 2) / d.size

    for name in chosen:
        f, drops = names.index(name), []
        for s in ex._shuffles([f], 2, n, 42):
            z = x.copy()
            z[:, f] = x[[(ex.PRIME * i + s.shift) % n for i in range(n)], f]
            drops.append(auc(x) - auc(z))
        assert got[name] == pytest.approx(np.mean(drops))


def test_a_forest_is_grown_in_parts(vectors, monkeypatch, tmp_path):
    train, test = (vectors.filter(f"split = '{s}'") for s in ("train", "test"))
    small = tr.train_forest(train, "y", trees=3, depth=4)
    monkeypatch.setattr(tr, "TREES_A_FIT", 3)
    forest = tr.train_forest(train, "y", trees=7, depth=4)
    assert forest.getNumTrees == 7 and len(forest.trees) == 7 and forest.getOrDefault("numTrees") == 7
    assert forest.numFeatures == small.numFeatures and forest.numClasses == 2
    text = [t.toDebugString.split("\n", 1)[1] for t in forest.trees]
    assert text[:3] == [t.toDebugString.split("\n", 1)[1] for t in small.trees] and len(set(text)) == 7
    again = tr.train_forest(train, "y", trees=7, depth=4)
    assert [t.toDebugString.split("\n", 1)[1] for t in again.trees] == text
    assert sum(forest.featureImportances) == pytest.approx(1)
    tr.save_model(forest, str(tmp_path / "forest"))
    both = tr.score({"a": forest, "b": tr.load_model("random_forest", str(tmp_path / "forest"))}, test, ["id"])
    assert both.filter("a_probability <> b_probability").isEmpty()
    # The mean of the trees' shares, as one fit gives it.
    row = test.first()
    shares = np.mean([t.predictProbability(row.features).toArray() for t in forest.trees], axis=0)
    assert forest.predictProbability(row.features).toArray() == pytest.approx(shares)


def test_importance_comparison(spark):
    rows = [("a", 0.1, "m1"), ("b", 0.5, "m1"), ("c", 0.2, "m1"), ("a", 0.9, "m2"), ("b", 0.0, "m2"), ("c", 0.1, "m2")]
    df = spark.createDataFrame(rows, "feature string, importance_mean double, model string")
    got = [tuple(r) for r in ex.compare_importance(df, ["m1", "m2"], 2).collect()]
    assert got == [("b", 0.5, 0.0), ("a", 0.1, 0.9)]


def test_vector_and_named_features_agree(split, fitted):
    named = fitted.transform(split, ["id"]).toPandas().set_index("id").sort_index()
    vector = fitted.transform_vector(split, ["id"]).collect()
    for r in vector[:50]:
        assert np.allclose(r.features.toArray(), named.loc[r.id].to_numpy())


def test_long_form_needs_probabilities(spark):
    with pytest.raises(ValueError):
        me.to_long(spark.createDataFrame([(1,)], "y_true int"))
