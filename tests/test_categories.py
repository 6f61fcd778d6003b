"""One-hot features by a joined table of categories."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tidemark.operators import categories as ca, prep as pp
from tidemark.operators.categories import CategoryTable

ROWS = [
    (1, "b", "x", 1.0), (2, "a", None, 2.0), (3, "b", "y", None), (4, None, "é", 4.0), (5, "a", "x", 5.0),
    (6, "b", "", 6.0), (7, "it's \\ odd", "x", 7.0), (8, "b", "x", 8.0),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "id long, one string, `two words` string, z double").cache()


@pytest.fixture(params=["broadcast", "shuffled"])
def width(request, monkeypatch):
    if request.param == "shuffled":
        monkeypatch.setattr(ca, "BROADCAST_VALUES", 0)
        monkeypatch.setattr(ca, "FREQUENT", 3)


def test_equals_the_expression_form(rows, width):
    columns = ["one", "two words"]
    plain = pp.Preprocessor.fit(rows, ["z"], columns)
    table = CategoryTable.fit(rows, columns)
    assert [r.feature for r in table.names().orderBy("position").collect()] == plain.feature_names[2:]
    numbers = pp.Preprocessor.fit(rows, ["z"], [])
    got = {r.id: r.features.toArray() for r in table.vectors(rows, ["id"], numbers).collect()}
    for r in plain.transform_vector(rows, ["id"]).collect():
        np.testing.assert_allclose(got[r.id], r.features.toArray())


def test_unseen_null_and_empty(spark, rows, width):
    table = CategoryTable.fit(rows, ["one", "two words"])
    assert [(c.column, c.mode, c.values) for c in table.columns] == [("one", "b", 3), ("two words", "x", 4)]
    given = spark.createDataFrame([(1, "new", None), (2, None, "never"), (3, "new", "never")], "id long, one string, `two words` string")
    got = {r.id: list(map(int, r.features.indices)) for r in table.vectors(given, ["id"]).collect()}
    assert got == {1: [4], 2: [1], 3: []}  # "", x, y, é take places 3 to 6
    assert table.vectors(given.limit(0), ["id"]).collect() == []


def test_no_values_no_rows(spark, rows):
    void = rows.withColumn("none", F.lit(None).cast("string"))
    table = CategoryTable.fit(void, ["none", "one"])
    assert [c.column for c in table.columns] == ["one"] and len(table) == 3
    nothing = CategoryTable.fit(rows.limit(0), ["one"])
    assert len(nothing) == 0
    assert {r.features.size for r in nothing.vectors(rows, ["id"]).collect()} == {0}


def test_rows_keep_clashing_columns(rows, width):
    table = CategoryTable.fit(rows, ["one"])
    named = rows.select("id", "one", *[F.lit(n).alias(n) for n in ("_kept", "value", "position", "slice", "_text0", "_place0", "_value", "n")])
    got = table.vectors(named, named.columns)
    assert got.columns == [*named.columns, "features"] and got.count() == len(ROWS)
    assert got.exceptAll(got.limit(0)).count() == len(ROWS)


def test_repeated_rows_stay(rows, width):
    table = CategoryTable.fit(rows, ["one"])
    assert table.vectors(rows.unionAll(rows), ["id"]).count() == 2 * len(ROWS)


def test_save_and_load(spark, rows, tmp_path):
    table = CategoryTable.fit(rows, ["one", "two words"])
    table.save(f"{tmp_path}/categories")
    again = CategoryTable.load(spark, f"{tmp_path}/categories")
    assert again.columns == table.columns
    assert sorted(map(str, again.vectors(rows, ["id"]).collect())) == sorted(map(str, table.vectors(rows, ["id"]).collect()))


def test_many_values_with_a_hot_one(spark, monkeypatch):
    """A third of the rows share a value; of the rest nearly every row has its own."""
    df = spark.range(300_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), "id")).alias("c"), (F.col("id") % 2).alias("y")
    )
    table = CategoryTable.fit(df, ["c"])
    assert len(table) == 200_001
    vectors = table.vectors(df, ["id", "y"])
    assert vectors.count() == 300_000
    place = {r.feature: r.position for r in table.names().where("feature IN ('c_hot', 'c_v1', 'c_v299999')").collect()}
    found = vectors.where("id IN (0, 1, 3, 299999)").collect()
    assert {r.id: r.features.indices.tolist() for r in found} == {
        0: [place["c_hot"]], 1: [place["c_v1"]], 3: [place["c_hot"]], 299_999: [place["c_v299999"]]
    }
    order = table.table.orderBy("position").select("value").limit(5).collect()
    assert [r.value for r in order] == sorted(["hot", *(f"v{i}" for i in range(300_000) if i % 3)])[:5]
    # What training reads is an ordinary vector column.
    assert LogisticRegression(featuresCol="features", labelCol="y", maxIter=1).fit(vectors).numFeatures == 200_001


def test_the_frequent_rows_are_spread(spark, monkeypatch):
    monkeypatch.setattr(ca, "BROADCAST_VALUES", 10)
    df = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("c"))
    table = CategoryTable.fit(df, ["c"])
    joined = table.positions(df, ["id"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan and "Cartesian" not in plan
    keyed = df.select(F.when(F.col("c") == "hot", F.pmod(F.xxhash64(F.struct("id")), F.lit(ca.SLICES)).cast("int")).otherwise(0).alias("s"), "c")
    hot = keyed.where("c = 'hot'").groupBy("s").count().agg(F.max("count")).first()[0]
    assert hot < 50
