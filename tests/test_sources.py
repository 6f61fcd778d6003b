"""Declared schemas, constraints and round trips."""

import os
from datetime import datetime

import pytest
from pyspark.sql import types as T

from tidemark.operators.events import join_cohort
from tidemark.operators.ranking import with_position
from tidemark.session import shared_dir, stage, staging
from tidemark.sources import io
from tidemark.sources.schemas import TABLES

T0 = datetime(2150, 3, 1, 12, 30, 5, 250000)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_admissions_round_trip(spark, tmp_path, fmt):
    row = {f.name: None for f in TABLES["admissions"].fields}
    row |= {"subject_id": 1, "hadm_id": 2, "admittime": T0, "admission_type": "URGENT", "hospital_expire_flag": 1}
    rows = [tuple(row.values()), tuple((row | {"hadm_id": 3, "deathtime": T0, "race": 'a "b", c'}).values())]
    df = spark.createDataFrame(rows, TABLES["admissions"])
    path = str(tmp_path / fmt)
    if fmt == "csv":
        io.write_csv(df, path)
    else:
        io.write_table(df, path)
    back = io.read_table(spark, "admissions", path, fmt)
    assert [f.dataType for f in back.schema] == [f.dataType for f in TABLES["admissions"]]
    assert back.exceptAll(df).isEmpty() and back.count() == 2
    assert not [r for r in io.null_violations(back, "admissions").collect() if r.violations]
    assert io.require_not_null(back, "admissions") is back


def test_null_in_a_required_column_is_refused(spark):
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in TABLES["d_items"].fields])
    df = spark.createDataFrame([(None,) * len(schema)], schema)
    with pytest.raises(ValueError, match="itemid"):
        io.require_not_null(df, "d_items")


def test_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_table(spark.range(5), path)
    io.write_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_staged_table_is_read_from_the_shared_folder(spark):
    df = stage(spark.range(10), "ten")
    assert df.count() == 10
    assert all(shared_dir(spark) in f for f in df.inputFiles())


def test_named_relation(spark):
    io.register(spark.range(4), "tidemark_four")
    assert spark.sql("SELECT count(*) AS n FROM tidemark_four").first().n == 4


def test_bucketed_tables_join_without_a_shuffle(spark):
    keys = ["subject_id", "hadm_id", "stay_id"]
    rows = spark.range(1000).selectExpr("id % 50 AS subject_id", "id % 50 AS hadm_id", "id % 50 AS stay_id", "id AS v")
    stays = rows.select(*keys).distinct().selectExpr("*", "1 AS intime", "2 AS prediction_time")
    names = ("tidemark_bucketed_events", "tidemark_bucketed_stays")
    try:
        for df, name in zip((rows, stays), names):
            io.write_table(df, name, bucket_by=keys, buckets=4)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = join_cohort(spark.table(names[0]), spark.table(names[1]), slices=1)
        assert joined.count() == 1000
        assert "Exchange hashpartitioning(subject_id" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_csv_is_read_by_name(spark, tmp_path):
    folder = tmp_path / "named"
    folder.mkdir()
    (folder / "part.csv").write_text('b,a,extra\n"x ""q"", y",1,z\n"two\nlines",2,\n"",3,w\n,4,w\n')
    rows = io.read_csv(spark, str(folder), "a INT, b STRING").collect()
    assert [tuple(r) for r in rows] == [(1, 'x "q", y'), (2, "two\nlines"), (3, ""), (4, None)]
    with pytest.raises(ValueError, match="lacks"):
        io.read_csv(spark, str(folder), "a INT, missing STRING")


def test_csv_with_a_bad_cell_fails(spark, tmp_path):
    folder = tmp_path / "bad"
    folder.mkdir()
    (folder / "part.csv").write_text("a,b\n1,x\nnot a number,y\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        io.read_csv(spark, str(folder), "a INT, b STRING").collect()


def test_staged_folders_go_with_their_owner(spark):
    folder = shared_dir(spark).removeprefix("file:")

    def left():
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    before = left()
    with staging(spark):
        kept = stage(spark.range(10), "owned")
        assert kept.count() == 10 and len(left() - before) == 1
        with staging(spark):
            assert stage(kept, "inner").count() == 10
        assert len(left() - before) == 1
    assert left() == before


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_nan_is_read_as_missing(spark, tmp_path, fmt):
    schema = T.StructType([T.StructField("stay_id", T.LongType()), T.StructField("value", T.DoubleType()), T.StructField("note", T.StringType())])
    rows = [(1, 2.0, "NaN"), (1, float("nan"), None), (1, None, ""), (2, float("inf"), "x")]
    path = str(tmp_path / fmt)
    df = spark.createDataFrame(rows, schema)
    io.write_csv(df, path) if fmt == "csv" else io.write_table(df, path)
    back = io.read_table(spark, "outputevents", path, fmt, schema)
    assert back.schema["note"].dataType == T.StringType()
    assert {(r.stay_id, r.total) for r in back.filter("value >= 0").groupBy("stay_id").agg({"value": "sum"}).toDF("stay_id", "total").collect()} == {
        (1, 2.0), (2, float("inf")),
    }
    assert back.filter("value IS NULL").count() == 2
    assert {r.note for r in back.filter("stay_id = 1").collect()} == {"NaN", None, ""}


@pytest.mark.parametrize("rows, parts", [(0, 3), (1, 1), (5000, 7)])
def test_position_follows_the_order_of_the_frame(spark, rows, parts):
    df = spark.range(rows).selectExpr("id % 10 AS `a.b`", "(id * 7919) % 5003 AS v").repartitionByRange(parts, "v").sortWithinPartitions("v")
    found = with_position(df, "nr").collect()
    assert with_position(df, "nr").columns == ["a.b", "v", "nr"]
    assert [r.nr for r in sorted(found, key=lambda r: r.v)] == list(range(1, rows + 1))
