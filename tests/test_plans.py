"""Physical plans: what is read, what is shuffled, and what happens to hot keys."""

import contextlib
import io
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.registry import cohort_df
from checks.views import RULES, view
from tidemark.operators import cohort as co, events as ev, explain as ex, metrics as me, prep as pp, profile as pr
from tidemark.operators.events import summarise, join_cohort
from tidemark.operators.ranking import exact_quantiles
from tidemark.plans import landmark_table as plan
from tidemark.rules import KEYS
from tidemark.session import stage


def explained(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@contextlib.contextmanager
def conf(spark, **settings):
    settings = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


@pytest.fixture(scope="module")
def cohort(spark, sf):
    return stage(cohort_df(spark, sf), "cohort")


@pytest.fixture(scope="module")
def tables(spark, sf):
    names = ("chartevents", "labevents", "ventilation", "inputevents", "outputevents")
    return {n: stage(view(spark, sf, n), n) for n in names}


def test_filters_and_columns_reach_the_scan(tables, cohort):
    text = explained(plan.vitals(tables["chartevents"], cohort, RULES))
    assert "In(itemid" in text and "IsNotNull(valuenum)" in text
    assert "valueuom" not in text


def test_wide_table_joins_on_keys_only(spark, tables, cohort):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = explained(plan.landmark_table(cohort, tables, RULES, slices=8), "simple")
    assert "NestedLoop" not in text and "Cartesian" not in text and "SinglePartition" not in text
    # One scan per event table, the largest one included, and the cohort six times.
    assert text.count("FileScan parquet") == 5 + 6
    # Feature tables arrive partitioned by the keys: of the five assembling joins
    # only the cohort side is shuffled for them.
    spread = [line for line in text.splitlines() if "Exchange hashpartitioning(subject_id" in line]
    # Two more reduce the values of one time first, which deals a hot stay out by its times.
    by_time = [line for line in spread if "charttime" in line]
    assert len(by_time) == 2 and len(spread) - len(by_time) == 1 + 5 * 3 + 2


def test_sliced_cohort_does_not_pass_through_the_driver(tables, cohort):
    # Small files, every row of them repeated: never a broadcast, whatever Spark guesses.
    text = explained(join_cohort(tables["ventilation"], cohort, slices=8), "simple")
    assert "Broadcast" not in text and "SortMergeJoin" in text


def test_orders_do_not_pass_through_the_driver(spark, sf):
    text = explained(view(spark, sf, "ventilation"), "simple")
    assert "Broadcast" not in text and "SortMergeJoin" in text


def test_cohort_tables_do_not_pass_through_the_driver(spark):
    # Files that take almost nothing, though they hold many rows.
    stays = spark.range(1000).selectExpr(
        "id AS stay_id", "id AS hadm_id", "id % 300 AS subject_id", "TIMESTAMP_NTZ '2020-01-01' AS intime",
        "TIMESTAMP_NTZ '2020-01-02' AS outtime", "'a' AS first_careunit", "'a' AS last_careunit", "1.0D AS los",
    )
    admissions = spark.range(1000).selectExpr(
        "id AS hadm_id", "id % 300 AS subject_id", "CAST(NULL AS TIMESTAMP_NTZ) AS deathtime", "0 AS hospital_expire_flag"
    )
    patients = spark.range(300).selectExpr("id AS subject_id", "50 AS anchor_age", "2020 AS anchor_year")
    stays, admissions, patients = (stage(df, "cohort_side") for df in (stays, admissions, patients))
    built = co.cohort(stays, patients, admissions)
    for df in (built, co.admitted_stays(stays, admissions), co.adult_stays(stays, patients)):
        text = explained(df, "simple")
        assert "Broadcast" not in text and "SortMergeJoin" in text
    assert built.count() == 300


def test_permuted_rows_do_not_pass_through_the_driver(spark):
    rows = spark.range(40).select(F.col("id").alias("_row"), F.array(F.col("id").cast("double")).alias("_x"))
    base = stage(rows, "numbered", bucket_by="_row")
    received = ex._received(base, [ex.Shuffle(0, 3), ex.Shuffle(0, 7)], 40)
    text = explained(received, "simple")
    assert "Broadcast" not in text and "SortMergeJoin" in text
    inverse = pow(ex.PRIME, -1, 40)
    for row in received.collect():
        source = {(r - s) * inverse % 40: r for s in (3,) for r in range(40)}
        assert row.replaced[0].value == source[row["_row"]]


def test_scores_do_not_pass_through_the_driver(spark):
    # Few rows that take almost nothing, with many scores each: Spark guesses their size from the files.
    arrays = F.array(*[F.rand(i) for i in range(40)])
    small = stage(spark.range(200).select((F.col("id") % 2).cast("int").alias("y"), arrays.alias("all")), "scores")
    scores = small.select("y", F.posexplode("all").alias("model", "p"))
    points = {most: me.score_points(scores, most=most) for most in (None, 200)}
    # Only the over-full cells, one per CELL_ROWS scores, are sent to all.
    hashed = [line for line in explained(points[None], "simple").splitlines() if "BroadcastHashJoin" in line]
    assert hashed and all("LeftOuter" in line for line in hashed)
    whole = explained(points[200], "simple")
    assert "Broadcast" not in whole and "Join" not in whole
    assert points[None].exceptAll(points[200]).isEmpty() and points[200].count() == 8000
    tables = [me.ranking_metrics(scores, most=most).orderBy("model").collect() for most in (None, 200)]
    for a, b in zip(*tables):
        assert a == pytest.approx(b)


def test_split_does_not_shuffle_the_table(spark, tables, cohort):
    text = explained(pp.stratified_split(cohort, "mortality_after_24h", "stay_id"), "simple")
    final_scan = text[text.index("Project"):].splitlines()
    path = [line for line in final_scan if line.startswith(("   +- ", "      :- ", "         +- "))]
    assert not [line for line in path if "Exchange hashpartitioning" in line]


def test_cohort_reduces_before_the_patient_join(spark, sf):
    """A patient with a third of all stays contributes one row per task and year, after
    its stays were dealt out by their times; both steps are hash aggregates."""
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = explained(cohort_df(spark, sf), "simple")
    assert "partial_min_by(stay_id" in text and "partial_min_by(hadm_id" in text
    assert "SortAggregate" not in text
    assert "SinglePartition" not in text


T0 = datetime(2150, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    """Events of 400 stays, a third of them in one stay, half of those copies."""
    n = 300_000
    stay = F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 399).cast("int")
    minute = F.when(F.col("id") % 6 == 0, 7).otherwise(F.col("id") % 2000).cast("int")
    events = spark.range(0, n, 1, 12).select(
        stay.alias("subject_id"),
        stay.alias("hadm_id"),
        stay.alias("stay_id"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(mins=minute)).alias("charttime"),
        F.lit("heart_rate").alias("variable"),
        (F.when(F.col("id") % 6 == 0, 5).otherwise(F.col("id") % 101)).cast("double").alias("valuenum"),
    )
    stays = spark.range(400).select(
        *[F.col("id").cast("int").alias(k) for k in KEYS],
        F.lit(T0).cast("timestamp_ntz").alias("intime"),
        F.lit(T0 + timedelta(hours=24)).cast("timestamp_ntz").alias("prediction_time"),
    )
    return stage(events, "hot"), stage(stays, "stays")


def windowed(events, stays, slices):
    joined = join_cohort(events, stays, slices=slices)
    return summarise(joined.filter("charttime >= intime AND charttime < prediction_time"))


def test_hot_stay_is_split_and_whole(spark, hot):
    events, stays = hot
    settings = dict(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="60KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="40KB",
        spark__sql__shuffle__partitions="32",
    )
    with conf(spark, **settings):
        sliced = windowed(events, stays, 8)
        rows = sliced.collect()
        final = sliced._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in final
    with conf(spark, spark__sql__adaptive__enabled="false"):
        plain = windowed(events, stays, 1).collect()

    def exact(r):
        return {k: v for k, v in r.asDict().items() if k != "value_mean"}

    assert sorted(map(str, map(exact, rows))) == sorted(map(str, map(exact, plain)))
    assert sum(r.measurement_count for r in rows) == events.filter("charttime < '2150-01-02'").count()


def test_counted_small_cohort_is_broadcast(spark, tables, cohort, monkeypatch):
    assert ev.slices_for(cohort) == 0
    small = plan.ventilation(tables["ventilation"], cohort, slices=0)
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert "BroadcastHashJoin" in explained(small, "simple")
    sliced = plan.ventilation(tables["ventilation"], cohort)
    assert small.exceptAll(sliced).isEmpty() and small.count() == sliced.count()
    monkeypatch.setattr(ev, "BROADCAST_ROWS", 1)
    assert ev.slices_for(cohort) == ev.SLICES


def test_cohort_of_many_megabytes_is_not_broadcast(spark, tables, cohort):
    # The wide table joins it five times, and all five pass through the driver together.
    sources = {n: tables[n] for n in ("chartevents", "labevents", "ventilation", "inputevents", "outputevents")}
    copies = F.array(*[F.lit(i) for i in range(60_000 // cohort.count() + 1)])
    many = stage(cohort.withColumn("copy", F.explode(copies)).drop("copy"), "many")
    assert 60_000 <= many.count() < 70_000
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = explained(plan.landmark_table(many, sources, RULES), "simple")
    hashed = [line for line in text.splitlines() if "BroadcastHashJoin" in line]
    # Item and range tables only.
    assert hashed and not [line for line in hashed if "stay_id" in line or "hadm_id" in line]


def test_slices_spread_a_hot_stay(hot):
    events, stays = hot
    content = [c for c in events.columns if c not in KEYS]
    slice_of = F.pmod(F.xxhash64(*content), F.lit(8))
    sizes = events.filter("stay_id = 0 AND valuenum <> 5").groupBy(slice_of).count().collect()
    assert len(sizes) == 8


def test_constant_scores_collapse_before_the_shuffle(spark):
    df = spark.range(0, 100_000, 1, 8).select(
        F.lit("m").alias("model"), (F.col("id") % 2).cast("int").alias("y"), F.lit(0.5).alias("p")
    )
    points = me.score_points(df)
    assert "partial_sum" in explained(points, "simple")
    assert points.count() == 1


@pytest.mark.parametrize(
    "build",
    [
        lambda df: me.ranking_metrics(df),
        lambda df: me.calibration_curve(df),
        lambda df: me.threshold_sweep(df),
        lambda df: exact_quantiles(df, ["model"], "p", [0.5]),
        lambda df: pr.missingness(df),
    ],
)
def test_no_cross_joins(spark, sf, build):
    text = explained(build(me.to_long(view(spark, sf, "predictions"))), "simple")
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_latest_and_first_agree_with_windows(spark, sf):
    stays = view(spark, sf, "icustays")
    by_min = co.first_per_key(stays, ["subject_id"], ["intime", "stay_id"])
    by_rank = co.ranked(stays, ["subject_id"], ["intime", "stay_id"]).filter("rank = 1").drop("rank")
    assert by_min.exceptAll(by_rank).isEmpty() and by_rank.exceptAll(by_min).isEmpty()
    by_max = co.latest_per_key(stays, ["subject_id"], ["intime", "stay_id"])
    order = [F.desc("intime"), F.desc("stay_id")]
    by_rank = co.ranked(stays, ["subject_id"], order).filter("rank = 1").drop("rank")
    assert by_max.exceptAll(by_rank).isEmpty()


def test_events_after_the_landmark_change_nothing(tables, cohort):
    late = cohort.select(*KEYS, "prediction_time")
    extra = late.select(
        *KEYS,
        F.expr("prediction_time + INTERVAL '1' SECOND").alias("charttime"),
        F.explode(F.array(*[F.lit(i) for i in range(8)])).alias("itemid"),
        F.lit(41.0).alias("valuenum"),
    )
    events = tables["chartevents"].drop("valueuom")
    before = plan.chart_features(events, cohort, RULES)
    after = plan.chart_features(events.unionByName(extra), cohort, RULES)
    rounded = [F.round(c, 9).alias(c) if c.endswith("mean") else c for c in before.columns]
    assert before.select(rounded).exceptAll(after.select(rounded)).isEmpty()
    assert after.count() == before.count()
