"""Hand-made rows at every edge of the landmark rules."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from tidemark.operators import cohort as co, events as ev, intervals as iv
from tidemark.plans import landmark_table as plan
from tidemark.plans.landmark_table import FeatureRules
from tidemark.rules import VITAL_ITEMS, VITAL_RANGES, Item
from tidemark.sources.schemas import TABLES

T0 = datetime(2150, 3, 1, 12)
H = timedelta(hours=1)
END = T0 + 24 * H


def table(spark, name, rows):
    """Rows as dicts; absent columns are null."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in TABLES[name].fields])
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def people(spark, deaths, **stay):
    """One adult per (flag, deathtime), each with one stay starting at T0."""
    patients = [dict(subject_id=i, gender="F", anchor_age=50, anchor_year=2150) for i in range(len(deaths))]
    admissions = [
        dict(subject_id=i, hadm_id=i, admittime=T0, admission_type="X", deathtime=d, hospital_expire_flag=f)
        for i, (f, d) in enumerate(deaths)
    ]
    stays = [dict(subject_id=i, hadm_id=i, stay_id=i, intime=T0, **stay) for i in range(len(deaths))]
    return (
        table(spark, "icustays", stays),
        table(spark, "patients", patients),
        table(spark, "admissions", admissions),
    )


@pytest.fixture(scope="module")
def one(spark):
    return co.cohort(*people(spark, [(0, None)])).cache()


def test_death_around_the_landmark(spark):
    deaths = [
        (1, END),
        (1, None),
        (1, END + timedelta(seconds=1)),
        (1, END - timedelta(seconds=1)),
        (0, END + H),
        (None, END + H),
    ]
    rows = {r.subject_id: r.mortality_after_24h for r in co.cohort(*people(spark, deaths)).collect()}
    assert rows == {0: 0, 1: 0, 2: 1, 4: 0, 5: 0}


def test_first_adult_stay_and_ties(spark):
    patients = table(
        spark,
        "patients",
        [
            dict(subject_id=1, anchor_age=17, anchor_year=2150),
            dict(subject_id=2, anchor_age=40, anchor_year=2150),
            dict(subject_id=3, anchor_age=17, anchor_year=2150),
        ],
    )
    next_year = T0.replace(year=2151)
    stays = [
        dict(subject_id=1, hadm_id=1, stay_id=1, intime=T0),
        dict(subject_id=1, hadm_id=2, stay_id=2, intime=next_year + H),
        dict(subject_id=1, hadm_id=2, stay_id=3, intime=next_year),
        dict(subject_id=2, hadm_id=3, stay_id=9, intime=T0),
        dict(subject_id=2, hadm_id=3, stay_id=8, intime=T0),
        dict(subject_id=3, hadm_id=4, stay_id=5, intime=T0),
        dict(subject_id=2, hadm_id=99, stay_id=7, intime=T0 - H),
    ]
    admissions = [
        dict(subject_id=s, hadm_id=h, admittime=T0, admission_type="X", hospital_expire_flag=0)
        for s, h in ((1, 1), (1, 2), (2, 3), (3, 4))
    ]
    cohort = co.cohort(table(spark, "icustays", stays), patients, table(spark, "admissions", admissions))
    assert {r.subject_id: (r.stay_id, r.age_at_icu_admission) for r in cohort.collect()} == {1: (3, 18), 2: (8, 40)}


def chart(spark, rows):
    full = [dict(subject_id=0, hadm_id=0, stay_id=0, charttime=t, itemid=i, valuenum=v) for t, i, v in rows]
    return table(spark, "chartevents", full)


def test_event_window_is_half_open(spark, one):
    events = chart(spark, [(T0 - H, 220045, 71.0), (T0, 220045, 72.0), (END - H, 220045, 73.0), (END, 220045, 74.0)])
    r = plan.vitals(events, one).first()
    assert (r.hr_first, r.hr_last, r.hr_measurement_count) == (72.0, 73.0, 2)


def test_range_edges_and_unknown_variables(spark, one):
    values = [20.0, 300.0, 19.99, 300.01, None]
    events = chart(spark, [(T0 + H, 220045, v) for v in values] + [(T0 + H, 999, 50.0)])
    r = plan.vitals(events, one).first()
    assert (r.hr_min, r.hr_max, r.hr_measurement_count) == (20.0, 300.0, 2)
    tagged = ev.tag_items(events, [*VITAL_ITEMS, Item(999, "no_range")])
    assert ev.plausible(tagged, VITAL_RANGES).filter("variable = 'no_range'").isEmpty()


def test_equal_times(spark, one):
    events = chart(spark, [(T0 + H, 220045, v) for v in (80.0, 60.0, 70.0)])
    r = plan.vitals(events, one).first()
    assert (r.hr_first, r.hr_last, r.hr_mean) == (60.0, 80.0, 70.0)


def vent(spark, rows):
    full = [dict(subject_id=0, hadm_id=0, stay_id=0, starttime=s, endtime=e) for s, e in rows]
    return table(spark, "ventilation", full)


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([(T0 - 2 * H, T0)], None),
        ([(END, END + H)], None),
        ([(T0 + H, None)], (T0 + H, END, 23.0)),
        ([(T0 - 5 * H, T0 + H)], (T0, T0 + H, 1.0)),
        ([(T0 + H, T0 + H)], None),
        ([(T0 + 2 * H, T0 + H)], None),
        ([(T0, T0 + 4 * H), (T0 + 2 * H, T0 + 6 * H)], (T0, T0 + 6 * H, 8.0)),
        ([(T0 - H, END + H), (T0, None)], (T0, END, 48.0)),
        ([(None, T0 + H)], None),
    ],
)
def test_intervals(spark, one, rows, expected):
    found = iv.interval_exposure(vent(spark, rows), one).collect()
    got = (found[0].exposure_start, found[0].exposure_end, found[0].exposure_hours) if found else None
    assert got == expected


def urine_row(spark, one, weights, totals=((T0 + H, 240.0),)):
    out = [dict(subject_id=0, hadm_id=0, stay_id=0, charttime=t, itemid=226559, value=v) for t, v in totals]
    return plan.urine_table(
        table(spark, "outputevents", out), chart(spark, [(t, 226512, w) for t, w in weights]), one
    ).first()


def test_weight_at_the_landmark_is_known(spark, one):
    r = urine_row(spark, one, [(T0, 60.0), (END, 80.0), (END + H, 90.0)])
    assert (r.weight_kg, r.weight_time, r.urine_output_ml_kg_h_24h) == (80.0, END, 240.0 / 80 / 24)


def test_old_weight_and_tied_weights(spark, one):
    assert urine_row(spark, one, [(T0 - 240 * H, 70.0)]).weight_kg == 70.0
    assert urine_row(spark, one, [(T0, 70.0), (T0, 75.0), (T0, 301.0)]).weight_kg == 75.0


def test_no_weight_keeps_the_total(spark, one):
    r = urine_row(spark, one, [])
    assert (r.urine_output_ml_24h, r.weight_kg, r.urine_output_ml_kg_h_24h) == (240.0, None, None)


def test_stay_without_events(spark, one):
    empty = {
        "chartevents": chart(spark, []),
        "labevents": table(spark, "labevents", []),
        "ventilation": vent(spark, []),
        "inputevents": table(spark, "inputevents", []),
        "outputevents": table(spark, "outputevents", []),
    }
    wide = plan.landmark_table(one, empty)
    assert len(wide.columns) == 192
    row = wide.first()
    assert row.hr_first is None and row.sodium_mean is None and row.ventilation_start is None
    assert row.mechanical_ventilation_24h == row.vasopressor_any_24h == row.pressor_exposure_hours == 0
    assert row.urine_output_ml_24h == row.urine_measurement_count == row.urine_output_missing == 0


def test_labs_without_a_stay_follow_the_window(spark, one):
    rows = [
        dict(subject_id=0, hadm_id=0, charttime=t, itemid=i, valuenum=v)
        for t, i, v in [(T0, 50971, 140.0), (T0 + H, 50824, 142.0), (END, 50971, 150.0), (T0 + H, 51221, 40.0)]
    ]
    r = plan.labs(table(spark, "labevents", rows), one).first()
    assert (r.sodium_first, r.sodium_last, r.sodium_max) == (140.0, 142.0, 142.0)
    assert not [c for c in r.asDict() if c.startswith("hematocrit")]


def test_rules_are_data(spark, one):
    events = chart(spark, [(T0 + H, 7, 55.0), (T0 + H, 8, 66.0), (T0 + H, 9, 1.0)])
    row = plan.weight(events, one, FeatureRules(weight_items=[Item(7, "weight"), Item(8, "weight")])).first()
    assert row.weight_kg == 66.0
    items = spark.createDataFrame([(7, "a"), (8, "a"), (9, "b")], "itemid int, variable string")
    ranges = spark.createDataFrame([("a", 55.0, 66.0)], "variable string, low double, high double")
    assert ev.plausible(ev.tag_items(events, items), ranges).count() == 2
