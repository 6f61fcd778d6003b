"""Name -> (Spark query, DuckDB text or None)."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.views import view, with_views
from tidemark.operators.cohort import ADMISSION_COLUMNS, PATIENT_COLUMNS, STAY_COLUMNS, cohort
from tidemark.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Query, str | None]] = {}


def check(name: str, sql: str | None = None, doubles: str = "") -> Callable[[Query], Query]:
    """Register a query. Columns in `doubles` are rounded to 6 places in both
    engines, whose summation orders differ."""
    columns = doubles.split()

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(spark, sf).withColumns({c: F.round(c, 6) + F.lit(0.0) for c in columns})

        text = sql
        if sql and columns:
            rounded = ", ".join(f"round({c}, 6) + CAST(0 AS DOUBLE) AS {c}" for c in columns)
            text = f"SELECT * REPLACE ({rounded}) FROM ({sql})"
        assert name not in QUERIES, name
        QUERIES[name] = (run if columns else fn, text)
        return fn

    return add


def scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


# -- the cohort, once per engine -----------------------------------------------

COHORT_VIEWS = "patients admissions icustays"

KEYS_SEEN = {"subject_id", "hadm_id"}
ATTRIBUTES = [
    *(f"i.{c}" for c in STAY_COLUMNS),
    "i.los AS icu_los_days",
    *(f"p.{c}" for c in PATIENT_COLUMNS if c not in KEYS_SEEN),
    *(f"a.{c}" for c in ADMISSION_COLUMNS if c not in KEYS_SEEN),
]

COHORT_CTES = {
    # Everything known about a stay, and the age its calendar year gives.
    "adult": f"""
        SELECT * FROM (
            SELECT {", ".join(ATTRIBUTES)}, CAST(year(i.intime) - (p.anchor_year - p.anchor_age) AS INT) AS age_at_icu_admission
            FROM icustays i, admissions a, patients p
            WHERE (a.hadm_id, a.subject_id) = (i.hadm_id, i.subject_id) AND p.subject_id = i.subject_id)
        WHERE age_at_icu_admission > 17""",
    # No other adult stay of the patient begins before it.
    "first_stay": """
        SELECT * FROM adult s
        WHERE NOT EXISTS (
            SELECT 1 FROM adult e WHERE e.subject_id = s.subject_id AND (e.intime, e.stay_id) < (s.intime, s.stay_id))""",
    # Not dead before the landmark; the outcome is a hospital death after it.
    "cohort": """
        SELECT *, 1 AS survived_to_24h,
               CAST(hospital_expire_flag = 1 AND coalesce(deathtime > prediction_time, false) AS INT) AS mortality_after_24h
        FROM (SELECT *, intime + to_hours(24) AS prediction_time FROM first_stay)
        WHERE NOT coalesce(deathtime < prediction_time, false)""",
}


def cohort_df(spark: SparkSession, sf: str) -> DataFrame:
    return cohort(view(spark, sf, "icustays"), view(spark, sf, "patients"), view(spark, sf, "admissions"))


def cohort_sql(query: str, views: str = "", **ctes: str) -> str:
    """`query` over the cohort, further views and CTEs."""
    return with_views(f"{COHORT_VIEWS} {views}".strip(), query, **COHORT_CTES, **ctes)
