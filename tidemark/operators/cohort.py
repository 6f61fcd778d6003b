"""Index record per entity, eligibility at the landmark, outcome after it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.scalar import label_after, survived_to
from tidemark.functions.timeline import age_at, landmark

STAY_COLUMNS = ["subject_id", "hadm_id", "stay_id", "intime", "outtime", "first_careunit", "last_careunit"]
PATIENT_COLUMNS = ["subject_id", "gender", "anchor_age", "anchor_year", "anchor_year_group"]
ADMISSION_COLUMNS = [
    "subject_id", "hadm_id", "admittime", "dischtime", "deathtime", "admission_type",
    "admission_location", "discharge_location", "insurance", "marital_status", "race",
    "hospital_expire_flag",
]


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def merged(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the table. What its files take, which is all
    that Spark goes by, says little about its rows as a broadcast."""
    return df.hint("merge")


def stay_attributes(icustays: DataFrame) -> DataFrame:
    return select_present(icustays, STAY_COLUMNS + ["los"]).withColumnRenamed("los", "icu_los_days")


def admitted_stays(icustays: DataFrame, admissions: DataFrame) -> DataFrame:
    """Stays with the attributes of their admission."""
    stays = stay_attributes(icustays)
    return stays.join(merged(select_present(admissions, ADMISSION_COLUMNS)), ["hadm_id", "subject_id"])


def adult_stays(stays: DataFrame, patients: DataFrame, min_age: int = 18) -> DataFrame:
    """Stays with patient attributes and age at admission, adults only."""
    joined = stays.join(merged(select_present(patients, PATIENT_COLUMNS)), "subject_id")
    age = age_at("anchor_age", "anchor_year", "intime")
    return joined.withColumn("age_at_icu_admission", age).filter(F.col("age_at_icu_admission") >= min_age)


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """Number the rows of each key; filter `name` = 1 for first or latest rows.

    Spark turns that filter into a per-task limit before the shuffle, so a hot
    key arrives with one row per task.
    """
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key with the smallest `order` values.

    A mergeable minimum: every task sends one row per key, whatever the skew.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key with the largest `order` values."""
    rest = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def first_adult_stay(
    icustays: DataFrame, patients: DataFrame, admissions: DataFrame, min_age: int = 18
) -> DataFrame:
    """First adult stay per patient, with patient and admission attributes.

    The index stay is chosen on identifiers alone; attributes are joined to the
    chosen stays only. Age depends on a stay through its calendar year, so the
    first stay per patient and year is all the patient join needs: a patient with
    very many stays arrives there with one row per year, not in one hot task.
    """
    admitted = icustays.select("subject_id", "hadm_id", "stay_id", "intime").join(
        merged(admissions.select("hadm_id", "subject_id")), ["hadm_id", "subject_id"], "left_semi"
    )
    # Stays of one time are reduced first, so that both steps are hash aggregates.
    at_once = admitted.groupBy("subject_id", "intime").agg(F.min("stay_id").alias("stay_id"), F.min_by("hadm_id", "stay_id").alias("hadm_id"))
    candidates = at_once.groupBy("subject_id", F.year("intime").alias("_year")).agg(
        F.min("intime").alias("intime"), F.min_by("stay_id", "intime").alias("stay_id"), F.min_by("hadm_id", "intime").alias("hadm_id")
    ).drop("_year")
    adults = adult_stays(candidates, patients, min_age)
    index = ranked(adults, ["subject_id"], ["intime", "stay_id"], "_rank").filter(F.col("_rank") == 1)
    chosen = index.drop("_rank", "intime").join(merged(stay_attributes(icustays)), ["subject_id", "hadm_id", "stay_id"])
    return chosen.join(merged(select_present(admissions, ADMISSION_COLUMNS)), ["hadm_id", "subject_id"])


def with_landmark(stays: DataFrame, hours: int = 24) -> DataFrame:
    """Add the landmark, the eligibility flag and the outcome."""
    return stays.withColumn("prediction_time", landmark("intime", hours)).withColumns(
        {
            "survived_to_24h": survived_to("deathtime", "prediction_time"),
            "mortality_after_24h": label_after("hospital_expire_flag", "deathtime", "prediction_time"),
        }
    )


def eligible(stays: DataFrame) -> DataFrame:
    return stays.filter(F.col("survived_to_24h") == 1)


def cohort(
    icustays: DataFrame, patients: DataFrame, admissions: DataFrame, min_age: int = 18, hours: int = 24
) -> DataFrame:
    """One row per eligible patient: index stay, landmark, attributes, outcome."""
    return eligible(with_landmark(first_adult_stay(icustays, patients, admissions, min_age), hours))
