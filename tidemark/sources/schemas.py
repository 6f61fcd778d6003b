"""Declared schemas of the warehouse tables. Types are never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

INT, SHORT, DOUBLE, TEXT, TIME = T.IntegerType(), T.ShortType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _required(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, False)


def _optional(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)


# Table layouts the pipeline reads.
TABLES = {
    "admissions": T.StructType(
        [
            _required("subject_id", INT),
            _required("hadm_id", INT),
            _required("admittime", TIME),
            _optional("dischtime", TIME),
            _optional("deathtime", TIME),
            _required("admission_type", TEXT),
            _optional("admit_provider_id", TEXT),
            _optional("admission_location", TEXT),
            _optional("discharge_location", TEXT),
            _optional("insurance", TEXT),
            _optional("language", TEXT),
            _optional("marital_status", TEXT),
            _optional("race", TEXT),
            _optional("edregtime", TIME),
            _optional("edouttime", TIME),
            _optional("hospital_expire_flag", SHORT),
        ]
    ),
    "d_hcpcs": T.StructType(
        [
            _required("code", TEXT),
            _optional("category", SHORT),
            _optional("long_description", TEXT),
            _optional("short_description", TEXT),
        ]
    ),
    "patients": T.StructType(
        [
            _required("subject_id", INT),
            _optional("gender", TEXT),
            _optional("anchor_age", INT),
            _optional("anchor_year", INT),
            _optional("anchor_year_group", TEXT),
        ]
    ),
    "icustays": T.StructType(
        [
            _required("subject_id", INT),
            _required("hadm_id", INT),
            _required("stay_id", INT),
            _optional("intime", TIME),
            _optional("outtime", TIME),
            _optional("first_careunit", TEXT),
            _optional("last_careunit", TEXT),
            _optional("los", DOUBLE),
        ]
    ),
    "d_items": T.StructType(
        [
            _required("itemid", INT),
            _optional("label", TEXT),
            _optional("abbreviation", TEXT),
            _optional("linksto", TEXT),
            _optional("category", TEXT),
            _optional("unitname", TEXT),
            _optional("param_type", TEXT),
            _optional("lownormalvalue", DOUBLE),
            _optional("highnormalvalue", DOUBLE),
        ]
    ),
    "d_labitems": T.StructType(
        [
            _required("itemid", INT),
            _optional("label", TEXT),
            _optional("fluid", TEXT),
            _optional("category", TEXT),
        ]
    ),
    "chartevents": T.StructType(
        [
            _required("subject_id", INT),
            _required("hadm_id", INT),
            _required("stay_id", INT),
            _optional("charttime", TIME),
            _optional("itemid", INT),
            _optional("valuenum", DOUBLE),
            _optional("valueuom", TEXT),
        ]
    ),
    "labevents": T.StructType(
        [
            _required("subject_id", INT),
            _optional("hadm_id", INT),
            _optional("charttime", TIME),
            _optional("itemid", INT),
            _optional("valuenum", DOUBLE),
            _optional("valueuom", TEXT),
        ]
    ),
    "inputevents": T.StructType(
        [
            _required("subject_id", INT),
            _required("hadm_id", INT),
            _required("stay_id", INT),
            _optional("starttime", TIME),
            _optional("endtime", TIME),
            _optional("itemid", INT),
            _optional("rate", DOUBLE),
            _optional("amount", DOUBLE),
            _optional("rateuom", TEXT),
            _optional("amountuom", TEXT),
        ]
    ),
    "outputevents": T.StructType(
        [
            _required("subject_id", INT),
            _required("hadm_id", INT),
            _required("stay_id", INT),
            _optional("charttime", TIME),
            _optional("itemid", INT),
            _optional("value", DOUBLE),
            _optional("valueuom", TEXT),
        ]
    ),
    "ventilation": T.StructType(
        [
            _required("subject_id", INT),
            _required("hadm_id", INT),
            _required("stay_id", INT),
            _optional("starttime", TIME),
            _optional("endtime", TIME),
        ]
    ),
}
