"""Rule tables: what the clinical pipeline looks for, as plain data.

Operators take rules as arguments; nothing here is wired into their logic.
"""

from __future__ import annotations

from typing import NamedTuple


class Item(NamedTuple):
    itemid: int
    variable: str


class Range(NamedTuple):
    variable: str
    low: float
    high: float


class Label(NamedTuple):
    """Names a lower-cased label that is in `equal` or matches one of `like`,
    unless it matches one of `unlike`."""

    variable: str
    like: tuple[str, ...] = ()
    equal: tuple[str, ...] = ()
    unlike: tuple[str, ...] = ()


# ---------------------------------------------------------------------------
# Item identifiers, plausible ranges and output prefixes.
# They must equal the values users rely on, so they are listed as they are.
# ---------------------------------------------------------------------------

VITAL_ITEMS = [
    Item(220045, "heart_rate"),
    Item(220179, "systolic_bp"),
    Item(220180, "diastolic_bp"),
    Item(220181, "mean_arterial_pressure"),
    Item(220210, "respiratory_rate"),
    Item(220277, "spo2"),
    Item(223761, "temperature"),
    Item(223900, "gcs_total"),
]

VITAL_RANGES = [
    Range("heart_rate", 20, 300),
    Range("systolic_bp", 30, 300),
    Range("diastolic_bp", 10, 200),
    Range("mean_arterial_pressure", 20, 250),
    Range("respiratory_rate", 1, 100),
    Range("spo2", 50, 100),
    Range("temperature", 25, 45),
    Range("gcs_total", 3, 15),
]

VITAL_PREFIXES = {
    "heart_rate": "hr",
    "systolic_bp": "sbp",
    "diastolic_bp": "dbp",
    "mean_arterial_pressure": "map",
    "respiratory_rate": "rr",
    "spo2": "spo2",
    "temperature": "temp",
    "gcs_total": "gcs",
}

LAB_ITEMS = [
    Item(50971, "sodium"),
    Item(50824, "sodium"),
    Item(50822, "potassium"),
    Item(50972, "potassium"),
    Item(50806, "chloride"),
    Item(50902, "chloride"),
    Item(50882, "bicarbonate"),
    Item(50803, "bicarbonate"),
    Item(51006, "bun"),
    Item(51000, "creatinine"),
    Item(50931, "glucose"),
    Item(50809, "glucose"),
    Item(51222, "hemoglobin"),
    Item(51221, "hematocrit"),
    Item(51301, "wbc"),
    Item(51265, "platelets"),
    Item(50885, "bilirubin_total"),
    Item(50861, "alt"),
    Item(50878, "ast"),
    Item(50862, "albumin"),
    Item(50808, "calcium"),
    Item(50960, "magnesium"),
    Item(50970, "phosphate"),
    Item(50813, "lactate"),
    Item(51237, "inr"),
    Item(51274, "ptt"),
    Item(50820, "ph"),
    Item(50821, "pao2"),
    Item(50818, "paco2"),
]

LAB_RANGES = [
    Range("sodium", 100, 200),
    Range("potassium", 1, 15),
    Range("chloride", 50, 160),
    Range("bicarbonate", 2, 60),
    Range("bun", 0, 300),
    Range("creatinine", 0, 30),
    Range("glucose", 10, 2000),
    Range("hemoglobin", 2, 25),
    Range("hematocrit", 5, 80),
    Range("wbc", 0, 500),
    Range("platelets", 1, 2000),
    Range("bilirubin_total", 0, 100),
    Range("alt", 0, 10000),
    Range("ast", 0, 10000),
    Range("albumin", 0, 10),
    Range("calcium", 2, 20),
    Range("magnesium", 0.5, 10),
    Range("phosphate", 0, 20),
    Range("lactate", 0, 30),
    Range("inr", 0, 20),
    Range("ptt", 0, 300),
    Range("ph", 6, 8),
    Range("pao2", 10, 700),
    Range("paco2", 10, 200),
]

# Hematocrit is read and range-checked but has no output columns.
LAB_PREFIXES = {
    "sodium": "sodium",
    "potassium": "potassium",
    "chloride": "chloride",
    "bicarbonate": "bicarbonate",
    "bun": "bun",
    "creatinine": "creatinine",
    "glucose": "glucose",
    "hemoglobin": "hemoglobin",
    "wbc": "wbc",
    "platelets": "platelets",
    "bilirubin_total": "bilirubin",
    "alt": "alt",
    "ast": "ast",
    "albumin": "albumin",
    "calcium": "calcium",
    "magnesium": "magnesium",
    "phosphate": "phosphate",
    "lactate": "lactate",
    "inr": "inr",
    "ptt": "ptt",
    "ph": "ph",
    "pao2": "pao2",
    "paco2": "paco2",
}

PRESSOR_ITEMS = [
    Item(221906, "norepinephrine"),
    Item(221289, "epinephrine"),
    Item(222315, "vasopressin"),
    Item(221749, "phenylephrine"),
    Item(221662, "dopamine"),
]

URINE_ITEMS = [Item(226559, "urine_output")]

WEIGHT_ITEMS = [Item(226512, "weight")]
WEIGHT_RANGE = Range("weight", 20, 300)

# First matching condition wins, so the order is part of the rule.
ICU_LABELS = [
    Label("heart_rate", like=("%heart rate%",)),
    Label("respiratory_rate", like=("%respiratory rate%",)),
    Label("spo2", like=("%oxygen saturation%", "%spo2%")),
    Label("systolic_bp", like=("%systolic%",)),
    Label("diastolic_bp", like=("%diastolic%",)),
    Label("mean_arterial_pressure", like=("%mean arterial%",)),
    Label("temperature", like=("%temperature%",)),
    Label("gcs", like=("%gcs%", "%glasgow%")),
    Label("mechanical_ventilation", like=("%ventilator%",)),
    Label("mechanical_ventilation", like=("%ventilation%",)),
    Label("mechanical_ventilation", like=("%invasive ventilation%",)),
    Label("norepinephrine", like=("%norepinephrine%",)),
    Label("norepinephrine", like=("%noradrenaline%",)),
    Label("epinephrine", like=("%epinephrine%",)),
    Label("epinephrine", like=("%adrenaline%",)),
    Label("vasopressin", like=("%vasopressin%",)),
    Label("phenylephrine", like=("%phenylephrine%",)),
    Label("dopamine", like=("%dopamine%",)),
    Label("urine_output", like=("%urine output%",)),
    Label("urine_output", like=("%urine volume%",)),
]

LAB_LABELS = [
    Label("sodium", equal=("sodium", "sodium, serum")),
    Label("potassium", equal=("potassium", "potassium, serum")),
    Label("chloride", equal=("chloride", "chloride, serum")),
    Label("bicarbonate", like=("%bicarbonate%",)),
    Label("bun", equal=("urea nitrogen", "bun")),
    Label("creatinine", equal=("creatinine", "creatinine, serum")),
    Label("glucose", like=("%glucose%",)),
    Label("hemoglobin", equal=("hemoglobin", "hemoglobin, blood")),
    Label("hematocrit", equal=("hematocrit", "hematocrit, blood")),
    Label("wbc", like=("%white blood cell%",)),
    Label("platelets", like=("%platelet%",)),
    Label("albumin", like=("%albumin%",)),
    Label("bilirubin_total", like=("%bilirubin, total%",)),
    Label("bilirubin_total", like=("%bilirubin%",), unlike=("%direct%", "%indirect%")),
    Label("ast", equal=("ast", "aspartate aminotransferase")),
    Label("alt", equal=("alt", "alanine aminotransferase")),
    Label("calcium", like=("%calcium%",)),
    Label("magnesium", like=("%magnesium%",)),
    Label("phosphate", like=("%phosphate%",)),
    Label("lactate", like=("%lactate%",)),
    Label("inr", like=("%inr%",)),
    Label("ptt", like=("%ptt%", "%partial thromboplastin%")),
    Label("ph", equal=("ph", "pH")),
    Label("pao2", like=("%pao2%", "%po2%")),
    Label("paco2", like=("%paco2%", "%pco2%")),
]

KEYS = ["subject_id", "hadm_id", "stay_id"]

TARGET = "mortality_after_24h"

# Cohort columns that enter the wide table ahead of the features.
WIDE_COHORT_COLUMNS = [
    "subject_id",
    "hadm_id",
    "stay_id",
    "intime",
    "prediction_time",
    "age_at_icu_admission",
    "gender",
    "first_careunit",
    "last_careunit",
    "admission_type",
    "admission_location",
    "insurance",
    "marital_status",
    "race",
    "mortality_after_24h",
]

# Identifiers and absolute times: needed for joins, never model input.
EXCLUDED_FEATURES = [
    "subject_id",
    "hadm_id",
    "stay_id",
    "intime",
    "prediction_time",
    "ventilation_start",
    "ventilation_end",
    "first_pressor_time",
    "last_pressor_time",
    "first_urine_time",
    "last_urine_time",
    "weight_time",
]

# Not known before the landmark; pass to `drop_excluded` for a leak-free model.
POST_LANDMARK_FEATURES = ["last_careunit"]

DISTRIBUTION_COLUMNS = [
    "age_at_icu_admission",
    "hr_mean",
    "sbp_mean",
    "dbp_mean",
    "map_mean",
    "rr_mean",
    "spo2_mean",
    "temp_mean",
    "sodium_mean",
    "potassium_mean",
    "bicarbonate_mean",
    "bun_mean",
    "creatinine_mean",
    "glucose_mean",
    "hemoglobin_mean",
    "wbc_mean",
    "platelets_mean",
    "bilirubin_mean",
    "albumin_mean",
    "lactate_mean",
    "ph_mean",
    "pao2_mean",
    "paco2_mean",
    "urine_output_ml_24h",
    "urine_output_ml_kg_h_24h",
    "ventilation_duration_hours",
    "pressor_exposure_hours",
]

COMPARISON_COLUMNS = [
    "age_at_icu_admission",
    "hr_mean",
    "map_mean",
    "rr_mean",
    "spo2_mean",
    "lactate_mean",
    "creatinine_mean",
    "wbc_mean",
    "hemoglobin_mean",
    "urine_output_ml_kg_h_24h",
]

INTERVENTION_COLUMNS = [
    "mechanical_ventilation_24h",
    "vasopressor_any_24h",
    "norepinephrine_24h",
    "epinephrine_24h",
    "vasopressin_24h",
    "phenylephrine_24h",
    "dopamine_24h",
]

SUBGROUPS = {
    "age_<65": "age_at_icu_admission < 65",
    "age_65_79": "age_at_icu_admission >= 65 AND age_at_icu_admission < 80",
    "age_80+": "age_at_icu_admission >= 80",
    "gender_M": "gender = 'M'",
    "gender_F": "gender = 'F'",
    "ventilated": "mechanical_ventilation_24h = 1",
    "not_ventilated": "mechanical_ventilation_24h = 0",
    "vasopressor": "vasopressor_any_24h = 1",
    "no_vasopressor": "vasopressor_any_24h = 0",
}
