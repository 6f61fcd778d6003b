"""From warehouse tables to the wide table, one row per eligible stay."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from tidemark import rules
from tidemark.functions.scalar import fill_zero, rate_per_kg_h
from tidemark.functions.timeline import in_window, up_to
from tidemark.operators.asof import as_of_last
from tidemark.operators.assemble import assemble, flag_missing, left_features, matched_flag
from tidemark.operators.events import (
    SLICES,
    events_in_window,
    join_cohort,
    pivot_summary,
    plausible,
    point_features,
    slices_for,
    summarise,
    summarise_sum,
    tag_items,
)
from tidemark.operators.intervals import interval_exposure
from tidemark.rules import KEYS, Item, Range


@dataclass(frozen=True)
class FeatureRules:
    """Everything that depends on the warehouse at hand."""

    vital_items: Sequence[Item] = field(default_factory=lambda: rules.VITAL_ITEMS)
    vital_ranges: Sequence[Range] = field(default_factory=lambda: rules.VITAL_RANGES)
    vital_prefixes: Mapping[str, str] = field(default_factory=lambda: rules.VITAL_PREFIXES)
    lab_items: Sequence[Item] = field(default_factory=lambda: rules.LAB_ITEMS)
    lab_ranges: Sequence[Range] = field(default_factory=lambda: rules.LAB_RANGES)
    lab_prefixes: Mapping[str, str] = field(default_factory=lambda: rules.LAB_PREFIXES)
    pressor_items: Sequence[Item] = field(default_factory=lambda: rules.PRESSOR_ITEMS)
    urine_items: Sequence[Item] = field(default_factory=lambda: rules.URINE_ITEMS)
    weight_items: Sequence[Item] = field(default_factory=lambda: rules.WEIGHT_ITEMS)
    weight_range: Range = rules.WEIGHT_RANGE


CLINICAL = FeatureRules()

VENTILATION_ZERO = ["mechanical_ventilation_24h", "ventilation_duration_hours"]
URINE_ZERO = ["urine_output_ml_24h", "urine_measurement_count"]


def pressor_names(r: FeatureRules) -> list[str]:
    return list(dict.fromkeys(item.variable for item in r.pressor_items))


def pressor_zero(r: FeatureRules) -> list[str]:
    drugs = [f"{d}_24h" for d in pressor_names(r)]
    return ["vasopressor_any_24h", *drugs, "pressor_exposure_hours"]


def vitals(chartevents: DataFrame, cohort: DataFrame, r: FeatureRules = CLINICAL, slices: int = SLICES) -> DataFrame:
    return point_features(
        chartevents, cohort, r.vital_items, r.vital_ranges, r.vital_prefixes, counts=["heart_rate"], slices=slices
    )


def labs(labevents: DataFrame, cohort: DataFrame, r: FeatureRules = CLINICAL, slices: int = SLICES) -> DataFrame:
    return point_features(
        labevents, cohort, r.lab_items, r.lab_ranges, r.lab_prefixes, stay_less=True, slices=slices
    )


def ventilation(periods: DataFrame, cohort: DataFrame, slices: int = SLICES) -> DataFrame:
    found = matched_flag(interval_exposure(periods, cohort, slices=slices), "mechanical_ventilation_24h")
    return found.select(
        *KEYS,
        "mechanical_ventilation_24h",
        F.col("exposure_start").alias("ventilation_start"),
        F.col("exposure_end").alias("ventilation_end"),
        F.col("exposure_hours").alias("ventilation_duration_hours"),
    )


def pressors(inputevents: DataFrame, cohort: DataFrame, r: FeatureRules = CLINICAL, slices: int = SLICES) -> DataFrame:
    drugs = pressor_names(r)
    tagged = tag_items(inputevents, r.pressor_items)
    found = matched_flag(interval_exposure(tagged, cohort, drugs, slices), "vasopressor_any_24h")
    return found.select(
        *KEYS,
        "vasopressor_any_24h",
        *[F.col(d).alias(f"{d}_24h") for d in drugs],
        F.col("exposure_start").alias("first_pressor_time"),
        F.col("exposure_end").alias("last_pressor_time"),
        F.col("exposure_hours").alias("pressor_exposure_hours"),
    )


def urine(outputevents: DataFrame, cohort: DataFrame, r: FeatureRules = CLINICAL, slices: int = SLICES) -> DataFrame:
    kept = tag_items(outputevents.filter(F.col("value") >= 0), r.urine_items)
    inside = events_in_window(kept.select(*KEYS, "charttime", "value"), cohort, slices=slices)
    return summarise_sum(inside).select(
        *KEYS,
        F.col("value_sum").alias("urine_output_ml_24h"),
        F.col("measurement_count").alias("urine_measurement_count"),
        F.col("first_time").alias("first_urine_time"),
        F.col("last_time").alias("last_urine_time"),
    )


def weight(chartevents: DataFrame, cohort: DataFrame, r: FeatureRules = CLINICAL, slices: int = SLICES) -> DataFrame:
    """Latest plausible weight known at the landmark."""
    ids = [item.itemid for item in r.weight_items]
    valid = chartevents.filter(
        F.col("itemid").isin(ids) & F.col("valuenum").between(float(r.weight_range.low), float(r.weight_range.high))
    )
    return as_of_last(valid, cohort, value_name="weight_kg", time_name="weight_time", slices=slices)


def chart_features(
    chartevents: DataFrame, cohort: DataFrame, r: FeatureRules = CLINICAL, slices: int = SLICES
) -> DataFrame:
    """Vitals and weight from one scan and one join of the largest table.

    Weight is a variable like the others, except that anything up to and
    including the landmark counts.
    """
    known = r.weight_range.variable
    tagged = tag_items(chartevents.filter(F.col("valuenum").isNotNull()), [*r.vital_items, *r.weight_items])
    kept = plausible(tagged, [*r.vital_ranges, r.weight_range])
    kept = kept.select(*KEYS, "charttime", "variable", "valuenum")
    inside = F.when(F.col("variable") == known, up_to("charttime", "prediction_time")).otherwise(
        in_window("charttime", "intime", "prediction_time")
    )
    summary = summarise(join_cohort(kept, cohort, slices=slices).filter(inside))
    prefixes = {**r.vital_prefixes, known: known}
    wide = pivot_summary(summary, prefixes, counts=["heart_rate"], times=[known])
    vital_columns = [c for c in wide.columns if c not in KEYS and not c.startswith(f"{known}_")]
    return wide.select(
        *KEYS,
        *vital_columns,
        F.col(f"{known}_last").alias("weight_kg"),
        F.col(f"{known}_last_time").alias("weight_time"),
    )


def with_urine_rate(df: DataFrame) -> DataFrame:
    """mL per kg and hour from the zero-filled total and the weight, if known."""
    filled = fill_zero(df, URINE_ZERO)
    return filled.withColumn("urine_output_ml_kg_h_24h", rate_per_kg_h("urine_output_ml_24h", "weight_kg"))


def urine_table(
    outputevents: DataFrame, chartevents: DataFrame, cohort: DataFrame, r: FeatureRules = CLINICAL
) -> DataFrame:
    """Urine and weight features of every cohort stay."""
    total = left_features(cohort, urine(outputevents, cohort, r))
    return with_urine_rate(total.join(weight(chartevents, cohort, r), KEYS, "left"))


def landmark_table(
    cohort: DataFrame, sources: Mapping[str, DataFrame], r: FeatureRules = CLINICAL, slices: int | None = None
) -> DataFrame:
    """The wide table. Without `slices` the cohort is counted to choose them.

    `cohort` feeds six joins: pass a staged one (`session.stage`), so that it
    is computed once. The sparse feature tables are joined directly; completing
    each of them first would join the cohort twice per table.
    """
    identity = [c for c in rules.WIDE_COHORT_COLUMNS if c in cohort.columns]
    slices = slices_for(cohort) if slices is None else slices
    chart = chart_features(sources["chartevents"], cohort, r, slices)
    blocks = [
        chart,
        labs(sources["labevents"], cohort, r, slices),
        ventilation(sources["ventilation"], cohort, slices),
        pressors(sources["inputevents"], cohort, r, slices),
        urine(sources["outputevents"], cohort, r, slices),
    ]
    wide = assemble(cohort.select(*identity), blocks)
    wide = fill_zero(wide, VENTILATION_ZERO + pressor_zero(r))
    wide = flag_missing(with_urine_rate(wide), {"urine_output_missing": F.col("urine_output_ml_24h")})
    features = [c for b in blocks[:4] for c in b.columns if c not in (*KEYS, "weight_kg", "weight_time")]
    tail = [
        "urine_output_ml_24h", "urine_output_ml_kg_h_24h", "urine_measurement_count",
        "first_urine_time", "last_urine_time", "weight_kg", "weight_time", "urine_output_missing",
    ]
    return wide.select(*identity, *features, *tail)
