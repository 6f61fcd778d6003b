"""Every profile of the wide table, as named report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark import rules
from tidemark.operators import profile as pr
from tidemark.sources.io import write_csv

# Columns in the short missingness report.
TOP_MISSING = 40


def explore(
    df: DataFrame,
    target: str = rules.TARGET,
    distributions: Sequence[str] = rules.DISTRIBUTION_COLUMNS,
    comparisons: Sequence[str] = rules.COMPARISON_COLUMNS,
    interventions: Sequence[str] = rules.INTERVENTION_COLUMNS,
) -> dict[str, DataFrame]:
    """Report name -> table. Pass a staged table: each report reads it again.

    Columns that the table lacks are left out of the reports that name them.
    """
    pr.require_columns(df, [target])

    def present(columns: Sequence[str]) -> list[str]:
        return [c for c in columns if c in df.columns]

    numeric, categorical = pr.split_types(df)
    missing = pr.missingness(df)
    reports = {
        "structure": pr.structure(df),
        "cohort_summary": pr.cohort_summary(df, target, rules.KEYS),
        "outcome_distribution": pr.value_counts(df, target),
        "target_validity": pr.validate_target(df, target),
        "missingness": missing,
        "top_missing": pr.top_k(pr.missing_only(missing), "missing_percent", TOP_MISSING, "column"),
        "numeric_summary": pr.numeric_summary(df, numeric),
        "suspicious_values": pr.suspicious(df, numeric),
    }
    for key in present(["stay_id", "subject_id"]):
        reports[f"duplicate_{key}"] = pr.duplicate_keys(df, key)
    if categorical:
        reports["categorical_summary"] = pr.categorical_summary(df, categorical)
        reports["category_counts"] = pr.category_counts(df, categorical)
    if present(distributions):
        reports["distributions"] = pr.histogram_by(df, present(distributions), target)
    if present(comparisons):
        reports["outcome_comparison"] = pr.compare_by(df, present(comparisons), target)
    if present(interventions):
        reports["intervention_prevalence"] = pr.prevalence(df, present(interventions))
        reports["intervention_by_outcome"] = pr.crosstab_pct(df, target, present(interventions))
    if len(present(["intime", "prediction_time"])) == 2:
        reports["window_length"] = pr.window_check(df)
    return reports


def write_reports(reports: dict[str, DataFrame], folder: str) -> None:
    for name, report in reports.items():
        write_csv(report, f"{folder}/{name}")
