"""Bring feature tables back to one row per cohort entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalar import fill_zero
from tidemark.rules import KEYS


def left_features(
    cohort: DataFrame, features: DataFrame, keys: Sequence[str] = KEYS, zero: Sequence[str] = ()
) -> DataFrame:
    """Every cohort entity once; columns in `zero` read 0 where nothing matched."""
    return fill_zero(cohort.select(*keys).join(features, list(keys), "left"), zero)


def matched_flag(features: DataFrame, name: str) -> DataFrame:
    """Mark rows so that a left join followed by zero-filling says who matched."""
    return features.withColumn(name, F.lit(1))


def assemble(cohort: DataFrame, tables: Sequence[DataFrame], keys: Sequence[str] = KEYS) -> DataFrame:
    """Left-join feature tables, one row per entity each.

    All joins share their keys, so each side is partitioned once: a table that
    was aggregated by the keys is joined where it lies.
    """
    wide = cohort
    for table in tables:
        wide = wide.join(table, list(keys), "left")
    return wide


def flag_missing(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add 0/1 columns telling where an input is null."""
    return df.withColumns({name: F.when(c.isNull(), 1).otherwise(0) for name, c in columns.items()})
