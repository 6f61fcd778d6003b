"""Dictionary of measurable items, classified by label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scalar import classify
from tidemark.rules import ICU_LABELS, LAB_LABELS, Label

SCHEMA = {
    "source_table": "string",
    "itemid": "int",
    "label": "string",
    "abbreviation": "string",
    "linksto": "string",
    "category": "string",
    "unitname": "string",
    "param_type": "string",
    "lownormalvalue": "double",
    "highnormalvalue": "double",
    "fluid": "string",
    "variable_name": "string",
}


def align(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Exactly the columns of `schema`, absent ones as typed nulls."""
    return df.select(
        *[
            (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in schema.items()
        ]
    )


def labelled(items: DataFrame, rules: Sequence[Label], source: str) -> DataFrame:
    """Items that a rule names, tagged with their source."""
    return items.withColumns(
        {"variable_name": classify("label", rules), "source_table": F.lit(source)}
    ).filter(F.col("variable_name").isNotNull())


def union_dictionaries(icu: DataFrame, lab: DataFrame, schema: dict[str, str] = SCHEMA) -> DataFrame:
    return align(icu, schema).unionByName(align(lab, schema))


def sorted_dictionary(df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(c) for c in ("source_table", "variable_name", "itemid")])


def dictionary(
    d_items: DataFrame,
    d_labitems: DataFrame,
    icu_rules: Sequence[Label] = ICU_LABELS,
    lab_rules: Sequence[Label] = LAB_LABELS,
) -> DataFrame:
    both = union_dictionaries(labelled(d_items, icu_rules, "icu"), labelled(d_labitems, lab_rules, "lab"))
    return sorted_dictionary(both)
