"""Warehouse tables derived from the driver's parquet tables.

One expression list per table serves both engines: Spark builds a DataFrame from
it, DuckDB a common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import rules
from tidemark.plans.landmark_table import FeatureRules
from tidemark.rules import Item, Range

_LINE = ("lineitem", [("inner", "orders", "l_orderkey = o_orderkey")])
_STAY_KEYS = {"subject_id": "o_custkey", "hadm_id": "o_orderkey", "stay_id": "o_orderkey"}
_EVENT_TIME = "o_orderdate + CAST(l_partkey % 48 - 12 AS INT) * INTERVAL '1' HOUR"
_END_TIME = (
    "CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE "
    "o_orderdate + CAST(l_partkey % 48 - 12 + l_quantity - 5 AS INT) * INTERVAL '1' HOUR END"
)

VIEWS = {
    "patients": (
        ("customer", [("left", "nation", "c_nationkey = n_nationkey")]),
        {
            "subject_id": "c_custkey",
            "gender": "CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END",
            "anchor_age": "CAST(10 + c_custkey % 80 AS INT)",
            "anchor_year": "1995",
            "anchor_year_group": "'1995 - 1997'",
            "race": "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE n_name END",
            "insurance": "c_mktsegment",
        },
    ),
    "admissions": (
        ("orders", []),
        {
            "hadm_id": "o_orderkey",
            "subject_id": "o_custkey",
            "admittime": "o_orderdate",
            "dischtime": "o_orderdate + CAST(o_orderkey % 240 AS INT) * INTERVAL '1' HOUR",
            "deathtime": "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 7 <> 0 "
            "THEN o_orderdate + CAST(o_orderkey % 96 AS INT) * INTERVAL '1' HOUR END",
            "hospital_expire_flag": "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END",
            "admission_type": "o_orderpriority",
            "admission_location": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END",
            "discharge_location": "o_orderstatus",
            "insurance": "CASE WHEN o_custkey % 3 = 0 THEN 'Private' ELSE 'Public' END",
            "marital_status": "CASE WHEN o_custkey % 13 = 0 THEN NULL "
            "WHEN o_custkey % 2 = 0 THEN 'MARRIED' ELSE 'SINGLE' END",
            "race": "CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE 'R' || CAST(o_custkey % 6 AS VARCHAR(2)) END",
        },
    ),
    "icustays": (
        ("orders", []),
        {
            "stay_id": "o_orderkey",
            "hadm_id": "o_orderkey",
            "subject_id": "o_custkey",
            "intime": "o_orderdate",
            "outtime": "o_orderdate + CAST(o_orderkey % 200 AS INT) * INTERVAL '1' HOUR",
            "first_careunit": "o_orderpriority",
            "last_careunit": "o_orderstatus",
            "los": "CAST(o_orderkey % 200 AS DOUBLE) / 24",
        },
    ),
    "chartevents": (
        _LINE,
        {
            **_STAY_KEYS,
            "charttime": _EVENT_TIME,
            "itemid": "CAST(l_suppkey % 8 AS INT)",
            "valuenum": "CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_quantity END",
            "valueuom": "l_returnflag",
        },
    ),
    "labevents": (
        _LINE,
        {
            "subject_id": "o_custkey",
            "hadm_id": "o_orderkey",
            "charttime": _EVENT_TIME,
            "itemid": "CAST(l_suppkey % 26 AS INT)",
            "valuenum": "CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_extendedprice / 100 END",
            "valueuom": "l_returnflag",
        },
    ),
    "inputevents": (
        _LINE,
        {
            **_STAY_KEYS,
            "itemid": "CAST(l_suppkey % 6 AS INT)",
            "starttime": _EVENT_TIME,
            "endtime": _END_TIME,
            "rate": "l_discount",
            "amount": "l_quantity",
        },
    ),
    "ventilation": (_LINE, {**_STAY_KEYS, "starttime": _EVENT_TIME, "endtime": _END_TIME}),
    "outputevents": (
        _LINE,
        {
            **_STAY_KEYS,
            "charttime": _EVENT_TIME,
            "itemid": "CAST(l_suppkey % 4 AS INT)",
            "value": "l_extendedprice / 100 - 50",
            "valueuom": "l_returnflag",
        },
    ),
    "d_items": (
        ("part", []),
        {
            "itemid": "CAST(p_partkey AS INT)",
            "label": "p_name",
            "category": "p_type",
            "unitname": "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_brand END",
            "lownormalvalue": "p_retailprice",
        },
    ),
    "d_labitems": (
        ("part", []),
        {
            "itemid": "CAST(p_partkey AS INT)",
            "label": "p_name",
            "fluid": "p_brand",
            "category": "p_type",
        },
    ),
    "predictions": (
        ("events", []),
        {
            "entity_id": "event_id",
            "y_true": "CASE WHEN event_type IN ('error', 'purchase') THEN 1 ELSE 0 END",
            "model_a_probability": "least(CAST(1 AS DOUBLE), value / 500)",
            "model_b_probability": "CAST(event_id * 7919 % 1000 AS DOUBLE) / 1000",
        },
    ),
    "attributes": (
        ("events", []),
        {
            "entity_id": "event_id",
            "age_at_icu_admission": "CAST(20 + user_id % 75 AS INT)",
            "gender": "CASE WHEN user_id % 7 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END",
            "mechanical_ventilation_24h": "CASE WHEN user_id % 5 = 0 THEN 1 ELSE 0 END",
            "vasopressor_any_24h": "CASE WHEN user_id % 11 = 0 THEN 1 ELSE 0 END",
        },
    ),
}

# Item maps and ranges that fit the derived tables. Values run from 1 to 50
# (chart) and from about 9 to 1,050 (lab), so every range cuts some off.
_LAB_VARIABLES = [r.variable for r in rules.LAB_RANGES]

RULES = FeatureRules(
    vital_items=[Item(i, r.variable) for i, r in enumerate(rules.VITAL_RANGES)],
    vital_ranges=rules.VITAL_RANGES,
    lab_items=[Item(i, _LAB_VARIABLES[i % len(_LAB_VARIABLES)]) for i in range(26)],
    lab_ranges=[Range(v, 10 + 5 * i, 400 + 25 * i) for i, v in enumerate(_LAB_VARIABLES)],
    pressor_items=[Item(i, r.variable) for i, r in enumerate(rules.PRESSOR_ITEMS)],
    urine_items=[Item(1, "urine_output"), Item(2, "urine_output")],
    weight_items=[Item(5, "weight")],
)


def base(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    (first, joins), columns = VIEWS[name]
    df = base(spark, sf, first)
    for how, other, on in joins:
        # Orders grow with their line items; what their files take, which is all that
        # Spark goes by, says little about their rows as a broadcast.
        more = base(spark, sf, other)
        df = df.join(more.hint("merge") if how == "inner" else more, F.expr(on), how)
    return df.selectExpr(*[f"{expr} AS {c}" for c, expr in columns.items()])


def view_sql(name: str) -> str:
    (first, joins), columns = VIEWS[name]
    source = first + "".join(f" {how.upper()} JOIN {other} ON {on}" for how, other, on in joins)
    return f"SELECT {', '.join(f'{expr} AS {c}' for c, expr in columns.items())} FROM {source}"


def with_views(names: str, query: str, **ctes: str) -> str:
    """`query` preceded by the named views and further CTEs, in order."""
    parts = [f"{n} AS ({view_sql(n)})" for n in names.split()]
    parts += [f"{n} AS ({text})" for n, text in ctes.items()]
    return f"WITH {', '.join(parts)} {query}" if parts else query


def values_sql(rows, columns: str) -> str:
    """An inline relation."""
    text = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {text}) AS t({columns})"
