"""Sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from checks.features import wide_sql
from checks.registry import check, cohort_df, cohort_sql, scratch
from checks.views import RULES, VIEWS, values_sql, view, view_sql, with_views
from tidemark.operators.events import tag_items
from tidemark.operators.prep import split_table, stratified_split
from tidemark.operators.train import load_model, save_model, score
from tidemark.sources.io import (
    null_violations,
    read_csv,
    read_split,
    read_table,
    register,
    write_csv,
    write_json,
    write_table,
)
from tidemark.sources.schemas import TABLES

ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType(), False),
        T.StructField("o_custkey", T.LongType(), False),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_orderdate", T.TimestampNTZType(), False),
        T.StructField("o_orderpriority", T.StringType(), False),
    ]
)
NATION = T.StructType([T.StructField("n_nationkey", T.IntegerType(), False), T.StructField("n_name", T.StringType())])


@check("A01_typed_scan", view_sql("admissions"))
def _(spark, sf):
    orders = read_table(spark, "admissions", f"{sf}/orders.parquet", schema=ORDERS)
    return orders.selectExpr(*[f"{e} AS {c}" for c, e in VIEWS["admissions"][1].items()])


@check(
    "A01_not_null_check",
    "SELECT * FROM (SELECT 'o_custkey' AS \"column\", count(*) FILTER (o_custkey IS NULL) AS violations FROM orders "
    "UNION ALL SELECT 'o_orderdate', count(*) FILTER (o_orderdate IS NULL) FROM orders)",
)
def _(spark, sf):
    orders = read_table(spark, "admissions", f"{sf}/orders.parquet", schema=ORDERS)
    return null_violations(orders, required=["o_custkey", "o_orderdate"])


@check("A02_code_table_scan", "SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS short_description FROM nation")
def _(spark, sf):
    table = read_table(spark, "d_hcpcs", f"{sf}/nation.parquet", schema=NATION)
    return table.select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("short_description"))


for _name, _view in [
    ("A03_icustays", "icustays"),
    ("A03_patients", "patients"),
    ("A04_chartevents", "chartevents"),
    ("A04_labevents", "labevents"),
    ("A04_outputevents", "outputevents"),
    ("A05_inputevents", "inputevents"),
    ("A05_ventilation", "ventilation"),
    ("A06_d_items", "d_items"),
    ("A06_d_labitems", "d_labitems"),
]:


    def _scan(spark, sf, name=_view):
        """The table as a warehouse file of declared types, read back with its schema."""
        path, given = scratch(spark, name), view(spark, sf, name)
        declared = [f for f in TABLES[name].fields if f.name in given.columns]
        write_table(given.select(*[F.col(f.name).cast(f.dataType) for f in declared]), path)
        kinds = dict(given.dtypes)
        return read_table(spark, name, path).select(*[F.col(f.name).cast(kinds[f.name]) for f in declared])

    # The view of patients also carries race and insurance, which belong to admissions.
    _twin = f"SELECT * EXCLUDE (race, insurance) FROM ({view_sql(_view)})" if _view == "patients" else view_sql(_view)
    check(f"{_name}_scan", _twin)(_scan)


@check(
    "A04_nan_is_missing",
    with_views(
        "outputevents",
        "SELECT stay_id, count(*) AS n, count(value) AS known, sum(value) FILTER (value >= 0) AS total "
        "FROM (SELECT stay_id, CASE WHEN itemid % 3 <> 0 THEN value END AS value FROM outputevents) GROUP BY stay_id",
    ),
    "total",
)
def _(spark, sf):
    """Stored NaN values are no measurements and spoil no total."""
    path, events = scratch(spark, "nan"), view(spark, sf, "outputevents")
    declared = [f for f in TABLES["outputevents"].fields if f.name in events.columns]
    value = F.when(F.col("itemid") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    write_table(events.withColumn("value", value).select(*[F.col(f.name).cast(f.dataType) for f in declared]), path)
    known = F.when(F.col("value") >= 0, F.col("value"))
    back = read_table(spark, "outputevents", path).withColumn("stay_id", F.col("stay_id").cast(dict(events.dtypes)["stay_id"]))
    return back.groupBy("stay_id").agg(F.count("*").alias("n"), F.count("value").alias("known"), F.sum(known).alias("total"))


WHOLE = (
    "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN '' "
    "ELSE concat(text, ' \"q\", ', chr(10), lang) END AS body, lang FROM documents"
)


@check("A10_A11_csv_of_whole_texts", WHOLE)
def _(spark, sf):
    """Commas, doubled quotes, line breaks, nulls, empty and long texts, read by name."""
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    body = F.concat("text", F.lit(' "q", \n'), "lang")
    body = F.when(F.col("doc_id") % 5 == 0, None).when(F.col("doc_id") % 7 == 0, "").otherwise(body)
    path = scratch(spark, "texts")
    write_csv(documents.select("source", "lang", "doc_id", body.alias("body")), path)
    return read_csv(spark, path, "doc_id BIGINT, body STRING, lang STRING")


@check(
    "A07_item_map",
    with_views(
        "labevents",
        "SELECT variable, count(*) AS n, count(DISTINCT itemid) AS items "
        "FROM labevents JOIN item USING (itemid) GROUP BY variable",
        item=values_sql(RULES.lab_items, "itemid, variable"),
    ),
)
def _(spark, sf):
    tagged = tag_items(view(spark, sf, "labevents"), RULES.lab_items)
    return tagged.groupBy("variable").agg(F.count("*").alias("n"), F.count_distinct("itemid").alias("items"))


@check(
    "A08_named_relation",
    cohort_sql("SELECT first_careunit, count(*) AS n, CAST(sum(mortality_after_24h) AS BIGINT) AS events "
               "FROM cohort GROUP BY first_careunit"),
)
def _(spark, sf):
    register(cohort_df(spark, sf), "tidemark_cohort")
    return spark.sql(
        "SELECT first_careunit, count(*) AS n, sum(mortality_after_24h) AS events "
        "FROM tidemark_cohort GROUP BY first_careunit"
    )


COHORT_CORE = ["subject_id", "stay_id", "intime", "prediction_time", "gender", "mortality_after_24h"]


@check("A09_replace_table", cohort_sql(f"SELECT {', '.join(COHORT_CORE)} FROM cohort"))
def _(spark, sf):
    path = scratch(spark, "table")
    chosen = cohort_df(spark, sf).select(*COHORT_CORE)
    write_table(chosen.limit(0), path)
    write_table(chosen, path)
    return spark.read.schema(chosen.schema).parquet(path)


@check("A10_A11_csv_round_trip", with_views("predictions", "SELECT * FROM predictions"))
def _(spark, sf):
    path = scratch(spark, "csv")
    predictions = view(spark, sf, "predictions")
    write_csv(predictions, path)
    return read_csv(spark, path, predictions.schema)


SPLIT_SQL = cohort_sql(
    "SELECT stay_id, CASE WHEN r <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM placed",
    placed="SELECT stay_id, row_number() OVER (PARTITION BY mortality_after_24h "
    "ORDER BY md5('42:' || CAST(stay_id AS VARCHAR)), stay_id) AS r, "
    "count(*) OVER (PARTITION BY mortality_after_24h) AS n FROM cohort",
)


@check("A12_A13_json_round_trip", SPLIT_SQL)
def _(spark, sf):
    path = scratch(spark, "json")
    split = split_table(stratified_split(cohort_df(spark, sf), "mortality_after_24h", "stay_id"), "stay_id")
    write_json(split, path)
    return read_split(spark, path, split.schema)


@check("A14_model_round_trip", wide_sql(
    "SELECT model, count(*) AS n, CAST(0 AS DOUBLE) AS largest_change FROM final, "
    "(VALUES ('logistic_regression'), ('random_forest'), ('gradient_boosting')) m(model) GROUP BY model"
))
def _(spark, sf):
    from checks.modelling import MODELS, model_of, vectors

    frame, _ = vectors(spark, sf)
    changes = []
    for name in MODELS:
        path = scratch(spark, name)
        model = model_of(spark, sf, name)
        save_model(model, path)
        both = score({"before": model, "after": load_model(name, path)}, frame, ["stay_id"])
        change = F.max(F.abs(F.col("before_probability") - F.col("after_probability")))
        changes.append(both.agg(F.lit(name).alias("model"), F.count("*").alias("n"), change.alias("largest_change")))
    return reduce(DataFrame.unionByName, changes)
