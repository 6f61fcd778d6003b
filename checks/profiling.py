"""Profiles of the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.features import wide_sql, wide_table
from checks.registry import check, cohort_df, cohort_sql
from checks.views import base, view, with_views
from tidemark import rules
from tidemark.operators import profile as pr
from tidemark.session import stage

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TARGET = rules.TARGET
FLAGS = list(rules.INTERVENTION_COLUMNS)
COMPARED = list(rules.COMPARISON_COLUMNS)
TEXTS = ["gender", "first_careunit", "admission_type", "admission_location", "insurance", "marital_status", "race"]


WIDE_TEXTS = ["gender", "first_careunit", "last_careunit", "admission_type", "admission_location", "insurance", "marital_status", "race"]


def union(parts):
    return " UNION ALL ".join(parts)


def long_sql(columns, source, keep=""):
    lead = f"{keep}, " if keep else ""
    return union(f"SELECT {lead}'{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns)


@check(
    "E12_cohort_summary",
    cohort_sql(
        union(
            f"SELECT '{name}' AS metric, CAST({expr} AS DOUBLE) AS value FROM cohort"
            for name, expr in {
                "rows": "count(*)",
                "columns": "max(26)",
                "unique_subject_id": "count(DISTINCT subject_id)",
                "unique_hadm_id": "count(DISTINCT hadm_id)",
                "unique_stay_id": "count(DISTINCT stay_id)",
                "events": "sum(mortality_after_24h)",
                "event_rate": "avg(mortality_after_24h)",
            }.items()
        )
    ),
    "value",
)
def _(spark, sf):
    return pr.cohort_summary(cohort_df(spark, sf), TARGET, rules.KEYS)


@check(
    "E13_value_counts",
    with_views("patients", "SELECT race, count(*) AS n, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM patients GROUP BY race"),
    "share",
)
def _(spark, sf):
    return pr.value_counts(view(spark, sf, "patients"), "race")


COMPARE = (
    'SELECT "column", mortality_after_24h, count(value) AS count, avg(value) AS mean, median(value) AS median, '
    "stddev_samp(value) AS std, min(value) AS min, max(value) AS max FROM long GROUP BY 1, 2"
)


@check("E15_compare_by_outcome", wide_sql(COMPARE, long=long_sql(COMPARED, "final", TARGET)), "mean median std min max")
def _(spark, sf):
    return pr.compare_by(stage(wide_table(spark, sf).select(TARGET, *COMPARED), "wide"), COMPARED, TARGET)


@check(
    "E16_crosstab_percent",
    wide_sql(
        union(
            f"SELECT '{c}' AS \"column\", mortality_after_24h, avg(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) * 100 AS percent_0, "
            f"avg(CASE WHEN {c} = 1 THEN 1 ELSE 0 END) * 100 AS percent_1 FROM final GROUP BY mortality_after_24h"
            for c in FLAGS
        )
    ),
    "percent_0 percent_1",
)
def _(spark, sf):
    return pr.crosstab_pct(wide_table(spark, sf), TARGET, FLAGS)


@check(
    "E17_prevalence",
    wide_sql(union(f"SELECT '{c}' AS \"column\", avg({c}) * 100 AS percent FROM final" for c in FLAGS)),
    "percent",
)
def _(spark, sf):
    return pr.prevalence(wide_table(spark, sf), FLAGS)


# Every column of the wide table, as (column, value) rows.
ALL_VALUES = 'SELECT * FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM final) UNPIVOT INCLUDE NULLS (value FOR "column" IN (COLUMNS(*)))'
MISSING = (
    'SELECT "column", count(*) FILTER (value IS NULL) AS missing_n, '
    'count(*) FILTER (value IS NULL) * 100 / CAST(count(*) AS DOUBLE) AS missing_percent FROM all_values GROUP BY 1'
)


@check("I05_G02_missingness", wide_sql(MISSING, all_values=ALL_VALUES), "missing_percent")
def _(spark, sf):
    return pr.missingness(wide_table(spark, sf))


@check(
    "C14_G03_top_missing",
    wide_sql(
        'SELECT *, row_number() OVER (ORDER BY missing_percent DESC, "column") AS position '
        f'FROM ({MISSING}) WHERE missing_percent > 0 ORDER BY position LIMIT 40',
        all_values=ALL_VALUES,
    ),
    "missing_percent",
)
def _(spark, sf):
    report = pr.missingness(wide_table(spark, sf))
    top = pr.top_k(pr.missing_only(report), "missing_percent", 40, "column")
    # The place of a row in the sorted report, not of a sort made anew.
    return top.withColumn("position", (F.monotonically_increasing_id() + 1).cast("long"))


@check("I01_required_columns", with_views("icustays", "SELECT stay_id FROM icustays"))
def _(spark, sf):
    return pr.require_columns(view(spark, sf, "icustays"), rules.KEYS).select("stay_id")


@check(
    "I02_target_validity",
    with_views(
        "",
        "SELECT count(*) FILTER (p IS NULL) AS missing_n, count(*) FILTER (p IS NULL OR p NOT IN (0, 1)) AS invalid_n, "
        "count(DISTINCT p) AS distinct_n FROM (SELECT nullif(p_size % 4, 3) AS p FROM part)",
    ),
)
def _(spark, sf):
    return pr.validate_target(base(spark, sf, "part").selectExpr("nullif(p_size % 4, 3) AS p"), "p")


@check(
    "I03_duplicate_keys",
    with_views("patients", "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT race FROM patients)) AS duplicates FROM patients"),
)
def _(spark, sf):
    return pr.duplicate_keys(view(spark, sf, "patients"), "race")


@check(
    "I04_duplicate_rows",
    "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM lineitem "
    "GROUP BY l_quantity, l_discount, l_tax, l_returnflag, l_shipdate)",
)
def _(spark, sf):
    columns = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate"]
    return pr.duplicate_rows(base(spark, sf, "lineitem"), columns)


NUMERIC = (
    'SELECT "column", count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, '
    "quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, "
    "max(value) AS max, count(*) FILTER (value IS NULL) AS missing_n, "
    "avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END) * 100 AS missing_percent FROM long GROUP BY 1"
)


@check("I06_numeric_summary", with_views("", f"WITH long AS ({long_sql(LINE_NUMBERS, 'lineitem')}) {NUMERIC}"), "mean std min p25 p50 p75 max missing_percent")
def _(spark, sf):
    return pr.numeric_summary(base(spark, sf, "lineitem"), LINE_NUMBERS)


ALL_NUMBERS = (
    f"SELECT * FROM (SELECT CAST(COLUMNS(* EXCLUDE ({', '.join(dict.fromkeys([*rules.EXCLUDED_FEATURES, *WIDE_TEXTS]))})) AS DOUBLE) FROM final) "
    'UNPIVOT INCLUDE NULLS (value FOR "column" IN (COLUMNS(*)))'
)


@check(
    "I06_numeric_summary_of_features",
    # Means of few decimals can end in an exact half, which a different order of
    # summation rounds the other way; a small step takes them off it.
    wide_sql(f"SELECT * REPLACE (mean + 3.3e-8 AS mean, std + 3.3e-8 AS std) FROM ({NUMERIC})", long=ALL_NUMBERS),
    "mean std min p25 p50 p75 max missing_percent",
)
def _(spark, sf):
    wide = stage(wide_table(spark, sf).drop(*rules.EXCLUDED_FEATURES), "wide")
    return pr.numeric_summary(wide).withColumns({c: F.col(c) + 3.3e-8 for c in ("mean", "std")})


@check(
    "I04_duplicate_full_rows",
    "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT *, count(*) AS n FROM "
    "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 7 = 0) GROUP BY ALL)",
)
def _(spark, sf):
    lines = base(spark, sf, "lineitem")
    return pr.duplicate_rows(lines.unionByName(lines.filter("l_orderkey % 7 = 0")))


@check(
    "I07_suspicious_values",
    with_views(
        "outputevents",
        union(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (isinf({c})) AS infinite_n, count(*) FILTER ({c} < 0) AS negative_n FROM t"
            for c in ("value", "ratio")
        ),
        t="SELECT value, CASE WHEN itemid = 0 THEN CAST('Infinity' AS DOUBLE) WHEN itemid = 3 THEN NULL ELSE value END AS ratio FROM outputevents",
    ),
)
def _(spark, sf):
    events = view(spark, sf, "outputevents").selectExpr(
        "value",
        "abs(value) AS magnitude",
        "CASE WHEN itemid = 0 THEN DOUBLE('Infinity') WHEN itemid = 3 THEN DOUBLE('NaN') ELSE value END AS ratio",
    )
    return pr.suspicious(events)


# Every column of the wide table; times are neither numeric nor categorical.
TYPED = (
    'SELECT "column", CASE type WHEN \'VARCHAR\' THEN \'string\' WHEN \'INTEGER\' THEN \'int\' WHEN \'TIMESTAMP\' THEN \'timestamp_ntz\' '
    "ELSE lower(type) END AS type FROM (SELECT typeof(COLUMNS(*)) FROM (SELECT 1) LEFT JOIN (SELECT * FROM final LIMIT 1) ON true) "
    'UNPIVOT (type FOR "column" IN (COLUMNS(*)))'
)
COUNTED = 'SELECT * FROM (SELECT count(COLUMNS(*)) FROM final) UNPIVOT (non_null FOR "column" IN (COLUMNS(*)))'


@check(
    "I08_column_types",
    wide_sql(
        'SELECT "column", type, non_null, CASE WHEN type IN (\'bigint\', \'int\', \'double\') THEN \'numeric\' '
        f"WHEN type = 'string' THEN 'categorical' END AS kind FROM ({TYPED}) JOIN ({COUNTED}) USING (\"column\")"
    ),
)
def _(spark, sf):
    wide = stage(wide_table(spark, sf), "wide")
    numeric, categorical = pr.split_types(wide)
    kinds = [(c, "numeric") for c in numeric] + [(c, "categorical") for c in categorical]
    names = F.create_map(*[F.lit(x) for pair in kinds for x in pair])
    report = pr.structure(wide)
    return report.select("column", "type", "non_null", F.try_element_at(names, F.col("column")).alias("kind"))


TEXT_LONG = union(f"SELECT '{c}' AS \"column\", {c} AS value FROM final" for c in WIDE_TEXTS)


@check(
    "I09_categorical_summary",
    wide_sql(
        'SELECT "column", count(DISTINCT value) AS n_unique, count(*) FILTER (value IS NULL) AS missing_n, '
        "avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END) * 100 AS missing_percent FROM long GROUP BY 1",
        long=TEXT_LONG,
    ),
    "missing_percent",
)
def _(spark, sf):
    return pr.categorical_summary(stage(wide_table(spark, sf), "wide"))


@check(
    "I10_category_counts",
    wide_sql(
        'SELECT "column", value, count(*) AS n FROM long WHERE "column" IN '
        '(SELECT "column" FROM long GROUP BY 1 HAVING count(DISTINCT value) <= 30) GROUP BY 1, 2 '
        'QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, value NULLS LAST) <= 30',
        long=union(f"SELECT '{c}' AS \"column\", {c} AS value FROM final" for c in WIDE_TEXTS),
    ),
)
def _(spark, sf):
    return pr.category_counts(stage(wide_table(spark, sf), "wide"))


BINS = 20
HISTOGRAM_COLUMNS = list(rules.DISTRIBUTION_COLUMNS)


@check(
    "I11_histogram_by_outcome",
    wide_sql(
        'SELECT "column", mortality_after_24h, bin, lo + bin * (hi - lo) / 20 AS bin_start, n, '
        "n / nullif(sum(n) OVER (PARTITION BY \"column\", mortality_after_24h) * (hi - lo) / 20, 0) AS density FROM binned",
        long=f"SELECT * FROM ({long_sql(HISTOGRAM_COLUMNS, 'final', TARGET)}) WHERE value IS NOT NULL",
        span='SELECT "column", min(value) AS lo, max(value) AS hi FROM long GROUP BY 1',
        binned='SELECT "column", mortality_after_24h, lo, hi, '
        "CAST(CASE WHEN hi > lo THEN least(floor((value - lo) / ((hi - lo) / 20)), 19) ELSE 0 END AS INT) AS bin, count(*) AS n "
        'FROM long JOIN span USING ("column") GROUP BY ALL',
    ),
    "bin_start density",
)
def _(spark, sf):
    wide = stage(wide_table(spark, sf).select(TARGET, *HISTOGRAM_COLUMNS), "wide")
    return pr.histogram_by(wide, HISTOGRAM_COLUMNS, TARGET, BINS)


@check(
    "I12_window_length",
    with_views(
        "admissions",
        "SELECT count(h) AS count, avg(h) AS mean, stddev_samp(h) AS std, min(h) AS min, quantile_cont(h, 0.25) AS p25, "
        "quantile_cont(h, 0.5) AS p50, quantile_cont(h, 0.75) AS p75, max(h) AS max, "
        "count(*) FILTER (h IS NULL OR abs(h - 24) > 0.01024) AS off_length_n FROM "
        "(SELECT date_diff('microsecond', admittime, deathtime) / CAST(3600000000 AS DOUBLE) AS h FROM admissions)",
    ),
    "mean std min p25 p50 p75 max",
)
def _(spark, sf):
    return pr.window_check(view(spark, sf, "admissions"), "admittime", "deathtime")


@check("I13_structure", wide_sql(f'SELECT "column", type, non_null FROM ({TYPED}) JOIN ({COUNTED}) USING ("column")'))
def _(spark, sf):
    return pr.structure(stage(wide_table(spark, sf), "wide")).drop("position")


@check(
    "I13_structure_in_order",
    cohort_sql(
        union(
            f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM cohort"
            for i, (c, t) in enumerate([("stay_id", "bigint"), ("intime", "timestamp_ntz"), ("race", "string"), ("deathtime", "timestamp_ntz")])
        )
    ),
)
def _(spark, sf):
    return pr.structure(cohort_df(spark, sf).select("stay_id", "intime", "race", "deathtime"))


@check(
    "I14_null_and_infinite_totals",
    with_views(
        "chartevents outputevents",
        "SELECT count(*) FILTER (valuenum IS NULL) AS null_n, CAST(0 AS BIGINT) AS infinite_n FROM chartevents",
    ),
)
def _(spark, sf):
    return pr.clean_report(view(spark, sf, "chartevents"), ["itemid", "valuenum"])
