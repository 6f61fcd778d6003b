"""Table profiles. Each is a handful of mergeable aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.scalar import quoted
from tidemark.functions.timeline import hours_between
from tidemark.operators.cohort import ranked
from tidemark.operators.ranking import exact_quantiles
from tidemark.operators.wide import column_statistics


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def split_types(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and categorical (text or boolean) column names, from the schema."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    categorical = [f.name for f in fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    return numeric, categorical


def missing_flags(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Per column a SQL predicate: null, or NaN in a floating column."""
    kinds = dict(df.dtypes)

    def flag(c: str) -> str:
        null = f"{quoted(c)} IS NULL"
        return f"({null} OR isnan({quoted(c)}))" if kinds[c] in ("double", "float") else null

    return {c: flag(c) for c in columns}


def long_numbers(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep, column, value): numbers as double, NaN as null."""
    names = [quoted(c) for c in columns]
    doubles = [f"nanvl(CAST({c} AS DOUBLE), CAST(NULL AS DOUBLE)) AS {c}" for c in names]
    return df.selectExpr(*map(quoted, keep), *doubles).unpivot(list(keep), list(columns), "column", "value")


def long_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    names = [quoted(c) for c in columns]
    return df.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in names]).unpivot(
        [], list(columns), "column", "value"
    )


def _long_row(row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    return row.unpivot([], list(columns), name, value)


def structure(df: DataFrame) -> DataFrame:
    """Column, type and non-null count, in schema order."""
    counts = df.agg(*[F.expr(f"count({quoted(c)}) AS {quoted(c)}") for c in df.columns])
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    order = F.create_map(*[F.lit(x) for i, c in enumerate(df.columns) for x in (c, i)])
    return _long_row(counts, df.columns, "column", "non_null").select(
        order[F.col("column")].alias("position"), "column", types[F.col("column")].alias("type"), "non_null"
    )


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def cohort_summary(df: DataFrame, target: str, ids: Sequence[str]) -> DataFrame:
    """(metric, value): rows, columns, distinct ids, events, event rate.

    Each identifier is counted on its own: a grouping by it, then a count of the
    groups, both merged map-side. No copy of a row is made per identifier.
    """
    totals = {"rows": F.count("*"), "columns": F.lit(len(df.columns)), "events": F.sum(target), "event_rate": F.avg(target)}
    row = df.agg(*[m.cast("double").alias(name) for name, m in totals.items()])
    parts = [_long_row(row, list(totals), "metric", "value")]
    for c in (c for c in ids if c in df.columns):
        groups = df.select(c).filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
        parts.append(groups.agg(F.lit(f"unique_{c}").alias("metric"), F.count("*").cast("double").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each value, null included, sorted by value."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy(F.asc_nulls_last(column))


def validate_target(df: DataFrame, target: str) -> DataFrame:
    """Missing, invalid (anything but 0 and 1, null included) and distinct."""
    valid = F.coalesce(F.col(target).isin(0, 1), F.lit(False))
    return df.agg(
        F.count_if(F.col(target).isNull()).alias("missing_n"),
        F.count_if(~valid).alias("invalid_n"),
        F.count_distinct(target).alias("distinct_n"),
    )


def require_valid_target(df: DataFrame, target: str) -> DataFrame:
    """Raise unless the target is 0 or 1 in every row (runs a job)."""
    require_columns(df, [target])
    if not df.filter(F.col(target).isNull() | ~F.col(target).isin(0, 1)).isEmpty():
        raise ValueError(f"{target} must be 0 or 1 in every row")
    return df


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Rows beyond the first of each key; null counts as one key."""
    keys = F.count_distinct(column) + F.max(F.col(column).isNull().cast("int"))
    return df.agg((F.count("*") - F.coalesce(keys, F.lit(0))).alias("duplicates"))


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier one in all `columns`.

    Grouping by the full row is exact, and copies collapse before the shuffle.
    """
    counts = df.groupBy(*(df.columns if columns is None else columns)).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def missingness(df: DataFrame) -> DataFrame:
    """Missing count and percent per column, most missing first; one scan."""
    row = df.agg(
        F.count("*").alias("_rows"),
        *[F.expr(f"count_if({flag}) AS {quoted(c)}") for c, flag in missing_flags(df, df.columns).items()],
    )
    long = row.unpivot(["_rows"], df.columns, "column", "missing_n")
    percent = F.try_divide(F.col("missing_n"), F.col("_rows")) * 100
    return long.select("column", "missing_n", percent.alias("missing_percent")).orderBy(
        F.desc("missing_percent"), "column"
    )


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The k largest rows by a column."""
    return df.orderBy(F.desc(by), tie).limit(k)


def missing_only(report: DataFrame) -> DataFrame:
    return report.filter(F.col("missing_percent") > 0)


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample deviation, extremes, quartiles and missing share of all
    columns together (runs jobs)."""
    columns = split_types(df)[0] if columns is None else list(columns)
    found = column_statistics(df, columns, [0.25, 0.5, 0.75])
    missing = F.col("n") - F.col("count")
    return found.select(
        "column", "count", "mean", "std", "min", *[F.col("quantiles")[i].alias(p) for i, p in enumerate(("p25", "p50", "p75"))],
        "max", missing.alias("missing_n"), (missing / F.col("n") * 100).alias("missing_percent"),
    )


def quartiles(long: DataFrame, by: Sequence[str]) -> DataFrame:
    cut = exact_quantiles(long, by, "value", [0.25, 0.5, 0.75])
    return cut.groupBy(*by).agg(
        *[F.max(F.when(F.col("fraction") == f, F.col("quantile"))).alias(n)
          for f, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]
    )


def suspicious(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with infinite or negative values."""
    columns = split_types(df)[0] if columns is None else list(columns)
    infinite = F.col("value").isin(float("inf"), float("-inf"))
    counts = long_numbers(df, columns).groupBy("column").agg(
        F.count_if(infinite).alias("infinite_n"), F.count_if(F.col("value") < 0).alias("negative_n")
    )
    return counts.filter((F.col("infinite_n") > 0) | (F.col("negative_n") > 0))


def _text_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return long_texts(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values and missing share per column, most distinct first."""
    counts = _text_counts(df, split_types(df)[1] if columns is None else list(columns))
    missing = F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0))
    return (
        counts.groupBy("column")
        .agg(
            F.count("value").alias("n_unique"),
            missing.alias("missing_n"),
            (missing / F.sum("n") * 100).alias("missing_percent"),
        )
        .orderBy(F.desc("n_unique"), "column")
    )


def category_counts(
    df: DataFrame, columns: Sequence[str] | None = None, max_card: int = 30, top: int = 30
) -> DataFrame:
    """Most frequent values of every column with few distinct values."""
    counts = _text_counts(df, split_types(df)[1] if columns is None else list(columns))
    small = counts.groupBy("column").agg(F.count("value").alias("_card")).filter(F.col("_card") <= max_card)
    kept = counts.join(F.broadcast(small.select("column")), "column")
    order = [F.desc("n"), F.asc_nulls_last("value")]
    return ranked(kept, ["column"], order, "_rank").filter(F.col("_rank") <= top).drop("_rank")


def histogram_by(df: DataFrame, columns: Sequence[str], target: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram per column, with the density inside each outcome.

    Bins are shared by the outcomes of a column.
    """
    long = long_numbers(df, columns, [target]).filter(F.col("value").isNotNull())
    # One row per column: bounded by the schema.
    span = F.broadcast(long.groupBy("column").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi")))
    width = (F.col("_hi") - F.col("_lo")) / bins
    position = F.when(width > 0, F.floor((F.col("value") - F.col("_lo")) / width)).otherwise(0)
    binned = (
        long.join(span, "column")
        .groupBy("column", target, "_lo", "_hi", F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    totals = F.broadcast(binned.groupBy("column", target).agg(F.sum("n").alias("_group")))
    return binned.join(totals, ["column", target]).select(
        "column",
        target,
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        "n",
        F.try_divide(F.col("n"), F.col("_group") * width).alias("density"),
    )


def compare_by(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """count, mean, median, deviation and extremes per column and outcome (runs
    jobs)."""
    found = column_statistics(df, columns, [0.5], [target])
    return found.select("column", target, "count", "mean", "std", "min", "max", F.col("quantiles")[0].alias("median"))


def prevalence(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Percent of ones per 0/1 column."""
    row = df.agg(*[(F.avg(c) * 100).alias(c) for c in columns])
    return _long_row(row, columns, "column", "percent")


def crosstab_pct(df: DataFrame, rows: str, columns: Sequence[str]) -> DataFrame:
    """For each 0/1 column: the percent of zeros and ones within each `rows` value."""
    flags = df.select(rows, *columns).unpivot([rows], list(columns), "column", "flag")
    pairs = flags.filter(F.col("flag").isNotNull() & F.col(rows).isNotNull())
    return pairs.groupBy("column", rows).agg(
        *[(F.avg((F.col("flag") == v).cast("int")) * 100).alias(f"percent_{v}") for v in (0, 1)]
    )


def window_check(
    df: DataFrame, low: str = "intime", high: str = "prediction_time", hours: float = 24.0
) -> DataFrame:
    """Describe window lengths and count those that are not `hours` long (runs
    jobs for the quartiles).

    The tolerance is 0.01 h plus 1e-5 of the length; an unknown length counts.
    """
    length = hours_between(low, high)
    close = F.coalesce(F.abs(length - hours) <= 0.01 + 1e-5 * hours, F.lit(False))
    measured = df.select(F.lit("hours").alias("column"), length.alias("value"), close.alias("_close"))
    moments = measured.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count_if(~F.col("_close")).alias("off_length_n"),
    )
    return moments.join(F.broadcast(quartiles(measured, ["column"])), "column", "left").select(
        "count", "mean", "std", "min", "p25", "p50", "p75", "max", "off_length_n"
    )


def clean_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total null and infinite entries over `columns`, counted row by row."""
    numeric = split_types(df.select(*columns))[0]
    infinite = [f"CAST({quoted(c)} AS DOUBLE) IN (DOUBLE('Infinity'), DOUBLE('-Infinity'))" for c in numeric]

    def total(flags: Sequence[str]) -> Column:
        return F.expr(f"coalesce(sum(size(filter(array({', '.join(flags) or 'false'}), hit -> hit))), 0)")

    missing = list(missing_flags(df, columns).values())
    return df.agg(total(missing).alias("null_n"), total(infinite).alias("infinite_n"))


def clean_vectors(df: DataFrame, vector: str = "features", by: Sequence[str] = ()) -> DataFrame:
    """(`by`, rows, null_n, infinite_n): entries of a vector column that are no
    number or infinite; a null vector counts as one null entry."""
    entries = vector_to_array(vector)
    missing = F.size(F.filter(entries, lambda x: F.isnan(x) | x.isNull()))
    infinite = F.size(F.filter(entries, lambda x: x.isin(float("inf"), float("-inf"))))
    none = F.col(vector).isNull()
    return df.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.sum(F.when(none, 1).otherwise(missing)).cast("long").alias("null_n"),
        F.sum(F.when(none, 0).otherwise(infinite)).cast("long").alias("infinite_n"),
    )


def assert_clean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise when any entry is null or infinite (runs a job)."""
    found = clean_report(df, columns).first()
    if found.null_n or found.infinite_n:
        raise ValueError(f"{found.null_n} null and {found.infinite_n} infinite entries")
    return df
