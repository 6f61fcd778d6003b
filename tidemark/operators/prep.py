"""Split and preprocessing. Everything fitted comes from the training rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.scalar import quoted
from tidemark.operators.cohort import ranked
from tidemark.operators.profile import _text_counts, missing_flags, split_types
from tidemark.operators.ranking import hash_order
from tidemark.operators.wide import column_statistics
from tidemark.rules import EXCLUDED_FEATURES

def drop_excluded(df: DataFrame, columns: Sequence[str] = EXCLUDED_FEATURES) -> DataFrame:
    """Drop columns that must not be features; absent ones are ignored."""
    return df.drop(*columns)


def stratified_split(
    df: DataFrame, y: str, key: str, fraction: float = 0.2, seed: int = 42, order: Column | None = None
) -> DataFrame:
    """Add `split`: exactly round(fraction x class size) test rows per class.

    The test rows of a class come first in a seeded hash order of the (unique)
    key, so the split is repeatable and does not depend on partitioning. Only the
    key that ends the test part is looked for: cell counts name its cell, and
    that cell alone is ordered. The table itself is never shuffled; one cut per
    class of the 0/1 target is broadcast to it.
    """
    order = hash_order(key, seed) if order is None else order
    placed = df.select(y, F.col(key).alias("_key"), order.alias("_order"))
    placed = placed.withColumn("_cell", F.substring("_order", 1, 4))
    counts = placed.groupBy(y, "_cell").agg(F.count("*").alias("_n"))
    per_class = Window.partitionBy(y)
    upto = per_class.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    ends = counts.withColumns(
        {
            "_end": F.sum("_n").over(upto),
            "_test": F.round(F.sum("_n").over(per_class) * F.lit(fraction)).cast("long"),
        }
    )
    cut_cells = ends.filter((F.col("_test") > F.col("_end") - F.col("_n")) & (F.col("_test") <= F.col("_end")))
    cut_cells = cut_cells.select(y, "_cell", (F.col("_test") - F.col("_end") + F.col("_n")).alias("_nth"))
    inside = placed.join(F.broadcast(cut_cells), [y, "_cell"])
    last = ranked(inside, [y], ["_order", "_key"], "_rank").filter(F.col("_rank") == F.col("_nth"))
    cuts = last.select(y, F.struct("_order", "_key").alias("_cut"))
    here = F.struct(order.alias("_order"), F.col(key).alias("_key"))
    split = F.when(here <= F.col("_cut"), "test").otherwise("train")
    return df.join(F.broadcast(cuts), y, "left").select(*df.columns, split.alias("split"))


def split_table(df: DataFrame, key: str) -> DataFrame:
    """Entity key and split, for audit and for finding test rows again."""
    return df.select(key, "split")


def class_weights(df: DataFrame, y: str) -> DataFrame:
    """Balanced weight per class: n / (classes x class size)."""
    counts = df.groupBy(y).agg(F.count("*").alias("n"))
    total, classes = counts.agg(F.sum("n")).scalar(), counts.agg(F.count("*")).scalar()
    return counts.select(y, (total / (classes * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, y: str) -> DataFrame:
    # One row per class of a validated 0/1 target.
    return df.join(F.broadcast(class_weights(df, y)), y)


# -- what is learned, as tables ------------------------------------------------


def fit_impute(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, median) of the non-missing values; an all-missing column has none
    (runs jobs)."""
    found = column_statistics(train, columns, [0.5]).where(F.col("count") > 0)
    return found.select("column", F.col("quantiles")[0].alias("median"))


def fit_indicators(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, missing_n) for columns with missing values in train."""
    flags = missing_flags(train, columns)
    row = train.agg(*[F.expr(f"count_if({flag}) AS {quoted(c)}") for c, flag in flags.items()])
    return row.unpivot([], list(columns), "column", "missing_n").filter(F.col("missing_n") > 0)


def fit_scale(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, mean, scale) of imputed columns and of their missing indicators.

    `scale` is the population deviation, or 1 where that is 0. Both follow from
    the moments of the observed values and the median, so imputed rows are never
    materialised (runs jobs).
    """
    stats = column_statistics(train, columns, [0.5]).select(
        "column", "n", F.col("count").alias("k"), F.col("mean").alias("m"), F.col("var_pop").alias("v"), F.col("quantiles")[0].alias("median")
    )
    n, k, m, v, c = (F.col(x) for x in ("n", "k", "m", "v", "median"))
    mean = (k * m + (n - k) * c) / n
    variance = (k * (v + (m - mean) ** 2) + (n - k) * (c - mean) ** 2) / n
    share = (n - k) / n
    value = F.struct(
        F.col("column").alias("feature"), mean.alias("mean"), F.sqrt(variance).alias("scale")
    )
    indicator = F.struct(
        F.concat(F.lit("missingindicator_"), "column").alias("feature"),
        share.alias("mean"),
        F.sqrt(share * (1 - share)).alias("scale"),
    )
    wanted = F.array_compact(F.array(F.when(k > 0, value), F.when(k < n, indicator)))
    exact = F.when(F.col("scale") == 0, 1.0).otherwise(F.col("scale"))
    return stats.select(F.inline(wanted)).withColumn("scale", exact)


def fit_categories(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) of the non-null values."""
    return _text_counts(train, columns).filter(F.col("value").isNotNull())


def fit_mode(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mode): most frequent value, the smallest among equals.

    Values are counted before columns are compared, so no task holds the values
    of a column.
    """
    best = F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("best")
    counts = fit_categories(train, columns)
    return counts.groupBy("column").agg(best).select("column", F.col("best.value").alias("mode"))


# -- the fitted preprocessor ---------------------------------------------------


@dataclass(frozen=True)
class NumericFit:
    column: str
    median: float | None
    mean: float | None
    scale: float | None
    indicator_mean: float | None
    indicator_scale: float | None


@dataclass(frozen=True)
class CategoryFit:
    column: str
    mode: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class Preprocessor:
    """Median-imputed, standardised numbers with missing indicators, and one-hot
    categories; every other column is dropped.

    Feature order: numbers, indicators, then categories by column and value.
    """

    numeric: tuple[NumericFit, ...]
    categorical: tuple[CategoryFit, ...]

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        numeric: Sequence[str] | None = None,
        categorical: Sequence[str] | None = None,
        exclude: Sequence[str] = (),
    ) -> Preprocessor:
        """Learn from the training rows (runs jobs).

        None stands for every column of the kind, an empty list for no column. A
        feature named in `exclude` is an error. What reaches the driver is a few
        numbers per column and the category names: one string per feature. For
        columns of very many values, see `categories.CategoryTable`.
        """
        numbers, texts = split_types(train, exclude)
        numbers = numbers if numeric is None else list(numeric)
        texts = texts if categorical is None else list(categorical)
        if banned := sorted({*numbers, *texts} & set(exclude)):
            raise ValueError(f"excluded columns among the features: {', '.join(banned)}")
        return cls(_fit_numbers(train, numbers), _fit_texts(train, texts))

    @property
    def feature_names(self) -> list[str]:
        return [name for name, _ in self.features()]

    def features(self) -> list[tuple[str, str]]:
        """Feature name and the SQL expression that computes it."""
        flags = [
            (
                f"{f.column}_{v}",
                f"CAST(coalesce(CAST({quoted(f.column)} AS STRING), {_text(f.mode)}) = {_text(v)} AS DOUBLE)",
            )
            for f in self.categorical
            for v in f.values
        ]
        return self.numbers() + flags

    def numbers(self) -> list[tuple[str, str]]:
        """Those of the values and missing indicators."""
        values = [
            (f.column, f"(coalesce({_number(f.column)}, {_double(f.median)}) - {_double(f.mean)}) / {_double(f.scale)}")
            for f in self.numeric
            if f.median is not None
        ]
        indicators = [
            (
                f"missingindicator_{f.column}",
                f"(CAST({_number(f.column)} IS NULL AS DOUBLE) - {_double(f.indicator_mean)}) "
                f"/ {_double(f.indicator_scale)}",
            )
            for f in self.numeric
            if f.indicator_mean is not None
        ]
        return values + indicators

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """One named column per feature."""
        return df.selectExpr(*map(quoted, keep), *[f"{sql} AS {quoted(name)}" for name, sql in self.features()])

    def transform_vector(self, df: DataFrame, keep: Sequence[str] = (), output: str = "features") -> DataFrame:
        """All features in one vector column, for training and scoring.

        Categories become sparse positions by lookup, so that a column with many
        values costs a row one entry. Unseen values have none.
        """
        numbers = [sql for _, sql in self.numbers()]
        parts = [array_to_vector(F.expr(f"array({', '.join(numbers)})")).alias("_numbers")] if numbers else []
        texts = [
            # Labels are names there, and names must not be empty.
            F.expr(f"concat('=', coalesce(CAST({quoted(f.column)} AS STRING), {_text(f.mode)}))").alias(f"_text{i}")
            for i, f in enumerate(self.categorical)
        ]
        # Further columns of the table may carry the names used in between.
        made = df.select(F.struct(*keep).alias("_kept"), *parts, *texts)
        places = [f"_place{i}" for i in range(len(texts))]
        flags = [f"_flags{i}" for i in range(len(texts))]
        if texts:
            for i, f in enumerate(self.categorical):
                index = StringIndexerModel.from_labels([f"={v}" for v in f.values], f"_text{i}", places[i], handleInvalid="keep")
                made = index.transform(made)
            # The last place is that of unseen values; it is dropped.
            made = OneHotEncoder(inputCols=places, outputCols=flags, dropLast=True).fit(made).transform(made)
        columns = [*(["_numbers"] if numbers else []), *flags]
        made = VectorAssembler(inputCols=columns, outputCol="_vector").transform(made)
        return made.select("_kept.*", F.col("_vector").alias(output))

    def save(self, spark: SparkSession, path: str) -> None:
        """Fitted state as JSON rows."""
        rows = [
            ("number", f.column, i, f.median, f.mean, f.scale, f.indicator_mean, f.indicator_scale, None, None)
            for i, f in enumerate(self.numeric)
        ] + [
            ("category", f.column, i, None, None, None, None, None, f.mode, list(f.values))
            for i, f in enumerate(self.categorical)
        ]
        spark.createDataFrame(rows, _STATE).coalesce(1).write.mode("overwrite").json(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        rows = spark.read.schema(_STATE).json(path).orderBy("kind", "position").collect()
        return cls(
            tuple(
                NumericFit(r.column, r.median, r.mean, r.scale, r.indicator_mean, r.indicator_scale)
                for r in rows
                if r.kind == "number"
            ),
            tuple(CategoryFit(r.column, r.mode, tuple(r["values"])) for r in rows if r.kind == "category"),
        )


_STATE = (
    "kind string, column string, position int, median double, mean double, scale double,"
    "indicator_mean double, indicator_scale double, mode string, values array<string>"
)


def _number(column: str) -> str:
    return f"nanvl(CAST({quoted(column)} AS DOUBLE), CAST(NULL AS DOUBLE))"


def _double(value: float) -> str:
    return f"({value!r}D)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _fit_numbers(train: DataFrame, columns: list[str]) -> tuple[NumericFit, ...]:
    if not columns:
        return ()
    fits = {}
    for r in column_statistics(train, columns, [0.5]).collect():
        known = r["count"]
        missing = r.n - known
        share = missing / r.n
        indicator = (share, math.sqrt(share * (1 - share)) or 1.0) if missing else (None, None)
        if not known:
            fits[r.column] = NumericFit(r.column, None, None, None, *indicator)
            continue
        median = r.quantiles[0]
        mean = (known * r.mean + missing * median) / r.n
        variance = (known * (r.var_pop + (r.mean - mean) ** 2) + missing * (median - mean) ** 2) / r.n
        fits[r.column] = NumericFit(r.column, median, mean, math.sqrt(variance) or 1.0, *indicator)
    return tuple(fits[c] for c in columns)


def _fit_texts(train: DataFrame, columns: list[str]) -> tuple[CategoryFit, ...]:
    if not columns:
        return ()
    by_column: dict[str, dict[str, int]] = {column: {} for column in columns}
    for r in fit_categories(train, columns).collect():
        by_column[r.column][r.value] = r.n
    fits = []
    for column, seen in by_column.items():
        if seen:
            mode = min(seen, key=lambda v: (-seen[v], v))
            fits.append(CategoryFit(column, mode, tuple(sorted(seen))))
    return tuple(fits)


def prep_summary(df: DataFrame, y: str, fitted: Preprocessor, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """One row: sizes and event rates of a table with a `split` column."""
    test = F.col("split") == "test"
    return df.agg(
        F.count("*").alias("original_rows"),
        F.lit(len(fitted.numeric) + len(fitted.categorical)).alias("original_features"),
        F.lit(len(fitted.numeric)).alias("numeric_features"),
        F.lit(len(fitted.categorical)).alias("categorical_features"),
        F.lit(len(fitted.feature_names)).alias("processed_features"),
        F.count_if(~test).alias("train_rows"),
        F.count_if(test).alias("test_rows"),
        F.avg(F.when(~test, F.col(y))).alias("train_event_rate"),
        F.avg(F.when(test, F.col(y))).alias("test_event_rate"),
        F.lit(seed).alias("random_state"),
        F.lit(float(fraction)).alias("test_size"),
    )
