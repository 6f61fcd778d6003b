"""Row-level rules: flags, classification, guarded rates, probability transforms."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.timeline import ColumnLike, _col
from tidemark.rules import Label


def survived_to(death: ColumnLike, landmark: ColumnLike) -> Column:
    """1 unless a recorded death precedes the landmark."""
    return F.when(_col(death) < _col(landmark), 0).otherwise(1)


def label_after(flag: ColumnLike, death: ColumnLike, landmark: ColumnLike) -> Column:
    """1 for a flagged death strictly after the landmark; unknown counts as 0."""
    return F.when((_col(flag) == 1) & (_col(death) > _col(landmark)), 1).otherwise(0)


def classify(label: ColumnLike, rules: Sequence[Label]) -> Column:
    """Variable of the first rule that names the label, else null."""
    text = F.lower(_col(label))
    branches = F
    for rule in rules:
        hits = [text.like(pattern) for pattern in rule.like]
        if rule.equal:
            hits.append(text.isin(*rule.equal))
        hit = reduce(or_, hits)
        for pattern in rule.unlike:
            hit = hit & ~text.like(pattern)
        branches = branches.when(hit, rule.variable)
    return branches


def is_null_flag(c: ColumnLike) -> Column:
    return _col(c).isNull().cast("int")


def fill_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.expr(f"coalesce({quoted(c)}, 0)") for c in columns})


def rate_per_kg_h(total: ColumnLike, weight: ColumnLike, hours: float = 24.0) -> Column:
    """total / weight / hours; null without a positive weight."""
    return F.when(_col(weight) > 0, _col(total) / _col(weight) / F.lit(float(hours)))


def clipped_logit(p: ColumnLike, epsilon: float = 1e-6) -> Column:
    q = F.least(F.greatest(_col(p), F.lit(epsilon)), F.lit(1 - epsilon))
    return F.log(q / (1 - q))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN becomes null, so that one kind of missing remains."""
    fixes = {
        name: F.nanvl(F.col(name), F.lit(None).cast(kind))
        for name, kind in df.dtypes
        if kind in ("double", "float")
    }
    return df.withColumns(fixes) if fixes else df


def quoted(name: str) -> str:
    """A column name for use in SQL text. Expressions over hundreds of columns
    are written as text: one call into the JVM per column instead of ten."""
    return "`" + name.replace("`", "``") + "`"
