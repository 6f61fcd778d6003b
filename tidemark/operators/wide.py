"""Exact statistics of many columns at once, without turning rows into columns.

One pass gives counts, moments, extremes and approximate percentiles of every
column together. The percentiles bracket each wanted quantile; a second pass counts
what lies below and up to the brackets, and a third one takes out the few values
inside those that are still open. From there on only these are looked at. So a
table of hundreds of columns is read three times at most, and quantiles are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.scalar import quoted
from tidemark.operators.ranking import Range, neighbours, resolved
from tidemark.session import stage

# One over the rank error of the bracketing percentiles; they lie three errors
# below and above the wanted rank.
ACCURACY = 1000

STATISTICS = "n long, count long, mean double, var_pop double, std double, min double, max double"


class _Column(NamedTuple):
    group: tuple
    name: str
    numbers: tuple
    brackets: tuple


def column_statistics(df: DataFrame, columns: Sequence[str], fractions: Sequence[float] = (), by: Sequence[str] = ()) -> DataFrame:
    """(`by`, column, n, count, mean, var_pop, std, min, max, quantiles) for each
    numeric column, NaN counting as missing (runs jobs).

    n counts rows and count known values; std is the sample deviation; quantiles
    are interpolated, in the order of `fractions`, null for a column without
    values. `by` must name few groups: a handful of numbers per group and column
    goes to the driver.
    """
    spark = df.sparkSession
    numbers = df.selectExpr(*map(quoted, by), *[f"nanvl(CAST({quoted(c)} AS DOUBLE), CAST(NULL AS DOUBLE)) AS {quoted(c)}" for c in columns])
    found = _moments(numbers, columns, fractions, by)
    values = _quantiles(numbers, found, fractions, by)
    rows = [(*c.group, c.name, *c.numbers, values.get((c.group, c.name))) for c in found]
    fields = [df.schema[b] for b in by] + [T.StructField("column", T.StringType())]
    fields += T.StructType.fromDDL(f"{STATISTICS}, quantiles array<double>").fields
    return spark.createDataFrame(rows, T.StructType(fields))


def _moments(numbers: DataFrame, columns: Sequence[str], fractions: Sequence[float], by: Sequence[str]) -> list[_Column]:
    cuts = [min(1.0, max(0.0, f + side * 3 / ACCURACY)) for f in fractions for side in (-1, 1)]
    bracket = f"percentile_approx({{0}}, array({', '.join(f'{c!r}D' for c in cuts)}), {ACCURACY})" if cuts else "CAST(NULL AS ARRAY<DOUBLE>)"

    def one(name: str) -> str:
        c = quoted(name)
        parts = f"count({c}), avg({c}), var_pop({c}), stddev_samp({c}), min({c}), max({c}), {bracket.format(c)}"
        return f"struct({parts}) AS {c}"

    if not columns:
        return []
    rows = numbers.groupBy(*by).agg(F.count("*").alias("_rows"), *[F.expr(one(c)) for c in columns]).collect()
    found = []
    for row in rows:
        group = tuple(row[: len(by)])
        for name, cell in zip(columns, row[len(by) + 1 :]):
            if row[len(by)]:
                found.append(_Column(group, name, (row[len(by)], *cell[:6]), tuple(cell[6] or ())))
    return found


def _within(group: tuple, by: Sequence[str], df: DataFrame) -> str:
    """A predicate that holds for the rows of a group."""
    kinds = dict(df.dtypes)
    tests = [f"{quoted(b)} <=> CAST({_literal(v)} AS {kinds[b]})" for b, v in zip(by, group)]
    return " AND ".join(tests) or "true"


def _literal(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _double(value: float) -> str:
    return f"DOUBLE('{value!r}')"


def _quantiles(numbers: DataFrame, found: list[_Column], fractions: Sequence[float], by: Sequence[str]) -> dict[tuple, list[float]]:
    ranges: list[Range] = []
    for i, c in enumerate(found):
        count = c.numbers[1]
        for k, f in enumerate(fractions if count else ()):
            wanted = tuple(sorted(set(neighbours(count, f))))
            ranges.append(Range((i,), c.brackets[2 * k], c.brackets[2 * k + 1], 0, 0, wanted))
    if not ranges:
        return {}
    values = _ranked(numbers, found, ranges, by)
    out = {}
    for i, c in enumerate(found):
        count = c.numbers[1]
        if count:
            out[c.group, c.name] = [_between(count, f, i, values) for f in fractions]
    return out


def _between(count: int, fraction: float, i: int, values: dict) -> float:
    below, above = neighbours(count, fraction)
    low, high = values[(i,), below], values[(i,), above]
    return low if low == high else low + (high - low) * ((count - 1) * fraction - below)


def _ranked(numbers: DataFrame, found: list[_Column], ranges: list[Range], by: Sequence[str]) -> dict:
    """The value at each wanted rank of each column."""
    where = [_within(c.group, by, numbers) for c in found]
    names = [quoted(c.name) for c in found]

    def counted(some: list[Range]) -> list[Range]:
        tests = []
        for k, r in enumerate(some):
            i = r.group[0]
            tests.append(f"count_if({where[i]} AND {names[i]} < {_double(r.low)}) AS b{k}")
            tests.append(f"count_if({where[i]} AND {names[i]} <= {_double(r.high)}) AS u{k}")
        row = numbers.agg(*map(F.expr, tests)).first()
        return [r._replace(skip=row[2 * k], n=row[2 * k + 1] - row[2 * k]) for k, r in enumerate(some)]

    def holds(r: Range) -> bool:
        return r.skip <= r.ranks[0] and r.ranks[-1] < r.skip + r.n

    ranges = counted(ranges)
    # A bracket that misses its rank, if ever, gives way to all values of the column.
    whole = [r._replace(low=found[r.group[0]].numbers[5], high=found[r.group[0]].numbers[6], skip=0, n=found[r.group[0]].numbers[1]) for r in ranges if not holds(r)]
    ranges = [r for r in ranges if holds(r)] + whole
    values = {(r.group, rank): r.low for r in ranges if r.low == r.high for rank in r.ranks}
    open_ranges = [r for r in ranges if r.low != r.high]
    if not open_ranges:
        return values
    # Ranges are told apart by their place in the list from here on.
    held = [
        f"CASE WHEN {where[r.group[0]]} AND {names[r.group[0]]} BETWEEN {_double(r.low)} AND {_double(r.high)} "
        f"THEN struct({k} AS id, {names[r.group[0]]} AS _v) END"
        for k, r in enumerate(open_ranges)
    ]
    inside = stage(numbers.select(F.expr(f"inline(array_compact(array({', '.join(held)})))")), "open_values")
    placed = resolved(inside, ["id"], [r._replace(group=(k,)) for k, r in enumerate(open_ranges)])
    for (group, rank), value in placed.items():
        values[open_ranges[group[0]].group, rank] = value
    return values
