"""Order statistics without a global sort in one task.

Scores are cut into cells by monotone rules, and over-full cells once more by their
counts. Cell totals are tiny, so running totals over cells give each cell its
offset, and only rows of one cell are ever ordered together. Everything is deterministic: a recomputed task gives
the same answer.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.scalar import quoted
from tidemark.session import stage

# Score cells of a running total, per halving of the distance to 0 or to 1.
SCORE_CELLS = 1 << 14

# Scores of a cell above which it is cut, and the cuts.
CELL_ROWS = 1 << 20
CELL_CUTS = 1 << 18

# Exact quantiles: histogram cells per range and pass, the number of values that
# are counted one by one, and the passes after which they are in any case.
VALUE_CELLS = 4096
SHORT_RANGE = 1_000_000
MAX_PASSES = 8


def _cell(share: Column, parts: int) -> Column:
    """Index of [0, 1] cut into `parts` equal cells; monotone, with out-of-range
    values in the outer cells."""
    index = F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * F.lit(float(parts)))
    return F.least(index, F.lit(parts - 1))


def _score_cell(score: Column) -> Column:
    """A monotone cell of a score; scores outside [0, 1] go on beyond both ends."""

    def octaves(x: Column) -> Column:
        return F.log2(F.greatest(x, F.lit(5e-324)))

    least, top = F.lit(-1075.0), F.lit(1026.0)
    place = (
        F.when(score < 0, least * 2 - octaves(-score) - top)
        .when(score < 0.5, octaves(score))
        .when(score <= 1, F.lit(-2.0) - octaves(1 - score))
        .otherwise(octaves(score - 1) - least * 2)
    )
    return F.floor(F.when(score == 0, least - 1).when(score == 1, F.lit(60.0)).otherwise(place) * SCORE_CELLS).cast("long")


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Add the place, from 1, that each row has in the order of `df`.

    Rows are counted where they lie: a row's place is its place in its partition plus
    the rows of all partitions before. The running total has one row a partition, and
    `df` is written once, so that both readings see the same rows.
    """
    kept = stage(df.withColumn("_at", F.monotonically_increasing_id()), "placed")
    # The identifier holds the partition above 33 bits for the row in it.
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = kept.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    placed = kept.withColumn("_own", part).join(F.broadcast(offsets), F.col("_own") == F.col("_part"))
    return placed.select(*[F.col(quoted(c)) for c in df.columns], (F.col("_before") + row + 1).alias(name))


def running_totals(
    df: DataFrame, by: Sequence[str], score: str, totals: Sequence[str], suffix: str = "_above", most: int | None = None
) -> DataFrame:
    """Add `<total>_above`: the sum of `total` over strictly higher scores.

    `df` holds one row per (`by`, score). Where a group is known to hold `most` rows
    and these are no more than CELL_ROWS, it is ordered whole. Cells grow with the distance to 0, or to
    1 for the upper half, so scores crowded next to either end (rare events, sure
    predictions) spread over as many tasks as scores in the middle. A cell that
    still holds more than CELL_ROWS scores is cut once more, evenly between its own
    extremes. A cell spans 2**38 doubles at most, so no cut holds more than 2**20
    scores, wherever they crowd.
    """

    def before(order: str, *keys: str | Column) -> list[Column]:
        window = Window.partitionBy(*by, *keys).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(F.sum(t).over(window), F.lit(0)) for t in totals]

    if most is not None and most <= CELL_ROWS:
        return df.select("*", *[b.alias(t + suffix) for t, b in zip(totals, before(score))])
    number = F.col(score).cast("double")
    celled = df.withColumn("_cell", _score_cell(number))
    extent = [F.count(F.lit(1)).alias("_n"), F.min(number).alias("_low"), F.max(number).alias("_high")]
    # At most one row per CELL_ROWS rows of `df`.
    full = celled.groupBy(*by, "_cell").agg(*extent).filter(F.col("_n") > CELL_ROWS).drop("_n")
    share = (number - F.col("_low")) / (F.col("_high") - F.col("_low"))
    cut = F.when(F.col("_low").isNull(), F.lit(0)).otherwise(_cell(share, CELL_CUTS)).cast("int")
    celled = celled.join(F.broadcast(full), [*by, "_cell"], "left").withColumn("_cut", cut).drop("_low", "_high")

    cuts = celled.groupBy(*by, "_cell", "_cut").agg(*[F.sum(t).alias(t) for t in totals])
    cells = cuts.groupBy(*by, "_cell").agg(*[F.sum(t).alias(t) for t in totals])
    cells = cells.select(*by, "_cell", *[b.alias(f"_c_{t}") for t, b in zip(totals, before("_cell", F.lit(0)))])
    inside = cuts.select(*by, "_cell", "_cut", *[b.alias(f"_i_{t}") for t, b in zip(totals, before("_cut", "_cell", F.lit(0)))])
    # Nearly as many rows as scores: both sides are merged, never sent through the driver.
    offsets = inside.join(cells.hint("merge"), [*by, "_cell"]).hint("merge")
    return celled.join(offsets, [*by, "_cell", "_cut"]).select(
        *df.columns,
        *[(F.col(f"_c_{t}") + F.col(f"_i_{t}") + b).alias(t + suffix) for t, b in zip(totals, before(score, "_cell", "_cut", F.lit(0)))],
    )


def hash_order(key: str, seed: int) -> Column:
    """A seeded pseudo-random order of keys, equal on every engine: 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def with_rank(
    df: DataFrame, by: Sequence[str], order: Column, tie: str, name: str = "rank", hex_digits: int = 4
) -> DataFrame:
    """Dense 0-based rank by (`order`, `tie`) within `by`; `order` is hex text.

    Groups may hold most of the table (the majority class does), so a group is
    cut by its first hex digits into 16**hex_digits cells of equal expectation;
    cell counts give offsets and each cell is ranked on its own. Ranking hashed
    keys keeps cells even whatever the data.
    """
    keyed = df.withColumn("_order", order).withColumn("_cell", F.substring("_order", 1, hex_digits))
    counts = keyed.groupBy(*by, "_cell").agg(F.count("*").alias("_n"))
    earlier = (
        Window.partitionBy(*by, F.lit(0)).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(*by, "_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(*by, "_cell").orderBy("_order", tie))
    ranked = keyed.join(offsets, [*by, "_cell"]).withColumn(name, F.col("_offset") + inside - 1)
    return ranked.select(*df.columns, name)


class Range(NamedTuple):
    """Part of a group's values that holds wanted ranks: `n` values from `low`
    to `high`, with `skip` values of the group below."""

    group: tuple
    low: float
    high: float
    skip: int
    n: int
    ranks: tuple[int, ...]


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, fractions: Sequence[float]) -> DataFrame:
    """(`by`, fraction, quantile): exact quantiles with linear interpolation
    (runs jobs).

    Wanted ranks are narrowed by counting. A histogram over a group's range shows
    which cells hold them; the next pass counts inside those cells only, until a
    million values or fewer are left, which are counted one by one. Histograms
    merge map-side, so no task holds a group, however large or crowded.

    `by` must name few groups (columns, models, classes): a handful of ranges per
    group goes to the driver and back as a broadcast. Null and NaN are left out;
    a group without values has no rows.
    """
    number = F.col(value).cast("double")
    data = df.select(*by, number.alias("_v")).filter(number.isNotNull() & ~F.isnan(number))
    extent = data.groupBy(*by).agg(F.min("_v").alias("low"), F.max("_v").alias("high"), F.count("*").alias("n"))
    totals, open_ranges = {}, []
    for row in extent.collect():
        group = tuple(row[b] for b in by)
        totals[group] = row.n
        ranks = {r for f in fractions for r in neighbours(row.n, f)}
        open_ranges.append(Range(group, row.low, row.high, 0, row.n, tuple(sorted(ranks))))
    found = resolved(data, by, open_ranges)

    def quantile(group: tuple, fraction: float) -> float:
        below, above = neighbours(totals[group], fraction)
        low, high = found[group, below], found[group, above]
        return low if low == high else low + (high - low) * ((totals[group] - 1) * fraction - below)

    rows = [(*group, float(f), quantile(group, f)) for group in totals for f in fractions]
    names = [T.StructField("fraction", T.DoubleType()), T.StructField("quantile", T.DoubleType())]
    schema = T.StructType([*[data.schema[b] for b in by], *names])
    return df.sparkSession.createDataFrame(rows, schema)


def resolved(data: DataFrame, by: Sequence[str], open_ranges: list[Range]) -> dict[tuple[tuple, int], float]:
    """The value at every wanted rank, by (group, rank), from rows (`by`, _v) that
    hold at least the values of the ranges (runs a job per pass)."""
    found = {}
    for attempt in range(MAX_PASSES):
        for r in open_ranges:
            if r.low == r.high:
                found.update({(r.group, rank): r.low for rank in r.ranks})
        open_ranges = [r for r in open_ranges if r.low != r.high]
        if not open_ranges:
            break
        open_ranges = _narrow(data, by, open_ranges, value_by_value=attempt >= MAX_PASSES - 2)
    return found


def neighbours(n: int, fraction: float) -> tuple[int, int]:
    position = (n - 1) * float(fraction)
    return math.floor(position), math.ceil(position)


def _squash(value: Column) -> Column:
    """A monotone scale that compresses long tails and bounds infinities."""
    return F.signum(value) * F.least(F.log1p(F.abs(value)), F.lit(1000.0))


def _narrow(data: DataFrame, by: Sequence[str], ranges: list[Range], value_by_value: bool) -> list[Range]:
    """The cells of the ranges that hold a wanted rank, as new ranges.

    Short ranges have a cell per value; the others are cut into VALUE_CELLS.
    """
    spark = data.sparkSession
    rows = [(*r.group, i, r.low, r.high, r.skip, value_by_value or r.n <= SHORT_RANGE, list(r.ranks)) for i, r in enumerate(ranges)]
    fields = "_id int, _low double, _high double, _skip long, _short boolean, _ranks array<long>"
    schema = T.StructType([*[data.schema[b] for b in by], *T.StructType.fromDDL(fields).fields])
    table = spark.createDataFrame(rows, schema)
    low, v = F.col("_low"), F.col("_v")
    scaled = table.drop("_ranks", "_skip").withColumn("_width", _squash(F.col("_high")) - _squash(low))
    inside = data.join(F.broadcast(scaled), list(by)).filter(v.between(low, F.col("_high")))
    share = F.when(F.col("_width") > 0, (_squash(v) - _squash(low)) / F.col("_width")).otherwise(0.0)
    cell = F.when(F.col("_short"), v).otherwise(_cell(share, VALUE_CELLS))
    cells = inside.groupBy("_id", cell.alias("_cell")).agg(
        F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")
    )
    earlier = Window.partitionBy("_id").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counted = cells.withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    start = F.col("_skip") + F.col("_before")
    held = F.filter("_ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n")))
    hits = (
        counted.join(F.broadcast(table.select("_id", "_skip", "_ranks")), "_id")
        .withColumn("start", start)
        .withColumn("held", held)
        .filter(F.size("held") > 0)
    )
    return [
        Range(ranges[r["_id"]].group, r.low, r.high, r.start, r.n, tuple(r.held))
        for r in hits.select("_id", "low", "high", "start", "n", "held").collect()
    ]
