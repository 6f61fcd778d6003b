"""Point events: tag, assign to an entity's window, check, summarise, pivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.scalar import quoted
from tidemark.functions.timeline import in_window
from tidemark.rules import KEYS, Item, Range

# A rule table written down in code is broadcast up to this many rows.
RULE_ROWS = 10_000

# Slices per entity in a join of events with the cohort.
SLICES = 8

# A cohort counted up to this many rows may be broadcast: five 8-byte columns
# make some 5 MB of it, and the driver holds one for each joined table at a time.
BROADCAST_ROWS = 50_000

SUMMARY = ["first", "last", "min", "max", "mean"]


def _rule_table(spark: SparkSession, rows: Sequence[tuple], columns: str) -> DataFrame:
    """An inline relation: its size is known to the optimizer, no Python worker
    is involved."""

    def literal(value: str | int | float) -> str:
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{value!r}D" if isinstance(value, float) else str(value)

    text = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    table = spark.sql(f"SELECT * FROM VALUES {text} AS t({columns})")
    return F.broadcast(table) if len(rows) <= RULE_ROWS else table


def item_map(spark: SparkSession, rows: Sequence[Item]) -> DataFrame:
    """(itemid, variable); several items may stand for one variable."""
    return _rule_table(spark, rows, "itemid, variable")


def range_table(spark: SparkSession, rows: Sequence[Range]) -> DataFrame:
    rows = [(r.variable, float(r.low), float(r.high)) for r in rows]
    return _rule_table(spark, rows, "variable, low, high")


def tag_items(events: DataFrame, items: Sequence[Item] | DataFrame) -> DataFrame:
    """Keep mapped items and name their variable.

    The ids of a map given as rows are also a plain filter, which reaches the
    parquet scan. A map given as a table is joined as Spark sees fit.
    """
    if isinstance(items, DataFrame):
        return events.join(items, "itemid")
    wanted = sorted({item.itemid for item in items})
    kept = events.filter(F.col("itemid").isin(wanted))
    return kept.join(item_map(events.sparkSession, items), "itemid")


def plausible(events: DataFrame, ranges: Sequence[Range] | DataFrame, value: str = "valuenum") -> DataFrame:
    """Keep values inside the inclusive range of their variable; a variable
    without a range is dropped."""
    table = ranges if isinstance(ranges, DataFrame) else range_table(events.sparkSession, ranges)
    joined = events.join(table, "variable").filter(F.col(value).between(F.col("low"), F.col("high")))
    return joined.drop("low", "high")


def slices_for(cohort: DataFrame) -> int:
    """0 (broadcast) for a cohort that was counted and is small, else SLICES.

    Runs a count, which a staged cohort answers from its file footers.
    """
    return 0 if cohort.count() <= BROADCAST_ROWS else SLICES


def join_cohort(
    facts: DataFrame,
    cohort: DataFrame,
    keys: Sequence[str] = KEYS,
    carry: Sequence[str] = ("intime", "prediction_time"),
    slices: int = SLICES,
) -> DataFrame:
    """Equi-join long facts with their cohort row and its window bounds.

    One entity may own a large share of the facts. Facts are therefore sliced by
    their content and the narrow cohort row is repeated once per slice: a hot
    entity spreads over several tasks, and because an aggregate by entity must
    shuffle its partial results afterwards, adaptive execution stays free to
    split a slice that is still too large. `slices=1` suits tables bucketed by
    entity, `slices=0` a cohort whose size was checked: see `slices_for`.

    Spark guesses the size of the repeated rows from the files of the cohort, far
    too low, and would send them all through the driver; so slices are merged.
    """
    bounds = cohort.select(*dict.fromkeys([*keys, *carry]))
    if slices <= 1:
        return facts.join(bounds if slices else F.broadcast(bounds), list(keys))
    content = [c for c in facts.columns if c not in keys]
    facts = facts.withColumn("_slice", F.pmod(F.xxhash64(*content), F.lit(slices)).cast("int"))
    numbers = F.array(*[F.lit(i) for i in range(slices)])
    bounds = bounds.withColumn("_slice", F.explode(numbers)).hint("merge")
    return facts.join(bounds, [*keys, "_slice"]).drop("_slice")


def events_in_window(
    events: DataFrame,
    cohort: DataFrame,
    keys: Sequence[str] = KEYS,
    time: str = "charttime",
    low: str = "intime",
    high: str = "prediction_time",
    slices: int = SLICES,
) -> DataFrame:
    """Events of cohort entities inside `[low, high)`."""
    joined = join_cohort(events, cohort, keys, (low, high), slices)
    return joined.filter(in_window(time, low, high)).drop(low, high)


def assign_to_stay(
    events: DataFrame,
    cohort: DataFrame,
    keys: Sequence[str] = ("subject_id", "hadm_id"),
    entity: str = "stay_id",
    time: str = "charttime",
    low: str = "intime",
    high: str = "prediction_time",
    slices: int = SLICES,
) -> DataFrame:
    """Give admission-level events the stay whose window contains them."""
    joined = join_cohort(events, cohort, keys, (entity, low, high), slices)
    return joined.filter(in_window(time, low, high)).drop(low, high)


def summarise(
    events: DataFrame,
    by: Sequence[str] = (*KEYS, "variable"),
    value: str = "valuenum",
    time: str = "charttime",
) -> DataFrame:
    """First, last, min, max, mean, latest time and count per group.

    Ties in time: the first value is the smallest, the last the largest. A null
    value counts as a measurement and is nowhere else.

    Values of one time are reduced first; then the order is a plain timestamp, so
    both steps are hash aggregates of fixed-width buffers, and a hot group is
    spread by its times.
    """
    at_once = events.groupBy(*by, time).agg(
        F.min(value).alias("_low"),
        F.max(value).alias("_high"),
        F.sum(value).alias("_sum"),
        F.count(value).alias("_known"),
        F.count("*").alias("_n"),
    )
    known = F.when(F.col("_known") > 0, F.col(time))
    return at_once.groupBy(*by).agg(
        F.min_by("_low", known).alias("value_first"),
        F.max_by("_high", known).alias("value_last"),
        F.min("_low").alias("value_min"),
        F.max("_high").alias("value_max"),
        (F.sum("_sum") / F.sum("_known")).alias("value_mean"),
        F.max(time).alias("last_time"),
        F.sum("_n").alias("measurement_count"),
    )


def summarise_sum(
    events: DataFrame, by: Sequence[str] = KEYS, value: str = "value", time: str = "charttime"
) -> DataFrame:
    """Total, count, first and last time per group."""
    return events.groupBy(*by).agg(
        F.sum(value).alias("value_sum"),
        F.count("*").alias("measurement_count"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
    )


def pivot_summary(
    summary: DataFrame,
    prefixes: Mapping[str, str],
    keys: Sequence[str] = KEYS,
    counts: Sequence[str] = (),
    times: Sequence[str] = (),
) -> DataFrame:
    """One row per entity with `<prefix>_<stat>` columns.

    The variable list is given, so no job looks for it. The narrow summary is
    partitioned by entity first; pivoting then happens in place, and no mostly
    empty wide rows are shuffled. `counts` and `times` name the variables whose
    measurement count or latest time is wanted too.
    """
    source = {s: f"value_{s}" for s in SUMMARY}
    if counts:
        source["measurement_count"] = "measurement_count"
    if times:
        source["last_time"] = "last_time"
    wide = (
        summary.repartition(*keys)
        .groupBy(*keys)
        .pivot("variable", list(prefixes))
        .agg(*[F.max(c).alias(stat) for stat, c in source.items()])
    )
    columns = []
    for variable, prefix in prefixes.items():
        extra = ["measurement_count"] * (variable in counts) + ["last_time"] * (variable in times)
        columns += [f"{quoted(f'{variable}_{s}')} AS {quoted(f'{prefix}_{s}')}" for s in SUMMARY + extra]
    return wide.selectExpr(*map(quoted, keys), *columns)


def point_features(
    events: DataFrame,
    cohort: DataFrame,
    items: Sequence[Item],
    ranges: Sequence[Range],
    prefixes: Mapping[str, str],
    counts: Sequence[str] = (),
    stay_less: bool = False,
    slices: int = SLICES,
) -> DataFrame:
    """Wide features of entities that have at least one plausible event.

    Every filter that needs no cohort runs before the join, so only candidate
    values are shuffled.
    """
    kept = plausible(tag_items(events.filter(F.col("valuenum").isNotNull()), items), ranges)
    keys = ["subject_id", "hadm_id"] if stay_less else KEYS
    kept = kept.select(*keys, "charttime", "variable", "valuenum")
    assign = assign_to_stay if stay_less else events_in_window
    return pivot_summary(summarise(assign(kept, cohort, slices=slices)), prefixes, counts=counts)
