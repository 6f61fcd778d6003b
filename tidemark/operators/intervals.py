"""Interval events: overlap with a window, clipping, exposure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.timeline import clipped_end, clipped_start, hours_between, overlaps
from tidemark.operators.events import SLICES, join_cohort
from tidemark.rules import KEYS


def intervals_in_window(
    intervals: DataFrame,
    cohort: DataFrame,
    keys: Sequence[str] = KEYS,
    start: str = "starttime",
    end: str = "endtime",
    low: str = "intime",
    high: str = "prediction_time",
    slices: int = SLICES,
) -> DataFrame:
    """Intervals that meet the window of their entity; the bounds stay on the
    row, so clipping needs no second join."""
    joined = join_cohort(intervals, cohort, keys, (low, high), slices)
    return joined.filter(overlaps(start, end, low, high))


def clip_interval(
    df: DataFrame,
    start: str = "starttime",
    end: str = "endtime",
    low: str = "intime",
    high: str = "prediction_time",
) -> DataFrame:
    """Cut intervals to the window; an open end runs to the window's end."""
    clipped = {start: clipped_start(start, low), end: clipped_end(end, high)}
    return df.withColumns(clipped).drop(low, high)


def positive_length(df: DataFrame, start: str = "starttime", end: str = "endtime") -> DataFrame:
    return df.filter(F.col(end) > F.col(start))


def exposure(
    intervals: DataFrame,
    by: Sequence[str] = KEYS,
    start: str = "starttime",
    end: str = "endtime",
    flags: Sequence[str] = (),
    category: str = "variable",
) -> DataFrame:
    """Envelope and summed hours per entity, plus one 0/1 column per flag.

    Hours of overlapping intervals add up.
    """
    return intervals.groupBy(*by).agg(
        *any_flags(flags, category),
        F.min(start).alias("exposure_start"),
        F.max(end).alias("exposure_end"),
        F.sum(hours_between(start, end)).alias("exposure_hours"),
    )


def any_flags(flags: Sequence[str], category: str = "variable") -> list:
    """Aggregates that are 1 when the category occurs in the group."""
    return [F.max(F.when(F.col(category) == f, 1).otherwise(0)).alias(f) for f in flags]


def interval_exposure(
    intervals: DataFrame, cohort: DataFrame, flags: Sequence[str] = (), slices: int = SLICES
) -> DataFrame:
    """Exposure inside the window, for entities that have any."""
    columns = [*KEYS, "starttime", "endtime", *(["variable"] if flags else [])]
    met = intervals_in_window(intervals.select(*columns), cohort, slices=slices)
    return exposure(positive_length(clip_interval(met)), flags=flags)
