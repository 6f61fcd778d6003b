"""Last value at or before a landmark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.timeline import up_to
from tidemark.operators.events import SLICES, join_cohort
from tidemark.rules import KEYS


def as_of_last(
    events: DataFrame,
    cohort: DataFrame,
    keys: Sequence[str] = KEYS,
    time: str = "charttime",
    value: str = "valuenum",
    high: str = "prediction_time",
    value_name: str = "last_value",
    time_name: str = "last_time",
    slices: int = SLICES,
) -> DataFrame:
    """Latest non-null value with `time <= high` per entity; ties take the
    larger value.

    Values of one time are reduced first, then the latest time wins: two hash
    aggregates instead of a sort per entity.
    """
    narrow = events.select(*keys, time, value).filter(F.col(value).isNotNull())
    known = join_cohort(narrow, cohort, keys, (high,), slices).filter(up_to(time, high))
    at_once = known.groupBy(*keys, time).agg(F.max(value).alias("_value"))
    latest = at_once.groupBy(*keys).agg(F.max_by("_value", time).alias(value_name), F.max(time).alias(time_name))
    return latest.select(*keys, value_name, time_name)
