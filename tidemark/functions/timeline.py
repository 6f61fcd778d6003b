"""Time arithmetic on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def age_at(anchor_age: ColumnLike, anchor_year: ColumnLike, ts: ColumnLike) -> Column:
    """Age in the year of `ts`, given the age in an anchor year."""
    return (_col(anchor_age) + F.year(_col(ts)) - _col(anchor_year)).cast("int")


def landmark(ts: ColumnLike, hours: int = 24) -> Column:
    return _col(ts) + F.expr(f"INTERVAL '{int(hours)}' HOUR")


def hours_between(start: ColumnLike, end: ColumnLike) -> Column:
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(3.6e9)


def in_window(ts: ColumnLike, low: ColumnLike, high: ColumnLike) -> Column:
    """Half-open: `low <= ts < high`."""
    return (_col(ts) >= _col(low)) & (_col(ts) < _col(high))


def up_to(ts: ColumnLike, high: ColumnLike) -> Column:
    """No lower bound, end included."""
    return _col(ts) <= _col(high)


def overlaps(start: ColumnLike, end: ColumnLike, low: ColumnLike, high: ColumnLike) -> Column:
    """Interval meets the window; a null end is still running."""
    return (_col(start) < _col(high)) & (_col(end).isNull() | (_col(end) > _col(low)))


def clipped_start(start: ColumnLike, low: ColumnLike) -> Column:
    return F.greatest(_col(start), _col(low))


def clipped_end(end: ColumnLike, high: ColumnLike) -> Column:
    return F.least(F.coalesce(_col(end), _col(high)), _col(high))


def parse_ts(c: ColumnLike, fmt: str | None = None) -> Column:
    """Text to timestamp; text that is no timestamp becomes null."""
    parsed = F.try_to_timestamp(_col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_col(c))
    return parsed.cast("timestamp_ntz")
