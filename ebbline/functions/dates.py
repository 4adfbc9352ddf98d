"""Date expressions. Three different day notions are in use; keep them apart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

SnapshotLike = str | dt.date | dt.datetime | Column


def ts(value: SnapshotLike) -> Column:
    """Timestamp literal without time zone (a foldable value, so filters push down)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        text = value.isoformat(sep=" ")
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def latest(values: Iterable[str | dt.date | dt.datetime]) -> str:
    """The latest of some snapshot dates."""
    return max((dt.datetime.fromisoformat(str(v)) for v in values)).isoformat(sep=" ")


def plus_days(moment: Column, days: int) -> Column:
    return moment + F.expr(f"INTERVAL '{int(days)}' DAY")


def day_diff(start: Column, end: Column) -> Column:
    """Whole elapsed 24-hour periods, rounded towards minus infinity."""
    return F.floor(micros_between(start, end) / F.lit(86_400_000_000)).cast("bigint")


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def frac_days(start: Column, end: Column) -> Column:
    """Elapsed days as a fraction."""
    return micros_between(start, end) / F.lit(86_400_000_000.0)


def in_window(moment: Column, snapshot: Column, days: int) -> Column:
    """``(snapshot - days, snapshot]``."""
    return (moment > plus_days(snapshot, -days)) & (moment <= snapshot)


def after_window(moment: Column, snapshot: Column, days: int) -> Column:
    """``(snapshot, snapshot + days]``."""
    return (moment > snapshot) & (moment <= plus_days(snapshot, days))
