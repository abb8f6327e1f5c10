"""Time helpers on TIMESTAMP_NTZ columns; the clock is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(text: str) -> Column:
    """Literal TIMESTAMP_NTZ."""
    return F.lit(text).cast("timestamp_ntz")


def cutoff(as_of: str, hours: int | Column) -> Column:
    """Start of the trailing window; the end is left open on purpose."""
    h = F.lit(hours) if isinstance(hours, int) else hours
    return instant(as_of) - F.make_dt_interval(F.lit(0), h)


def within(ts: Column, as_of: str, hours: int) -> Column:
    """Inclusive trailing window; a literal bound, so it reaches the scan."""
    return ts >= cutoff(as_of, hours)


EPOCH = "1970-01-01 00:00:00"


def _elapsed(start: Column, end: Column) -> Column:
    """Exact seconds as a decimal; plain subtraction, so no time zone is involved."""
    return (end - start).cast("interval second").cast("decimal(20,6)")


def seconds_between(start: Column, end: Column) -> Column:
    return _elapsed(start, end).cast("double")


def micros_between(start: Column, end: Column) -> Column:
    return (_elapsed(start, end) * 1000000).cast("bigint")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ."""
    return micros_between(instant(EPOCH), ts)


def from_micros(value: Column) -> Column:
    return F.timestamp_add("MICROSECOND", value, instant(EPOCH))
