"""Time expressions.

Timestamps without zone are handled as wall-clock values, so no expression
here depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from zonepulse.functions.columns import as_col


def hour_bucket(ts: Column | str) -> Column:
    """Start of the wall-clock hour."""
    ts = as_col(ts)
    return F.to_date(ts).cast("timestamp_ntz") + F.hour(ts) * F.expr("INTERVAL 1 HOUR")


def date_trunc(unit: str, ts: Column | str) -> Column:
    """Truncate to hour, day, month or year, keeping the no-zone type."""
    if unit == "hour":
        return hour_bucket(ts)
    if unit == "day":
        return F.to_date(as_col(ts)).cast("timestamp_ntz")
    return F.trunc(F.to_date(as_col(ts)), unit).cast("timestamp_ntz")


def dow_sun0(ts: Column | str) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(as_col(ts)) - 1


def dow_mon0(ts: Column | str) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(as_col(ts))


def wrap(value: Column, modulus: int) -> Column:
    """Non-negative remainder, for hour and weekday offsets."""
    return F.pmod(value, F.lit(modulus))


def shift_months(d: Column | str, n: int) -> Column:
    return F.add_months(as_col(d), n)


def month_start(d: Column | str) -> Column:
    return F.trunc(as_col(d), "month")


def month_end(d: Column | str) -> Column:
    return F.last_day(as_col(d))


def days_in_month(d: Column | str) -> Column:
    return F.day(F.last_day(as_col(d)))


def epoch(ts: Column | str) -> Column:
    """Whole seconds since 1970, reading the wall clock as is."""
    return F.unix_timestamp(as_col(ts))


def from_epoch(seconds: Column | str) -> Column:
    start = F.lit("1970-01-01").cast("date").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", as_col(seconds), start)


def parse_iso(text: Column | str) -> Column:
    """ISO text to a wall-clock timestamp; a zone suffix is dropped, bad text gives null."""
    return F.trim(as_col(text)).try_cast("timestamp_ntz")


def typed_time(df, ts: str, value: str) -> Column:
    """A literal of the column's own type, so that the comparison pushes down."""
    return F.lit(value).cast(df.schema[ts].dataType)
