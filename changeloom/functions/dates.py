"""Date keys: integers of the form YYYYMMDD, and their epoch-day wire form."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Epoch days of 0001-01-01 and 9999-12-31; anything else is not a calendar date.
MIN_EPOCH_DAY = -719162
MAX_EPOCH_DAY = 2932896


def date_key(date: Column) -> Column:
    """YYYYMMDD integer of a date, by arithmetic so that it stays in generated code."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def valid_epoch_day(days: Column) -> Column:
    return days.isNull() | days.between(MIN_EPOCH_DAY, MAX_EPOCH_DAY)


def epoch_days_key(days: Column, strict_zero: bool = False) -> Column:
    """Epoch days to YYYYMMDD. ``strict_zero`` also reads day 0 as "absent"."""
    present = days.between(MIN_EPOCH_DAY, MAX_EPOCH_DAY)
    if strict_zero:
        present = present & (days != 0)
    return F.when(present, date_key(F.date_from_unix_date(days)))


def order_date_key(days: Column, event_time: Column, strict_zero: bool = False) -> Column:
    """Order date key; an absent date falls back to the day of the event."""
    return F.coalesce(epoch_days_key(days, strict_zero), date_key(event_time))


def millis_to_ntz(millis: Column) -> Column:
    """Epoch milliseconds to TIMESTAMP_NTZ, whatever the session time zone is."""
    seconds = millis.cast("decimal(18,0)") / F.lit(1000)
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


def key_of(value: dt.date | str | int) -> int:
    """Report bound (date, ISO text or ready key) as a YYYYMMDD integer."""
    if isinstance(value, int):
        return value
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return value.year * 10000 + value.month * 100 + value.day
