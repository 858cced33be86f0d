"""Time functions.

Timestamps are wall-clock text ``yyyy-MM-ddTHH:mm:ssZ``. They are taken apart by position, so no
session time zone is involved and the expressions stay inside code generation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

DAY_SECONDS = 86400
DAY_MINUTES = 1440


def text_date(ts: Column) -> Column:
    """Date part of a timestamp text."""
    return F.substring(ts, 1, 10).try_cast("date")


def seconds_of_day(ts: Column) -> Column:
    """Second of the day; hours past 23 wrap, so 24:59:59 is 00:59:59."""
    hour, minute, second = (F.substring(ts, at, 2).try_cast("int") for at in (12, 15, 18))
    return (hour * 3600 + minute * 60 + second) % DAY_SECONDS


def parse_ts(ts: Column) -> Column:
    """Timestamp text to TIMESTAMP_NTZ; hours past 23 roll into the next day."""
    hour, minute, second = (F.substring(ts, at, 2).try_cast("int") for at in (12, 15, 18))
    midnight_ts = text_date(ts).cast("timestamp_ntz")
    return F.timestamp_add("SECOND", hour * 3600 + minute * 60 + second, midnight_ts)


def _two(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def format_ts(date: Column, second: Column) -> Column:
    """Timestamp text from a date and a second of the day."""
    hour = F.floor(second / 3600).cast("int")
    minute = F.floor((second % 3600) / 60).cast("int")
    return F.concat(date.cast("string"), F.lit("T"), _two(hour), F.lit(":"), _two(minute),
                    F.lit(":"), _two((second % 60).cast("int")), F.lit("Z"))


def midnight(date: Column) -> Column:
    """Timestamp text of the start of a day."""
    return F.concat(date.cast("string"), F.lit("T00:00:00Z"))


def date_int(date: Column) -> Column:
    """Date as yyyymmdd."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.day(date)).cast("int")


def time_int(second: Column) -> Column:
    """Second of the day as hhmmss."""
    hour = F.floor(second / 3600)
    minute = F.floor((second % 3600) / 60)
    return (hour * 10000 + minute * 100 + second % 60).cast("int")


def date_text_int(date: Column) -> Column:
    """Date text to yyyymmdd."""
    return F.replace(date, F.lit("-"), F.lit("")).cast("int")


def second_of(ts: Column) -> Column:
    """Second of the day of a TIMESTAMP_NTZ."""
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def day_before(date: Column) -> Column:
    return F.date_sub(date, 1)


def day_range(start: Column, end: Column) -> Column:
    """Array of the days from start to end, both included; empty when end is before start."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))


def date_range(start: str, end: str) -> list[str]:
    """Days from start to end, both included, as text; an end before the start is an error."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    if last < first:
        raise ValueError(f"period ends ({end}) before it starts ({start})")
    return [(first + dt.timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


def shift(date: str, days: int) -> str:
    return (dt.date.fromisoformat(date) + dt.timedelta(days=days)).isoformat()


def slot_count(period: int = DAY_MINUTES, interval: int = 5) -> int:
    return period // interval


def ts_slot(second: Column, interval: int = 5, slots: int = 288) -> Column:
    """Sample slot of a second of the day.

    The second is rounded half-up to minutes, the minute half-up to slots; the slot one past the
    end belongs to the last. Both roundings are exact in integers.
    """
    minute = F.floor((second + 30) / 60)
    slot = F.floor((minute * 2 + interval) / (2 * interval)).cast("int")
    return F.when(slot == slots, slots - 1).otherwise(slot)
