"""Dates and instants relative to an explicit as-of date; parsing of landed timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarspark.functions.scalars import col

BANGKOK = "Asia/Bangkok"


def as_date(as_of) -> dt.date:
    if isinstance(as_of, dt.datetime):
        return as_of.date()
    return dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of


def as_instant(as_of) -> Column:
    """The as-of moment as a UTC timestamp literal; a plain date means its midnight."""
    if not isinstance(as_of, dt.datetime):
        as_of = dt.datetime.combine(as_date(as_of), dt.time())
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit(int(as_of.timestamp() * 1_000_000)))


def day(as_of, back: int = 0) -> Column:
    """The calendar day `back` days before the as-of date, as a literal."""
    return F.lit(as_date(as_of) - dt.timedelta(days=back))


def since_day(c, as_of, days: int) -> Column:
    """Date from `days` days before the as-of date up to that date, so a past day can be replayed.

    Literal bounds, so partitions prune.
    """
    return (col(c) >= day(as_of, days)) & (col(c) <= day(as_of))


def before(as_of, days: int) -> Column:
    """The moment exactly `days` x 24 h before the as-of moment, not cut to midnight."""
    start = as_of if isinstance(as_of, dt.datetime) else dt.datetime.combine(as_date(as_of), dt.time())
    return as_instant(start - dt.timedelta(days=days))


def since_instant(c, as_of, days: int) -> Column:
    """Timestamp from `days` x 24 h before the as-of moment up to it; a plain as-of date counts to its end."""
    until = col(c) <= as_instant(as_of) if isinstance(as_of, dt.datetime) else col(c) < before(as_of, -1)
    return (col(c) >= before(as_of, days)) & until


def between_days(c, as_of, newest: int | None, oldest: int) -> Column:
    """Date in [as_of - oldest, as_of - newest); `newest=None` ends with the as-of date itself."""
    inside = since_day(c, as_of, oldest)
    return inside if newest is None else inside & (col(c) < day(as_of, newest))


def between_instants(c, as_of, newest: int | None, oldest: int) -> Column:
    inside = since_instant(c, as_of, oldest)
    return inside if newest is None else inside & (col(c) < before(as_of, newest))


# Epoch seconds of 0001-01-01 and 9999-12-31: what lies outside, such as milliseconds, is no readable instant.
INSTANT = (
    "case when trim({0}) rlike '^-?[0-9]+([.][0-9]+)?$'"
    " then case when try_cast(trim({0}) as double) between -62135596800 and 253402300799"
    " then timestamp_micros(cast(try_cast(trim({0}) as double) * 1000000 as bigint)) end"
    " when trim({0}) rlike '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' then try_cast(concat(trim({0}), 'T00:00:00Z') as timestamp)"
    " when trim({0}) rlike '(Z|[+-][0-9]{{2}}:?[0-9]{{2}})$' then try_cast(trim({0}) as timestamp)"
    " else try_cast(concat(trim({0}), 'Z') as timestamp) end"
)


def parse_instant(name: str) -> Column:
    """Epoch seconds or an ISO text to a timestamp; a text without an offset is UTC. NULL if unreadable.

    `name` is a column or field path, or SQL text of a string expression.
    """
    return F.expr(INSTANT.format(name))


def local_day(ts, timezone: str = BANGKOK) -> Column:
    """Calendar day of an instant on the wall clock of `timezone` (session time zone UTC)."""
    return F.to_date(F.from_utc_timestamp(col(ts), timezone))


def compact_day(name: str) -> Column:
    """YYYYMMDD or ISO text to a date, NULL when it is neither."""
    text = F.expr(name)
    return F.when(F.length(text) == 8, F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")).otherwise(
        parse_instant(name).cast("date")
    )


def named_period(name: str, as_of) -> tuple[dt.date, dt.date]:
    """First and last day (both included) of a period named relative to the as-of date."""
    today = as_date(as_of)
    first = today.replace(day=1)
    before = first - dt.timedelta(days=1)
    periods = {
        "today": (today, today),
        "yesterday": (today - dt.timedelta(days=1),) * 2,
        "last_7_days": (today - dt.timedelta(days=6), today),
        "last_30_days": (today - dt.timedelta(days=29), today),
        "this_month": (first, today),
        "last_month": (before.replace(day=1), before),
    }
    if name not in periods:
        raise ValueError(f"unknown period: {name}")
    return periods[name]


def day_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from `start` to `end`, both included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date"))


def start_of_day(c) -> Column:
    return F.date_trunc("DAY", col(c))


def end_of_day(c) -> Column:
    return start_of_day(c) + F.expr("interval 1 day") - F.expr("interval 1 microsecond")
