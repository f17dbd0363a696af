"""Dates, stamps and lake paths.

Instants are ``TIMESTAMP_NTZ`` values in UTC, so nothing here depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OFFSET = r"([+-])(\d{2}):?(\d{2})$"


def event_day(created_at: Column) -> Column:
    """First ten characters of the stored string, ``''`` for null. No time zone maths."""
    return F.substring(F.coalesce(created_at, F.lit("")), 1, 10)


def utc_instant(created_at: Column) -> Column:
    """Parse an ISO or space-separated timestamp to a UTC instant; null when it does not parse.

    A trailing ``+hh:mm`` is taken off the local reading; ``Z`` or nothing means UTC.
    """
    local = created_at.try_cast("timestamp_ntz")
    has_time = F.length(created_at) > 10
    sign = F.regexp_extract(created_at, _OFFSET, 1)
    hours = F.regexp_extract(created_at, _OFFSET, 2).try_cast("int")
    minutes = F.regexp_extract(created_at, _OFFSET, 3).try_cast("int")
    shift = F.make_dt_interval(F.lit(0), F.coalesce(hours, F.lit(0)), F.coalesce(minutes, F.lit(0)))
    return (
        F.when(has_time & (sign == "+"), local - shift)
        .when(has_time & (sign == "-"), local + shift)
        .otherwise(local)
    )


def to_event_time(instant: Column) -> Column:
    """A UTC instant as ``TIMESTAMP``, which watermarks need, whatever the session time zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), instant).cast("timestamp")


def from_event_time(moment: Column) -> Column:
    """The UTC instant of a ``TIMESTAMP``."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))


def utc_date(instant: Column) -> Column:
    return instant.cast("date")


def _padded(instant: Column, part: str, width: int) -> Column:
    return F.lpad(F.date_part(F.lit(part), instant).cast("int").cast("string"), width, "0")


def posts_partition_path(prefix: str, instant: Column) -> Column:
    """``{prefix}/posts/year=YYYY/month=MM/day=DD`` of an instant."""
    return F.concat(
        F.lit(f"{prefix}/posts/year="),
        _padded(instant, "YEAR", 4),
        F.lit("/month="),
        _padded(instant, "MONTH", 2),
        F.lit("/day="),
        _padded(instant, "DAY", 2),
    )


def summary_partition_path(prefix: str, instant: Column) -> Column:
    """``{prefix}/daily_summary/run_date=YYYY-MM-DD`` of an instant."""
    return F.concat(
        F.lit(f"{prefix}/daily_summary/run_date="), instant.cast("date").cast("string")
    )


def run_stamp(instant: Column) -> Column:
    """``YYYYMMDDTHHMMSSZ``."""
    day = F.regexp_replace(instant.cast("date").cast("string"), "-", "")
    return F.concat(
        day,
        F.lit("T"),
        _padded(instant, "HOUR", 2),
        _padded(instant, "MINUTE", 2),
        _padded(instant, "SECOND", 2),
        F.lit("Z"),
    )


def event_partition_path(prefix: str, day: Column) -> Column:
    """The posts partition of a ``YYYY-MM-DD`` string; missing parts stay empty."""
    part = F.split(day, "-")
    piece = [F.coalesce(F.get(part, F.lit(i)), F.lit("")) for i in range(3)]
    return F.concat(
        F.lit(f"{prefix}/posts/year="), piece[0], F.lit("/month="), piece[1], F.lit("/day="), piece[2]
    )


def path_date(path: Column) -> Column:
    """The date a posts partition path stands for; null when it is not one."""
    pattern = r"year=(\d{4})/month=(\d{2})/day=(\d{2})"
    joined = F.regexp_replace(F.regexp_extract(path, pattern, 0), r"[a-z]+=", "")
    return F.replace(joined, F.lit("/"), F.lit("-")).try_cast("date")
