"""Calendar rules. Every date trap of the metric definitions is settled here, once.

``as_of`` is always an explicit Python ``date`` or ``datetime``; bounds derived from it are
plain literals, so they fold at planning time and reach the Parquet scan.
"""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(as_of: date | datetime) -> date:
    return as_of.date() if isinstance(as_of, datetime) else as_of


def as_datetime(as_of: date | datetime) -> datetime:
    return as_of if isinstance(as_of, datetime) else datetime(as_of.year, as_of.month, as_of.day)


def lit_date(d: date | datetime) -> Column:
    return F.lit(as_date(d).isoformat()).cast("date")


def lit_ts(t: date | datetime) -> Column:
    """Time-zone free literal; ``F.lit(datetime)`` would depend on the Python process's zone."""
    return F.lit(as_datetime(t).isoformat(sep=" ")).cast("timestamp_ntz")


def shift_months(d: date | datetime, months: int):
    """Calendar month shift that keeps the day, or the last day of a shorter month."""
    index = d.year * 12 + d.month - 1 + months
    year, month = divmod(index, 12)
    day = min(d.day, calendar.monthrange(year, month + 1)[1])
    return d.replace(year=year, month=month + 1, day=day)


def shift_days(d, days: int):
    return d + timedelta(days=days)


def month_start(d: date | datetime) -> date:
    return as_date(d).replace(day=1)


def quarter_start(d: date | datetime, fiscal: bool = False) -> date:
    """First day of the quarter; fiscal quarters start in Feb, May, Aug and Nov."""
    d = as_date(d)
    if fiscal:
        return shift_months(quarter_start(shift_months(d.replace(day=1), -1)), 1)
    return d.replace(month=3 * ((d.month - 1) // 3) + 1, day=1)


def last_complete_month(as_of: date | datetime) -> tuple[date, date]:
    """Half-open bounds [start, end) of the calendar month before ``as_of``'s."""
    end = month_start(as_of)
    return shift_months(end, -1), end


def trunc_date(col: Column, grain: str, fiscal: bool = False) -> Column:
    """Start of the day, week (Monday), month, quarter or year, as a DATE.

    The fiscal year starts on 1 February; only quarter and year differ from the calendar.
    """
    day = col.cast("date")
    if grain == "day":
        return day
    if fiscal and grain in ("quarter", "year"):
        return F.add_months(F.trunc(F.add_months(day, -1), grain), 1)
    return F.trunc(day, grain)


def trunc_minute(col: Column) -> Column:
    return F.date_trunc("minute", col).cast("timestamp_ntz")


def boundary_hours(start: Column, end: Column) -> Column:
    """Hour boundaries crossed between two timestamps (00:59 to 01:01 is 1, not 0)."""
    return F.timestamp_diff(
        "HOUR",
        F.date_trunc("hour", start).cast("timestamp_ntz"),
        F.date_trunc("hour", end).cast("timestamp_ntz"),
    )


def age_seconds(start: Column, as_of: datetime) -> Column:
    return F.timestamp_diff(
        "SECOND", F.date_trunc("second", start).cast("timestamp_ntz"), lit_ts(as_of.replace(microsecond=0))
    )


def is_monday(d: date | datetime) -> bool:
    return as_date(d).weekday() == 0
