"""Dates, periods and time zones; the run date is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_time(utc: Column, tz: str = "America/Los_Angeles") -> Column:
    """Wall-clock time in ``tz`` of a zone-free UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def local_date(utc: Column, tz: str = "America/Los_Angeles") -> Column:
    return F.to_date(local_time(utc, tz))


def ntz(value: dt.datetime | dt.date | str) -> Column:
    """Zone-free timestamp literal."""
    return F.lit(str(value)).cast("timestamp_ntz")


def local_day_bounds(first: dt.date, end: dt.date, tz: str) -> tuple[Column, Column]:
    """UTC instants of the local midnights that bound ``[first, end)``.

    They fold to literals, so a filter on the raw column is pushed to the scan.
    """
    return tuple(F.convert_timezone(F.lit(tz), F.lit("UTC"), ntz(day)) for day in (first, end))


def month_label(day: Column) -> Column:
    """``Mon-yy``"""
    return F.date_format(day, "MMM-yy")


# Months per closed period of each rebate frequency (fixed values).
PERIOD_MONTHS = {"Monthly": 1, "Bi-Monthly": 2, "Quarter": 3, "Annual": 12}


def period_bounds(as_of: Column, frequency: str) -> tuple[Column, Column]:
    """Half-open ``[start, end)`` of the last closed period before ``as_of``."""
    unit = {"Quarter": "quarter", "Annual": "year"}.get(frequency, "month")
    end = F.trunc(as_of, unit)
    return F.add_months(end, -PERIOD_MONTHS[frequency]), end


def month_start(day: dt.date, back: int = 0) -> dt.date:
    """First day of the month ``back`` months before the month of ``day``."""
    months = day.year * 12 + day.month - 1 - back
    return dt.date(months // 12, months % 12 + 1, 1)


def year_start(day: dt.date, back: int = 0) -> dt.date:
    return dt.date(day.year - back, 1, 1)
