"""Calendar columns of a timestamp, all native expressions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from breezemart.functions.keys import time_key
from breezemart.lookups import HOLIDAYS, SEASONS


def season_key(ts: str) -> Column:
    """1 Winter (Dec-Feb), 2 Spring, 3 Summer, 4 Fall; a missing stamp counts as 4."""
    month = F.month(ts)
    return (F.when(month.isin(12, 1, 2), 1).when(month.isin(3, 4, 5), 2)
            .when(month.isin(6, 7, 8), 3).otherwise(4))


def season_name(ts: str) -> Column:
    key = season_key(ts)
    names = {row[0]: row[1] for row in SEASONS}
    return (F.when(key == 1, names[1]).when(key == 2, names[2])
            .when(key == 3, names[3]).otherwise(names[4]))


def is_holiday(ts: str) -> Column:
    """True on a listed day; false in a year without a list and for a missing stamp."""
    days = [datetime.date(year, month, day)
            for year, pairs in HOLIDAYS.items() for month, day in pairs]
    return F.coalesce(F.to_date(ts).isin(days), F.lit(False))


def fiscal_year(ts: str) -> Column:
    """Fiscal years start in October."""
    return F.when(F.month(ts) >= 10, F.year(ts) + 1).otherwise(F.year(ts))


def fiscal_quarter(ts: str) -> Column:
    """Place of the month inside its quarter (1..3), under its customary name.

    `fiscal_quarter_of_year` is the fiscal quarter proper.
    """
    return ((F.month(ts) - 1) % 3 + 1).cast("int")


def fiscal_quarter_of_year(ts: str) -> Column:
    return F.quarter(F.add_months(F.to_date(ts), 3))


BASE_COLUMNS = {
    "time_key": time_key,
    "full_date": F.to_date,
    "year": F.year,
    "quarter": F.quarter,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
    "day_of_week": F.dayofweek,
    "is_weekend": lambda ts: F.dayofweek(ts).isin(1, 7),
    "season": season_name,
    "is_holiday": is_holiday,
}
EXTRA_COLUMNS = {
    "month_name": lambda ts: F.date_format(ts, "MMMM"),
    "day_name": lambda ts: F.date_format(ts, "EEEE"),
    "week_of_year": F.weekofyear,
    "is_end_of_month": lambda ts: F.to_date(ts) == F.last_day(ts),
    "fiscal_year": fiscal_year,
    "fiscal_quarter": fiscal_quarter,
    "fiscal_quarter_of_year": fiscal_quarter_of_year,
}


def calendar_columns(ts: str, names: list[str] | None = None) -> list[Column]:
    """The asked-for calendar columns of `ts`, ready for one `select`."""
    known = {**BASE_COLUMNS, **EXTRA_COLUMNS}
    return [known[name](ts).alias(name) for name in (names or known)]
