"""Reading values as they arrive: text, gaps, epochs, local times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(text) -> Column:
    """Null where the text is no timestamp (a plain cast would end the job)."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def epoch_to_timestamp(seconds: str) -> Column:
    return F.timestamp_seconds(F.col(seconds))


def iso_text(ts: str) -> Column:
    """2025-01-19T21:15:00, without a zone."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def to_utc(ts: Column, zone: str | None) -> Column:
    """A local time of `zone` as UTC; without a zone the time is UTC already."""
    return ts if zone is None else F.to_utc_timestamp(ts, zone)


def whole_number(text: str) -> Column:
    """'55', '55.0' and '55.9' are 55; anything that is no number is null."""
    number = F.col(text).try_cast("double")
    return F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).try_cast("int")


def code_or_default(code: str, default: int = -1) -> Column:
    return F.coalesce(F.col(code).try_cast("int"), F.lit(default))


def two_decimals(name: str) -> Column:
    return F.round(F.col(name), 2)
