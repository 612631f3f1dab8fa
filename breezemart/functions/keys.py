"""Surrogate keys that are the same in every run and on every machine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def location_key(latitude: str, longitude: str, known: bool = False) -> Column:
    """60 bits of the md5 of the position, written with four decimals; null without a position.

    Say `known` where positions cannot be null. The key is then not nullable, and Spark does not
    place a null test on this costly expression in front of every aggregation under a join.
    """
    lat, lon = F.col(latitude), F.col(longitude)
    digest = F.md5(F.format_string("%.4f_%.4f", lat, lon))
    key = F.coalesce(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(0))
    return key if known else F.when(lat.isNotNull() & lon.isNotNull(), key)


def time_key(ts) -> Column:
    """yyyyMMddHH as an integer, by arithmetic (no text formatting per row); null after 2147."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return (F.year(ts).cast("long") * 1000000 + F.month(ts) * 10000 + F.dayofmonth(ts) * 100
            + F.hour(ts)).try_cast("int")
