"""Fact-to-dimension joins.

Every dimension join here is a plain equi join. Dimensions with a fixed size (status, season,
severity) carry a broadcast hint. Time, location and weather codes come from the data, so they are
given as written tables and Spark checks their real size: broadcast below
`spark.sql.autoBroadcastJoinThreshold`, else a sort-merge join of two plain shuffles, in which
adaptive execution cuts a hot key's rows into several tasks (the fact is always the side that may
be cut).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breezemart.functions.calendar import calendar_columns


def with_calendar(df: DataFrame, names: list[str], ts: str = "timestamp") -> DataFrame:
    """Readings joined to the time dimension of their own timestamps.

    Such a join only drops rows without a timestamp, so it is that filter plus expressions.
    """
    return df.filter(F.col(ts).isNotNull()).select("*", *calendar_columns(ts, names))


def outer_by_hour(weather: DataFrame, air: DataFrame) -> DataFrame:
    """Full outer join on (timestamp, location_key), the keys coalesced.

    Repeated keys multiply, so callers reduce both sides with `latest_per_key` first; after that
    each key has one row per side and no key can be hot.
    """
    return weather.join(air, ["timestamp", "location_key"], "full_outer")


def star_join(fact: DataFrame, fixed: dict[str, DataFrame],
              written: dict[str, DataFrame]) -> DataFrame:
    """The fact with all its dimensions, each given under its key column.

    `fixed` dimensions have a fixed size, `written` ones grow with the data.
    """
    joined = fact
    for key, dimension in fixed.items():
        joined = joined.join(F.broadcast(dimension), key, "left")
    for key, dimension in written.items():
        joined = joined.join(dimension, key, "left")
    return joined


def orphans(fact: DataFrame, dimension: DataFrame, key: str, fact_name: str,
            dimension_name: str) -> DataFrame:
    """One row: how many fact rows point to no dimension row, those without a key included.

    Fact keys are counted first, so the anti join sees each key once.
    """
    used = fact.groupBy(key).agg(F.count("*").alias("_rows"))
    return (used.join(dimension.select(key), key, "left_anti")
            .agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("orphan_rows"))
            .select(F.lit(fact_name).alias("fact"), F.lit(dimension_name).alias("dimension"),
                    "orphan_rows"))
