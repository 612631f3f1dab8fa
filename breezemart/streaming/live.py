"""Stateful steps on the live stream."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from breezemart.operators.merge import latest_per_key
from breezemart.plans.facts import LAG_STEPS, LAGGED
from breezemart.plans.harmonized import KEYS

DEPTH = max(LAG_STEPS.values())


def drop_repeats(readings: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """One reading per (location, time); rows older than the watermark are dropped."""
    return (readings.withWatermark("timestamp", delay)
            .dropDuplicatesWithinWatermark(["location_key", "timestamp"]))


def _stamp(watermark: datetime.datetime):
    return F.lit(watermark.isoformat(sep=" ")).cast("timestamp")


def late_rows(readings: DataFrame, watermark: datetime.datetime | None) -> DataFrame:
    """Readings that come after the watermark passed their time."""
    return readings.where(F.lit(False) if watermark is None else F.col("timestamp") < _stamp(watermark))


def with_history(readings: DataFrame, history: DataFrame | None, kind: str,
                 watermark: datetime.datetime | None) -> DataFrame:
    """A micro-batch's readings that are in time, and the row history, by station and time together.

    `history` is what `kept_history` left: of every station the rows the watermark has not passed and
    the 24 before them. Readings that history holds already are left out, of readings that share a
    place and time one stays. Adds the values 1 and 24 rows back, `_new`, and `_emit`: whether the row
    is new, or an open one whose earlier rows have changed because a reading came late between them.

    A station's window holds its history and what one trigger brings of it; the source bounds that.
    """
    in_time = readings if watermark is None else readings.where(F.col("timestamp") >= _stamp(watermark))
    new = latest_per_key(in_time, KEYS, []).withColumn("_new", F.lit(True))
    steps = {name: f"_old{name}" for name in LAG_STEPS}
    if history is not None:
        new = new.join(history.select(*KEYS), KEYS, "left_anti")
        past = history.withColumnsRenamed(steps).withColumn("_new", F.lit(False))
        rows = new.unionByName(past, allowMissingColumns=True)
    else:
        kind_of_lag = readings.schema[LAGGED[kind]].dataType
        rows = new.withColumns({old: F.lit(None).cast(kind_of_lag) for old in steps.values()})
    by_time = Window.partitionBy("location_key").orderBy("timestamp")
    rows = rows.withColumns({name: F.lag(LAGGED[kind], back).over(by_time) for name, back in LAG_STEPS.items()})
    moved = F.lit(False)
    for name, old in steps.items():
        moved = moved | ~F.col(name).eqNullSafe(F.col(old))
    still_open = F.lit(True) if watermark is None else F.col("timestamp") >= _stamp(watermark)
    return rows.withColumn("_emit", F.col("_new") | (still_open & moved)).drop(*steps.values())


def kept_history(rows: DataFrame, watermark: datetime.datetime) -> DataFrame:
    """What the next micro-batch needs of `with_history`: rows the new watermark has not passed, and of
    each station the 24 newest it has passed."""
    past = F.col("timestamp") < _stamp(watermark)
    newest = Window.partitionBy("location_key", past).orderBy(F.desc("timestamp"))
    return (rows.withColumn("_back", F.row_number().over(newest)).where(~past | (F.col("_back") <= DEPTH))
            .drop("_back", "_new", "_emit"))
