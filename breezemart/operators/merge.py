"""Union of sources and one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breezemart.operators.positions import with_position


def latest_per_key(df: DataFrame, keys: list[str], rank: list[Column]) -> DataFrame:
    """The row with the highest rank per key; remaining columns break ties, so it is repeatable.

    This is a maximum, not a window: copies of a key are reduced inside each map task, so one key
    with a third of all rows shuffles one row per task.
    """
    rest = [name for name in df.columns if name not in keys]
    best = F.max(F.struct(*[column.alias(f"_rank{i}") for i, column in enumerate(rank)],
                          *rest)).alias("_best")
    return (df.groupBy(*keys).agg(best)
            .select(*keys, *[F.col(f"_best.{name}").alias(name) for name in rest])
            .select(*df.columns))


def union_sources(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """History and stream rows together, told apart by `source`; columns missing in one are null."""
    return (batch.withColumn("source", F.lit("batch"))
            .unionByName(stream.withColumn("source", F.lit("stream")), allowMissingColumns=True))


def merge_batch_and_stream(batch: DataFrame, stream: DataFrame, arrival: str = "ingestion_timestamp",
                           sort: bool = False) -> DataFrame:
    """One row per (timestamp, location): stream before history, then the later arrival.

    Both sides are bounded frames; the live half is `streaming.live.drop_repeats`. `sort` adds the
    row's `position` by time, with the location as second key so that one busy hour can be cut up.
    """
    both = union_sources(batch, stream)
    if arrival not in both.columns:
        both = both.withColumn(arrival, F.lit(None).cast("timestamp"))
    priority = F.when(F.col("source") == "stream", 1).otherwise(0)
    merged = latest_per_key(both, ["timestamp", "location_key"], [priority, F.col(arrival)])
    return with_position(merged, ["timestamp", "location_key"]) if sort else merged


def tumbling_window(df: DataFrame, ts: str = "timestamp", width: str = "1 hour") -> DataFrame:
    """Adds the start and end of the row's window."""
    frame = F.window(ts, width)
    return df.withColumns({"window_start": frame["start"], "window_end": frame["end"]})
