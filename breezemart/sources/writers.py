"""Tables, exports and message documents.

Every partitioned writer lets Spark rebalance: adaptive execution cuts a full month into several
writing tasks and joins small ones, so no month goes through a single task.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breezemart.functions.cleaning import iso_text
from breezemart.schemas import DATA_SOURCES, measures_of

DERIVABLE = {"year": F.year, "month": F.month, "date": F.to_date}


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, partition_by: list[str] | None = None,
                      mode: str = "overwrite", whole_table: bool = True,
                      cluster: list[str] | None = None) -> str:
    """Parquet in one folder per partition value; year, month and date are derived when absent.

    `cluster` columns order the rows inside each file. With `whole_table=False` an overwrite
    replaces only the partitions that occur in `df`.
    """
    folders = partition_by or ["year", "month"]
    absent = {name: DERIVABLE[name]("timestamp") for name in folders if name not in df.columns}
    laid_out = df.withColumns(absent) if absent else df
    (laid_out.hint("rebalance", *[F.col(name) for name in folders])
     .sortWithinPartitions(*folders, *(cluster or []))
     .write.mode(mode).partitionBy(*folders)
     .option("partitionOverwriteMode", "static" if whole_table else "dynamic").parquet(path))
    return path


def write_clustered(df: DataFrame, path: str, folder: str, cluster: list[str],
                    mode: str = "overwrite") -> str:
    """One folder per date or month, rows in cluster order, so files carry tight key ranges.

    Range partitioning includes the time: a key that fills a day is spread over many tasks.
    """
    value = (F.trunc("timestamp", "month") if folder == "month_start"
             else DERIVABLE[folder]("timestamp"))
    laid_out = df if folder in df.columns else df.withColumn(folder, value)
    order = [folder, *cluster, "timestamp"]
    (laid_out.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode(mode).partitionBy(folder)
     .option("partitionOverwriteMode", "static").parquet(path))
    return path


def range_name(prefix: str, first: datetime.date, last: datetime.date) -> str:
    return f"{prefix}_{first:%Y%m%d}_{last:%Y%m%d}"


def stamped_name(prefix: str, moment: datetime.datetime) -> str:
    return f"{prefix}_{moment:%Y%m%d_%H%M%S}"


def write_csv(readings: DataFrame, path: str, kind: str) -> str:
    """History export: `time` first, measures, and the place."""
    (readings.select(iso_text("timestamp").alias("time"), *measures_of(kind), "latitude", "longitude")
     .write.mode("overwrite").option("header", True).csv(path))
    return path


def envelope(readings: DataFrame, kind: str, stamp: str = "timestamp") -> Column:
    """The nested message document of a flat reading."""
    place = F.struct("latitude", "longitude")
    parts = [
        F.struct(iso_text(stamp).alias("timestamp"), place.alias("location"),
                 F.lit(DATA_SOURCES[kind]).alias("data_source")).alias("metadata"),
        F.struct(iso_text("timestamp").alias("timestamp"),
                 F.struct(*measures_of(kind)).alias("values")).alias("current_conditions"),
    ]
    if kind == "weather":
        empty = F.array().cast("array<struct<timestamp:string>>")
        parts.append(F.struct(empty.alias("time_series")).alias("hourly_forecast"))
    return F.struct(*parts)


def messages(readings: DataFrame, kind: str) -> DataFrame:
    """Readings as JSON messages in a `value` column, ready for a topic or text files."""
    return readings.select(F.to_json(envelope(readings, kind)).alias("value"))


def write_documents(readings: DataFrame, path: str, kind: str) -> str:
    """JSON export, one document per line."""
    (readings.select(envelope(readings, kind).alias("_doc")).select("_doc.*")
     .write.mode("overwrite").json(path))
    return path


def publish(df: DataFrame, topic: str, servers: str) -> None:
    """Send `value` messages to a Kafka topic (needs the Kafka connector on the class path)."""
    (df.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def dead_letters(bad: DataFrame) -> DataFrame:
    """Rejected messages with the reason and the time."""
    return bad.select("original_data", "error", F.current_timestamp().alias("timestamp"))
