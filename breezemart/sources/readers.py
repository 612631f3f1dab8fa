"""History files, message documents and tables."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breezemart.functions.cleaning import parse_timestamp, to_utc, whole_number
from breezemart.functions.keys import location_key
from breezemart.schemas import ARRIVAL, CORRUPT, READING_KEYS, envelope_schema, file_schema, measures_of


def read_csv_history(spark: SparkSession, path: str, kind: str,
                     place: tuple[float, float] | None = None, fail_fast: bool = False) -> DataFrame:
    """Readings from CSV files (a glob will do) with a header and a `time` column.

    Files of one station name no place: give it as `place`. Files of many stations carry latitude
    and longitude columns. `fail_fast` ends the job at the first malformed row. A file's time of change
    is when its readings arrived.
    """
    rows = (spark.read.schema(file_schema(kind, with_location=place is None))
            .option("header", True)
            .option("mode", "FAILFAST" if fail_fast else "PERMISSIVE").csv(path))
    return _from_file(rows, kind, place)


def read_csv_checked(spark: SparkSession, path: str, kind: str,
                     place: tuple[float, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """(readings, rejected lines) of CSV history files: together they are all lines of the files.

    A line is rejected when it has another number of fields than the header, text where a number is
    due, or no time or place. Rejected lines carry their text, the file's path and the reason, in the
    layout of the dead letters. Fields are read as text first, so that nothing turns null unseen.
    """
    wanted = file_schema(kind, with_location=place is None)
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted.fields]).add(CORRUPT, "string")
    rows = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    numbers = {f.name: whole_number(f.name) if f.name == "us_aqi" else F.col(f.name).try_cast(f.dataType)
               for f in wanted.fields if f.name != "time"}
    # every field is looked at, so Spark reads whole lines and sees missing fields
    odd = [F.col(name).isNotNull() & number.isNull() for name, number in numbers.items()]
    error = (F.when(F.col(CORRUPT).isNotNull(), "malformed line")
             .when(reduce(Column.__or__, odd), "malformed number")
             .when(parse_timestamp("time").isNull(), "missing timestamp"))
    if place is None:
        error = error.when(F.col("latitude").isNull() | F.col("longitude").isNull(), "missing location")
    line = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[f.name for f in wanted.fields])))
    marked = rows.select("*", "_metadata", error.alias("error"))
    good = marked.where("error is null").withColumns(numbers)
    bad = marked.where("error is not null").select(
        line.alias("original_data"), "error", F.col("_metadata.file_path").alias("file_path"),
        F.current_timestamp().alias("timestamp"))
    return _from_file(good, kind, place), bad


def _from_file(rows: DataFrame, kind: str, place: tuple[float, float] | None) -> DataFrame:
    if place is not None:
        rows = rows.withColumns({"latitude": F.lit(float(place[0])),
                                 "longitude": F.lit(float(place[1]))})
    return as_readings(rows.withColumns({"timestamp": parse_timestamp("time"),
                                         ARRIVAL: F.col("_metadata.file_modification_time")}), kind)


def as_readings(df: DataFrame, kind: str) -> DataFrame:
    """Uniform reading columns: keys first, measures as double, `us_aqi` an integer.

    Measures the input lacks become null columns. When readings arrived is kept where it is known:
    cleaning keeps the latest arrival.
    """
    def measure(name: str):
        target = "int" if name == "us_aqi" else "double"
        column = F.col(name) if name in df.columns else F.lit(None)
        return column.try_cast(target).alias(name)

    placed = df if "location_key" in df.columns else df.withColumn(
        "location_key", location_key("latitude", "longitude"))
    arrival = [ARRIVAL] if ARRIVAL in df.columns else []
    return placed.select(*READING_KEYS, *[measure(name) for name in measures_of(kind)], *arrival)


def read_documents(spark: SparkSession, path: str, kind: str, multi_line: bool = True) -> DataFrame:
    """Message documents from JSON files, nested as they are."""
    return (spark.read.schema(envelope_schema(kind))
            .option("multiLine", multi_line).json(path))


def current_readings(documents: DataFrame, kind: str, zone: str | None = None) -> DataFrame:
    """The current conditions of message documents as flat readings; `zone` as for messages. The
    document's own time is when they arrived."""
    flat = documents.select(
        "metadata.location.*", to_utc(parse_timestamp(F.col("metadata.timestamp")), zone).alias(ARRIVAL),
        to_utc(parse_timestamp(F.col("current_conditions.timestamp")), zone).alias("timestamp"),
        "current_conditions.values.*")
    return as_readings(flat, kind)


def trailing_window(df: DataFrame, as_of: datetime.date, days: int = 180) -> DataFrame:
    """History from `days` before yesterday until yesterday, both days whole."""
    last = as_of - datetime.timedelta(days=1)
    first = last - datetime.timedelta(days=days)
    stop = last + datetime.timedelta(days=1)
    return df.filter((F.col("timestamp") >= _stamp(first)) & (F.col("timestamp") < _stamp(stop)))


def between(df: DataFrame, start=None, end=None) -> DataFrame:
    """Closed time range, applied only with both ends; a bare end date keeps its midnight alone."""
    if not (start and end):
        return df
    return df.filter((F.col("timestamp") >= _stamp(start)) & (F.col("timestamp") <= _stamp(end)))


def read_months(spark: SparkSession, path: str, start, end) -> DataFrame:
    """A table partitioned by year and month, cut to a closed time range.

    Spark prunes folders only by the folder columns, so the range is said in those terms too.
    """
    def month_number(value):
        return value.year * 12 + value.month

    table = spark.read.parquet(path)
    months = F.col("year") * 12 + F.col("month")
    pruned = table.filter(months.between(month_number(start), month_number(end)))
    return between(pruned, start, end)


def _stamp(value: datetime.date | datetime.datetime):
    """A timestamp literal in session time, whatever zone Python runs in."""
    return F.lit(value.isoformat(sep=" ") if isinstance(value, datetime.datetime)
                 else value.isoformat()).cast("timestamp")
