"""Array payloads to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def arrays_to_rows(df: DataFrame, payload: str, variables: list[str], time: str = "time") -> DataFrame:
    """A struct of equally ordered arrays becomes one row per time.

    Short arrays give null at their end; variables the payload lacks become null columns.
    """
    fields = df.schema[payload].dataType.names
    present = [name for name in variables if name in fields]
    rest = [name for name in df.columns if name != payload]
    zipped = F.arrays_zip(*[F.col(f"{payload}.{name}").alias(name) for name in [time, *present]])
    rows = df.select(*rest, F.inline(zipped))
    return rows.select(*rest, time, *[
        F.col(name) if name in present else F.lit(None).cast("double").alias(name)
        for name in variables])


def hourly_axis(df: DataFrame, start: str, end: str, values: dict[str, str],
                out: str = "timestamp") -> DataFrame:
    """One row per hour of [start, end), with each array's value at that place.

    `values` maps output column to array column. An array that is too short gives null; a range
    that holds no hour gives no row.
    """
    hour = F.expr("INTERVAL 1 HOUR")
    axis = F.when(F.col(end) > F.col(start),
                  F.sequence(F.col(start), F.col(end) - F.expr("INTERVAL 1 MICROSECOND"), hour))
    rest = [name for name in df.columns if name not in {start, end, *values.values()}]
    return (df.select(*rest, *values.values(), F.posexplode(axis).alias("_place", out))
            .select(*rest, out, *[F.get(array, F.col("_place")).alias(name)
                                  for name, array in values.items()]))


def name_by_position(df: DataFrame, values: str, names: list[str]) -> DataFrame:
    """One row per array element, named by its place; places without a name get a stand-in."""
    rest = [name for name in df.columns if name != values]
    known = F.array(*[F.lit(name) for name in names]) if names else F.array().cast(
        T.ArrayType(T.StringType()))
    place = F.col("_place")
    name: Column = F.coalesce(F.get(known, place),
                              F.concat(F.lit("unknown_variable_"), place.cast("string")))
    return (df.select(*rest, F.posexplode(values).alias("_place", "value"))
            .select(*rest, name.alias("variable"), "value"))


def forecast_rows(documents: DataFrame, variables: list[str]) -> DataFrame:
    """One row per hourly forecast entry of a message document."""
    return (documents.select("metadata.location.*",
                             F.explode("hourly_forecast.time_series").alias("_entry"))
            .select("latitude", "longitude",
                    F.try_to_timestamp("_entry.timestamp").alias("timestamp"),
                    *[F.col(f"_entry.values.{name}").alias(name) for name in variables]))
