"""Weather and air-quality readings derived from an `events` table.

A user is a station and an event is a reading of that station, so the number of stations, readings
and hours grows with the table. FIXTURES.md §4 states the formulas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from breezemart.functions.keys import location_key
from breezemart.lookups import WEATHER_CONDITIONS
from breezemart.schemas import READING_KEYS, measures_of

AIR_EVENTS = ["click", "error", "view"]
WEATHER_EVENTS = ["purchase", "signup", "view"]


def latitude(station: str = "user_id") -> Column:
    return ((F.col(station) * 7919 + 1007128) % 1400017 - 600000).cast("double") / F.lit(10000.0)


def longitude(station: str = "user_id") -> Column:
    return ((F.col(station) * 104729 + 1059940) % 3599971 - 1800000).cast("double") / F.lit(10000.0)


def observations(spark: SparkSession, sf_dir: str, event_types: list[str]) -> DataFrame:
    """event_id, observed_at, timestamp (its hour), place, k and v of the chosen event types.

    Stations are shifted by 0 to 23 spans of 31 days, so two years of calendar occur.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    shift = F.make_dt_interval(days=(F.col("user_id") % 24 * 31).cast("int"))
    placed = (events.filter(F.col("event_type").isin(event_types) & F.col("user_id").isNotNull())
              .select("event_id", "event_type",
                      (F.col("ts") + shift).cast("timestamp").alias("observed_at"),
                      latitude().alias("latitude"), longitude().alias("longitude"),
                      F.get_json_object("props", "$.k").cast("int").alias("k"),
                      F.col("value").alias("v")))
    return placed.select("event_id", "event_type", "observed_at",
                         F.date_trunc("hour", "observed_at").alias("timestamp"),
                         location_key("latitude", "longitude", known=True).alias("location_key"),
                         "latitude", "longitude", "k", "v")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A site table: one row per station, with made-up names and heights."""
    users = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").dropna().distinct()
    return users.select(
        latitude().alias("latitude"), longitude().alias("longitude"),
        F.concat(F.lit("Station "), F.col("user_id").cast("string")).alias("city"),
        F.concat(F.lit("Region "), (F.col("user_id") % 7).cast("string")).alias("region"),
        F.lit("Eventland").alias("country"), F.lit("Testia").alias("continent"),
        (F.col("user_id") % 900).cast("double").alias("elevation"),
        F.lit("UTC").alias("timezone"), (F.col("user_id") % 3 == 0).alias("is_coastal"),
        F.lit("High").alias("population_density"), F.lit("Low").alias("urban_density"))


def _k(factor: float, offset: float = 0.0) -> Column:
    return F.col("k") * F.lit(float(factor)) + F.lit(float(offset))


def _air_measures() -> dict[str, Column]:
    k, v = F.col("k"), F.col("v")
    return {
        "pm10": v * F.lit(0.6),
        "pm2_5": v * F.lit(0.4),
        "carbon_monoxide": _k(2, 100),
        "nitrogen_dioxide": _k(0.3),
        "sulphur_dioxide": _k(0.1),
        "ozone": _k(0.8),
        "aerosol_optical_depth": _k(0.01),
        "dust": (k % 7).cast("double"),
        "uv_index": (k % 11).cast("double"),
        "us_aqi": F.when(k % 17 != 0, F.floor(v).cast("int")),
    }


def _weather_measures() -> dict[str, Column]:
    k, v = F.col("k"), F.col("v")
    codes = [float(row[0]) for row in WEATHER_CONDITIONS] + [4.0]
    code = F.get(F.array(*[F.lit(c) for c in codes]), k % 30)
    return {
        "temperature_2m": _k(0.5, -12),
        "relative_humidity_2m": k.cast("double"),
        "apparent_temperature": _k(0.45, -14),
        "precipitation": _k(0.05),
        "rain": _k(0.03),
        "snowfall": _k(0.02),
        "cloud_cover": k.cast("double"),
        "cloud_cover_low": (k % 50).cast("double"),
        "cloud_cover_mid": (k % 40).cast("double"),
        "cloud_cover_high": (k % 30).cast("double"),
        "surface_pressure": _k(0.5, 980),
        "visibility": _k(150),
        "wind_speed_10m": v,
        "wind_direction_10m": _k(3),
        "wind_gusts_10m": v * F.lit(1.5),
        "weather_code": code,
        "precipitation_probability": k.cast("double"),
    }


MEASURE_FORMULAS = {"air_quality": _air_measures, "weather": _weather_measures}
EVENT_TYPES = {"air_quality": AIR_EVENTS, "weather": WEATHER_EVENTS}


def raw_readings(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """A reading per event: several may share an hour and a station."""
    return _measured(observations(spark, sf_dir, EVENT_TYPES[kind]), kind, "event_id", "event_type",
                     "observed_at", "k")


def hourly_readings(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """One reading per station and hour: that of the first event.

    Event ids are unique, so both minima are of one event. They are combined in the map tasks and
    hashed (plain buffers), and grouping by (timestamp, location_key) leaves rows where the outer
    join wants them.
    """
    seen = observations(spark, sf_dir, EVENT_TYPES[kind])
    first = seen.groupBy("timestamp", "location_key").agg(
        F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude"),
        F.min_by("k", "event_id").alias("k"), F.min_by("v", "event_id").alias("v"))
    return _measured(first, kind)


def _measured(seen: DataFrame, kind: str, *also: str) -> DataFrame:
    formulas = MEASURE_FORMULAS[kind]()
    return seen.select(*also, *READING_KEYS, *[formulas[n].alias(n) for n in measures_of(kind)])
