"""The two fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breezemart.functions import measures as M
from breezemart.functions.calendar import season_key
from breezemart.functions.categories import aqi_status_key, severity_key, visibility_category
from breezemart.functions.cleaning import code_or_default
from breezemart.functions.keys import time_key
from breezemart.operators.lags import row_lags

# Measures stored in each fact, in table order.
AIR_FACT_MEASURES = ["pm2_5", "pm10", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide",
                     "ozone", "us_aqi", "aerosol_optical_depth", "dust", "uv_index"]
WEATHER_FACT_MEASURES = ["temperature_2m", "apparent_temperature", "precipitation", "snowfall",
                         "wind_speed_10m", "wind_direction_10m", "wind_gusts_10m",
                         "relative_humidity_2m", "surface_pressure", "cloud_cover",
                         "cloud_cover_low", "cloud_cover_mid", "cloud_cover_high", "visibility",
                         "precipitation_probability"]

LAG_STEPS = {"_previous_1": 1, "_previous_24": 24}
LAGGED = {"air_quality": "us_aqi", "weather": "temperature_2m"}


def air_quality_facts(air: DataFrame, derived: bool = True) -> DataFrame:
    """Air-quality fact; `derived` adds trends, ratios and indices.

    The *_24h change is 24 rows back, which is 24 hours only where no hour is missing. Rows
    without a timestamp or place are no facts (the warehouse keys are NOT NULL). Where the input
    already holds the earlier values (a stream keeps them as state), they are used as they are.
    """
    return _air(_with_previous(air, "air_quality") if derived else _keyed(air), derived)


def weather_facts(weather: DataFrame, derived: bool = True) -> DataFrame:
    """Weather fact; `derived` adds trends, comfort measures and severity flags."""
    return _weather(_with_previous(weather, "weather") if derived else _keyed(weather), derived)


FACT_BUILDERS = {"air_quality": air_quality_facts, "weather": weather_facts}


def processed(fact: DataFrame, batch_id: str) -> DataFrame:
    """With processing time and batch id, as stored."""
    return fact.withColumns({"processing_timestamp": F.current_timestamp(),
                             "etl_batch_id": F.lit(batch_id)})


def _keyed(readings: DataFrame) -> DataFrame:
    return readings.filter(F.col("timestamp").isNotNull() & F.col("location_key").isNotNull())


def _with_previous(readings: DataFrame, kind: str) -> DataFrame:
    if set(LAG_STEPS) <= set(readings.columns):
        return _keyed(readings)
    return row_lags(_keyed(readings), LAGGED[kind], LAG_STEPS)


def _air(readings: DataFrame, derived: bool) -> DataFrame:
    extra = {
        "aqi_change_1h": F.col("us_aqi") - F.col("_previous_1"),
        "aqi_change_24h": F.col("us_aqi") - F.col("_previous_24"),
        "pm_ratio": M.pm_ratio(),
        "pollution_index": M.pollution_index(),
        "pm25_normalized": M.pm25_normalized(),
        "pm10_normalized": M.pm10_normalized(),
    } if derived else {}
    return readings.select(
        time_key("timestamp").alias("time_key"), "location_key",
        aqi_status_key("us_aqi").alias("status_key"), "timestamp", *AIR_FACT_MEASURES,
        *[column.alias(name) for name, column in extra.items()])


def _weather(readings: DataFrame, derived: bool) -> DataFrame:
    severity = severity_key("weather_code")
    extra = {
        "temp_difference": M.temp_difference(),
        "temp_change_1h": F.col("temperature_2m") - F.col("_previous_1"),
        "temp_change_24h": F.col("temperature_2m") - F.col("_previous_24"),
        "wind_chill": M.wind_chill(),
        "heat_index": M.heat_index(),
        "is_severe_weather": severity >= 4,
        "visibility_category": visibility_category("visibility"),
    } if derived else {}
    return readings.select(
        time_key("timestamp").alias("time_key"), "location_key",
        code_or_default("weather_code").alias("condition_key"), severity.alias("severity_key"),
        season_key("timestamp").alias("season_key"), "timestamp", *WEATHER_FACT_MEASURES,
        *[column.alias(name) for name, column in extra.items()])
