"""The wide feature table: weather, air, calendar and place in one row per hour and station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breezemart.functions import measures as M
from breezemart.operators.joins import outer_by_hour, with_calendar

KEYS = ["timestamp", "location_key"]
# Features taken from each side, in table order.
WEATHER_FEATURES = ["temperature_2m", "apparent_temperature", "precipitation", "wind_speed_10m",
                    "wind_direction_10m", "relative_humidity_2m", "surface_pressure",
                    "cloud_cover", "visibility"]
AIR_FEATURES = ["pm2_5", "pm10", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide",
                "ozone", "us_aqi", "aerosol_optical_depth", "dust", "uv_index"]
TIME_FEATURES = ["year", "month", "hour", "day_of_week", "is_weekend", "season", "is_holiday"]
PLACE_FEATURES = ["latitude", "longitude", "elevation", "climate_zone"]


def harmonize(air: DataFrame, weather: DataFrame, location: DataFrame,
              derived: bool = True) -> DataFrame:
    """Weather ⟗ air on (timestamp, location_key), with calendar and place features.

    Rows without a timestamp drop out, rows whose place is not in `location` too. Give sides with
    one row per key (`latest_per_key`): repeats multiply.
    """
    known = F.col("timestamp").isNotNull()
    joined = outer_by_hour(weather.filter(known).select(*KEYS, *WEATHER_FEATURES),
                           air.filter(known).select(*KEYS, *AIR_FEATURES))
    full = (with_calendar(joined, TIME_FEATURES)
            .join(location.select("location_key", *PLACE_FEATURES), "location_key"))
    extra = {"air_density": M.air_density(), "dew_point": M.dew_point()} if derived else {}
    return full.select(*KEYS, *WEATHER_FEATURES, *AIR_FEATURES, *TIME_FEATURES, *PLACE_FEATURES,
                       *[column.alias(name) for name, column in extra.items()])


def on_the_hour(readings: DataFrame) -> DataFrame:
    """Current readings come at any minute; history is hourly. Cut before joining the two."""
    return readings.withColumn("timestamp", F.date_trunc("hour", "timestamp"))
