"""The six dimensions."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breezemart.functions.calendar import BASE_COLUMNS, EXTRA_COLUMNS, calendar_columns
from breezemart.functions.categories import aqi_status_key, climate_zone, hemisphere
from breezemart.functions.cleaning import code_or_default
from breezemart.functions.keys import location_key
from breezemart.lookups import (
    LOW_SIGHT_CATEGORIES, PRECIPITATION_CATEGORIES, SEASONS, SEVERITIES, UNKNOWN_CONDITION,
    condition_table, status_table)
from breezemart.operators.merge import latest_per_key


def time_dimension(air: DataFrame, weather: DataFrame, start: datetime.datetime | None = None,
                   end: datetime.datetime | None = None, extras: bool = True) -> DataFrame:
    """One row per timestamp of either source, plus every hour of [start, end) if both are given."""
    stamps = air.select("timestamp").union(weather.select("timestamp"))
    if start and end:
        stamps = stamps.union(_hours(air.sparkSession, start, end))
    names = [*BASE_COLUMNS, *(EXTRA_COLUMNS if extras else [])]
    return (stamps.filter(F.col("timestamp").isNotNull()).distinct()
            .select("timestamp", *calendar_columns("timestamp", names)))


def _hours(spark: SparkSession, start: datetime.datetime, end: datetime.datetime) -> DataFrame:
    count = max(0, -int((start - end) // datetime.timedelta(hours=1)))
    first = F.lit(start.isoformat(sep=" ")).cast("timestamp")
    hour = F.make_dt_interval(hours=F.col("id").cast("int"))
    return spark.range(count).select((first + hour).alias("timestamp"))


def location_dimension(positions: DataFrame, sites: DataFrame | None = None,
                       extras: bool = True) -> DataFrame:
    """One row per location key of `positions`, with what `sites` knows about it.

    Of positions that share a key (they agree in four decimals) the smallest stands for all; of site
    rows that share one, the one with the greatest values. Places no site table knows get 'Unknown'
    names and null numbers.
    """
    places = (positions.select("latitude", "longitude").dropna().distinct()
              .groupBy(location_key("latitude", "longitude", known=True).alias("location_key"))
              .agg(F.min(F.struct("latitude", "longitude")).alias("_at"))
              .select("location_key", "_at.latitude", "_at.longitude"))
    texts = ["city", "region", "country", "continent", "timezone", "population_density",
             "urban_density"]
    others = ["elevation", "is_coastal"]
    if sites is None:
        known = places.withColumns({name: F.lit(None).cast("string") for name in texts})
        known = known.withColumns({"elevation": F.lit(None).cast("double"),
                                   "is_coastal": F.lit(None).cast("boolean")})
    else:
        described = sites.dropna(subset=["latitude", "longitude"]).withColumn(
            "location_key", location_key("latitude", "longitude", known=True))
        described = latest_per_key(described.select("location_key", *texts, *others), ["location_key"], [])
        known = places.join(described, "location_key", "left")
    named = {name: F.coalesce(F.col(name), F.lit("Unknown")).alias(name) for name in texts}
    base = ["location_key", "latitude", "longitude", named["city"], named["region"],
            climate_zone("latitude").alias("climate_zone"), "elevation"]
    more = [named["country"], named["continent"], hemisphere("latitude").alias("hemisphere"),
            named["timezone"], "is_coastal", named["population_density"], named["urban_density"]]
    return known.select(*base, *(more if extras else []))


def weather_condition_dimension(weather: DataFrame, extras: bool = True) -> DataFrame:
    """One row per distinct weather code; codes outside the table are Unknown, level -1.

    A missing code is -1, so it has a row that facts can point to.
    """
    codes = (weather.select(code_or_default("weather_code").alias("weather_code")).distinct()
             .withColumn("condition_key", F.col("weather_code")))
    found = codes.join(F.broadcast(condition_table(weather.sparkSession)), "condition_key", "left")
    description, category, level = UNKNOWN_CONDITION
    base = found.select(
        "condition_key", "weather_code",
        F.coalesce("description", F.lit(description)).alias("description"),
        F.coalesce("category", F.lit(category)).alias("category"),
        F.coalesce("severity_level", F.lit(level)).alias("severity_level"))
    if not extras:
        return base
    kind, level = F.col("category"), F.col("severity_level")
    return base.withColumns({
        "is_precipitation": kind.isin(PRECIPITATION_CATEGORIES),
        "is_severe": level >= 3,
        "visibility_impact": F.when(kind.isin(LOW_SIGHT_CATEGORIES), "High")
                              .when(kind == "Clouds", "Medium").otherwise("Low"),
        "travel_impact": F.when(level >= 4, "Severe").when(level >= 3, "High")
                          .when(level >= 2, "Medium").otherwise("Low"),
    })


def air_quality_status_dimension(air: DataFrame, extras: bool = True) -> DataFrame:
    """One row per status that occurs in the data."""
    used = air.select(aqi_status_key("us_aqi").alias("status_key")).distinct()
    base = (used.join(F.broadcast(status_table(air.sparkSession)), "status_key")
            .select("status_key", "aqi_category", "health_implications", "cautionary_statement",
                    "color_code"))
    if not extras:
        return base
    name = F.col("aqi_category")
    unhealthy = name.contains("Unhealthy")
    return base.withColumns({
        "risk_level": F.when(name == "Good", "Low").when(name == "Moderate", "Medium")
                       .when(unhealthy, "High").otherwise("Severe"),
        "outdoor_activity_recommendation":
            F.when(name == "Good", "Normal outdoor activities")
             .when(name == "Moderate",
                   "Sensitive individuals should limit prolonged outdoor exposure")
             .when(unhealthy, "Limit outdoor activities").otherwise("Avoid outdoor activities"),
        "sensitive_groups_affected": F.when(name.contains("Sensitive"), "Yes").otherwise("No"),
    })


SEASON_BASE = ("season_key int not null, season_name string not null, start_month int not null, "
               "end_month int not null, avg_daylight_hours double, typical_temp_range string, "
               "characteristic_weather string")
SEASON_EXTRA = ("date_range string, precipitation_likelihood string, heating_demand string, "
                "daylight_pattern string, outdoor_activity_level string")
SEVERITY_BASE = ("severity_key int not null, severity_level int not null, "
                 "severity_name string not null, description string not null, "
                 "recommended_actions string not null, alert_level string not null")
SEVERITY_EXTRA = ("operational_status string not null, safety_measures string not null, "
                  "monitoring_requirement string not null")


def season_dimension(spark: SparkSession, extras: bool = True) -> DataFrame:
    table = spark.createDataFrame(SEASONS, f"{SEASON_BASE}, {SEASON_EXTRA}")
    return table if extras else table.select(*table.columns[:7])


def severity_dimension(spark: SparkSession, extras: bool = True) -> DataFrame:
    table = spark.createDataFrame(SEVERITIES, f"{SEVERITY_BASE}, {SEVERITY_EXTRA}")
    return table if extras else table.select(*table.columns[:6])


def stamped(dimension: DataFrame) -> DataFrame:
    """With the time it was built, for the tables that carry `last_updated`."""
    return dimension.withColumn("last_updated", F.current_timestamp())
