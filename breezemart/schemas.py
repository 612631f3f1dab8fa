"""Input schemas: history files and message documents."""

from __future__ import annotations

from pyspark.sql import types as T

# Measure names in file order.
AIR_MEASURES = [
    "pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone",
    "aerosol_optical_depth", "dust", "uv_index", "us_aqi",
]
WEATHER_MEASURES = [
    "temperature_2m", "relative_humidity_2m", "apparent_temperature", "precipitation", "rain",
    "snowfall", "cloud_cover", "cloud_cover_low", "cloud_cover_mid", "cloud_cover_high",
    "surface_pressure", "visibility", "wind_speed_10m", "wind_direction_10m", "wind_gusts_10m",
    "weather_code", "precipitation_probability",
]
MEASURES = {"air_quality": AIR_MEASURES, "weather": WEATHER_MEASURES}

# Source names inside message documents.
DATA_SOURCES = {
    "air_quality": "Open-Meteo Air Quality API",
    "weather": "Open-Meteo API",
}

READING_KEYS = ["timestamp", "location_key", "latitude", "longitude"]
CORRUPT = "_corrupt_record"
ARRIVAL = "ingestion_timestamp"


def measures_of(kind: str) -> list[str]:
    if kind not in MEASURES:
        raise ValueError(f"unknown reading kind {kind!r}; expected one of {sorted(MEASURES)}")
    return MEASURES[kind]


def file_schema(kind: str, with_location: bool = False) -> T.StructType:
    """History file columns: single-precision measures, `us_aqi` an integer.

    `with_location` is for files that hold many stations.
    """
    schema = T.StructType([T.StructField("time", T.StringType())])
    for name in measures_of(kind):
        schema.add(name, T.IntegerType() if name == "us_aqi" else T.FloatType())
    if with_location:
        schema.add("latitude", T.DoubleType()).add("longitude", T.DoubleType())
    return schema


def values_schema(kind: str) -> T.StructType:
    """Message measures; all read as double, since a JSON `55.0` is not an integer to Spark."""
    return T.StructType([T.StructField(name, T.DoubleType()) for name in measures_of(kind)])


def envelope_schema(kind: str) -> T.StructType:
    """metadata / current_conditions (/ hourly_forecast), plus the corrupt-record column."""
    location = T.StructType().add("latitude", T.DoubleType()).add("longitude", T.DoubleType())
    metadata = (T.StructType().add("timestamp", T.StringType()).add("location", location)
                .add("data_source", T.StringType()))
    point = T.StructType().add("timestamp", T.StringType()).add("values", values_schema(kind))
    schema = T.StructType().add("metadata", metadata).add("current_conditions", point)
    if kind == "weather":
        schema.add("hourly_forecast", T.StructType().add("time_series", T.ArrayType(point)))
    return schema.add(CORRUPT, T.StringType())


def any_envelope_schema() -> T.StructType:
    """One envelope for messages of every kind: the measures of all of them."""
    names = dict.fromkeys(name for kind in MEASURES for name in MEASURES[kind])
    schema = envelope_schema("air_quality")
    point = T.StructType().add("timestamp", T.StringType()).add(
        "values", T.StructType([T.StructField(name, T.DoubleType()) for name in names]))
    return T.StructType([T.StructField("current_conditions", point) if f.name == "current_conditions" else f
                         for f in schema.fields])
