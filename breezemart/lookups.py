"""Tables, bands and texts that results must carry as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# WMO weather codes (code, description, category, severity level).
WEATHER_CONDITIONS = [
    (0, "Clear sky", "Clear", 0),
    (1, "Mainly clear", "Clear", 0),
    (2, "Partly cloudy", "Clouds", 1),
    (3, "Overcast", "Clouds", 2),
    (45, "Fog", "Fog", 2),
    (48, "Depositing rime fog", "Fog", 3),
    (51, "Light drizzle", "Drizzle", 1),
    (53, "Moderate drizzle", "Drizzle", 2),
    (55, "Dense drizzle", "Drizzle", 3),
    (56, "Light freezing drizzle", "Freezing Drizzle", 2),
    (57, "Dense freezing drizzle", "Freezing Drizzle", 3),
    (61, "Slight rain", "Rain", 1),
    (63, "Moderate rain", "Rain", 2),
    (65, "Heavy rain", "Rain", 3),
    (66, "Light freezing rain", "Freezing Rain", 2),
    (67, "Heavy freezing rain", "Freezing Rain", 3),
    (71, "Slight snow fall", "Snow", 1),
    (73, "Moderate snow fall", "Snow", 2),
    (75, "Heavy snow fall", "Snow", 3),
    (77, "Snow grains", "Snow", 1),
    (80, "Slight rain showers", "Rain", 1),
    (81, "Moderate rain showers", "Rain", 2),
    (82, "Violent rain showers", "Rain", 3),
    (85, "Slight snow showers", "Snow", 1),
    (86, "Heavy snow showers", "Snow", 3),
    (95, "Thunderstorm", "Storm", 3),
    (96, "Thunderstorm with slight hail", "Storm", 4),
    (99, "Thunderstorm with heavy hail", "Storm", 5),
]
UNKNOWN_CONDITION = ("Unknown", "Unknown", -1)
PRECIPITATION_CATEGORIES = ["Rain", "Snow", "Drizzle"]
LOW_SIGHT_CATEGORIES = ["Fog", "Storm"]

# Severity key by weather code, highest first; every other code is 1.
SEVERITY_CODES = [
    (5, [95, 96, 99]),
    (4, [65, 67, 75, 82, 86]),
    (3, [63, 73, 81]),
    (2, [51, 53, 61, 71, 80, 85]),
]
OTHER_SEVERITY = 1

# Air-quality bands (upper bound, key, category, health implications,
# cautionary statement, colour). The last band has no upper bound; key 0 stands for no value.
AQI_BANDS = [
    (50, 1, "Good", "Air quality is satisfactory", "None", "green"),
    (100, 2, "Moderate", "Acceptable air quality",
     "Unusually sensitive people should consider reducing prolonged outdoor exposure", "yellow"),
    (150, 3, "Unhealthy for Sensitive Groups",
     "Members of sensitive groups may experience health effects",
     "Active children and adults should limit prolonged outdoor exposure", "orange"),
    (200, 4, "Unhealthy", "Everyone may begin to experience health effects",
     "Everyone should reduce outdoor activities", "red"),
    (300, 5, "Very Unhealthy", "Health warnings of emergency conditions",
     "Everyone should avoid outdoor activities", "purple"),
    (None, 6, "Hazardous", "Health alert: everyone may experience serious health effects",
     "Everyone should avoid all outdoor activities", "maroon"),
]
UNKNOWN_AQI = (0, "Unknown", "Unable to determine health implications",
               "Unable to provide cautionary statement", "gray")

# Seasons.
SEASONS = [
    (1, "Winter", 12, 2, 9.5, "-5°C to 5°C", "Snow, frost, cold winds",
     "December to February", "Low", "High", "Shortest", "Low"),
    (2, "Spring", 3, 5, 12.5, "5°C to 20°C", "Rain showers, mild temperatures",
     "March to May", "Medium", "Medium", "Increasing", "Medium"),
    (3, "Summer", 6, 8, 14.5, "20°C to 30°C", "Warm, thunderstorms, humid",
     "June to August", "High", "Low", "Longest", "High"),
    (4, "Fall", 9, 11, 10.5, "5°C to 20°C", "Cool, windy, rain",
     "September to November", "Medium", "Medium", "Decreasing", "Medium"),
]

# Severities.
SEVERITIES = [
    (1, 1, "Minor", "Minimal impact", "No specific actions needed", "Info",
     "Normal operations", "None required", "Routine monitoring"),
    (2, 2, "Moderate", "Some impact", "Be aware and monitor", "Watch",
     "Elevated awareness", "Standard precautions", "Increased monitoring"),
    (3, 3, "Significant", "Notable impact", "Take precautions", "Advisory",
     "Modified operations", "Active precautions", "Enhanced monitoring"),
    (4, 4, "Severe", "Major impact", "Take protective actions", "Warning",
     "Limited operations", "Urgent precautions", "Continuous monitoring"),
    (5, 5, "Extreme", "Critical impact", "Immediate action required", "Emergency",
     "Emergency operations", "Emergency measures", "Crisis monitoring"),
]

# Holidays, as (month, day) by year. Other years have none.
HOLIDAYS = {
    2024: [(1, 1), (1, 15), (2, 19), (5, 27), (6, 19), (7, 4), (9, 2),
           (10, 14), (11, 11), (11, 28), (11, 29), (12, 24), (12, 25), (12, 31)],
    2025: [(1, 1), (1, 20), (2, 17), (5, 26), (6, 19), (7, 4), (9, 1),
           (10, 13), (11, 11), (11, 27), (11, 28), (12, 24), (12, 25), (12, 31)],
}

# What is known about the one named site.
NEW_YORK = (40.7128, -74.006, "New York", "Northeast", "United States", "North America",
            10.0, "America/New_York", True, "High", "High")

SITE_SCHEMA = T.StructType([
    T.StructField("latitude", T.DoubleType(), False),
    T.StructField("longitude", T.DoubleType(), False),
    T.StructField("city", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("continent", T.StringType()),
    T.StructField("elevation", T.DoubleType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("is_coastal", T.BooleanType()),
    T.StructField("population_density", T.StringType()),
    T.StructField("urban_density", T.StringType()),
])


def known_sites(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([NEW_YORK], SITE_SCHEMA)


def condition_table(spark: SparkSession) -> DataFrame:
    """28 rows; small enough to broadcast whatever the data."""
    return spark.createDataFrame(
        WEATHER_CONDITIONS,
        "condition_key int, description string, category string, severity_level int")


def status_table(spark: SparkSession) -> DataFrame:
    """7 rows, the unknown status included."""
    rows = [UNKNOWN_AQI] + [band[1:] for band in AQI_BANDS]
    return spark.createDataFrame(
        rows, "status_key int, aqi_category string, health_implications string, "
              "cautionary_statement string, color_code string")
