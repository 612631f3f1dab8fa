"""Ordered first-match buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from breezemart.lookups import AQI_BANDS, OTHER_SEVERITY, SEVERITY_CODES, UNKNOWN_AQI


def aqi_status_key(aqi: str) -> Column:
    """Status key of an index value. Fractions are not rounded: 50.5 is Moderate."""
    value = F.col(aqi).cast("double")
    result = F.when(value.isNull(), UNKNOWN_AQI[0])
    for upper, key, *_ in AQI_BANDS:
        result = result.otherwise(key) if upper is None else result.when(value <= upper, key)
    return result


def aqi_category(aqi: str) -> Column:
    value = F.col(aqi).cast("double")
    result = F.when(value.isNull(), UNKNOWN_AQI[1])
    for upper, _, name, *_ in AQI_BANDS:
        result = result.otherwise(name) if upper is None else result.when(value <= upper, name)
    return result


def severity_key(code: str) -> Column:
    """1..5 from the weather code; unlisted and missing codes are 1."""
    (first_key, first_codes), *rest = SEVERITY_CODES
    result = F.when(F.col(code).isin(first_codes), first_key)
    for key, codes in rest:
        result = result.when(F.col(code).isin(codes), key)
    return result.otherwise(OTHER_SEVERITY)


def visibility_category(metres: str) -> Column:
    """A missing value counts as Good."""
    value = F.col(metres)
    return (F.when(value < 1000, "Very Poor").when(value < 4000, "Poor")
            .when(value < 10000, "Moderate").otherwise("Good"))


def climate_zone(latitude: str) -> Column:
    away = F.abs(F.col(latitude))
    return (F.when(away < 23.5, "Tropical").when(away < 35, "Subtropical")
            .when(away < 66.5, "Temperate").otherwise("Polar"))


def hemisphere(latitude: str) -> Column:
    return F.when(F.col(latitude) >= 0, "Northern").otherwise("Southern")
