"""Derived measures. Inputs are double columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _d(value: float) -> Column:
    return F.lit(float(value))


def pm_ratio() -> Column:
    return F.when(F.col("pm2_5") > 0, F.col("pm10") / F.col("pm2_5"))


def pollution_index() -> Column:
    weights = {"pm2_5": 0.3, "pm10": 0.2, "nitrogen_dioxide": 0.2, "ozone": 0.2,
               "sulphur_dioxide": 0.1}
    terms = [F.col(name) * _d(weight) for name, weight in weights.items()]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def pm25_normalized() -> Column:
    """Against a guideline value of 35."""
    return F.col("pm2_5") / _d(35)


def pm10_normalized() -> Column:
    """Against a guideline value of 50."""
    return F.col("pm10") / _d(50)


def temp_difference() -> Column:
    return F.col("temperature_2m") - F.col("apparent_temperature")


def wind_chill() -> Column:
    """Felt temperature below 10 °C with wind over 4.8 km/h, else null."""
    t, wind = F.col("temperature_2m"), F.col("wind_speed_10m")
    factor = F.pow(wind, _d(0.16))
    felt = _d(13.12) + t * _d(0.6215) - factor * _d(11.37) + t * factor * _d(0.3965)
    return F.when((t < 10) & (wind > 4.8), felt)


# Regression terms (factor, power of temperature, power of humidity).
HEAT_INDEX_TERMS = [
    (-42.379, 0, 0),
    (2.04901523, 1, 0),
    (10.14333127, 0, 1),
    (-0.22475541, 1, 1),
    (-6.83783e-3, 2, 0),
    (-5.481717e-2, 0, 2),
    (1.22874e-3, 2, 1),
    (8.5282e-4, 1, 2),
    (-1.99e-6, 2, 2),
]


def heat_index() -> Column:
    """Heat index over 27 °C, else null.

    The regression is meant for degrees Fahrenheit and is applied to °C as it stands, so values
    compare with each other and with earlier tables, not with published heat-index charts.
    """
    t, rh = F.col("temperature_2m"), F.col("relative_humidity_2m")
    total = None
    for factor, t_power, rh_power in HEAT_INDEX_TERMS:
        term = _d(factor)
        for column, power in ((t, t_power), (rh, rh_power)):
            for _ in range(power):
                term = term * column
        total = term if total is None else total + term
    return F.when(t > 27, total)


def air_density() -> Column:
    """Pressure over (gas constant × kelvin). Pressure stays in hPa, so the unit is kg/m³ ÷ 100."""
    kelvin = F.col("temperature_2m") + _d(273.15)
    return F.try_divide(F.col("surface_pressure"), kelvin * _d(287.05))


def dew_point() -> Column:
    return F.col("temperature_2m") - (_d(100) - F.col("relative_humidity_2m")) / _d(5)
