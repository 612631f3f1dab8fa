import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from breezemart import lookups
from breezemart.functions import calendar, categories, cleaning, keys, measures
from breezemart.plans import dims


def one(spark, columns, values, schema):
    row = spark.createDataFrame([values], schema).select(*columns).first()
    return row[0] if len(row) == 1 else tuple(row)


@pytest.mark.parametrize("aqi, key, name", [
    (0.0, 1, "Good"), (50.0, 1, "Good"), (50.5, 2, "Moderate"), (51.0, 2, "Moderate"),
    (100.0, 2, "Moderate"), (101.0, 3, "Unhealthy for Sensitive Groups"),
    (150.0, 3, "Unhealthy for Sensitive Groups"), (200.0, 4, "Unhealthy"),
    (300.0, 5, "Very Unhealthy"), (301.0, 6, "Hazardous"), (None, 0, "Unknown")])
def test_aqi_bands(spark, aqi, key, name):
    found = one(spark, [categories.aqi_status_key("a"), categories.aqi_category("a")], (aqi,), "a double")
    assert found == (key, name)


@pytest.mark.parametrize("metres, name", [
    (999.0, "Very Poor"), (1000.0, "Poor"), (3999.0, "Poor"), (4000.0, "Moderate"),
    (9999.0, "Moderate"), (10000.0, "Good"), (None, "Good")])
def test_visibility(spark, metres, name):
    assert one(spark, [categories.visibility_category("m")], (metres,), "m double") == name


@pytest.mark.parametrize("latitude, zone, half", [
    (0.0, "Tropical", "Northern"), (23.4, "Tropical", "Northern"),
    (-23.5, "Subtropical", "Southern"), (35.0, "Temperate", "Northern"),
    (-66.4, "Temperate", "Southern"), (66.5, "Polar", "Northern")])
def test_places(spark, latitude, zone, half):
    found = one(spark, [categories.climate_zone("l"), categories.hemisphere("l")], (latitude,), "l double")
    assert found == (zone, half)


def test_severity_of_every_code(spark):
    codes = [row[0] for row in lookups.WEATHER_CONDITIONS] + [4, None]
    rows = spark.createDataFrame([(None if c is None else float(c),) for c in codes], "c double")
    found = {r.c: r.s for r in rows.select("c", categories.severity_key("c").alias("s")).collect()}
    assert found[95.0] == found[96.0] == found[99.0] == 5
    assert found[65.0] == found[86.0] == 4 and found[73.0] == 3 and found[85.0] == 2
    # Listed conditions of some weight still count as minor here: two separate scales.
    assert all(found[c] == 1 for c in (55.0, 57.0, 66.0, 45.0, 48.0, 56.0, 77.0, 4.0, None))


@pytest.mark.parametrize("stamp, expected", [
    ("2024-02-29 13:00:00", dict(time_key=2024022913, quarter=1, day_of_week=5, is_weekend=False,
                                 season="Winter", is_holiday=False, is_end_of_month=True,
                                 fiscal_year=2024, fiscal_quarter=2, fiscal_quarter_of_year=2)),
    ("2024-12-31 23:00:00", dict(time_key=2024123123, quarter=4, season="Winter", is_holiday=True,
                                 week_of_year=1, is_end_of_month=True, fiscal_year=2025,
                                 fiscal_quarter=3, fiscal_quarter_of_year=1)),
    ("2025-01-20 00:00:00", dict(is_holiday=True, day_name="Monday", month_name="January")),
    ("2026-07-04 10:00:00", dict(is_holiday=False, season="Summer", is_weekend=True, day_of_week=7,
                                 fiscal_quarter=1, fiscal_quarter_of_year=4)),
    ("2024-03-03 05:00:00", dict(day_of_week=1, is_weekend=True, season="Spring")),
    ("2024-10-01 00:00:00", dict(season="Fall", fiscal_year=2025, fiscal_quarter=1)),
])
def test_calendar(spark, stamp, expected):
    frame = spark.sql(f"select timestamp '{stamp}' as timestamp")
    row = frame.select(*calendar.calendar_columns("timestamp")).first().asDict()
    assert {name: row[name] for name in expected} == expected


def test_holiday_of_no_time_is_false(spark):
    assert one(spark, [calendar.is_holiday("t")], (None,), "t timestamp") is False


def test_location_key_is_stable(spark):
    found = spark.createDataFrame([(40.7128, -74.006), (40.7128, -74.0061), (None, 1.0)],
                                  "a double, b double").select(keys.location_key("a", "b")).collect()
    assert found[0][0] != found[1][0] and found[2][0] is None
    assert found[0][0] == int(hashlib.md5(b"40.7128_-74.0060").hexdigest()[:15], 16)


WEATHER = "temperature_2m double, wind_speed_10m double, relative_humidity_2m double, surface_pressure double"


@pytest.mark.parametrize("t, wind, filled", [(9.9, 4.9, True), (10.0, 20.0, False), (0.0, 4.8, False)])
def test_wind_chill_limits(spark, t, wind, filled):
    value = one(spark, [measures.wind_chill()], (t, wind, 50.0, 1000.0), WEATHER)
    assert (value is not None) == filled
    if filled:
        assert value == pytest.approx(13.12 + .6215 * t - 11.37 * wind ** .16 + .3965 * t * wind ** .16)


def test_heat_index(spark):
    assert one(spark, [measures.heat_index()], (27.0, 1.0, 50.0, 1000.0), WEATHER) is None
    t, rh = 30.0, 50.0
    expected = (-42.379 + 2.04901523 * t + 10.14333127 * rh - .22475541 * t * rh
                - 6.83783e-3 * t ** 2 - 5.481717e-2 * rh ** 2 + 1.22874e-3 * t ** 2 * rh
                + 8.5282e-4 * t * rh ** 2 - 1.99e-6 * t ** 2 * rh ** 2)
    assert one(spark, [measures.heat_index()], (t, 1.0, rh, 1000.0), WEATHER) == pytest.approx(expected)


def test_density_at_absolute_zero_is_null(spark):
    assert one(spark, [measures.air_density()], (-273.15, 1.0, 50.0, 1000.0), WEATHER) is None
    assert one(spark, [measures.dew_point()], (20.0, 1.0, 50.0, 1000.0), WEATHER) == 10.0


def test_pm_ratio_without_fine_dust_is_null(spark):
    schema = "pm10 double, pm2_5 double"
    assert one(spark, [measures.pm_ratio()], (5.0, 0.0), schema) is None
    assert one(spark, [measures.pm_ratio()], (5.0, 2.0), schema) == 2.5


def test_tolerant_values(spark):
    texts = ["55", "55.0", "55.9", "-1.5", "x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in rows.select(cleaning.whole_number("t")).collect()] == [55, 55, 55, -1, None, None]
    assert one(spark, [cleaning.parse_timestamp("t")], ("no time",), "t string") is None
    assert one(spark, [cleaning.code_or_default("c")], (None,), "c double") == -1


def test_local_times(spark):
    frame = spark.sql("select timestamp '2025-01-19 21:15:00' as t, bigint(1737321300) as e")
    row = frame.select(cleaning.iso_text("t").alias("iso"),
                       F.date_format(cleaning.to_utc(F.col("t"), "America/New_York"), "dd HH:mm").alias("utc"),
                       F.date_format(cleaning.epoch_to_timestamp("e"), "dd HH:mm").alias("epoch")).first()
    assert tuple(row) == ("2025-01-19T21:15:00", "20 02:15", "19 21:15")


def test_condition_dimension_covers_all_codes(spark):
    codes = [row[0] for row in lookups.WEATHER_CONDITIONS] + [4, None]
    rows = spark.createDataFrame([(None if c is None else float(c),) for c in codes * 2],
                                 "weather_code double")
    found = {r.weather_code: r for r in dims.weather_condition_dimension(rows).collect()}
    assert len(found) == 30
    assert (found[73].description, found[73].category, found[73].severity_level) == (
        "Moderate snow fall", "Snow", 2)
    assert found[73].is_precipitation and not found[73].is_severe
    assert not found[67].is_precipitation and found[67].travel_impact == "High"
    assert found[99].visibility_impact == "High" and found[99].travel_impact == "Severe"
    for code in (4, -1):
        assert (found[code].category, found[code].severity_level) == ("Unknown", -1)


def test_status_dimension_has_one_row_per_status(spark):
    values = [1, 2, 50, 60, 120, 160, 250, 400, None]
    rows = dims.air_quality_status_dimension(
        spark.createDataFrame([(v,) for v in values], "us_aqi int")).collect()
    found = {r.status_key: r for r in rows}
    assert sorted(found) == [0, 1, 2, 3, 4, 5, 6] and len(rows) == 7
    assert found[3].sensitive_groups_affected == "Yes" and found[3].risk_level == "High"
    assert found[6].outdoor_activity_recommendation == "Avoid outdoor activities"


def test_known_site(spark):
    place = spark.createDataFrame([(40.7128, -74.006)], "latitude double, longitude double")
    row = dims.location_dimension(place.union(place), lookups.known_sites(spark)).collect()
    assert len(row) == 1
    assert (row[0].city, row[0].elevation, row[0].climate_zone) == ("New York", 10.0, "Temperate")
    bare = dims.location_dimension(place).first()
    assert bare.city == "Unknown" and bare.elevation is None


def test_time_range_is_half_open(spark):
    none = spark.createDataFrame([(None,)], "timestamp timestamp")
    start, end = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 1, 3)
    rows = dims.time_dimension(none, none, start, end).select("hour").collect()
    assert sorted(r.hour for r in rows) == [0, 1, 2]
    assert dims.time_dimension(none, none, end, start).count() == 0
    assert dims.time_dimension(none, none, start, None).count() == 0


def test_values_that_do_not_fit_become_null(spark):
    from breezemart.functions.cleaning import code_or_default
    from breezemart.functions.keys import time_key
    from breezemart.sources.readers import as_readings

    row = spark.sql("select timestamp'9999-12-31 05:00:00' as timestamp, 1.0d as latitude, 2.0d as longitude, "
                    "'s' as source, 1e12d as us_aqi, double('NaN') as weather_code")
    assert row.select(time_key("timestamp")).first()[0] is None
    assert row.select(code_or_default("us_aqi")).first()[0] == -1
    assert as_readings(row, "air_quality").first().us_aqi is None
