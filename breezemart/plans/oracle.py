"""The same results in plain SQL over the same tables, one statement per registered query."""

from __future__ import annotations

import itertools

from breezemart import lookups
from breezemart.plans import queries as q
from breezemart.plans.facts import AIR_FACT_MEASURES, WEATHER_FACT_MEASURES
from breezemart.plans.harmonized import AIR_FEATURES, WEATHER_FEATURES
from breezemart.schemas import AIR_MEASURES, WEATHER_MEASURES

KEY_LIST = '"timestamp", location_key, latitude, longitude'


def _d(expression: str) -> str:
    return f"cast({expression} as double)"


def _num(value: float) -> str:
    return f"cast({value!r} as double)"


AIR_SQL = {
    "pm10": f"v * {_num(0.6)}",
    "pm2_5": f"v * {_num(0.4)}",
    "carbon_monoxide": f"k * {_num(2.0)} + {_num(100.0)}",
    "nitrogen_dioxide": f"k * {_num(0.3)}",
    "sulphur_dioxide": f"k * {_num(0.1)}",
    "ozone": f"k * {_num(0.8)}",
    "aerosol_optical_depth": f"k * {_num(0.01)}",
    "dust": _d("k % 7"),
    "uv_index": _d("k % 11"),
    "us_aqi": "case when k % 17 = 0 then null else cast(floor(v) as integer) end",
}
_CODES = ", ".join(str(row[0]) for row in lookups.WEATHER_CONDITIONS)
WEATHER_SQL = {
    "temperature_2m": f"k * {_num(0.5)} - {_num(12.0)}",
    "relative_humidity_2m": _d("k"),
    "apparent_temperature": f"k * {_num(0.45)} - {_num(14.0)}",
    "precipitation": f"k * {_num(0.05)}",
    "rain": f"k * {_num(0.03)}",
    "snowfall": f"k * {_num(0.02)}",
    "cloud_cover": _d("k"),
    "cloud_cover_low": _d("k % 50"),
    "cloud_cover_mid": _d("k % 40"),
    "cloud_cover_high": _d("k % 30"),
    "surface_pressure": f"k * {_num(0.5)} + {_num(980.0)}",
    "visibility": f"k * {_num(150.0)}",
    "wind_speed_10m": "v",
    "wind_direction_10m": f"k * {_num(3.0)}",
    "wind_gusts_10m": f"v * {_num(1.5)}",
    "weather_code": _d(f"([{_CODES}, 4])[k % 30 + 1]"),
    "precipitation_probability": _d("k"),
}


def _six(expression: str) -> str:
    """Six decimals, by the arithmetic the queries use."""
    million = "cast(1000000 as double)"
    return f"floor(({expression}) * {million} + cast(0.5 as double)) / {million}"


def _select(formulas: dict[str, str]) -> str:
    return ", ".join(f"{expression} as {name}" for name, expression in formulas.items())


def _rounded(names: list[str], prefix: str = "", whole: tuple[str, ...] = ("us_aqi",)) -> str:
    """Doubles at six decimals; `whole` columns are integers and stay."""
    return ", ".join(f"{prefix}{n}" if n in whole else f"{_six(prefix + n)} as {n}"
                     for n in names)


def _in(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _calendar(ts: str) -> dict[str, str]:
    days = ", ".join(f"date '{year}-{month:02d}-{day:02d}'"
                     for year, pairs in lookups.HOLIDAYS.items() for month, day in pairs)
    month = f"month({ts})"
    return {
        "time_key": f"cast(year({ts}) * 1000000 + {month} * 10000 + day({ts}) * 100 + hour({ts}) "
                    "as integer)",
        "full_date": f"cast({ts} as date)",
        "year": f"cast(year({ts}) as integer)",
        "quarter": f"cast(ceil({month} / 3.0) as integer)",
        "month": f"cast({month} as integer)",
        "day": f"cast(day({ts}) as integer)",
        "hour": f"cast(hour({ts}) as integer)",
        "day_of_week": f"cast(dayofweek({ts}) + 1 as integer)",
        "is_weekend": f"dayofweek({ts}) in (0, 6)",
        "season": f"case when {month} in (12, 1, 2) then 'Winter' when {month} in (3, 4, 5) "
                  f"then 'Spring' when {month} in (6, 7, 8) then 'Summer' else 'Fall' end",
        "is_holiday": f"cast({ts} as date) in ({days})",
        "month_name": f"monthname({ts})",
        "day_name": f"dayname({ts})",
        "week_of_year": f"cast(weekofyear({ts}) as integer)",
        "is_end_of_month": f"cast({ts} as date) = last_day({ts})",
        "fiscal_year": f"cast(case when {month} >= 10 then year({ts}) + 1 else year({ts}) end "
                       "as integer)",
        "fiscal_quarter": f"cast(case when {month} >= 10 then {month} - 9 when {month} >= 7 then "
                          f"{month} - 6 when {month} >= 4 then {month} - 3 else {month} end "
                          "as integer)",
        "fiscal_quarter_of_year": f"cast(case when {month} >= 10 then 1 when {month} >= 7 then 4 "
                                  f"when {month} >= 4 then 3 else 2 end as integer)",
    }


_SEASON_KEY = ('case when month("timestamp") in (12, 1, 2) then 1 when month("timestamp") in '
               '(3, 4, 5) then 2 when month("timestamp") in (6, 7, 8) then 3 else 4 end')
_SEVERITY = ("case " + " ".join(f"when weather_code in ({_in(codes)}) then {key}"
                                for key, codes in lookups.SEVERITY_CODES) + " else 1 end")


def _band(position: int, unknown) -> str:
    cases = [f"when us_aqi <= {band[0]} then {_in([band[position]])}"
             for band in lookups.AQI_BANDS if band[0] is not None]
    return (f"case when us_aqi is null then {_in([unknown])} {' '.join(cases)} "
            f"else {_in([lookups.AQI_BANDS[-1][position]])} end")


_STATUS_KEY, _CATEGORY = _band(1, lookups.UNKNOWN_AQI[0]), _band(2, lookups.UNKNOWN_AQI[1])
_SIGHT = ("case when visibility < 1000 then 'Very Poor' when visibility < 4000 then 'Poor' "
          "when visibility < 10000 then 'Moderate' else 'Good' end")
_ZONE = ("case when abs(latitude) < 23.5 then 'Tropical' when abs(latitude) < 35 then "
         "'Subtropical' when abs(latitude) < 66.5 then 'Temperate' else 'Polar' end")
_AIR_EXTRA = {
    "pm_ratio": "case when pm2_5 > 0 then pm10 / pm2_5 end",
    "pollution_index": f"pm2_5 * {_num(0.3)} + pm10 * {_num(0.2)} + nitrogen_dioxide * {_num(0.2)} "
                       f"+ ozone * {_num(0.2)} + sulphur_dioxide * {_num(0.1)}",
    "pm25_normalized": f"pm2_5 / {_num(35.0)}",
    "pm10_normalized": f"pm10 / {_num(50.0)}",
}
_T, _RH, _W = "temperature_2m", "relative_humidity_2m", "wind_speed_10m"
_WEATHER_EXTRA = {
    "temp_difference": f"{_T} - apparent_temperature",
    "wind_chill": f"case when {_T} < 10 and {_W} > 4.8 then {_num(13.12)} + {_num(0.6215)} * {_T} "
                  f"- {_num(11.37)} * pow({_W}, {_num(0.16)}) "
                  f"+ {_num(0.3965)} * {_T} * pow({_W}, {_num(0.16)}) end",
    "heat_index": f"case when {_T} > 27 then {_num(-42.379)} + {_num(2.04901523)} * {_T} "
                  f"+ {_num(10.14333127)} * {_RH} - {_num(0.22475541)} * {_T} * {_RH} "
                  f"- {_num(6.83783e-3)} * pow({_T}, 2) - {_num(5.481717e-2)} * pow({_RH}, 2) "
                  f"+ {_num(1.22874e-3)} * pow({_T}, 2) * {_RH} "
                  f"+ {_num(8.5282e-4)} * {_T} * pow({_RH}, 2) "
                  f"- {_num(1.99e-6)} * pow({_T}, 2) * pow({_RH}, 2) end",
}
_DENSITY = f"surface_pressure / ({_num(287.05)} * ({_T} + {_num(273.15)}))"
_DEW = f"{_T} - ((100 - {_RH}) / {_num(5.0)})"


def _rounded_formulas(formulas: dict[str, str]) -> str:
    return ", ".join(f"{_six(e)} as {n}" for n, e in formulas.items())


def _change(name: str, column: str, back: int) -> str:
    return (f"{column} - lag({column}, {back}) over "
            f'(partition by location_key order by "timestamp") as {name}')


def _outer(weather: str, air: str) -> str:
    return f"""
  select coalesce(w."timestamp", a."timestamp") as "timestamp",
         coalesce(w.location_key, a.location_key) as location_key,
         {", ".join("w." + n for n in WEATHER_FEATURES)}, {", ".join("a." + n for n in AIR_FEATURES)}
  from {weather} w full outer join {air} a
    on w."timestamp" = a."timestamp" and w.location_key = a.location_key"""


def _types(names: list[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


_FIRST = 'row_number() over (partition by "timestamp", location_key order by event_id)'
_LAST = 'row_number() over (partition by "timestamp", location_key order by observed_at desc)'
_CONDITION_ROWS = ", ".join(f"({c}, '{d}', '{g}', {s})" for c, d, g, s in lookups.WEATHER_CONDITIONS)
_STATUS_ROWS = ", ".join(f"({_in(row)})" for row in
                         [lookups.UNKNOWN_AQI, *[band[1:] for band in lookups.AQI_BANDS]])
_SEASON_ROWS = ", ".join(f"({_in(row)})" for row in lookups.SEASONS)
_SEVERITY_ROWS = ", ".join(f"({_in(row)})" for row in lookups.SEVERITIES)

def _fact_tables(air: str, weather: str) -> str:
    return f"""{air}_fact as (
  select *, {_STATUS_KEY} as status_key, {_select(_AIR_EXTRA)},
         {_calendar('"timestamp"')["time_key"]} as time_key,
         {_change("aqi_change_1h", "us_aqi", 1)}, {_change("aqi_change_24h", "us_aqi", 24)}
  from {air}),
{weather}_fact as (
  select *, cast(coalesce(weather_code, -1) as integer) as condition_key, {_SEVERITY} as severity_key,
         {_SEASON_KEY} as season_key, {_select(_WEATHER_EXTRA)},
         {_calendar('"timestamp"')["time_key"]} as time_key, {_SIGHT} as visibility_category,
         severity_key >= 4 as is_severe_weather,
         {_change("temp_change_1h", "temperature_2m", 1)},
         {_change("temp_change_24h", "temperature_2m", 24)}
  from {weather})"""


_PRELUDE = f"""
with placed as (
  select event_id, event_type, user_id,
         ts + to_days(cast(user_id % 24 * 31 as integer)) as observed_at,
         {_d("(user_id * 7919 + 1007128) % 1400017 - 600000")} / {_num(10000.0)} as latitude,
         {_d("(user_id * 104729 + 1059940) % 3599971 - 1800000")} / {_num(10000.0)} as longitude,
         cast(json_extract_string(props, '$.k') as integer) as k, value as v
  from events),
base as (
  select *, date_trunc('hour', observed_at) as "timestamp",
         cast('0x' || substr(md5(printf('%.4f_%.4f', latitude, longitude)), 1, 15) as bigint)
           as location_key
  from placed),
air_raw as (
  select event_id, event_type, observed_at, k, {KEY_LIST}, {_select(AIR_SQL)}
  from base where event_type in ({_types(q.events.AIR_EVENTS)})),
weather_raw as (
  select event_id, event_type, observed_at, k, {KEY_LIST}, {_select(WEATHER_SQL)}
  from base where event_type in ({_types(q.events.WEATHER_EVENTS)})),
air as (select * from air_raw qualify {_FIRST} = 1),
weather as (select * from weather_raw qualify {_FIRST} = 1),
air_last as (select * from air_raw qualify {_LAST} = 1),
weather_last as (select * from weather_raw qualify {_LAST} = 1),
{_fact_tables("air", "weather")},
{_fact_tables("air_last", "weather_last")},
site as (
  select distinct location_key, latitude, longitude, 'Station ' || user_id as city,
         'Region ' || (user_id % 7) as region, {_d("user_id % 900")} as elevation,
         user_id % 3 = 0 as is_coastal, {_ZONE} as climate_zone,
         case when latitude >= 0 then 'Northern' else 'Southern' end as hemisphere
  from base),
harmonized as ({_outer("weather", "air")}),
harmonized_current as ({_outer("weather_last", "air_last")}),
conditions(condition_key, description, category, severity_level) as (values {_CONDITION_ROWS}),
statuses(status_key, aqi_category, health_implications, cautionary_statement, color_code) as (
  values {_STATUS_ROWS}),
seasons(season_key, season_name, start_month, end_month, avg_daylight_hours, typical_temp_range,
        characteristic_weather, date_range, precipitation_likelihood, heating_demand,
        daylight_pattern, outdoor_activity_level) as (values {_SEASON_ROWS}),
severities(severity_key, severity_level, severity_name, description, recommended_actions,
           alert_level, operational_status, safety_measures, monitoring_requirement) as (
  values {_SEVERITY_ROWS}),
condition_dim as (
  select code as condition_key, code as weather_code,
         coalesce(description, 'Unknown') as description, coalesce(category, 'Unknown') as category,
         cast(coalesce(severity_level, -1) as integer) as severity_level
  from (select distinct cast(coalesce(weather_code, -1) as integer) as code from weather_raw)
  left join conditions on code = condition_key),
condition_full as (
  select *, category in ('Rain', 'Snow', 'Drizzle') as is_precipitation,
         severity_level >= 3 as is_severe,
         case when category in ('Fog', 'Storm') then 'High' when category = 'Clouds' then 'Medium'
              else 'Low' end as visibility_impact,
         case when severity_level >= 4 then 'Severe' when severity_level >= 3 then 'High'
              when severity_level >= 2 then 'Medium' else 'Low' end as travel_impact
  from condition_dim),
status_full as (
  select statuses.*,
         case when aqi_category = 'Good' then 'Low' when aqi_category = 'Moderate' then 'Medium'
              when aqi_category like '%Unhealthy%' then 'High' else 'Severe' end as risk_level,
         case when aqi_category = 'Good' then 'Normal outdoor activities'
              when aqi_category = 'Moderate'
                then 'Sensitive individuals should limit prolonged outdoor exposure'
              when aqi_category like '%Unhealthy%' then 'Limit outdoor activities'
              else 'Avoid outdoor activities' end as outdoor_activity_recommendation,
         case when aqi_category like '%Sensitive%' then 'Yes' else 'No' end
           as sensitive_groups_affected
  from statuses where status_key in (select {_STATUS_KEY} from air_raw)),
condition_last as (
  select * from condition_full where weather_code in (
    select cast(coalesce(weather_code, -1) as integer) from weather_last)),
status_last as (select * from status_full where status_key in (select {_STATUS_KEY} from air_last)),
stamps as (select "timestamp" from air union select "timestamp" from weather)
"""

_AIR_READING = f"{KEY_LIST}, {_rounded(AIR_MEASURES)}"
_WEATHER_READING = f"{KEY_LIST}, {_rounded(WEATHER_MEASURES)}"
_AIR_FACT = f'time_key, location_key, status_key, "timestamp", {_rounded(AIR_FACT_MEASURES)}'
_AIR_FACT_EXTRA = (f"aqi_change_1h, aqi_change_24h, {_rounded(list(_AIR_EXTRA))}")
_WEATHER_FACT = ('time_key, location_key, condition_key, severity_key, season_key, "timestamp", '
                 f"{_rounded(WEATHER_FACT_MEASURES)}")
_WEATHER_FACT_EXTRA = (
    f"{_rounded(['temp_difference', 'temp_change_1h', 'temp_change_24h', 'wind_chill', 'heat_index'])}, "
    "severity_key >= 4 as is_severe_weather, visibility_category")


def _single(names: list[str]) -> str:
    """What a single-precision file keeps of a measure."""
    kept = {n: _six(f"cast(cast({n} as float) as double)") for n in names}
    return ", ".join(n if n == "us_aqi" else f"{kept[n]} as {n}" for n in names)


def _pick(names: list[str], ts: str = '"timestamp"') -> str:
    calendar = _calendar(ts)
    return ", ".join(f"{calendar[n]} as {n}" for n in names)


def _profile(table: str, columns: dict[str, str]) -> str:
    nulls = " + ".join(f"count(*) filter (where {e} is null)" for e in columns.values())
    mean = _six(f"100.0::double * ({nulls}) / (count(*) * {len(columns)})")
    return " union all ".join(
        f"select '{n}' as column_name, count(*) as n_rows, "
        f"count(*) filter (where {e} is null) as null_count, "
        + _six(f"100.0::double * count(*) filter (where {e} is null) / count(*)") + " as null_pct, "
        f"{mean} as mean_null_pct from {table}" for n, e in columns.items())


def _orphan(fact: str, key: str, dimension: str, names: tuple[str, str]) -> str:
    return (f"select '{names[0]}' as fact, '{names[1]}' as dimension, count(*) as orphan_rows "
            f"from {fact} where {key} is null or {key} not in "
            f"(select {key} from {dimension} where {key} is not null)")


def _nulls(names: list[str], kind: str) -> str:
    return ", ".join(f"cast(null as {kind}) as {n}" for n in names)


def _facts_without_derived() -> str:
    air_only = [n for n in AIR_FACT_MEASURES if n != "us_aqi"]
    return (f"select {_AIR_FACT}, {_nulls(['condition_key', 'severity_key', 'season_key'], 'integer')}, "
            f"{_nulls(WEATHER_FACT_MEASURES, 'double')} from air_fact union all by name "
            f"select {_WEATHER_FACT}, {_nulls(['status_key', 'us_aqi'], 'integer')}, "
            f"{_nulls(air_only, 'double')} from weather_fact")


_WEATHER_PROFILE = ["time_key", "location_key", "condition_key", "severity_key", "season_key",
                    '"timestamp"', *WEATHER_FACT_MEASURES, "temp_difference", "temp_change_1h",
                    "temp_change_24h", "wind_chill", "heat_index"]


def _gate() -> str:
    return (f"select *, null_pct <= {q.STRICT_THRESHOLD} as passed from ("
            + _profile("air_raw", {n: n for n in AIR_MEASURES}) + ")")


_MERGE_SOURCES = f"""(
  select event_id, {KEY_LIST}, {", ".join(AIR_MEASURES)}, observed_at as ingestion_timestamp,
         'batch' as source from air_raw
  union all by name
  select event_id, {KEY_LIST}, {", ".join(n for n in AIR_MEASURES if n != "pm2_5")},
         pm2_5 + {_num(1.0)} as pm2_5, observed_at + interval 1 day as ingestion_timestamp,
         'stream' as source from air_raw where event_type = 'view')"""

_START, _END = f"timestamp '{q.RANGE_START}'", f"timestamp '{q.RANGE_END}'"
_TIME_COLUMNS = ["time_key", "full_date", "year", "quarter", "month", "day", "hour", "day_of_week",
                 "is_weekend", "season", "is_holiday"]
_DAY = 'latitude, longitude, cast("timestamp" as date)'
_STAR_WEATHER = f"""
select f.time_key, f.location_key, round(f.temperature_2m, 6) as temperature_2m, f.condition_key,
       c.description, c.category, c.travel_impact, s.season_name, v.severity_name, v.alert_level,
       dayname(f."timestamp") as day_name, {_calendar('f."timestamp"')["is_holiday"]} as is_holiday,
       p.city, p.climate_zone
from weather_fact f left join condition_full c on f.condition_key = c.condition_key
  left join seasons s on f.season_key = s.season_key
  left join severities v on f.severity_key = v.severity_key
  left join site p on f.location_key = p.location_key"""
_STAR_AIR = f"""
select f.time_key, f.location_key, f.us_aqi, s.aqi_category, s.color_code, s.risk_level,
       {_calendar('f."timestamp"')["season"]} as season,
       {_calendar('f."timestamp"')["week_of_year"]} as week_of_year, p.city, p.hemisphere
from air_fact f left join status_full s on f.status_key = s.status_key
  left join site p on f.location_key = p.location_key"""
_MONTHS = [f'cast(year("timestamp") as integer) as year', 'cast(month("timestamp") as integer) as month']
# Columns that are doubles wherever they occur; all others print alike in both engines.
_DOUBLES = {*AIR_MEASURES, *WEATHER_MEASURES, *_AIR_EXTRA, *_WEATHER_EXTRA, "temp_change_1h", "temp_change_24h",
            "latitude", "longitude", "elevation", "avg_daylight_hours", "air_density", "dew_point"} - {"us_aqi"}


def _content(source: str, columns: list[str], whole: tuple[str, ...] = ()) -> str:
    """Rows and the sum of row digests of `columns` of `source`; `whole` names columns that are integers here."""
    def text(name: str) -> str:
        quoted = f'"{name}"'
        if name in _DOUBLES and name not in whole:
            value = f"cast(floor(cast({quoted} as double) * cast(1000000 as double) + cast(0.5 as double)) as bigint)"
        elif name == "timestamp":
            value = f"cast(floor(epoch({quoted})) as bigint)"
        else:
            value = quoted
        return f"coalesce(cast({value} as varchar), 'null')"

    row = ", ".join(text(name) for name in sorted(columns))
    return (f"count(*) as n_rows, coalesce(sum(cast('0x' || substr(md5(concat_ws('|', {row})), 1, 12) as bigint)), 0)"
            f"::bigint as content from ({source})")


def _contents(tables: dict[str, tuple]) -> str:
    return " union all ".join(f"select '{name}' as table_name, {_content(*table)}" for name, table in tables.items())


_CALENDAR = list(_calendar("x"))
_STORED_AIR = ["time_key", "location_key", "status_key", "timestamp", *AIR_FACT_MEASURES, *_AIR_EXTRA,
               "aqi_change_1h", "aqi_change_24h"]
_STORED_WEATHER = ["time_key", "location_key", "condition_key", "severity_key", "season_key", "timestamp",
                   *WEATHER_FACT_MEASURES, *_WEATHER_EXTRA, "temp_change_1h", "temp_change_24h",
                   "is_severe_weather", "visibility_category"]
_FEATURE_COLUMNS = ["timestamp", "location_key", *WEATHER_FEATURES, *AIR_FEATURES, "year", "month", "hour",
                    "day_of_week", "is_weekend", "season", "is_holiday", "latitude", "longitude", "elevation",
                    "climate_zone", "air_density", "dew_point"]
_CONDITION_COLUMNS = ["condition_key", "weather_code", "description", "category", "severity_level",
                      "is_precipitation", "is_severe", "visibility_impact", "travel_impact"]
_STATUS_COLUMNS = ["status_key", "aqi_category", "health_implications", "cautionary_statement", "color_code",
                   "risk_level", "outdoor_activity_recommendation", "sensitive_groups_affected"]
_SITE_COLUMNS = ["location_key", "latitude", "longitude", "city", "region", "climate_zone", "elevation", "country",
                 "continent", "hemisphere", "timezone", "is_coastal", "population_density", "urban_density"]
_SEASON_COLUMNS = ["season_key", "season_name", "start_month", "end_month", "avg_daylight_hours", "typical_temp_range",
                   "characteristic_weather", "date_range", "precipitation_likelihood", "heating_demand",
                   "daylight_pattern", "outdoor_activity_level"]
_SEVERITY_COLUMNS = ["severity_key", "severity_level", "severity_name", "description", "recommended_actions",
                     "alert_level", "operational_status", "safety_measures", "monitoring_requirement"]


def _by_month(table: str) -> str:
    return f"select *, {', '.join(_MONTHS)} from {table}"


def _features(table: str) -> str:
    return f"""
select h."timestamp", h.location_key, {_rounded(WEATHER_FEATURES)}, {_rounded(AIR_FEATURES)},
       {_pick(["year", "month", "hour", "day_of_week", "is_weekend", "season", "is_holiday"],
              'h."timestamp"')},
       p.latitude, p.longitude, p.elevation, p.climate_zone, {_six(_DENSITY)} as air_density,
       {_six(_DEW)} as dew_point
from {table} h join site p on h.location_key = p.location_key"""


_PLACES = """
select location_key, latitude, longitude, city, region, climate_zone, elevation,
       'Eventland' as country, 'Testia' as continent, hemisphere, 'UTC' as timezone, is_coastal,
       'High' as population_density, 'Low' as urban_density
from site where location_key in (select location_key from air_raw union
                                 select location_key from weather_raw)"""


def _spoilt(name: str) -> str:
    """Readings of a kind as the quarantine query has them: k = 50 in the year 9999, k = 51 without a place."""
    return (f"(select '{name}' as kind, case when k = 51 then 'location_key must not be null' "
            f"when k = 50 then 'time_key must not be null' end as rule, * from {name}_raw)")


def _quarantine() -> str:
    parts = [f"select 'raw_{kind}' as \"table\", rule, count(*) as n_rows from {_spoilt(t)} "
             "where rule is not null group by all" for kind, t in (("air_quality", "air"), ("weather", "weather"))]
    good = '(select distinct "timestamp", location_key from {0} where rule is null)'
    for kind, t, fact in (("air_quality", "air", "AirQualityFact"), ("weather", "weather", "WeatherFact")):
        kept = good.format(_spoilt(t))
        parts.append(f"select '{fact}', 'published', count(*) from {kept}")
        parts.append(f"select 'raw_{kind}', 'repeated', (select count(*) from {_spoilt(t)} where rule is null) "
                     f"- (select count(*) from {kept})")
    both = " union ".join(f"select * from {good.format(_spoilt(t))}" for t in ("air", "weather"))
    parts.append(f"select 'HarmonizedData', 'published', count(*) from ({both})")
    return " union all ".join(parts)


_SPLIT = f"timestamp '{q.STREAM_SPLIT}'"


def _stream_metrics() -> str:
    """Steps 0 and 1 hold the readings until the split and after it, step 2 those until it once more."""
    mark = 'cast((select max("timestamp") from air) as timestamp) - interval 10 minute'
    kept = ["time_key", "location_key", "status_key", '"timestamp"', *AIR_FACT_MEASURES, *_AIR_EXTRA,
            "aqi_change_1h", "aqi_change_24h"]
    lines = []
    for step, (table, columns, stage) in itertools.product(range(3), [("air", AIR_MEASURES, "pre"),
                                                                      ("air_fact", kept, "post")]):
        again = step == 2
        rows = f'"timestamp" {">" if step == 1 else "<="} {_SPLIT}' + (" and false" if again and stage == "post" else "")
        late = f'count(*) filter (where "timestamp" < {mark})' if again and stage == "pre" else "0"
        nulls = " + ".join(f"count(*) filter (where {c} is null)" for c in columns)
        width = len(columns) + (2 if stage == "post" else 0)  # processing time and batch id are stored too
        share = _six(f"coalesce(100.0::double * ({nulls}) / nullif(count(*) * {width}, 0), 0)")
        lines.append(
            f"select '{step}' as stream_batch, 'air_quality_{stage}' as stream_name, count(*) as record_count, "
            f"{share} as null_percentage, {late}::bigint as late_count, "
            f"({f'count(*) - {late}' if again and stage == 'pre' else 0})::bigint as repeat_count, "
            f"{1 if stage == 'pre' else 0}::bigint as rejected_count from {table} where {rows}")
    return " union all ".join(lines)


def _csv_rejects() -> str:
    kept = f"select {KEY_LIST}, {_single(WEATHER_MEASURES)} from weather_raw where k not between 50 and 53"
    reasons = {"malformed line": 50, "malformed number": 51, "missing timestamp": 52, "missing location": 53}
    return " union all ".join([
        f"select 'accepted' as error, {_content(kept, ['timestamp', 'location_key', 'latitude', 'longitude', *WEATHER_MEASURES])}",
        *[f"select '{error}', count(*), 0::bigint from weather_raw where k = {k} having count(*) > 0"
          for error, k in reasons.items()]])


_STATEMENTS = {
    "harmonized": _features("harmonized"),
    "harmonized_current": _features("harmonized_current"),
    "harmonized_outer": f'select "timestamp", location_key, {_rounded(WEATHER_FEATURES)}, '
                        f"{_rounded(AIR_FEATURES)} from harmonized",
    "harmonized_derived": f"select event_id, {_six(_DENSITY)} as air_density, "
                          f"{_six(_DEW)} as dew_point from weather_raw",
    "fact_air_quality": f"select {_AIR_FACT}, {_AIR_FACT_EXTRA} from air_fact",
    "fact_weather": f"select {_WEATHER_FACT}, {_WEATHER_FACT_EXTRA} from weather_fact",
    "facts_without_derived": _facts_without_derived(),
    "aqi_change": 'select "timestamp", location_key, us_aqi, aqi_change_1h, aqi_change_24h '
                  "from air_fact",
    "temp_change": 'select "timestamp", location_key, round(temperature_2m, 6) as temperature_2m, '
                   "round(temp_change_1h, 6) as temp_change_1h, "
                   "round(temp_change_24h, 6) as temp_change_24h from weather_fact",
    "air_derived": f"select event_id, {_rounded_formulas(_AIR_EXTRA)} from air_raw",
    "weather_derived": f"select event_id, {_rounded_formulas(_WEATHER_EXTRA)}, "
                       f"{_SEVERITY} as severity_key, {_SEVERITY} >= 4 as is_severe_weather, "
                       f"{_SIGHT} as visibility_category from weather_raw",
    "aqi_status": f"select event_id, us_aqi, {_STATUS_KEY} as status_key, "
                  f"{_CATEGORY} as aqi_category from air_raw",
    "visibility_category": f"select event_id, visibility, {_SIGHT} as visibility_category "
                           "from weather_raw",
    "dim_time": f"""
select "timestamp", {_pick(list(_calendar("x")))} from (
  select "timestamp" from stamps union
  select unnest(generate_series(timestamp '{q.AXIS_START}', timestamp '{q.AXIS_END}'
                                - interval 1 hour, interval 1 hour)))""",
    "dim_location": _PLACES,
    "dim_weather_condition": "select * from condition_full",
    "dim_aq_status": "select * from status_full",
    "dim_season": """
select seasons.* replace (cast(avg_daylight_hours as double) as avg_daylight_hours), n_readings
from seasons left join (select season_key as s, count(*) as n_readings from weather_fact group by 1)
  on season_key = s""",
    "dim_severity": """
select severities.*, n_readings from severities
left join (select severity_key as s, count(*) as n_readings from weather_fact group by 1)
  on severity_key = s""",
    "join_time_dim": f'select event_id, "timestamp", {_pick(_TIME_COLUMNS)} from weather_raw',
    "star_join": _STAR_WEATHER,
    "star_join_air": _STAR_AIR,
    "fk_orphans": " union all ".join([
        _orphan("air_fact", "status_key", "statuses", ("AirQualityFact", "AirQualityStatusDim")),
        _orphan("air_fact", "location_key", "site", ("AirQualityFact", "LocationDim")),
        _orphan("weather_fact", "condition_key", "conditions", ("WeatherFact", "WeatherConditionDim")),
        _orphan("weather_fact", "severity_key", "severities", ("WeatherFact", "SeverityDim")),
        _orphan("weather_fact", "location_key", "site", ("WeatherFact", "LocationDim"))]),
    "dq_profile": _profile("weather_fact", {
        **{n.strip('"'): n for n in _WEATHER_PROFILE}, "is_severe_weather": "severity_key",
        "visibility_category": "visibility_category"}),
    "dq_gate": _gate(),
    "merge_latest": f"""
select *, row_number() over (order by "timestamp", location_key) as position from (
select event_id, {_AIR_READING}, ingestion_timestamp, source from {_MERGE_SOURCES}
qualify row_number() over (partition by "timestamp", location_key
                           order by source desc, ingestion_timestamp desc) = 1)""",
    "merge_union": f"""
select event_id, source, "timestamp", location_key, round(pm2_5, 6) as pm2_5,
       case when source = 'batch' then dust end as dust,
       case when source = 'batch' then uv_index end as uv_index from {_MERGE_SOURCES}""",
    "window_tumbling": "select event_id, observed_at, date_trunc('hour', observed_at) as "
                       "window_start, date_trunc('hour', observed_at) + interval 1 hour as "
                       "window_end from air_raw",
    "src_csv_readings": f"select {KEY_LIST}, {_single(WEATHER_MEASURES)} from weather",
    "src_csv_failfast": f"select {KEY_LIST}, {_single(AIR_MEASURES)} from air",
    "src_envelope": f"select {_WEATHER_READING} from weather",
    "forecast_rows": f'select latitude, longitude, "timestamp", {_rounded(WEATHER_MEASURES)} '
                     "from weather",
    "arrays_to_rows": f"""
select latitude, longitude, strftime("timestamp", '%Y-%m-%dT%H:%M:%S') as time,
       {_rounded([n for n in AIR_MEASURES if n not in ("dust", "uv_index", "us_aqi")])},
       cast(null as double) as dust, round(cast(us_aqi as double), 6) as us_aqi,
       case when row_number() over (partition by {_DAY} order by "timestamp" desc) > 1
            then uv_index end as uv_index
from air""",
    "hourly_axis": f"""
select d.latitude, d.longitude, d.axis as "timestamp", round(w.temperature_2m, 6) as temperature_2m,
       round(w.visibility, 6) as visibility
from (select latitude, longitude, day,
             unnest(generate_series(start, cast(day + 1 as timestamp) - interval 1 hour,
                                    interval 1 hour)) as axis,
             generate_subscripts(generate_series(start, cast(day + 1 as timestamp)
                                 - interval 1 hour, interval 1 hour), 1) as place
      from (select latitude, longitude, cast("timestamp" as date) as day,
                   min("timestamp") as start from weather group by 1, 2, 3)) d
left join (select *, cast("timestamp" as date) as day,
                  row_number() over (partition by {_DAY} order by "timestamp") as place
           from weather) w
  on d.latitude = w.latitude and d.longitude = w.longitude and d.day = w.day
     and d.place = w.place""",
    "name_by_position": " union all ".join(
        f"select event_id, '{name}' as variable, {_six(column)} as value from air_raw"
        for name, column in (("pm10", "pm10"), ("pm2_5", "pm2_5"), ("unknown_variable_2", "ozone"),
                             ("unknown_variable_3", "dust"))),
    "history_window": f"""
select event_id, "timestamp", location_key from weather_raw
where cast("timestamp" as date) between date '{q.AS_OF}' - 181 and date '{q.AS_OF}' - 1""",
    "filter_range": f"""
select event_id, "timestamp", location_key from air_raw
where "timestamp" between {_START} and {_END}""",
    "clean_readings": f"""
select event_id, us_aqi, round(pm10, 2) as pm10, us_aqi is null as breaks_rule,
       us_aqi as us_aqi_from_text, cast(null as integer) as weather_code from air_raw
union all
select event_id, null, null, null, null, cast(coalesce(weather_code, -1) as integer)
from weather_raw""",
    "epoch_to_ts": """
select event_id, cast(floor(epoch(observed_at)) as bigint) as epoch_seconds,
       date_trunc('second', observed_at) as observed_at,
       strftime(observed_at, '%Y-%m-%dT%H:%M:%S') as iso from weather_raw""",
    "csv_rejects": _csv_rejects(),
    "sink_roundtrip": f"""
select {KEY_LIST}, {_rounded(AIR_MEASURES)}, {_nulls(WEATHER_MEASURES, "double")}, 'air_quality' as kind from air
union all by name
select {KEY_LIST}, {_rounded(WEATHER_MEASURES)}, 'weather' as kind from weather""",
    "sink_facts_partitioned": f"""
select {_AIR_FACT}, {", ".join(_MONTHS)} from air_fact""",
    "read_months": f"""
select {_AIR_FACT}, {", ".join(_MONTHS)} from air_fact
where "timestamp" between {_START} and {_END}""",
    "sink_harmonized": _features("harmonized"),
    "layout_clustered": f"""
select {_WEATHER_FACT}, cast("timestamp" as date) as date from weather_fact""",
    "layout_lookup": f"""
select {_WEATHER_FACT}, cast("timestamp" as date) as date from weather_fact
where cast("timestamp" as date) between cast({_START} as date) and cast({_END} as date)
  and location_key = (select min(location_key) from weather_fact
                      where cast("timestamp" as date) between cast({_START} as date) and cast({_END} as date))""",
    "sink_csv": f"""
select strftime("timestamp", '%Y-%m-%dT%H:%M:%S') as time, {_rounded(WEATHER_MEASURES)},
       latitude, longitude, (select strftime(min("timestamp"), '%Y%m%d') || '_' || strftime(max("timestamp"), '%Y%m%d')
                             from weather) as file_range from weather""",
    "to_envelope": f"select {_WEATHER_READING}, 'Open-Meteo API' as data_source from weather",
    "parse_messages": f"""
select {KEY_LIST}, {_rounded(AIR_MEASURES)}, cast(null as varchar) as error from air_raw
where k <> 50
union all by name
select cast(null as timestamp) as "timestamp", cast(null as bigint) as location_key,
       {_nulls(["latitude", "longitude", *[n for n in AIR_MEASURES if n != "us_aqi"]], "double")},
       cast(null as integer) as us_aqi, 'malformed JSON' as error from air_raw where k = 50""",
    "dead_letter": "select 'bad message ' || event_id as original_data, 'malformed JSON' as error "
                   "from weather_raw where k = 50",
    "stream_type_detect": "select 'air_quality' as kind, 'pm2_5' as missing, count(*) as n_rows "
                          "from air_raw union all select 'weather', '', count(*) from weather_raw",
    "stream_source": f"select {_WEATHER_READING} from weather",
    "stream_late_data": f"select {_AIR_READING} from air",
    "stream_facts": f"select {_AIR_FACT}, {_AIR_FACT_EXTRA} from air_fact",
    "stream_metrics": _stream_metrics(),
    "stream_late_rows": f"""
select {_WEATHER_READING}, (select max("timestamp") from weather) - interval 10 minute as watermark,
       '2' as stream_batch from weather
where "timestamp" <= {_SPLIT} and "timestamp" < (select max("timestamp") from weather) - interval 10 minute""",
    "stream_foreach_batch": f"select {_WEATHER_FACT}, {_WEATHER_FACT_EXTRA} from weather_fact",
    "merged_facts": f"""
select {_AIR_FACT}, {_AIR_FACT_EXTRA} from air_fact union all by name
select {_WEATHER_FACT}, {_WEATHER_FACT_EXTRA} from weather_fact""",
    "batch_tables": _contents({
        "TimeDim": (f'select "timestamp", {_pick(_CALENDAR)} from stamps', ["timestamp", *_CALENDAR]),
        "LocationDim": (_PLACES, _SITE_COLUMNS),
        "WeatherConditionDim": ("select * from condition_last", _CONDITION_COLUMNS, ("weather_code",)),
        "AirQualityStatusDim": ("select * from status_last", _STATUS_COLUMNS),
        "SeasonDim": ("select * from seasons", _SEASON_COLUMNS),
        "SeverityDim": ("select * from severities", _SEVERITY_COLUMNS),
        "AirQualityFact": (_by_month("air_last_fact"), [*_STORED_AIR, "year", "month"]),
        "WeatherFact": (_by_month("weather_last_fact"), [*_STORED_WEATHER, "year", "month"]),
        "HarmonizedData": (_features("harmonized_current"), _FEATURE_COLUMNS),
    }),
    "batch_quarantine": _quarantine(),
    "stream_tables": _contents({
        "facts/air_quality": ("select * from air_fact", _STORED_AIR),
        "facts/weather": ("select * from weather_fact", _STORED_WEATHER),
        **{f"dead_letter/{kind}": ("select 'no JSON' as original_data, 'malformed JSON' as error from range(2)",
                                   ["original_data", "error"]) for kind in ("air_quality", "weather")},
    }),
}


def statements() -> dict[str, str]:
    return {name: _PRELUDE + body for name, body in _STATEMENTS.items()}
