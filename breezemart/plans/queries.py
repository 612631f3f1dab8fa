"""The registered queries: every operator over readings derived from the whole `events` table."""

from __future__ import annotations

import datetime
import functools
import time
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breezemart.functions import categories as B
from breezemart.functions import cleaning as C
from breezemart.functions import measures as M
from breezemart.operators import arrays, joins, merge, quality
from breezemart.plans import dims, facts, pipeline
from breezemart.plans.harmonized import (
    AIR_FEATURES, KEYS, WEATHER_FEATURES, harmonize, on_the_hour)
from breezemart.schemas import ARRIVAL, READING_KEYS, measures_of
from breezemart.session import pin_utc, staged, workspace
from breezemart.sources import event_readings as events
from breezemart.sources import readers, snapshots, writers
from breezemart.streaming import live, merging, messages, run, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Arguments the queries run with; the SQL side states the same.
AS_OF = datetime.date(2025, 1, 1)
RANGE_START = datetime.datetime(2024, 11, 15)
RANGE_END = datetime.datetime(2025, 2, 15)
AXIS_START = datetime.datetime(2023, 12, 30)
AXIS_END = datetime.datetime(2024, 1, 2)
STRICT_THRESHOLD = 5.0
STREAM_SPLIT = datetime.datetime(2024, 9, 1)


def comparable(df: DataFrame) -> DataFrame:
    """Zone-less timestamps and doubles of six decimals, as any engine would print them.

    The decimals are cut by plain arithmetic: `round` goes through decimals and costs more than
    the queries do. Values from a billion on, infinite ones and NaN stay as they are.
    """
    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.DoubleType):
            units = F.floor(column * F.lit(1e6) + F.lit(0.5)).cast("double")
            kept = F.when(F.abs(column) < 1e9, units / F.lit(1e6)).otherwise(column)
            return kept.alias(field.name)
        return column

    return df.select(*[plain(field) for field in df.schema.fields])


#: Columns that tell when and by which run a row was stored, not what it holds.
RUN_COLUMNS = ["etl_batch_id", "processing_timestamp", "last_updated"]


def content(df: DataFrame) -> list:
    """Aggregates over all rows and columns: how many, and a sum of row digests that no order changes.

    A row's digest is of its columns by name: doubles as millionths, times as epoch seconds. It has 48
    bits, so that their sum may pass 63 bits from 32,769 rows on; it is kept modulo 2^64, as a signed
    bigint. The halves of the digests are summed apart, which 2^39 rows do not overflow.
    """
    def text(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            column = F.floor(column * F.lit(1e6) + F.lit(0.5)).cast("bigint")
        if isinstance(field.dataType, T.TimestampType):
            column = F.unix_seconds(column)
        return F.coalesce(column.cast("string"), F.lit("null"))

    fields = sorted((f for f in df.schema.fields if f.name not in RUN_COLUMNS), key=lambda f: f.name)
    digest = F.md5(F.concat_ws("|", *[text(f) for f in fields]))
    high, low = [F.sum(F.conv(F.substring(digest, at, 6), 16, 10).cast("bigint")) for at in (1, 7)]
    whole, half = [F.lit(Decimal(n)) for n in (2**64, 2**63)]
    wrapped = F.pmod(high.cast("decimal(20,0)") * F.lit(2**24) + low, whole)
    signed = F.when(wrapped >= half, wrapped - whole).otherwise(wrapped)
    return [F.count(F.lit(1)).alias("n_rows"),
            F.coalesce(signed.cast("bigint"), F.lit(0).cast("bigint")).alias("content")]


def _contents(tables: dict[str, DataFrame]) -> DataFrame:
    sums = [frame.agg(*content(frame)).select(F.lit(name).alias("table_name"), "n_rows", "content")
            for name, frame in tables.items()]
    return functools.reduce(DataFrame.union, sums)


def query(function: Query) -> Query:
    @functools.wraps(function)
    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(function(pin_utc(spark), sf_dir))

    QUERIES[function.__name__] = run_query
    return function


def _air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.hourly_readings(spark, sf_dir, "air_quality")


def _weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.hourly_readings(spark, sf_dir, "weather")


def _location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The location dimension as a written table, the way the batch job joins it."""
    sites = events.stations(spark, sf_dir)
    return staged(dims.location_dimension(sites, sites), "LocationDim")


# --- features, facts, dimensions ---------------------------------------------------------------

@query
def harmonized(spark, sf_dir):
    return harmonize(_air(spark, sf_dir), _weather(spark, sf_dir), _location(spark, sf_dir))


@query
def harmonized_current(spark, sf_dir):
    """Current readings come at any minute: cut to the hour, the last of an hour kept."""
    sides = {}
    for kind in ("air_quality", "weather"):
        rows = events.raw_readings(spark, sf_dir, kind).withColumn("timestamp", F.col("observed_at"))
        sides[kind] = merge.latest_per_key(on_the_hour(rows), KEYS, [F.col("observed_at")])
    return harmonize(sides["air_quality"], sides["weather"], _location(spark, sf_dir))


@query
def harmonized_outer(spark, sf_dir):
    weather = _weather(spark, sf_dir).select(*KEYS, *WEATHER_FEATURES)
    return joins.outer_by_hour(weather, _air(spark, sf_dir).select(*KEYS, *AIR_FEATURES))


@query
def harmonized_derived(spark, sf_dir):
    rows = events.raw_readings(spark, sf_dir, "weather")
    return rows.select("event_id", M.air_density().alias("air_density"),
                       M.dew_point().alias("dew_point"))


@query
def fact_air_quality(spark, sf_dir):
    return facts.air_quality_facts(_air(spark, sf_dir))


@query
def fact_weather(spark, sf_dir):
    return facts.weather_facts(_weather(spark, sf_dir))


@query
def facts_without_derived(spark, sf_dir):
    air = facts.air_quality_facts(_air(spark, sf_dir), derived=False)
    weather = facts.weather_facts(_weather(spark, sf_dir), derived=False)
    return air.unionByName(weather, allowMissingColumns=True)


@query
def aqi_change(spark, sf_dir):
    fact = facts.air_quality_facts(_air(spark, sf_dir))
    return fact.select("timestamp", "location_key", "us_aqi", "aqi_change_1h", "aqi_change_24h")


@query
def temp_change(spark, sf_dir):
    fact = facts.weather_facts(_weather(spark, sf_dir))
    return fact.select("timestamp", "location_key", "temperature_2m", "temp_change_1h",
                       "temp_change_24h")


@query
def air_derived(spark, sf_dir):
    rows = events.raw_readings(spark, sf_dir, "air_quality")
    return rows.select("event_id", M.pm_ratio().alias("pm_ratio"),
                       M.pollution_index().alias("pollution_index"),
                       M.pm25_normalized().alias("pm25_normalized"),
                       M.pm10_normalized().alias("pm10_normalized"))


@query
def weather_derived(spark, sf_dir):
    rows = events.raw_readings(spark, sf_dir, "weather")
    severity = B.severity_key("weather_code")
    return rows.select("event_id", M.temp_difference().alias("temp_difference"),
                       M.wind_chill().alias("wind_chill"), M.heat_index().alias("heat_index"),
                       severity.alias("severity_key"), (severity >= 4).alias("is_severe_weather"),
                       B.visibility_category("visibility").alias("visibility_category"))


@query
def aqi_status(spark, sf_dir):
    rows = events.raw_readings(spark, sf_dir, "air_quality")
    return rows.select("event_id", "us_aqi", B.aqi_status_key("us_aqi").alias("status_key"),
                       B.aqi_category("us_aqi").alias("aqi_category"))


@query
def visibility_category(spark, sf_dir):
    rows = events.raw_readings(spark, sf_dir, "weather")
    return rows.select("event_id", "visibility",
                       B.visibility_category("visibility").alias("visibility_category"))


@query
def dim_time(spark, sf_dir):
    return dims.time_dimension(_air(spark, sf_dir), _weather(spark, sf_dir), AXIS_START, AXIS_END)


@query
def dim_location(spark, sf_dir):
    positions = (events.raw_readings(spark, sf_dir, "air_quality").select("latitude", "longitude")
                 .union(events.raw_readings(spark, sf_dir, "weather")
                        .select("latitude", "longitude")))
    return dims.location_dimension(positions, events.stations(spark, sf_dir))


@query
def dim_weather_condition(spark, sf_dir):
    return dims.weather_condition_dimension(events.raw_readings(spark, sf_dir, "weather"))


@query
def dim_aq_status(spark, sf_dir):
    return dims.air_quality_status_dimension(events.raw_readings(spark, sf_dir, "air_quality"))


@query
def dim_season(spark, sf_dir):
    """The season table with the weather readings that fall in each season."""
    fact = facts.weather_facts(_weather(spark, sf_dir), derived=False)
    used = fact.groupBy("season_key").agg(F.count("*").alias("n_readings"))
    return dims.season_dimension(spark).join(used, "season_key", "left")


@query
def dim_severity(spark, sf_dir):
    """The severity table with the weather readings of each severity."""
    fact = facts.weather_facts(_weather(spark, sf_dir), derived=False)
    used = fact.groupBy("severity_key").agg(F.count("*").alias("n_readings"))
    return dims.severity_dimension(spark).join(used, "severity_key", "left")


@query
def join_time_dim(spark, sf_dir):
    names = ["time_key", "full_date", "year", "quarter", "month", "day", "hour", "day_of_week",
             "is_weekend", "season", "is_holiday"]
    rows = events.raw_readings(spark, sf_dir, "weather").select("event_id", "timestamp")
    return joins.with_calendar(rows, names)


@query
def star_join(spark, sf_dir):
    air, weather = _air(spark, sf_dir), _weather(spark, sf_dir)
    fact = facts.weather_facts(weather, derived=False)
    condition = staged(dims.weather_condition_dimension(weather), "WeatherConditionDim").select(
        "condition_key", "description", "category", "travel_impact")
    season = dims.season_dimension(spark).select("season_key", "season_name")
    severity = dims.severity_dimension(spark).select("severity_key", "severity_name", "alert_level")
    time_dim = staged(dims.time_dimension(air, weather), "TimeDim").select(
        "timestamp", "day_name", "is_holiday")
    place = _location(spark, sf_dir).select("location_key", "city", "climate_zone")
    joined = joins.star_join(
        fact, {"season_key": season, "severity_key": severity},
        {"condition_key": condition, "timestamp": time_dim, "location_key": place})
    return joined.select("time_key", "location_key", "temperature_2m", "condition_key",
                         "description", "category", "travel_impact", "season_name",
                         "severity_name", "alert_level", "day_name", "is_holiday", "city",
                         "climate_zone")


@query
def star_join_air(spark, sf_dir):
    air, weather = _air(spark, sf_dir), _weather(spark, sf_dir)
    fact = facts.air_quality_facts(air, derived=False)
    status = dims.air_quality_status_dimension(air).select(
        "status_key", "aqi_category", "color_code", "risk_level")
    time_dim = staged(dims.time_dimension(air, weather), "TimeDim").select(
        "timestamp", "season", "week_of_year")
    place = _location(spark, sf_dir).select("location_key", "city", "hemisphere")
    joined = joins.star_join(fact, {"status_key": status},
                             {"timestamp": time_dim, "location_key": place})
    return joined.select("time_key", "location_key", "us_aqi", "aqi_category", "color_code",
                         "risk_level", "season", "week_of_year", "city", "hemisphere")


@query
def fk_orphans(spark, sf_dir):
    """Against the bare lookup tables, so that codes outside them show."""
    air, weather = _air(spark, sf_dir), _weather(spark, sf_dir)
    air_fact = facts.air_quality_facts(air, derived=False)
    weather_fact = facts.weather_facts(weather, derived=False)
    place = _location(spark, sf_dir)
    condition = dims.condition_table(spark)
    found = [
        joins.orphans(air_fact, dims.status_table(spark), "status_key", "AirQualityFact",
                      "AirQualityStatusDim"),
        joins.orphans(air_fact, place, "location_key", "AirQualityFact", "LocationDim"),
        joins.orphans(weather_fact, condition, "condition_key", "WeatherFact",
                      "WeatherConditionDim"),
        joins.orphans(weather_fact, dims.severity_dimension(spark), "severity_key", "WeatherFact",
                      "SeverityDim"),
        joins.orphans(weather_fact, place, "location_key", "WeatherFact", "LocationDim"),
    ]
    return functools.reduce(DataFrame.union, found)


# --- quality and merging -----------------------------------------------------------------------

@query
def dq_profile(spark, sf_dir):
    return quality.profile(facts.weather_facts(_weather(spark, sf_dir)))


@query
def dq_gate(spark, sf_dir):
    rows = events.raw_readings(spark, sf_dir, "air_quality")
    return quality.gate_report(rows, STRICT_THRESHOLD, measures_of("air_quality"))


def _history_and_stream(spark, sf_dir):
    """All air readings as history; those of one event type sent again, a day later, as stream."""
    kept = ["event_id", *READING_KEYS, *measures_of("air_quality")]
    rows = events.raw_readings(spark, sf_dir, "air_quality")
    history = rows.select(*kept, F.col("observed_at").alias("ingestion_timestamp"))
    later = F.col("observed_at") + F.expr("INTERVAL 1 DAY")
    stream = (rows.filter(F.col("event_type") == "view")
              .withColumn("pm2_5", F.col("pm2_5") + F.lit(1.0))
              .select(*kept, later.alias("ingestion_timestamp")))
    return history, stream


@query
def merge_latest(spark, sf_dir):
    history, stream = _history_and_stream(spark, sf_dir)
    return merge.merge_batch_and_stream(history, stream, sort=True)


@query
def merge_union(spark, sf_dir):
    history, stream = _history_and_stream(spark, sf_dir)
    both = merge.union_sources(history, stream.drop("dust", "uv_index"))
    return both.select("event_id", "source", "timestamp", "location_key", "pm2_5", "dust",
                       "uv_index")


@query
def window_tumbling(spark, sf_dir):
    rows = events.raw_readings(spark, sf_dir, "air_quality")
    return merge.tumbling_window(rows.select("event_id", "observed_at"), "observed_at")


# --- sources -----------------------------------------------------------------------------------

def _csv_round_trip(spark, sf_dir, kind, fail_fast):
    path = writers.write_csv(events.hourly_readings(spark, sf_dir, kind), workspace(spark, "csv"),
                             kind)
    return readers.read_csv_history(spark, f"{path}/*.csv", kind, fail_fast=fail_fast).drop(ARRIVAL)


@query
def src_csv_readings(spark, sf_dir):
    return _csv_round_trip(spark, sf_dir, "weather", fail_fast=False)


@query
def src_csv_failfast(spark, sf_dir):
    return _csv_round_trip(spark, sf_dir, "air_quality", fail_fast=True)


@query
def src_envelope(spark, sf_dir):
    path = writers.write_documents(_weather(spark, sf_dir), workspace(spark, "documents"), "weather")
    documents = readers.read_documents(spark, path, "weather", False)
    return readers.current_readings(documents, "weather").drop(ARRIVAL)


def _per_day(readings: DataFrame, entry) -> DataFrame:
    """Entries of a station and day as one sorted array: 24 at most, as readings are hourly."""
    return (readings.groupBy("latitude", "longitude", F.to_date("timestamp").alias("day"))
            .agg(F.sort_array(F.collect_list(entry)).alias("entries")))


@query
def forecast_rows(spark, sf_dir):
    names = measures_of("weather")
    entry = F.struct(C.iso_text("timestamp").alias("timestamp"), F.struct(*names).alias("values"))
    days = _per_day(_weather(spark, sf_dir), entry)
    documents = days.select(
        F.struct(F.struct("latitude", "longitude").alias("location")).alias("metadata"),
        F.struct(F.col("entries").alias("time_series")).alias("hourly_forecast"))
    return arrays.forecast_rows(documents, names)


@query
def arrays_to_rows(spark, sf_dir):
    """A payload without `dust`, and with a `uv_index` array that is one short."""
    names = measures_of("air_quality")
    entry = F.struct(C.iso_text("timestamp").alias("time"),
                     *[F.col(name).cast("double").alias(name) for name in names])
    days = _per_day(_air(spark, sf_dir), entry)
    fields = [F.col(f"entries.{name}").alias(name) for name in ["time", *names]
              if name not in ("dust", "uv_index")]
    short = F.slice("entries.uv_index", 1, F.greatest(F.size("entries") - 1, F.lit(0)))
    payload = days.select("latitude", "longitude",
                          F.struct(*fields, short.alias("uv_index")).alias("hourly"))
    return arrays.arrays_to_rows(payload, "hourly", names)


@query
def hourly_axis(spark, sf_dir):
    """Values put on the hours from a day's first reading to midnight, by place."""
    entry = F.struct("timestamp", "temperature_2m", "visibility")
    days = _per_day(_weather(spark, sf_dir), entry)
    payload = days.select("latitude", "longitude", F.col("entries")[0]["timestamp"].alias("start"),
                          F.date_add("day", 1).cast("timestamp").alias("stop"),
                          F.col("entries.temperature_2m").alias("t"),
                          F.col("entries.visibility").alias("v"))
    return arrays.hourly_axis(payload, "start", "stop", {"temperature_2m": "t", "visibility": "v"})


@query
def name_by_position(spark, sf_dir):
    rows = events.raw_readings(spark, sf_dir, "air_quality")
    listed = rows.select("event_id", F.array("pm10", "pm2_5", "ozone", "dust").alias("listed"))
    return arrays.name_by_position(listed, "listed", measures_of("air_quality")[:2])


@query
def history_window(spark, sf_dir):
    rows = events.raw_readings(spark, sf_dir, "weather").select("event_id", "timestamp", "location_key")
    return readers.trailing_window(rows, AS_OF)


@query
def filter_range(spark, sf_dir):
    rows = events.raw_readings(spark, sf_dir, "air_quality").select("event_id", "timestamp", "location_key")
    return readers.between(rows, RANGE_START, RANGE_END)


@query
def clean_readings(spark, sf_dir):
    air = events.raw_readings(spark, sf_dir, "air_quality").select(
        "event_id", "us_aqi",
        F.concat(F.col("us_aqi").cast("string"), F.lit(".7")).alias("text"),
        C.two_decimals("pm10").alias("pm10"), F.col("us_aqi").isNull().alias("breaks_rule"))
    weather = events.raw_readings(spark, sf_dir, "weather").select(
        "event_id", C.code_or_default("weather_code").alias("weather_code"))
    return (air.withColumn("us_aqi_from_text", C.whole_number("text")).drop("text")
            .unionByName(weather, allowMissingColumns=True))


@query
def epoch_to_ts(spark, sf_dir):
    rows = events.raw_readings(spark, sf_dir, "weather")
    seconds = rows.select("event_id", F.unix_seconds("observed_at").alias("epoch_seconds"))
    return (seconds.withColumn("observed_at", C.epoch_to_timestamp("epoch_seconds"))
            .withColumn("iso", C.iso_text("observed_at")))


# --- sinks -------------------------------------------------------------------------------------

@query
def csv_rejects(spark, sf_dir):
    """History files with broken lines: what is accepted, and what is rejected for which reason."""
    rows = events.raw_readings(spark, sf_dir, "weather")
    names = measures_of("weather")
    spoilt = {name: F.col(name).cast("string") for name in names}
    spoilt["visibility"] = F.when(F.col("k") == 51, F.lit("far")).otherwise(spoilt["visibility"])
    time_text = F.when(F.col("k") == 52, F.lit("noon")).otherwise(C.iso_text("timestamp"))
    place = F.when(F.col("k") != 53, F.col("longitude").cast("string"))
    last = F.when(F.col("k") == 50, F.concat(place, F.lit(",one more"))).otherwise(place)
    path = workspace(spark, "spoilt-csv")
    (rows.select(time_text.alias("time"), *[spoilt[n].alias(n) for n in names],
                 F.col("latitude").cast("string").alias("latitude"), last.alias("longitude"))
     .write.option("header", True).option("quote", "").csv(path))
    good, bad = readers.read_csv_checked(spark, path, "weather")
    letters = writers.write_table(bad, workspace(spark, "dead-lines"))
    stored = spark.read.parquet(letters)
    cut = stored.groupBy("error").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(0).cast("bigint").alias("content"))
    kept = good.drop(ARRIVAL)
    return kept.agg(*content(kept)).select(F.lit("accepted").alias("error"), "n_rows", "content").union(
        cut.select("error", "n_rows", "content"))


@query
def sink_roundtrip(spark, sf_dir):
    path, names = workspace(spark, "table"), [*measures_of("air_quality"), *measures_of("weather")]
    for kind, mode in (("air_quality", "overwrite"), ("weather", "append")):
        rows = events.hourly_readings(spark, sf_dir, kind)
        absent = {n: F.lit(None).cast("int" if n == "us_aqi" else "double") for n in names if n not in rows.columns}
        rows = rows.withColumns(absent).select(*READING_KEYS, *names, F.lit(kind).alias("kind"))
        writers.write_table(rows, path, mode)
    return spark.read.parquet(path)


@query
def sink_facts_partitioned(spark, sf_dir):
    fact = facts.air_quality_facts(_air(spark, sf_dir), derived=False)
    return spark.read.parquet(writers.write_partitioned(fact, workspace(spark, "fact")))


@query
def read_months(spark, sf_dir):
    """A time range of the partitioned table: only the folders of its months are listed."""
    fact = facts.air_quality_facts(_air(spark, sf_dir), derived=False)
    path = writers.write_partitioned(fact, workspace(spark, "fact"))
    return readers.read_months(spark, path, RANGE_START, RANGE_END)


@query
def sink_harmonized(spark, sf_dir):
    table = harmonize(_air(spark, sf_dir), _weather(spark, sf_dir), _location(spark, sf_dir))
    return spark.read.parquet(writers.write_partitioned(table, workspace(spark, "harmonized")))


@query
def layout_clustered(spark, sf_dir):
    fact = facts.weather_facts(_weather(spark, sf_dir), derived=False)
    return spark.read.parquet(writers.write_clustered(fact, workspace(spark, "clustered"), "date",
                                                      ["location_key", "severity_key"]))


@query
def layout_lookup(spark, sf_dir):
    """One station and a time range of the clustered table: only the days' folders and the row groups
    whose key range holds the station are read."""
    fact = facts.weather_facts(_weather(spark, sf_dir), derived=False)
    path = writers.write_clustered(fact, workspace(spark, "clustered"), "date", ["location_key", "severity_key"])
    some_days = spark.read.parquet(path).filter(F.col("date").between(RANGE_START.date(), RANGE_END.date()))
    station = some_days.agg(F.min("location_key")).first()[0]
    return some_days.filter(F.col("location_key") == F.lit(station))


@query
def sink_csv(spark, sf_dir):
    """All readings, in a folder named by the days they span."""
    readings = _weather(spark, sf_dir)
    first, last = readings.agg(F.min(F.to_date("timestamp")), F.max(F.to_date("timestamp"))).first()
    name = writers.range_name("weather", first, last)
    path = writers.write_csv(readings, f"{workspace(spark, 'export')}/{name}", "weather")
    columns = ", ".join(["time string", *[f"{m} double" for m in measures_of("weather")],
                         "latitude double", "longitude double"])
    rows = spark.read.schema(columns).option("header", True).csv(path)
    return rows.withColumn("file_range", F.regexp_extract(F.input_file_name(), r"weather_(\d{8}_\d{8})", 1))


@query
def to_envelope(spark, sf_dir):
    sent = writers.messages(_weather(spark, sf_dir), "weather")
    source = F.get_json_object("original_data", "$.metadata.data_source").alias("data_source")
    return messages.parse_messages(sent, "weather").select(
        *READING_KEYS, *measures_of("weather"), source)


# --- messages and streams ----------------------------------------------------------------------

def _mixed_messages(spark, sf_dir, kind):
    """A message per event; every event with k = 50 is cut to text that is no JSON."""
    sent = events.raw_readings(spark, sf_dir, kind)
    junk = F.concat(F.lit("bad message "), F.col("event_id").cast("string"))
    return sent.select(F.when(F.col("k") == 50, junk)
                       .otherwise(F.to_json(writers.envelope(sent, kind))).alias("value"))


@query
def parse_messages(spark, sf_dir):
    parsed = messages.parse_messages(_mixed_messages(spark, sf_dir, "air_quality"), "air_quality")
    return parsed.select(*READING_KEYS, *measures_of("air_quality"), "error")


@query
def dead_letter(spark, sf_dir):
    parsed = messages.parse_messages(_mixed_messages(spark, sf_dir, "weather"), "weather")
    path = writers.write_table(writers.dead_letters(messages.rejected(parsed)),
                               workspace(spark, "dead_letter"))
    return spark.read.parquet(path).select("original_data", "error")


@query
def stream_type_detect(spark, sf_dir):
    found = []
    for kind in ("air_quality", "weather"):
        rows = events.raw_readings(spark, sf_dir, kind)
        rows = rows.drop("pm2_5") if kind == "air_quality" else rows
        detected, missing = messages.detect_kind(rows.columns)
        found.append(rows.agg(F.count("*").alias("n_rows")).select(
            F.lit(detected).alias("kind"), F.lit(",".join(missing)).alias("missing"), "n_rows"))
    return found[0].union(found[1])


def stream_session(spark: SparkSession) -> SparkSession:
    """A session for streaming: state is kept in as many parts as there are cores, at most."""
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                spark.sparkContext.defaultParallelism)
    session = pin_utc(spark.newSession())
    session.conf.set("spark.sql.shuffle.partitions", str(parts))
    return session


def land_messages(steps: list[DataFrame], kind: str, path: str) -> int:
    """Write readings as message files, a step after the other; returns the files per step.

    Each step also holds one message that is no JSON. File sources go by modification time, so the
    files of a step are stamped a minute after those of the step before.
    """
    spark = steps[0].sparkSession
    number = spark.sparkContext.defaultParallelism
    junk = spark.createDataFrame([("no JSON",)], "junk string")
    files, folder = snapshots.file_system(spark, path)
    start, seen = int(time.time() * 1000) - 3_600_000, set()
    for step, rows in enumerate(steps):
        # columns are dealt out, not the several times longer text
        dealt = rows.unionByName(junk, allowMissingColumns=True).repartition(number)
        (dealt.select(F.coalesce("junk", F.to_json(writers.envelope(dealt, kind))).alias("value"))
         .write.mode("append").text(path))
        for status in files.listStatus(folder):
            file = status.getPath()
            if file.getName().startswith("part-") and file.getName() not in seen:
                seen.add(file.getName())
                files.setTimes(file, start + 60_000 * step, -1)
    if len(seen) != number * len(steps):
        raise RuntimeError(f"{len(seen)} message files for {len(steps)} steps of {number}")
    return number


def _written(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The hourly readings, derived once and written: each step, and the history, reads them again."""
    return staged(events.hourly_readings(spark, sf_dir, kind), f"readings-{kind}")


def _in_steps(readings: DataFrame, resend: bool = False) -> list[DataFrame]:
    """Readings until `STREAM_SPLIT` and those after it; with `resend` the first ones again."""
    early = F.col("timestamp") <= F.lit(STREAM_SPLIT)
    parts = [readings.filter(early), readings.filter(~early)]
    return [*parts, parts[0]] if resend else parts


@query
def stream_source(spark, sf_dir):
    session, out = stream_session(spark), workspace(spark, "source")
    land_messages(_in_steps(_written(session, sf_dir, "weather")), "weather", f"{out}/in")
    raw = messages.read_messages(session, f"{out}/in")
    parsed = messages.accepted(messages.parse_messages(raw, "weather"))
    (parsed.writeStream.format("parquet").option("path", f"{out}/rows")
     .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True)
     .start().awaitTermination())
    return spark.read.parquet(f"{out}/rows").select(*READING_KEYS, *measures_of("weather"))


@query
def stream_late_data(spark, sf_dir):
    """The first half sent again after the watermark passed it: each reading is kept once."""
    session, out = stream_session(spark), workspace(spark, "late")
    files = land_messages(_in_steps(_written(session, sf_dir, "air_quality"), resend=True), "air_quality", f"{out}/in")
    raw = messages.read_messages(session, f"{out}/in", per_trigger=files)
    kept = live.drop_repeats(messages.accepted(messages.parse_messages(raw, "air_quality")))
    (kept.writeStream.format("parquet").option("path", f"{out}/rows")
     .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True)
     .start().awaitTermination())
    return spark.read.parquet(f"{out}/rows").select(*READING_KEYS, *measures_of("air_quality"))


def _run_streams(spark, sf_dir, kinds, steps=_in_steps, **options):
    """One stream over the topics of `kinds`, a step of each in every micro-batch."""
    session, out = stream_session(spark), workspace(spark, "streams")
    files = [land_messages(steps(_written(session, sf_dir, kind)), kind, f"{out}/in/{kind}")
             for kind in kinds]
    run.start_streams(session, {kind: f"{out}/in/{kind}" for kind in kinds}, out, threshold=10.0, once=True,
                      per_trigger=sum(files), **options).awaitTermination()
    return out


def _stream_table(spark, out, name):
    return store.read(spark, out, name).drop("date", *RUN_COLUMNS)


@query
def stream_facts(spark, sf_dir):
    """Facts from two micro-batches, the second full of rows between those of the first: changes of rows
    that are stored already are written again."""
    def shuffled(readings):
        held_back = F.hour("timestamp") % 5 == 3
        return [readings.filter(~held_back), readings.filter(held_back)]

    out = _run_streams(spark, sf_dir, ["air_quality"], shuffled, delay=datetime.timedelta(days=1000))
    return _stream_table(spark, out, "facts/air_quality")


@query
def stream_metrics(spark, sf_dir):
    """Counts and null shares of each micro-batch before and after; the third is late throughout."""
    out = _run_streams(spark, sf_dir, ["air_quality"], lambda rows: _in_steps(rows, resend=True))
    return store.read(spark, out, "metrics").drop("processing_time", "records_per_second")


@query
def stream_late_rows(spark, sf_dir):
    """The readings that came after the watermark, with the watermark they missed."""
    out = _run_streams(spark, sf_dir, ["weather"], lambda rows: _in_steps(rows, resend=True))
    return store.read(spark, out, "late/weather").drop(ARRIVAL)


@query
def stream_foreach_batch(spark, sf_dir):
    """The same micro-batch handed in twice is stored once."""
    session, out = stream_session(spark), workspace(spark, "replay")
    topics = {"weather": f"{out}/in/weather"}
    files = land_messages(_in_steps(_written(session, sf_dir, "weather")), "weather", topics["weather"])
    process = run.batch_processor(out, ["weather"], "replay", lambda _: "replayed", threshold=10.0)

    def twice(batch: DataFrame, batch_id: int) -> None:
        process(batch, batch_id)
        process(batch, batch_id)

    parsed = messages.parse_topics(messages.read_topics(session, topics, per_trigger=files), topics)
    run.start_query(parsed, twice, "replay", f"{out}/checkpoint", once=True).awaitTermination()
    return _stream_table(spark, out, "facts/weather")


# --- jobs --------------------------------------------------------------------------------------

def _arrived(spark, sf_dir, kind):
    """All readings; of those that share an hour and place the last one observed arrived last."""
    rows = events.raw_readings(spark, sf_dir, kind).withColumn(ARRIVAL, F.col("observed_at"))
    return readers.as_readings(rows, kind)


@query
def batch_tables(spark, sf_dir):
    """The job's tables, found through the manifest of the snapshot it published."""
    out = workspace(spark, "pipeline")
    pipeline.run_batch(*[_arrived(spark, sf_dir, kind) for kind in ("air_quality", "weather")],
                       out=out, sites=events.stations(spark, sf_dir))
    return _contents({name: table for name, table in snapshots.read(spark, out).items()
                      if name != pipeline.QUARANTINE})


@query
def batch_quarantine(spark, sf_dir):
    """Readings of the year 9999 and of no place beside good ones: rows by rule, and rows published."""
    out, spoilt = workspace(spark, "spoilt"), {}
    for kind in ("air_quality", "weather"):
        rows = events.raw_readings(spark, sf_dir, kind).withColumn(ARRIVAL, F.col("observed_at"))
        far = F.lit("9999-12-31 05:00:00").cast("timestamp")
        rows = rows.withColumn("timestamp", F.when(F.col("k") == 50, far).otherwise(F.col("timestamp"))).withColumn(
            "location_key", F.when(F.col("k") != 51, F.col("location_key")))
        spoilt[kind] = readers.as_readings(rows, kind)
    pipeline.run_batch(spoilt["air_quality"], spoilt["weather"], out=out, sites=events.stations(spark, sf_dir))
    tables = snapshots.read(spark, out)
    held = tables[pipeline.QUARANTINE].groupBy("table", "rule").agg(F.count(F.lit(1)).alias("n_rows"))
    stored = [tables[name].agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table"), F.lit("published").alias("rule"), "n_rows")
        for name in (*pipeline.FACTS.values(), pipeline.HARMONIZED)]
    became = snapshots.manifest(spark, out)["notes"]["readings"]
    repeats = spark.createDataFrame([(f"raw_{kind}", "repeated", n["repeats"]) for kind, n in became.items()],
                                    "table string, rule string, n_rows bigint")
    return functools.reduce(DataFrame.union, [held, repeats, *stored])


@query
def stream_tables(spark, sf_dir):
    """Both topics in one stream: the contents of every table it stored."""
    out = _run_streams(spark, sf_dir, ["air_quality", "weather"])
    names = [f"{table}/{kind}" for kind in ("air_quality", "weather") for table in ("facts", "dead_letter")]
    return _contents({name: _stream_table(spark, out, name).drop("timestamp" if "dead" in name else "")
                      for name in names})


@query
def merged_facts(spark, sf_dir):
    """History from the batch job, the days after `STREAM_SPLIT` from the stream: both in one table."""
    out = workspace(spark, "both")
    session = stream_session(spark)
    topics = {kind: f"{out}/in/{kind}" for kind in ("air_quality", "weather")}
    readings = {kind: _written(spark, sf_dir, kind) for kind in topics}
    files = [land_messages(_in_steps(readings[kind]), kind, place) for kind, place in topics.items()]
    history = [readings[kind].filter(F.col("timestamp") <= F.lit(STREAM_SPLIT)) for kind in topics]
    done = pipeline.run(
        "both", lambda: pipeline.run_batch(*history, out=f"{out}/mart", sites=events.stations(spark, sf_dir)),
        lambda: run.start_streams(session, topics, f"{out}/live", once=True, per_trigger=sum(files)).awaitTermination(),
        lambda: merging.merge_facts(spark, f"{out}/mart", f"{out}/live", f"{out}/facts"))
    facts_of = [spark.read.parquet(path).drop("date", "year", "month", *RUN_COLUMNS) for path in done["merged"].values()]
    return facts_of[0].unionByName(facts_of[1], allowMissingColumns=True)
