"""The batch job: readings to a staged, checked copy, then dimensions, facts and features.

All tables of a run are built and judged in a folder of that run and published as one snapshot
(`sources.snapshots`), so a run that fails at any step leaves the last one's tables as they were. Rows
that break a rule go to the table Quarantine of the same snapshot instead of ending the job.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breezemart.functions.keys import time_key
from breezemart.operators import quarantine
from breezemart.operators.merge import latest_per_key
from breezemart.operators.quality import Rules, check, judge, observed
from breezemart.plans import dims, facts
from breezemart.plans.harmonized import KEYS, harmonize
from breezemart.schemas import READING_KEYS, measures_of
from breezemart.sources import snapshots
from breezemart.sources.readers import between
from breezemart.sources.writers import write_partitioned, write_table

DIMENSIONS = ["TimeDim", "LocationDim", "WeatherConditionDim", "AirQualityStatusDim", "SeasonDim",
              "SeverityDim"]
FACTS = {"air_quality": "AirQualityFact", "weather": "WeatherFact"}
HARMONIZED = "HarmonizedData"
QUARANTINE = "Quarantine"

# Columns that may not be null in a stored table.
NOT_NULL = {
    "TimeDim": ["time_key", "full_date", "year", "quarter", "month", "day", "hour", "day_of_week",
                "is_weekend", "is_holiday"],
    "LocationDim": ["location_key", "latitude", "longitude", "city", "region", "climate_zone"],
    "WeatherConditionDim": ["condition_key", "weather_code", "description", "category",
                            "severity_level"],
    "AirQualityStatusDim": ["status_key", "aqi_category", "health_implications",
                            "cautionary_statement", "color_code"],
    "SeasonDim": ["season_key", "season_name", "start_month", "end_month"],
    "SeverityDim": ["severity_key", "severity_level", "severity_name", "description",
                    "recommended_actions", "alert_level"],
    "AirQualityFact": ["timestamp", "location_key", "status_key"],
    "WeatherFact": ["timestamp", "location_key", "condition_key", "severity_key", "season_key"],
    "HarmonizedData": ["timestamp", "location_key", "year", "month"],
}

# What a row of a dimension is known by. The time dimension has one per minute as readings have.
UNIQUE = {"TimeDim": "timestamp", "LocationDim": "location_key", "WeatherConditionDim": "condition_key",
          "AirQualityStatusDim": "status_key", "SeasonDim": "season_key", "SeverityDim": "severity_key"}

# Row order inside the files of a stored table.
CLUSTER = {
    "TimeDim": ["full_date", "hour"],
    "AirQualityFact": ["location_key", "status_key", "timestamp"],
    "WeatherFact": ["location_key", "severity_key", "timestamp"],
    "HarmonizedData": ["location_key", "timestamp"],
}


def reading_rules(kind: str, threshold: float = 10.0) -> Rules:
    return Rules(f"raw_{kind}", measured=["timestamp", "location_key", *measures_of(kind)],
                 threshold=threshold)


def clean(readings: DataFrame, arrival: str = "ingestion_timestamp") -> DataFrame:
    """One reading per (timestamp, location); rows without either are left out.

    The latest `arrival` stays, where the readings have that column. Without it, and between equal
    ones, a hash of the row decides: repeatable, and no bias to high or low values.
    """
    keyed = readings.select(*READING_KEYS, *[c for c in readings.columns if c not in READING_KEYS])
    drawn = F.xxhash64(*keyed.columns)
    rank = [F.col(arrival), drawn] if arrival in keyed.columns else [drawn]
    return latest_per_key(keyed.dropna(subset=KEYS), KEYS, rank)


def reading_constraints() -> dict:
    """What a reading needs to be a row of any table: a place, and a time that has a time key."""
    return quarantine.not_null(KEYS) | {"time_key must not be null": time_key("timestamp").isNotNull()}


def stage(readings: DataFrame, path: str, rules: Rules, table: str, held: str | None = None,
          batch_id: str = "batch") -> tuple[DataFrame, dict[str, int]]:
    """Clean and write the readings once, bucketed by the outer join's keys, and read them back.

    Everything later scans this columnar copy instead of parsing files and reducing repeats
    again, losing an executor costs no recomputation, and the outer join needs no shuffle: the
    reduction has left the rows hashed by these keys into as many parts as there are buckets.
    Null counts ride along with the write; they are of the readings as they came, before cleaning.
    Readings that break `reading_constraints` are appended to the quarantine at `held`.

    Also returns how many readings were read, quarantined, left out as repeats and kept.
    """
    spark, constraints = readings.sparkSession, reading_constraints()
    watched, nulls = observed(readings, rules)
    good, _, observation = quarantine.split(watched, constraints)
    buckets, spread = _buckets(spark)
    cleaned = clean(good)
    if spread:
        cleaned = cleaned.repartition(buckets, *KEYS)
    cleaned.write.mode("overwrite").bucketBy(buckets, *KEYS).option("path", path).saveAsTable(table)
    judge(nulls.get, readings, rules)
    rows, broken = quarantine.counted(observation, constraints)
    if broken and held:
        _, bad, _ = quarantine.split(readings, constraints)
        quarantine.quarantined(bad, rules.table, batch_id).drop("table").write.mode("append").parquet(
            f"{held}/table={rules.table}")
    quarantine.judge_share(rules.table, rows, broken, rules.threshold)
    kept = spark.table(table).count()
    gone = sum(broken.values())
    return spark.table(table), {"read": rows, "quarantined": gone, "repeats": rows - gone - kept, "kept": kept}


def _buckets(spark: SparkSession) -> tuple[int, bool]:
    """The number of buckets, and whether the rows must be dealt out once more to match it.

    As many buckets as shuffle partitions put each partition into one bucket. Where Spark allows
    fewer, it is the largest power of two allowed, and one more exchange of the reduced rows makes
    one file a bucket, in place of one for each partition and bucket.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return (parts, False) if parts <= most else (1 << (most.bit_length() - 1), True)


def run_batch(air: DataFrame, weather: DataFrame, out: str, start: datetime.datetime | None = None,
              end: datetime.datetime | None = None, sites: DataFrame | None = None,
              batch_id: str = "batch", threshold: float = 10.0, keep: int = snapshots.KEEP) -> dict[str, str]:
    """Build all nine tables, judge them, then publish them under `out`; returns table name to path.

    The paths, Quarantine among them, are those of the snapshot this run published; `snapshots.read`
    finds the newest. `start` and `end` filter the readings and extend the time dimension, both only
    if both are given. Dimensions are written before the tables that join them, so those joins plan
    with the dimension's real size. `threshold` limits null % per measure and the share of rows in
    quarantine. The snapshot's notes hold what became of the readings.
    """
    spark: SparkSession = air.sparkSession
    run_id = uuid.uuid4().hex[:12]
    folder = snapshots.run_folder(out, run_id)
    built = {name: f"{folder}/{name}" for name in [*DIMENSIONS, *FACTS.values(), HARMONIZED, QUARANTINE]}
    names = {kind: f"breezemart_{kind}_{run_id}" for kind in FACTS}
    readings, became = {}, {}
    try:
        # so that the table is there without a broken row, too
        empty = spark.createDataFrame([], quarantine.SCHEMA).drop("table")
        empty.coalesce(1).write.parquet(f"{built[QUARANTINE]}/table=none")
        for kind, raw in (("air_quality", air), ("weather", weather)):
            readings[kind], became[kind] = stage(
                between(raw, start, end), f"{folder}/staging/{kind}", reading_rules(kind, threshold), names[kind],
                built[QUARANTINE], batch_id)
        _build(readings["air_quality"], readings["weather"], built, start, end, sites, batch_id, threshold)
        snapshots.publish(spark, out, run_id, built, {"batch_id": batch_id, "readings": became}, keep)
    finally:
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        # a publication that failed half-way may still have happened: what a manifest names stays
        done = snapshots.published(spark, out, run_id)
        snapshots.remove(spark, f"{folder}/staging" if done else folder)
    return built


def _build(air: DataFrame, weather: DataFrame, paths: dict[str, str], start, end,
           sites: DataFrame | None, batch_id: str, threshold: float) -> None:
    spark = air.sparkSession
    positions = air.select("latitude", "longitude").union(weather.select("latitude", "longitude"))
    built = {
        "TimeDim": dims.time_dimension(air, weather, start, end),
        "LocationDim": dims.stamped(dims.location_dimension(positions, sites)),
        "WeatherConditionDim": dims.weather_condition_dimension(weather),
        "AirQualityStatusDim": dims.stamped(dims.air_quality_status_dimension(air)),
        "SeasonDim": dims.season_dimension(spark),
        "SeverityDim": dims.severity_dimension(spark),
    }

    def store(table: DataFrame, name: str) -> None:
        """By year and month where the table has a cluster order; its NOT NULL rules split it."""
        def write(good: DataFrame) -> None:
            if name in CLUSTER:
                write_partitioned(good, paths[name], cluster=CLUSTER[name])
            else:
                write_table(good, paths[name])

        quarantine.store(table, quarantine.not_null(NOT_NULL[name]), write, paths[QUARANTINE], name, batch_id,
                         threshold)

    def write_dimension(name: str) -> None:
        store(built[name], name)
        check(spark.read.parquet(paths[name]), Rules(name, [], unique=[UNIQUE[name]]))

    def write_fact(kind: str, readings: DataFrame) -> None:
        fact = facts.FACT_BUILDERS[kind](readings)
        store(facts.processed(fact, batch_id), FACTS[kind])

    def write_features() -> None:
        location = spark.read.parquet(paths["LocationDim"])
        store(harmonize(air, weather, location), HARMONIZED)

    _together(spark, [partial(write_dimension, name) for name in DIMENSIONS])
    _together(spark, [partial(write_fact, "air_quality", air),
                      partial(write_fact, "weather", weather), write_features])


def _together(spark: SparkSession, jobs: list[Callable[[], None]]) -> None:
    """Independent Spark jobs at the same time, so that one's last tasks leave no core idle."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(inherit(job)) for job in jobs]:
            done.result()


def run(mode: str, batch=None, stream=None, merge=None) -> dict:
    """Batch, stream or both; batch always finishes first, and with both, `merge` puts the streamed rows
    into the batch's tables last. The parts are callables."""
    if mode not in ("batch", "stream", "both"):
        raise ValueError("mode must be batch, stream or both")
    done = {}
    if mode in ("batch", "both"):
        done["batch"] = batch()
    if mode in ("stream", "both"):
        done["stream"] = stream()
    if mode == "both" and merge is not None:
        done["merged"] = merge()
    return done
