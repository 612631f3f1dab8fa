"""The batch job end to end, and the physical plans the design counts on."""

import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from breezemart.operators import joins
from breezemart.operators.quality import DataQualityError, Rules, check
from breezemart.plans import dims, facts, pipeline
from breezemart.plans.harmonized import harmonize
from breezemart.plans.queries import comparable, content
from breezemart.sources import event_readings as events
from breezemart.sources import readers, snapshots


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.collect()
    return plan_of(frame)


@pytest.fixture
def raw(spark, sf_dir):
    return [readers.as_readings(events.raw_readings(spark, sf_dir, kind), kind)
            for kind in ("air_quality", "weather")]


def test_batch_job(spark, sf_dir, raw, tmp_path):
    out = str(tmp_path / "out")
    start, end = datetime.datetime(2024, 2, 1), datetime.datetime(2024, 3, 1)
    for _ in range(2):  # a second run replaces the first
        paths = pipeline.run_batch(*raw, out=out, start=start, end=end,
                                   sites=events.stations(spark, sf_dir), batch_id="b1",
                                   threshold=20.0)  # a few dozen readings only
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    assert set(tables) == {*pipeline.DIMENSIONS, *pipeline.FACTS.values(), pipeline.HARMONIZED, pipeline.QUARANTINE}
    assert snapshots.paths(spark, out) == paths and snapshots.versions(spark, out) == [1, 2]
    air = raw[0].filter(F.col("timestamp").between(start, end)).select("timestamp", "location_key").distinct()
    assert tables["AirQualityFact"].count() == air.count() > 0
    assert tables["AirQualityFact"].select("etl_batch_id").distinct().first()[0] == "b1"
    assert tables["TimeDim"].count() == 29 * 24
    assert tables["HarmonizedData"].filter("location_key is null or year <> 2024").count() == 0
    for fact, dimension, key in (("WeatherFact", "LocationDim", "location_key"),
                                 ("WeatherFact", "TimeDim", "time_key"),
                                 ("AirQualityFact", "AirQualityStatusDim", "status_key")):
        assert joins.orphans(tables[fact], tables[dimension], key, "f", "d").first().orphan_rows == 0
    assert "last_updated" in tables["LocationDim"].columns
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("breezemart")] == []


def test_batch_job_stops_on_bad_readings(raw, tmp_path):
    air = raw[0].withColumn("pm10", F.lit(None).cast("double"))
    with pytest.raises(DataQualityError, match="raw_air_quality: pm10 is null in 100.00%"):
        pipeline.run_batch(air, raw[1], out=str(tmp_path / "out"))


def test_a_failed_run_leaves_the_last_tables(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    paths = pipeline.run_batch(*raw, out=out, batch_id="good", threshold=20.0)
    site = raw[0].select("latitude", "longitude").first()
    half = raw[0].withColumn("us_aqi", F.when(F.hash("timestamp", "pm10") % 2 == 0, F.col("us_aqi")))
    with pytest.raises(DataQualityError, match="us_aqi is null"):
        pipeline.run_batch(half.union(raw[0].where(F.col("latitude") == site.latitude)), raw[1], out=out,
                           batch_id="bad", threshold=20.0)
    assert snapshots.paths(spark, out) == paths
    fact = snapshots.read(spark, out)["WeatherFact"]
    assert [r[0] for r in fact.select("etl_batch_id").distinct().collect()] == ["good"]
    assert fact.where("condition_key is null").isEmpty()
    runs = list((tmp_path / "out" / "_snapshots").iterdir())
    assert [sorted(p.name for p in run.iterdir() if not p.name.startswith(".")) for run in runs] == [sorted(paths)]


def test_cleaning_keeps_the_latest_arrival_and_is_not_drawn_to_high_values(spark):
    hour = datetime.datetime(2024, 1, 1)
    rows = [(hour, place, 1.0, 2.0, float(value), hour + datetime.timedelta(days=10 - value))
            for place in range(200) for value in (0, 1)]
    frame = spark.createDataFrame(rows, "timestamp timestamp, location_key bigint, latitude double, "
                                        "longitude double, pm10 double, ingestion_timestamp timestamp")
    assert pipeline.clean(frame).agg(F.sum("pm10")).first()[0] == 0
    drawn = pipeline.clean(frame.drop("ingestion_timestamp")).agg(F.count("*"), F.sum("pm10")).first()
    assert drawn[0] == 200 and 60 <= drawn[1] <= 140


def test_places_and_sites_that_share_a_key_are_one_row(spark):
    spots = spark.createDataFrame([(40.71281, -74.006), (40.71279, -74.006), (1.0, 2.0)],
                                  "latitude double, longitude double")
    texts = ["city", "region", "country", "continent", "timezone", "population_density", "urban_density"]
    sites = spots.limit(2).union(spots.limit(2)).select("*", *[F.lit("x").alias(t) for t in texts],
                                                        F.lit(1.0).alias("elevation"), F.lit(True).alias("is_coastal"))
    places = dims.location_dimension(spots, sites).collect()
    assert sorted((r.latitude, r.city) for r in places) == [(1.0, "Unknown"), (40.71279, "x")]
    with pytest.raises(DataQualityError, match="city repeats"):
        check(spots.withColumn("city", F.lit("x")), Rules("LocationDim", [], unique=["city"]))


def test_values_that_need_no_cut_stay(spark):
    frame = spark.sql("select explode(array(1e13, double('NaN'), double('Infinity'), -3e9, 1.5D)) as x")
    assert [str(r.x) for r in comparable(frame).collect()] == ["10000000000000.0", "nan", "inf", "-3000000000.0", "1.5"]


def test_job_modes():
    calls = []
    parts = dict(batch=lambda: calls.append("batch"), stream=lambda: calls.append("stream"))
    pipeline.run("both", **parts)
    pipeline.run("stream", **parts)
    assert calls == ["batch", "stream", "stream"]
    with pytest.raises(ValueError):
        pipeline.run("other", **parts)


def test_batch_queries_run_no_python(spark, sf_dir):
    for name in ("harmonized", "fact_air_quality", "fact_weather", "dim_time", "merge_latest",
                 "star_join", "dq_profile", "parse_messages"):
        plan = plan_of(entry.queries()[name](spark, sf_dir))
        assert "Python" not in plan and "Pandas" not in plan, name


def test_scan_reads_and_filters_only_what_is_needed(spark, sf_dir):
    plan = plan_of(entry.queries()["window_tumbling"](spark, sf_dir))
    assert "PushedFilters" in plan and "In(event_type, [click,error,view])" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_both_lags_share_one_sort_and_no_exchange(spark, sf_dir):
    readings = events.hourly_readings(spark, sf_dir, "air_quality")
    plan = plan_of(facts.air_quality_facts(readings))
    assert plan.count("lag(us_aqi") == 2
    assert len([line for line in plan.splitlines() if "Window [" in line and "lag(us_aqi" in line]) == 1
    assert plan.count("Sort [") == 1 and "Exchange" not in plan and "Bucketed: true" in plan
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("breezemart_parts")]


def test_small_dimensions_are_broadcast(spark, sf_dir, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(entry.queries()["star_join"](spark, sf_dir))
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 3


def hot_readings(spark, kind):
    """Two stations with ten thousand hours each, one with half of all rows."""
    hour = F.timestamp_seconds(F.lit(1_000_000_000) * 1 + F.col("id") * 3600)
    station = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 400)
    rows = spark.range(0, 40_000, numPartitions=8).select(
        hour.alias("timestamp"), station.cast("bigint").alias("location_key"),
        F.lit(1.0).alias("latitude"), station.cast("double").alias("longitude"),
        *[F.rand(3).alias(name) for name in
          (events.measures_of(kind) if kind == "weather" else events.measures_of(kind)[:-1])])
    return rows if kind == "weather" else rows.withColumn("us_aqi", F.lit(7))


def test_hot_station_is_cut_up_when_the_dimension_is_large(spark, conf, tmp_path):
    air, weather = hot_readings(spark, "air_quality"), hot_readings(spark, "weather")
    place = (weather.select("latitude", "longitude", "location_key").distinct()
             .withColumns({"elevation": F.lit(1.0), "climate_zone": F.lit("x")}))
    place.write.parquet(str(tmp_path / "place"))
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
         spark__sql__shuffle__partitions="16")
    table = harmonize(air, weather, spark.read.parquet(str(tmp_path / "place")))
    table.write.mode("overwrite").parquet(str(tmp_path / "warm"))
    assert "SortMergeJoin(skew=true)" in final_plan(table)
    assert spark.read.parquet(str(tmp_path / "warm")).count() == 40_000


def test_bucketed_staging_joins_without_a_shuffle(spark, sf_dir, raw, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    staged = []
    for kind, readings in zip(("air_quality", "weather"), raw):
        staged.append(pipeline.stage(readings, str(tmp_path / kind),
                                     Rules(kind, []), f"staged_{kind}")[0])
    location = dims.location_dimension(staged[0])
    plan = plan_of(harmonize(*staged, location))
    outer = plan[plan.index("FullOuter"):]
    outer = outer[:outer.index("Bucketed: true", outer.index("Bucketed: true") + 1)]
    assert "Exchange" not in outer
    for kind in ("air_quality", "weather"):
        spark.sql(f"DROP TABLE staged_{kind}")


def test_bucket_count_follows_the_shuffle_partitions(spark, conf):
    conf(spark__sql__shuffle__partitions="409600")
    assert pipeline._buckets(spark) == (65_536, True)
    conf(spark__sql__shuffle__partitions="200")
    assert pipeline._buckets(spark) == (200, False)


@pytest.mark.parametrize("parts", [3, 11, 13, 20])
def test_staging_writes_a_file_for_each_bucket_at_most(spark, raw, tmp_path, conf, parts):
    conf(spark__sql__shuffle__partitions=str(parts), spark__sql__sources__bucketing__maxBuckets="10",
         spark__sql__adaptive__enabled="false")
    table, _ = pipeline.stage(raw[0], str(tmp_path / "air"), Rules("air", []), f"staged_{parts}")
    assert len(list((tmp_path / "air").glob("*.parquet"))) <= min(parts, 10)
    assert table.count() == raw[0].select("timestamp", "location_key").distinct().count()
    spark.sql(f"DROP TABLE staged_{parts}")


def test_outer_join_edges(spark):
    columns = {"weather": events.measures_of("weather"), "air_quality": events.measures_of("air_quality")}

    def rows(kind, keys):
        schema = ", ".join(["timestamp timestamp", "location_key bigint",
                            *[f"{n} {'int' if n == 'us_aqi' else 'double'}" for n in columns[kind]]])
        filler = [1 if n == "us_aqi" else 1.0 for n in columns[kind]]
        return spark.createDataFrame([(*key, *filler) for key in keys], schema)

    one, two = datetime.datetime(2024, 2, 29, 1), datetime.datetime(2024, 2, 29, 2)
    place = spark.createDataFrame([(1, 40.0, 1.0, 10.0, "Temperate")],
                                  "location_key bigint, latitude double, longitude double, "
                                  "elevation double, climate_zone string")
    table = harmonize(rows("air_quality", [(one, 1), (None, 1), (two, 9)]),
                      rows("weather", [(one, 1), (two, 1), (two, 1)]), place).collect()
    found = sorted((r.timestamp, r.us_aqi, r.temperature_2m, r.day_of_week) for r in table
                   if r.timestamp == one)
    assert found == [(one, 1, 1.0, 5)]
    assert len(table) == 3  # repeats multiply; unknown places and missing times drop out
    assert all(r.us_aqi is None for r in table if r.timestamp == two)


@pytest.mark.parametrize("n", [0, 1, 1000, 100_000, 300_000])
def test_content_of_many_rows(spark, n):
    rows = spark.range(n)
    total = sum(int(hashlib.md5(str(i).encode()).hexdigest()[:12], 16) for i in range(n))
    found = rows.agg(*content(rows)).first()
    assert (found.n_rows, found.content) == (n, (total + 2**63) % 2**64 - 2**63)  # 2^63 is passed from some 65,000 rows on
