import datetime
import random

import pytest
from pyspark.sql import functions as F

from breezemart.operators import lags
from breezemart.operators.lags import row_lags
from breezemart.operators.merge import latest_per_key, merge_batch_and_stream, tumbling_window
from breezemart.operators.positions import with_position
from breezemart.plans import facts
from breezemart.schemas import AIR_MEASURES
from breezemart.session import staged
from breezemart.sources import event_readings as events

START = datetime.datetime(2024, 1, 1)
STEPS = {"back_1": 1, "back_24": 24}


def uneven_series():
    """One station with most rows, one with long gaps, one with few rows; some values missing."""
    rng = random.Random(5)
    rows = [("hot", START + datetime.timedelta(minutes=10 * i)) for i in range(3000)]
    stamp = START
    for _ in range(120):
        stamp += datetime.timedelta(hours=rng.choice([1, 1, 2, 30, 24 * 45]))
        rows.append(("gaps", stamp))
    rows += [("few", START + datetime.timedelta(days=200 * i)) for i in range(3)]
    return [(key, stamp, None if rng.random() < 0.1 else rng.randrange(1000)) for key, stamp in rows]


def brute_force(rows):
    expected = {}
    for key in {r[0] for r in rows}:
        series = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        for i, (_, stamp, _) in enumerate(series):
            expected[key, stamp] = tuple(
                series[i - step][2] if i >= step else None for step in STEPS.values())
    return expected


@pytest.fixture
def parts(conf):
    """Cut lags into that many parts, empty ones included."""
    return lambda n: conf(spark__sql__shuffle__partitions=str(n),
                          spark__sql__adaptive__coalescePartitions__enabled="false")


@pytest.mark.parametrize("n", [1, 3, 40, 400])
def test_lags_equal_brute_force_however_they_are_cut(spark, parts, n):
    parts(n)
    rows = uneven_series()
    frame = spark.createDataFrame(rows, "location_key string, timestamp timestamp, value int")
    found = row_lags(frame.repartition(5), "value", STEPS).collect()
    assert {(r.location_key, r.timestamp): (r.back_1, r.back_24) for r in found} == brute_force(rows)
    assert len(found) == len(rows)


def test_a_station_with_nearly_all_rows_in_one_day_is_cut_evenly(spark, parts, monkeypatch):
    parts(10)
    kept, real = [], lags._guests
    monkeypatch.setattr(lags, "_guests", lambda cut, *more: kept.append(cut) or real(cut, *more))
    second = F.when(F.col("id") < 9900, F.col("id") * 8).otherwise(F.col("id") * 100_000)
    frame = spark.range(10_000).select(F.lit("hot").alias("location_key"), F.col("id").alias("value"),
                                       F.timestamp_seconds(second).alias("timestamp"))
    found = row_lags(frame, "value", STEPS)
    assert max(r["count"] for r in kept[0].groupBy("_part").count().collect()) <= 2000
    assert found.where("back_1 = value - 1 and (back_24 = value - 24 or value < 24)").count() == 9999


def test_tails_are_handed_on_block_by_block(spark, monkeypatch):
    """400 parts of one station, in blocks of 8: no window and no group holds more than a block."""
    monkeypatch.setattr(lags, "BLOCK", 8)
    rng, rows = random.Random(9), []
    for part in range(400):
        if part % 37 != 5:  # a part may hold no row of the station
            rows.append(("hot", part, [(part * 100 + i, part * 100 + i) for i in range(rng.choice([1, 2, 24, 24]))]))
        if part in (3, 4, 200):
            rows.append(("b", part, [(part, part)]))
    ends = spark.createDataFrame(rows, "k string, _part int, _tail array<struct<t:int,v:int>>")
    levels = []
    monkeypatch.setattr(lags, "staged", lambda df, name: levels.append(staged(df, name)) or levels[-1])
    found = {(r.k, r["_part"]): [x.v for x in r["_before"]] for r in lags.rows_before(ends, "k", 24, 400).collect()}
    for key, part, _ in rows:
        earlier = [v for k, p, tail in rows if k == key and p < part for v, _ in tail]
        assert found[key, part] == earlier[-24:], (key, part)
    assert len(found) == len(rows)
    assert [level.where("k = 'hot'").count() for level in levels] == [50, 7]
    sizes = [frame.groupBy("k", F.floor(F.col("_part") / 8)).count().agg(F.max("count")).first()[0]
             for frame in [ends, *levels]]
    assert max(sizes) <= 8


def test_few_rows_are_handed_on(spark, parts, monkeypatch):
    parts(20)
    kept, real = [], lags._guests
    monkeypatch.setattr(lags, "_guests", lambda *a: kept.append(real(*a)) or kept[-1])
    frame = spark.range(40_000).select((F.col("id") % 500 * (F.col("id") % 3 > 0).cast("int")).alias("location_key"),
                                       F.timestamp_seconds("id").alias("timestamp"), F.col("id").alias("value"))
    assert row_lags(frame, "value", STEPS).count() == 40_000
    assert 0 < kept[0].count() <= 24 * 20


def test_one_instant_cannot_be_cut_but_is_whole(spark, parts):
    parts(7)
    frame = spark.range(50).select(F.lit("a").alias("location_key"), F.lit(START).alias("timestamp"),
                                   F.col("id").alias("value"))
    assert row_lags(frame, "value", STEPS).count() == 50


def test_facts_do_not_depend_on_the_cut(spark, sf_dir, parts):
    for kind, build in facts.FACT_BUILDERS.items():
        readings = events.hourly_readings(spark, sf_dir, kind)
        whole = build(readings)
        parts(50)
        cut = build(readings)
        assert whole.exceptAll(cut).count() == 0 and cut.exceptAll(whole).count() == 0


def test_rows_without_time_or_place_are_no_facts(spark):
    columns = ", ".join(["timestamp timestamp", "location_key bigint",
                         *[f"{n} double" for n in AIR_MEASURES if n != "us_aqi"], "us_aqi int"])
    blank = [1.0] * 9 + [10]
    rows = spark.createDataFrame([(START, 1, *blank), (None, 1, *blank), (START, None, *blank)], columns)
    assert facts.air_quality_facts(rows).count() == 1
    assert facts.air_quality_facts(rows, derived=False).count() == 1


def test_merge_prefers_stream_then_arrival(spark):
    def at(hour, minute=0):
        return START + datetime.timedelta(hours=hour, minutes=minute)

    columns = "timestamp timestamp, location_key bigint, pm2_5 double, ingestion_timestamp timestamp"
    history = spark.createDataFrame(
        [(at(1), 1, 1.0, at(9)), (at(1), 2, 2.0, at(1)), (at(1), 2, 3.0, at(2)), (at(2), 1, 4.0, at(2))],
        columns)
    stream = spark.createDataFrame([(at(1), 1, 10.0, at(2)), (at(1), 1, 11.0, at(1)), (at(3), 1, 12.0, at(3))],
                                   columns)
    rows = merge_batch_and_stream(history, stream, sort=True).orderBy("position").collect()
    assert [r.position for r in rows] == [1, 2, 3, 4]
    assert [(r.timestamp, r.location_key, r.pm2_5, r.source) for r in rows] == [
        (at(1), 1, 10.0, "stream"), (at(1), 2, 3.0, "batch"), (at(2), 1, 4.0, "batch"),
        (at(3), 1, 12.0, "stream")]


def test_copies_are_reduced_before_the_shuffle(spark):
    copies = spark.range(0, 20000, numPartitions=4).select(
        F.when(F.col("id") < 15000, 1).otherwise(F.col("id")).alias("key"), F.col("id").alias("v"))
    frame = latest_per_key(copies, ["key"], [F.col("v")])
    assert frame.filter("key = 1").first().v == 14999
    assert frame.count() == 5001
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_window_start_and_end(spark):
    frame = spark.createDataFrame([(START + datetime.timedelta(minutes=75),)], "timestamp timestamp")
    row = tumbling_window(frame).first()
    assert (row.window_start, row.window_end) == (START + datetime.timedelta(hours=1),
                                                  START + datetime.timedelta(hours=2))


def test_positions_are_global_without_one_task(spark, parts):
    parts(7)
    frame = spark.range(3000).select(((F.col("id") * 7919) % 3001).alias("a"), (F.col("id") % 5).alias("b"))
    found = with_position(frame, ["b", "a"], "at")
    rows = found.collect()
    assert [r["at"] for r in sorted(rows, key=lambda r: (r.b, r.a))] == list(range(1, 3001))
    assert with_position(frame.limit(0), ["a"]).count() == 0
    assert found.select(F.col("at")).agg(F.sum("at")).first()[0] == 3000 * 3001 // 2
