"""Live path over message files, one micro-batch per step."""

import datetime
import json
import os
import time

import pytest

from breezemart.operators.quality import DataQualityError
from breezemart.plans import facts, queries
from breezemart.schemas import AIR_MEASURES, WEATHER_MEASURES
from breezemart.sources import snapshots
from breezemart.streaming import live, merging, messages, run, store

START = datetime.datetime(2025, 1, 1)


def message(hour, place=1.0, aqi=50.0, measures=AIR_MEASURES, **values):
    stamp = (START + datetime.timedelta(hours=hour)).isoformat()
    measures = {name: 1.0 for name in measures} | ({"us_aqi": aqi} if "us_aqi" in measures else {}) | values
    return json.dumps({
        "metadata": {"timestamp": stamp, "location": {"latitude": place, "longitude": 2.0}},
        "current_conditions": {"timestamp": stamp, "values": measures}})


def land(folder, number, lines):
    """File times a second apart keep the order of the files."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{number:03d}.txt")
    with open(path, "w") as file:
        file.write("\n".join(lines) + "\n")
    os.utime(path, (time.time() - 1000 + number, time.time() - 1000 + number))


def drain(spark, folder, out, **options):
    """Run the air-quality stream over what has landed, one file per micro-batch."""
    run.start_streams(spark, {"air_quality": folder}, out, once=True, per_trigger=1, **options).awaitTermination()
    return store.read(spark, out, "facts/air_quality")


def batch_facts(spark, *folders):
    """What the batch build makes of the same messages."""
    raw = spark.read.text(list(folders))
    return facts.air_quality_facts(messages.accepted(messages.parse_messages(raw, "air_quality")))


def same_rows(found, expected):
    found = found.select(*expected.columns)
    return expected.exceptAll(found).isEmpty() and found.exceptAll(expected).isEmpty()


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "out")


def test_changes_reach_across_batches_like_a_batch_run(spark, folders):
    source, out = folders
    aqi = [10 + (i * 37) % 300 for i in range(60)]
    for number, hours in enumerate((range(0, 10), range(10, 30), range(30, 60))):
        land(source, number, [message(h, aqi=float(aqi[h])) for h in hours]
             + [message(h, place=5.0, aqi=float(h)) for h in hours if h % 7 == 0])
    found = drain(spark, source, out)
    assert len(store.segments(store.state(spark, out), "facts/air_quality")) == 3
    assert same_rows(found, batch_facts(spark, source))


def test_a_row_that_comes_late_but_in_time_corrects_the_rows_after_it(spark, folders):
    source, out = folders
    aqi = [10 + (i * 37) % 300 for i in range(90)]
    order = [[h for h in range(90) if h % 9 not in (2, 4)], [h for h in range(90) if h % 9 == 4],
             [h for h in range(90) if h % 9 == 2 and h > 3]]
    for number, hours in enumerate(order):
        land(source, number, [message(h, aqi=float(aqi[h])) for h in hours])
    found = drain(spark, source, out, delay=datetime.timedelta(hours=200))
    assert same_rows(found, batch_facts(spark, source))
    history = spark.read.parquet(f"{out}/{store.state(spark, out)['tables']['history_air_quality']}")
    assert history.count() == found.count() == 89


def test_history_holds_24_rows_before_the_watermark(spark, folders):
    source, out = folders
    for number, hours in enumerate((range(0, 60), range(60, 63))):
        land(source, number, [message(h) for h in hours] + [message(h, place=7.0) for h in hours if h % 20 == 0])
    drain(spark, source, out, delay=datetime.timedelta(hours=5))
    history = spark.read.parquet(f"{out}/{store.state(spark, out)['tables']['history_air_quality']}")
    counts = {r.latitude: r["count"] for r in history.groupBy("latitude").count().collect()}
    assert counts == {1.0: 24 + 6, 7.0: 4}


def test_no_python_in_the_stream(spark, folders):
    source, _ = folders
    land(source, 0, [message(0)])
    topics = {"air_quality": source}
    parsed = messages.parse_topics(messages.read_topics(spark, topics), topics)
    assert parsed.isStreaming
    bounded = messages.parse_topics(spark.read.text(source).withColumn("topic", messages.F.lit("in")), topics)
    settled = live.with_history(messages.accepted(bounded).drop("kind"), None, "air_quality", None)
    plan = facts.air_quality_facts(live.kept_history(settled, START))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    types = dict(settled.dtypes)
    assert types["_previous_1"] == types["us_aqi"] == "int"


def test_two_topics_in_one_stream(spark, folders):
    source, out = folders
    land(f"{source}/a ir", 0, [message(0), message(1, aqi=70.0), "{oops"])
    land(f"{source}/weather", 1, [message(h, measures=WEATHER_MEASURES) for h in range(4)])
    land(f"{source}/other", 2, [message(9)])  # no topic of the stream
    run.start_streams(spark, {"air_quality": f"{source}/a ir", "weather": f"{source}/weather"}, out, once=True
                      ).awaitTermination()
    assert store.read(spark, out, "facts/air_quality").count() == 2
    weather = store.read(spark, out, "facts/weather")
    assert weather.count() == 4 and "us_aqi" not in weather.columns
    assert store.read(spark, out, "dead_letter/air_quality").first().original_data == "{oops"
    assert store.tables(store.state(spark, out)) == ["dead_letter/air_quality", "facts/air_quality", "facts/weather", "metrics"]
    with pytest.raises(ValueError, match="one folder"):
        messages.read_topics(spark, {"air_quality": f"{source}/x", "weather": f"{out}/y"})


def test_a_trigger_is_bounded_without_being_told(spark, folders, monkeypatch):
    source, out = folders
    for number in range(3):
        land(source, number, [message(number)])
    monkeypatch.setattr(messages, "BYTES_PER_TRIGGER", 10)
    run.start_streams(spark, {"air_quality": source}, out, once=True).awaitTermination()
    assert len(store.segments(store.state(spark, out), "facts/air_quality")) == 3


def test_restart_adds_nothing_and_goes_on(spark, folders):
    source, out = folders
    land(source, 0, [message(h) for h in range(3)])
    assert drain(spark, source, out).count() == 3
    assert drain(spark, source, out).count() == 3
    land(source, 1, [message(3, aqi=80.0)])
    found = drain(spark, source, out)
    assert found.count() == 4
    assert found.filter("us_aqi = 80").first().aqi_change_1h == 30


def test_bad_messages_go_to_the_dead_letters(spark, folders):
    source, out = folders
    far = json.loads(message(0))
    far["current_conditions"]["timestamp"] = "9999-12-31T00:00:00"
    land(source, 0, [message(0), "{oops", json.dumps({"metadata": {}}), json.dumps(far)])
    assert drain(spark, source, out).count() == 1
    letters = store.read(spark, out, "dead_letter/air_quality").collect()
    assert {r.original_data: r.error for r in letters} == {
        "{oops": "malformed JSON", '{"metadata": {}}': "missing timestamp",
        json.dumps(far): "timestamp out of range"}


def test_repeats_and_late_rows_are_dropped(spark, folders):
    source, out = folders
    land(source, 0, [message(0), message(0), message(1)])
    land(source, 1, [message(1), message(10)])  # a repeat within the watermark
    land(source, 2, [message(11)])
    land(source, 3, [message(2), message(12)])  # hour 2 is late: drops start a batch after the move
    found = drain(spark, source, out)
    assert sorted(r.timestamp.hour for r in found.select("timestamp").collect()) == [0, 1, 10, 11, 12]
    late = store.read(spark, out, "late/air_quality").collect()
    assert [(r.timestamp.hour, r.stream_batch, r.watermark.hour) for r in late] == [(2, "3", 10)]
    rows = {r.stream_batch: r for r in store.read(spark, out, "metrics").where("stream_name like '%pre'").collect()}
    assert [(rows[b].late_count, rows[b].repeat_count) for b in "0123"] == [(0, 1), (0, 1), (0, 0), (1, 0)]


def test_metrics_before_and_after(spark, folders):
    source, out = folders
    land(source, 0, [message(0), message(1, pm10=None), "no JSON"])
    drain(spark, source, out)
    rows = {r.stream_name: r for r in store.read(spark, out, "metrics").collect()}
    assert rows["air_quality_pre"].record_count == rows["air_quality_post"].record_count == 2
    assert rows["air_quality_pre"].null_percentage == pytest.approx(100 * 1 / 20)
    assert rows["air_quality_pre"].records_per_second > 0
    assert rows["air_quality_pre"].rejected_count == 1


def test_failed_gate_stores_nothing(spark, folders):
    source, out = folders
    land(source, 0, [message(h, pm10=None) for h in range(4)])
    with pytest.raises(Exception, match="pm10 is null in 100.00%"):
        drain(spark, source, out, threshold=10.0)
    assert store.state(spark, out)["version"] == 0


def test_missing_columns_are_an_error(spark, folders):
    process = run.batch_processor(folders[1], ["air_quality"], "run", lambda _: "s")
    frame = spark.createDataFrame([("t", None)], "original_data string, error string")
    with pytest.raises(DataQualityError, match="us_aqi"):
        process(frame, 0)


def parsed_batch(spark, hours):
    raw = spark.createDataFrame([(message(h), "t") for h in hours], "value string, topic string")
    return messages.parse_topics(raw, {"air_quality": "t"})


def test_replays_and_failed_commits_are_counted_once(spark, folders, monkeypatch):
    out = folders[1]
    process = run.batch_processor(out, ["air_quality"], "run", lambda _: "s")
    process(parsed_batch(spark, range(5)), 0)
    process(parsed_batch(spark, range(5)), 0)  # committed already
    assert store.state(spark, out)["version"] == 1
    with monkeypatch.context() as patched:
        patched.setattr(snapshots, "_rename", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            process(parsed_batch(spark, range(5, 9)), 1)
    assert store.read(spark, out, "facts/air_quality").count() == 5
    for _ in range(2):
        process(parsed_batch(spark, range(5, 9)), 1)
    assert store.read(spark, out, "facts/air_quality").count() == 9
    assert store.read(spark, out, "metrics").where("stream_name like '%pre'").count() == 2


def test_a_new_checkpoint_keeps_what_is_stored(spark, folders):
    source, out = folders
    land(source, 0, [message(h) for h in range(3)])
    assert drain(spark, source, out).count() == 3
    land(source, 1, [message(h, aqi=60.0) for h in range(3, 6)])
    found = drain(spark, source, out, checkpoint=f"{out}/checkpoints/second")
    assert found.count() == 6  # what the new stream reads again is late or there already
    assert same_rows(found, batch_facts(spark, source))
    assert len(store.state(spark, out)["notes"]["streams"]) == 2


def test_segments_are_merged_and_their_number_is_bounded(spark, folders):
    source, out = folders
    aqi = [10 + (i * 37) % 300 for i in range(40)]
    hours = [h for h in range(40) if h % 3] + [h for h in range(40) if h % 3 == 0]
    for number in range(10):
        land(source, number, [message(h, aqi=float(aqi[h])) for h in hours[number * 4:number * 4 + 4]])
    found = drain(spark, source, out, merge=3, delay=datetime.timedelta(hours=100))
    manifest = store.state(spark, out)
    assert sorted(tier for _, tier, _, _ in store.segments(manifest, "facts/air_quality")) == [0, 2]
    assert len(store.segments(manifest, "metrics")) == 2
    assert store.read(spark, out, "metrics").where("stream_name like '%pre'").count() == 10
    assert same_rows(found, batch_facts(spark, source))
    folders_left = os.listdir(f"{out}/_snapshots")
    assert len(folders_left) <= 12
    # no tier holds more than two segments, so files grow with the logarithm of the micro-batches
    merged = next(p for _, tier, _, p in store.segments(manifest, "facts/air_quality") if tier == 2)
    days = os.listdir(f"{out}/{merged}")
    assert {len([f for f in os.listdir(f"{out}/{merged}/{d}") if f.endswith(".parquet")])
            for d in days if d.startswith("date=")} == {1}


def test_streamed_days_are_merged_into_history_and_others_keep_their_files(spark, folders, tmp_path):
    source, out = folders
    land(source, 0, [message(h, aqi=float(h)) for h in range(72)])
    path = str(tmp_path / "fact")
    whole = drain(spark, source, out)
    merging.write_clustered(whole.drop("date"), path, "date", ["location_key"])

    def files():
        return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet"))
                for d in os.listdir(path) if d.startswith("date=")}

    before = files()
    new = whole.drop("date").where("hour(timestamp) < 2 and day(timestamp) = 2").withColumn("us_aqi", messages.F.lit(500))
    for _ in range(2):
        assert merging.upsert_days(spark, path, new) == ["2025-01-02"]
    after = files()
    assert before.keys() == after.keys()
    assert {d for d in after if after[d] != before[d]} == {"date=2025-01-02"}
    stored = spark.read.parquet(path)
    assert stored.count() == 72 and stored.where("us_aqi = 500").count() == 2
    assert merging.upsert_days(spark, path, new.limit(0)) == []


def test_merged_days_take_the_latest_of_several_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    columns = "timestamp timestamp, location_key bigint, us_aqi int"
    noon = datetime.datetime(2025, 1, 2, 12)
    spark.createDataFrame([(noon, 1, 10), (noon, 2, 20)], columns).withColumn(
        "date", messages.F.to_date("timestamp")).write.partitionBy("date").parquet(path)
    rows = spark.createDataFrame([(noon, 1, 7, 3), (noon, 1, 5, 4), (noon, 1, 9, 2), (noon, 3, 1, 1)], f"{columns}, _seq bigint")
    for _ in range(2):
        assert merging.upsert_days(spark, path, rows, "_seq") == ["2025-01-02"]
        stored = spark.read.parquet(path)
        assert set(stored.columns) == {"timestamp", "location_key", "us_aqi", "date"}
        assert sorted((r.location_key, r.us_aqi) for r in stored.collect()) == [(1, 5), (2, 20), (3, 1)]


def test_readings_of_a_stream_are_derived_once(spark, sf_dir, monkeypatch):
    derived, plain = [], queries.events.hourly_readings
    monkeypatch.setattr(queries.events, "hourly_readings", lambda *a: derived.append(a[2]) or plain(*a))
    monkeypatch.setattr(queries.run, "start_streams", lambda *a, **b: (_ for _ in ()).throw(InterruptedError))
    with pytest.raises(InterruptedError):
        queries.QUERIES["stream_tables"](spark, sf_dir)
    assert derived == ["air_quality", "weather"]
    readings = queries._written(spark, sf_dir, "weather")
    plan = readings._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and sorted(readings.collect()) == sorted(plain(spark, sf_dir, "weather").collect())


def test_write_is_tried_three_times():
    tries = []

    def fails_twice():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("storage away")

    run.written(fails_twice, "x")
    assert len(tries) == 3
    with pytest.raises(OSError):
        run.written(lambda: (_ for _ in ()).throw(OSError("away")), "x")


def test_kafka_needs_its_connector(spark):
    with pytest.raises(ValueError):
        messages.read_messages(spark, "x", source="queue")
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.read_messages(spark, "topic", source="kafka", servers="broker:9092")


def test_state_survives_missing_values(spark, folders):
    source, out = folders
    land(source, 0, [message(0, aqi=None), message(1, aqi=20.0)])
    land(source, 1, [message(2, aqi=25.0), message(3, aqi=None), message(4, aqi=30.0)])
    found = {r.timestamp.hour: r.aqi_change_1h for r in drain(spark, source, out).collect()}
    assert found == {0: None, 1: None, 2: 5, 3: None, 4: None}
