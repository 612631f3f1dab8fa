"""Snapshots: all tables of a run or none, whatever step fails; rows that break a rule are set aside."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from breezemart.operators import quarantine
from breezemart.operators.quality import DataQualityError
from breezemart.plans import pipeline
from breezemart.sources import event_readings as events
from breezemart.sources import readers, snapshots

NINE = {*pipeline.DIMENSIONS, *pipeline.FACTS.values(), pipeline.HARMONIZED}


def write_run(spark, root, run, names=("a", "b"), value=None):
    built = {name: f"{snapshots.run_folder(root, run)}/{name}" for name in names}
    for path in built.values():
        spark.createDataFrame([(value or run,)], "run string").write.parquet(path)
    return built


def runs_read(spark, root):
    return {name: frame.first().run for name, frame in snapshots.read(spark, root).items()}


def test_readers_go_from_one_snapshot_to_the_next(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        snapshots.manifest(spark, root)
    assert snapshots.publish(spark, root, "one", write_run(spark, root, "one")) == 1
    assert snapshots.publish(spark, root, "two", write_run(spark, root, "two"), {"n": 5}) == 2
    assert runs_read(spark, root) == {"a": "two", "b": "two"}
    assert {n: f.first().run for n, f in snapshots.read(spark, root, 1).items()} == {"a": "one", "b": "one"}
    assert snapshots.manifest(spark, root)["notes"] == {"n": 5}
    assert snapshots.published(spark, root, "one") and not snapshots.published(spark, root, "on")


def test_tables_that_a_run_does_not_write_are_carried_over(spark, tmp_path):
    root = str(tmp_path)
    for k in range(6):
        names = ("a", "b") if k == 0 else ("a",)
        snapshots.publish(spark, root, f"r{k}", write_run(spark, root, f"r{k}", names), keep=2)
    assert runs_read(spark, root) == {"a": "r5", "b": "r0"}
    assert snapshots.versions(spark, root) == [5, 6]
    assert sorted(os.listdir(f"{root}/_snapshots")) == ["r0", "r4", "r5"]
    assert os.listdir(f"{root}/_snapshots/r0") == ["b"]


def test_only_one_of_two_runs_gets_a_number(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    snapshots.publish(spark, root, "one", write_run(spark, root, "one"))
    seen = snapshots.versions(spark, root)
    snapshots.publish(spark, root, "two", write_run(spark, root, "two"))
    monkeypatch.setattr(snapshots, "versions", lambda *_: seen)  # looked before the other published
    with pytest.raises(snapshots.PublishError):
        snapshots.publish(spark, root, "three", write_run(spark, root, "three"))
    monkeypatch.undo()
    assert runs_read(spark, root) == {"a": "two", "b": "two"}
    assert [n for n in os.listdir(f"{root}/_manifests") if n.startswith(".") and not n.endswith(".crc")] == []


def test_sweep_takes_what_no_manifest_names(spark, tmp_path):
    root = str(tmp_path)
    snapshots.publish(spark, root, "one", write_run(spark, root, "one"))
    write_run(spark, root, "lost")
    assert snapshots.sweep(spark, root) == []
    assert snapshots.sweep(spark, root, older_than=-1) == ["lost"]
    assert runs_read(spark, root) == {"a": "one", "b": "one"}
    assert snapshots.sweep(spark, str(tmp_path / "none")) == []


@pytest.fixture(scope="module")
def raw(spark):
    sf_dir = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    return [readers.as_readings(events.raw_readings(spark, sf_dir, kind), kind) for kind in ("air_quality", "weather")]


def consistent(spark, out, batch_id):
    tables = snapshots.read(spark, out)
    assert NINE | {pipeline.QUARANTINE} == set(tables)
    for name in ("AirQualityFact", "WeatherFact"):
        assert [r[0] for r in tables[name].select("etl_batch_id").distinct().collect()] == [batch_id]
    hours = tables["WeatherFact"].select("timestamp").union(tables["AirQualityFact"].select("timestamp")).distinct()
    assert tables["TimeDim"].select("timestamp").exceptAll(hours).isEmpty()
    assert all(not tables[name].isEmpty() for name in NINE)


STEPS = {
    "staging": ("breezemart.plans.pipeline.clean", DataQualityError),
    "dimensions": ("breezemart.plans.pipeline.write_table", OSError),
    "facts": ("breezemart.plans.facts.processed", OSError),
    "features": ("breezemart.plans.pipeline.harmonize", OSError),
    "draft": ("breezemart.sources.snapshots._write", OSError),
    "rename": ("breezemart.sources.snapshots._rename", OSError),
}


def test_a_run_that_fails_at_any_step_leaves_nine_consistent_tables(spark, raw, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    pipeline.run_batch(*raw, out=out, batch_id="good", threshold=20.0)
    for name, (target, error) in STEPS.items():
        def fail(*_, error=error, name=name, **__):
            raise error(f"step {name} fails")

        with monkeypatch.context() as patched:
            patched.setattr(target, fail)
            with pytest.raises(error, match=name):
                pipeline.run_batch(*raw, out=out, batch_id="bad", threshold=20.0)
        assert snapshots.versions(spark, out) == [1]
        assert len(os.listdir(f"{out}/_snapshots")) == 1
    consistent(spark, out, "good")

    real = snapshots._rename
    with monkeypatch.context() as patched:  # the rename happens, but its answer is lost
        def lost(*arguments):
            real(*arguments)
            raise OSError("no answer")

        patched.setattr(snapshots, "_rename", lost)
        with pytest.raises(OSError, match="no answer"):
            pipeline.run_batch(*raw, out=out, batch_id="unsure", threshold=20.0)
    consistent(spark, out, "unsure")
    with monkeypatch.context() as patched:  # what cannot expire now expires later
        patched.setattr(snapshots, "expire", lambda *_: 1 / 0)
        pipeline.run_batch(*raw, out=out, batch_id="last", threshold=20.0)
    consistent(spark, out, "last")


def test_a_reading_of_the_year_9999_is_quarantined(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    odd = raw[0].limit(1).withColumn("timestamp", F.lit("9999-12-31 05:00:00").cast("timestamp"))
    lost = raw[0].limit(2).withColumn("location_key", F.lit(None).cast("bigint"))
    pipeline.run_batch(raw[0].union(odd).union(lost), raw[1], out=out, batch_id="b", threshold=20.0)
    consistent(spark, out, "b")
    tables = snapshots.read(spark, out)
    found = tables["Quarantine"].collect()
    assert sorted((r.table, r.rule, r.batch_id) for r in found) == [
        ("raw_air_quality", "location_key must not be null", "b")] * 2 + [
        ("raw_air_quality", "time_key must not be null", "b")]
    row = json.loads(next(r.row for r in found if "time_key" in r.rule))
    assert row["timestamp"].startswith("9999-12-31T05") and "pm10" in row
    good = raw[0].select("timestamp", "location_key").distinct().count()
    assert tables["AirQualityFact"].count() == good
    notes = snapshots.manifest(spark, out)["notes"]["readings"]["air_quality"]
    assert notes == {"read": raw[0].count() + 3, "quarantined": 3, "kept": good,
                     "repeats": raw[0].count() - good}


def test_too_many_broken_rows_end_the_job(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    odd = raw[0].limit(200).withColumn("timestamp", F.lit("9999-12-31 05:00:00").cast("timestamp"))
    with pytest.raises(DataQualityError, match="time_key must not be null in 200"):
        pipeline.run_batch(raw[0].union(odd), raw[1], out=out, threshold=20.0)
    assert not os.path.exists(f"{out}/_manifests")


def test_rules_name_the_first_one_broken(spark, tmp_path):
    frame = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    rules = quarantine.not_null(["a", "b"]) | {"a is small": F.col("a") < 3}
    good, bad, observation = quarantine.split(frame, rules)
    assert good.count() == 0 and good.columns == ["a", "b"]
    assert quarantine.counted(observation, rules) == (
        3, {"a must not be null": 1, "b must not be null": 1, "a is small": 1})
    assert {r.a: r.rule for r in bad.collect()} == {
        1: "b must not be null", None: "a must not be null", 3: "a is small"}
    with pytest.raises(DataQualityError, match="3 of 3 rows"):
        quarantine.store(frame, rules, lambda g: g.write.parquet(str(tmp_path / "t")), str(tmp_path / "q"), "T", "b", 100)
    rows = spark.read.parquet(str(tmp_path / "q")).collect()
    assert {(r.table, r.row) for r in rows} == {("T", '{"a":1,"b":null}'), ("T", '{"a":null,"b":null}'), ("T", '{"a":3,"b":"x"}')}
    with pytest.raises(DataQualityError, match="no data"):
        quarantine.store(frame.limit(0), rules, lambda g: g.write.parquet(str(tmp_path / "t2")), str(tmp_path / "q"), "T", "b", 100)


def test_arrival_is_carried_from_files_and_documents(spark, tmp_path):
    hour = datetime.datetime(2024, 1, 1)
    reading = spark.createDataFrame([(hour, 1.0, 2.0, 5.0)], "timestamp timestamp, latitude double, longitude double, pm10 double")
    later = reading.withColumns({"pm10": F.lit(9.0), "ingestion_timestamp": F.lit("2024-02-01").cast("timestamp")})
    first = reading.withColumn("ingestion_timestamp", F.lit("2024-01-02").cast("timestamp"))
    both = readers.as_readings(later.unionByName(first), "air_quality")
    assert [r.pm10 for r in pipeline.clean(both).collect()] == [9.0]
    both.select(F.lit("2024-01-01T00:00:00").alias("time"), *[c for c in both.columns if c not in (
        "timestamp", "location_key", "ingestion_timestamp", "latitude", "longitude")], "latitude", "longitude").limit(
        1).write.option("header", True).csv(str(tmp_path / "csv"))
    read = readers.read_csv_history(spark, str(tmp_path / "csv"), "air_quality")
    assert abs((read.first().ingestion_timestamp - datetime.datetime.now()).total_seconds()) < 3600
