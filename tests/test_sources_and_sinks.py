import datetime
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from breezemart.operators import arrays
from breezemart.schemas import AIR_MEASURES, WEATHER_MEASURES
from breezemart.schemas import measures_of
from breezemart.session import build_session, scan_bytes, shuffle_partitions, workspace
from breezemart.sources import readers, writers
from breezemart.streaming import messages

HEADER = "time," + ",".join(AIR_MEASURES)
AIR_DOCUMENT = {
    "metadata": {"timestamp": "2025-01-19T21:22:14.952519",
                 "location": {"latitude": 40.7128, "longitude": -74.006},
                 "data_source": "Open-Meteo Air Quality API"},
    "current_conditions": {"timestamp": "2025-01-19T21:22:14.952519",
                           "values": {"pm10": 5.0, "pm2_5": 4.8, "us_aqi": 55.0}},
}


@pytest.fixture
def air_csv(tmp_path):
    path = tmp_path / "air.csv"
    path.write_text(f"{HEADER}\n2024-07-22T00:00,5.0,4.8,221,25.3,2.9,53,0.05,0,0,55\n"
                    "no time,1,1,1,1,1,1,1,1,1,1\n2024-07-22T01:00,junk,4,1,1,1,1,1,1,1,50.5\n")
    return str(path)


def test_csv_of_one_station(spark, air_csv):
    rows = readers.read_csv_history(spark, air_csv, "air_quality", place=(40.7128, -74.006)).collect()
    assert rows[0].us_aqi == 55 and rows[0].latitude == 40.7128
    assert rows[0].pm2_5 == pytest.approx(4.8, abs=1e-6) and rows[0].pm2_5 != 4.8  # single precision
    assert rows[0].timestamp == datetime.datetime(2024, 7, 22)
    assert rows[1].timestamp is None and rows[2].pm10 is None and rows[2].us_aqi is None


def test_csv_fail_fast(spark, air_csv):
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv_history(spark, air_csv, "air_quality", place=(1.0, 1.0), fail_fast=True).collect()


def test_documents(spark, tmp_path):
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(AIR_DOCUMENT, indent=2))
    row = readers.current_readings(
        readers.read_documents(spark, str(path), "air_quality"), "air_quality").first()
    assert row.us_aqi == 55 and row.dust is None and row.longitude == -74.006
    assert row.timestamp.microsecond == 952519
    local = readers.current_readings(readers.read_documents(spark, str(path), "air_quality"),
                                     "air_quality", zone="America/New_York").first()
    assert local.timestamp - row.timestamp == datetime.timedelta(hours=5)


def test_parse_tells_why_a_message_is_rejected(spark):
    no_time = json.dumps({"metadata": AIR_DOCUMENT["metadata"], "current_conditions": {}})
    no_place = json.dumps({**AIR_DOCUMENT, "metadata": {}})
    texts = [json.dumps(AIR_DOCUMENT), "{broken", no_time, no_place]
    raw = spark.createDataFrame([(bytearray(t, "utf8"),) for t in texts], "value binary")
    parsed = messages.parse_messages(raw, "air_quality")
    assert [r.error for r in parsed.collect()] == [
        None, "malformed JSON", "missing timestamp", "missing location"]
    assert messages.accepted(parsed).first().us_aqi == 55
    letters = writers.dead_letters(messages.rejected(parsed)).collect()
    assert [r.original_data for r in letters] == texts[1:]


def test_kind_of_topic_and_columns(spark):
    topics = {"air_quality": "in/a", "weather": "in/w"}
    rows = spark.createDataFrame([("a",), ("w",), ("other",)], "topic string")
    kinds = rows.select(messages.kind_of_topic(topics).alias("kind")).collect()
    assert [r.kind for r in kinds] == ["air_quality", "weather", "weather"]
    assert messages.detect_kind(["timestamp", "us_aqi"]) == ("air_quality", ["pm2_5"])
    assert messages.detect_kind(["weather_code"]) == ("weather", ["timestamp", "temperature_2m"])


def test_envelope_and_back(spark):
    stamp = datetime.datetime(2025, 1, 19, 21, 15)
    values = tuple(float(i) for i in range(len(WEATHER_MEASURES)))
    flat = spark.createDataFrame([(stamp, 40.7128, -74.006, *values)], ", ".join(
        ["timestamp timestamp", "latitude double", "longitude double",
         *[f"{n} double" for n in WEATHER_MEASURES]]))
    sent = writers.messages(flat, "weather")
    document = json.loads(sent.first().value)
    assert document["hourly_forecast"] == {"time_series": []}
    assert document["metadata"]["data_source"] == "Open-Meteo API"
    row = messages.accepted(messages.parse_messages(sent, "weather")).first()
    assert row.timestamp == stamp and tuple(row[n] for n in WEATHER_MEASURES) == values


def test_array_payload_with_gaps(spark):
    payload = spark.createDataFrame([(1, (["a", "b", "c"], [1.0, 2.0, 3.0], [9.0]))],
                                    "id int, hourly struct<time: array<string>, pm10: array<double>, dust: array<double>>")
    rows = arrays.arrays_to_rows(payload, "hourly", ["pm10", "dust", "ozone"]).collect()
    assert [tuple(r) for r in rows] == [(1, "a", 1.0, 9.0, None), (1, "b", 2.0, None, None),
                                        (1, "c", 3.0, None, None)]


def test_hourly_axis(spark):
    frame = spark.sql("""select * from values
        (1, timestamp '2024-01-01 00:00', timestamp '2024-01-01 03:00', array(1.0D, 2.0D)),
        (2, timestamp '2024-01-01 00:00', timestamp '2024-01-01 00:00', array(1.0D)),
        (3, timestamp '2024-01-01 00:00', timestamp '2024-01-01 01:30', array(7.0D, 8.0D, 9.0D))
        as t(id, first, stop, values)""")
    rows = arrays.hourly_axis(frame, "first", "stop", {"v": "values"}).collect()
    assert [(r.id, r.timestamp.hour, r.v) for r in rows] == [
        (1, 0, 1.0), (1, 1, 2.0), (1, 2, None), (3, 0, 7.0), (3, 1, 8.0)]


def test_names_by_position(spark):
    frame = spark.createDataFrame([(1, [5.0, 6.0, 7.0])], "id int, listed array<double>")
    rows = arrays.name_by_position(frame, "listed", ["a", "b"]).collect()
    assert [(r.variable, r.value) for r in rows] == [("a", 5.0), ("b", 6.0), ("unknown_variable_2", 7.0)]


@pytest.fixture
def hours(spark):
    return spark.sql("""select explode(sequence(timestamp '2024-11-01', timestamp '2025-03-01',
                        interval 6 hour)) as timestamp""").withColumn("location_key", F.lit(1))


def test_range_filter_keeps_the_last_midnight_only(hours):
    first, last = datetime.datetime(2024, 12, 1), datetime.datetime(2024, 12, 3)
    assert readers.between(hours, first, last).count() == 9
    assert readers.between(hours, first, None).count() == hours.count()


def test_trailing_window_keeps_both_days_whole(hours):
    kept = readers.trailing_window(hours, datetime.date(2025, 1, 10), days=2)
    assert kept.count() == 12
    assert kept.agg(F.min("timestamp")).first()[0] == datetime.datetime(2025, 1, 7)


def test_months_are_pruned(spark, hours, tmp_path):
    path = writers.write_partitioned(hours, str(tmp_path / "t"))
    first, last = datetime.datetime(2024, 12, 31, 12), datetime.datetime(2025, 1, 1, 6)
    cut = readers.read_months(spark, path, first, last)
    assert cut.count() == 4
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters: [(((year" in plan


def test_partition_overwrite(spark, hours, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(hours, path)
    january = hours.filter("month(timestamp) = 1").limit(1)
    writers.write_partitioned(january, path, whole_table=False)
    counts = {r.month: r["count"] for r in spark.read.parquet(path).groupBy("month").count().collect()}
    assert counts[1] == 1 and counts[12] == 124


def test_full_month_is_written_by_several_tasks(spark, tmp_path, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    month = spark.range(0, 200_000, numPartitions=16).select(  # cut between map outputs
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("timestamp"), F.rand(1).alias("v"))
    path = writers.write_partitioned(month, str(tmp_path / "t"), cluster=["timestamp"])
    files = spark.read.parquet(path).filter("month = 1").inputFiles()
    assert len(files) > 4 and spark.read.parquet(path).count() == 200_000


def test_clustered_files_have_tight_ranges(spark, tmp_path, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")  # so little data is one file else
    rows = spark.range(4000).select((F.col("id") % 40).alias("location_key"),
                                    F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("timestamp"))
    path = writers.write_clustered(rows, str(tmp_path / "t"), "date", ["location_key"])
    spans = (spark.read.parquet(path).groupBy(F.input_file_name())
             .agg(F.min("location_key").alias("a"), F.max("location_key").alias("b"))
             .orderBy("a").collect())
    assert len(spans) > 1 and all(x.b <= y.a for x, y in zip(spans, spans[1:]))


def test_a_key_filter_reads_few_row_groups(spark, tmp_path, conf):
    conf(spark__sql__shuffle__partitions="4", parquet__block__size="65536", parquet__page__row__count__limit="1000")
    rows = spark.range(200_000).select(
        (F.floor(F.col("id") / 10) * 7919 % 1000).alias("location_key"), F.rand(3).alias("x"), F.rand(4).alias("y"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 10 * 86400 + F.floor(F.col("id") / 10)).alias("timestamp"))
    path = writers.write_clustered(rows, str(tmp_path / "t"), "date", ["location_key"])
    found = spark.read.parquet(path).where("location_key = 3 and date >= date'2024-01-03' and date < date'2024-01-05'")
    assert found.count() == 40
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "EqualTo(location_key,3)" in scan
    whole, read = scanned(spark.read.parquet(path).select("x", "location_key")), scanned(found.select("x", "location_key"))
    assert whole["numOutputRows"] == 200_000 and read["numFiles"] < whole["numFiles"]
    assert read["numOutputRows"] <= 8_000  # of 40,000 in the two days: row groups without the key are left out


def scanned(frame):
    """What the scan of an executed frame counted: files, and rows of the row groups it read."""
    execution = frame._jdf.queryExecution()
    frame._jdf.collect()
    plan = execution.executedPlan()
    while not plan.nodeName().startswith("Scan") and plan.children().size():
        plan = plan.children().apply(0)
    metrics = plan.metrics()
    return {name: metrics.apply(name).value() for name in ("numFiles", "numOutputRows")}


def test_export_name():
    first, last = datetime.date(2024, 7, 22), datetime.date(2025, 1, 18)
    assert writers.range_name("air_quality", first, last) == "air_quality_20240722_20250118"
    moment = datetime.datetime(2025, 1, 19, 21, 22, 14)
    assert writers.stamped_name("weather_current", moment) == "weather_current_20250119_212214"


def cluster(master, checkpoint_dir=None):
    """As much of a session as the working folder asks for; the real setting is fixed at start."""
    settings = {"spark.checkpoint.dir": checkpoint_dir}
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: settings[key] or default),
                           sparkContext=context)


def test_workspace_is_under_the_named_folder():
    named = cluster("yarn", "hdfs:///shared/")
    assert workspace(named, "x").startswith("hdfs:///shared/breezemart/x-")
    assert workspace(named, "x") != workspace(named, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace(cluster("yarn"), "x")


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions(10) == 200 and shuffle_partitions(2**40) == 4096
    assert shuffle_partitions(100 * 2**40) == 32_768 and scan_bytes(10) == 128 * 2**20
    assert 100 * 2**40 / scan_bytes(100 * 2**40) <= 100_000
    assert build_session().conf.get("spark.sql.session.timeZone") == "UTC"


def test_accepted_and_rejected_lines_are_all_lines(spark, tmp_path):
    names = measures_of("air_quality")
    header = ",".join(["time", *names, "latitude", "longitude"])
    good = "2025-01-19T21:00:00," + ",".join(["1.5"] * 9) + ",55.0,40.0,2.0"
    lines = {
        good: None, good.replace("55.0", ""): None, good.replace("40.0", "41"): None,
        good + ",9": "malformed line", good.rsplit(",", 3)[0]: "malformed line", "": None,
        good.replace("1.5", "x", 1): "malformed number", good.replace("55.0", "many"): "malformed number",
        good.replace("2025-01-19T21", "soon"): "missing timestamp", good.replace("2025-01-19T21:00:00", ""): "missing timestamp",
        good.replace("40.0", ""): "missing location"}
    (tmp_path / "csv").mkdir()
    for k in range(2):
        (tmp_path / "csv" / f"{k}.csv").write_text("\n".join([header, *lines]) + "\n")
    accepted, rejected = readers.read_csv_checked(spark, str(tmp_path / "csv"), "air_quality")
    found = rejected.collect()
    assert accepted.count() == 6 and len(found) == 14  # blank lines are none
    assert {(r.original_data, r.error) for r in found} == {(text, error) for text, error in lines.items() if error}
    assert {r.file_path.rsplit("/", 1)[1] for r in found} == {"0.csv", "1.csv"}
    assert sorted(r.us_aqi or 0 for r in accepted.collect()) == [0, 0, 55, 55, 55, 55]
    here, _ = readers.read_csv_checked(spark, str(tmp_path / "csv"), "air_quality")
    assert here.columns == readers.read_csv_history(spark, str(tmp_path / "csv"), "air_quality").columns
