"""Message source and decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breezemart.functions.cleaning import parse_timestamp, to_utc
from breezemart.functions.keys import location_key, time_key
from breezemart.schemas import CORRUPT, MEASURES, READING_KEYS, any_envelope_schema, envelope_schema, measures_of


#: What a trigger takes unless told otherwise: it bounds what a micro-batch holds of one station.
RECORDS_PER_TRIGGER = 1_000_000
BYTES_PER_TRIGGER = 4 * 2**30


def read_messages(spark: SparkSession, location: str, source: str = "text",
                  servers: str | None = None, per_trigger: int | None = None) -> DataFrame:
    """A stream with the message text in `value` and where it came from in `topic`.

    `source="kafka"` subscribes to the topic `location` (several with commas) from the latest offsets,
    stops where data was lost, and takes `per_trigger` records at a time, 1,000,000 unless given; it
    needs the Kafka connector. `source="text"` reads files of one message per line, `per_trigger` files
    at a time or, unless given, 4 GB; a file's folder is its topic.
    """
    if source == "kafka":
        options = {
            "kafka.bootstrap.servers": servers, "subscribe": location, "startingOffsets": "latest",
            "failOnDataLoss": "true",
            "kafka.request.timeout.ms": "60000", "kafka.session.timeout.ms": "30000",
            "kafka.heartbeat.interval.ms": "10000",
            "maxOffsetsPerTrigger": per_trigger or RECORDS_PER_TRIGGER,
        }
        return (spark.readStream.format("kafka").options(**options).load()
                .select(F.col("value").cast("string").alias("value"), "topic"))
    if source == "text":
        reader = spark.readStream.format("text")
        if per_trigger:
            reader = reader.option("maxFilesPerTrigger", per_trigger)
        else:
            reader = reader.option("maxBytesPerTrigger", BYTES_PER_TRIGGER)
        folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        return reader.load(location).select("value", F.url_decode(folder).alias("topic"))
    raise ValueError("source must be kafka or text")


def read_topics(spark: SparkSession, topics: dict[str, str], source: str = "text", **options) -> DataFrame:
    """One stream over all topics; `topics` maps kind to topic name, or to folder for files.

    Folders must lie in one folder and be told apart by their names.
    """
    places = list(dict.fromkeys(place.rstrip("/") for place in topics.values()))
    if source == "kafka":
        return read_messages(spark, ",".join(places), source, **options)
    if len(places) == 1:
        return read_messages(spark, places[0], source, **options)
    parents = {place.rpartition("/")[0] for place in places}
    if len(parents) > 1:
        raise ValueError(f"message folders must lie in one folder, not in {sorted(parents)}")
    names = ",".join(place.rpartition("/")[2] for place in places)
    return read_messages(spark, f"{parents.pop()}/{{{names}}}", source, **options)


def kind_of_topic(topics: dict[str, str], topic: str = "topic") -> Column:
    """The reading kind of a row's topic; `topics` maps kind to topic, anything else is weather."""
    name = topics.get("air_quality", "").rstrip("/").rpartition("/")[2]
    return F.when(F.col(topic) == name, "air_quality").otherwise("weather")


def parse_topics(raw: DataFrame, topics: dict[str, str], zone: str | None = None) -> DataFrame:
    """Decode messages of all topics in one pass: `kind`, keys, the measures of all kinds (null where
    the row's kind has none), `original_data` and `error` as `parse_messages` gives them."""
    names = dict.fromkeys(name for kind in MEASURES for name in measures_of(kind))
    parsed = _decoded(raw.withColumn("kind", kind_of_topic(topics)), any_envelope_schema(), list(names), zone, ["kind"])
    own = {name: [kind for kind in MEASURES if name in measures_of(kind)] for name in names}
    return parsed.withColumns({name: F.when(F.col("kind").isin(kinds), F.col(name)) for name, kinds in own.items()})


def parse_messages(raw: DataFrame, kind: str, zone: str | None = None) -> DataFrame:
    """Decode `value` into flat readings, with `original_data` and `error` for rejected ones.

    A message is rejected when it is no JSON document or names no time or place; `error` is null
    otherwise. Times are taken as UTC unless `zone` names the local time they are in. Works on
    streams and on bounded frames alike.
    """
    return _decoded(raw, envelope_schema(kind), measures_of(kind), zone)


def _decoded(raw: DataFrame, schema: T.StructType, names: list[str], zone: str | None,
             carried: list[str] | None = None) -> DataFrame:
    text, carried = F.col("value").cast("string"), carried or []
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    document = raw.select(*carried, text.alias("original_data"), F.from_json(text, schema, options).alias("doc"))
    place, now = "doc.metadata.location", "doc.current_conditions"
    flat = document.select(
        *carried, "original_data", F.col(f"doc.{CORRUPT}").alias(CORRUPT),
        to_utc(parse_timestamp(F.col(f"{now}.timestamp")), zone).alias("timestamp"),
        F.col(f"{place}.latitude").alias("latitude"),
        F.col(f"{place}.longitude").alias("longitude"),
        *[_measure(f"{now}.values.{name}", name) for name in names])
    error = (F.when(F.col(CORRUPT).isNotNull(), "malformed JSON")
             .when(F.col("timestamp").isNull(), "missing timestamp")
             .when(time_key("timestamp").isNull(), "timestamp out of range")
             .when(F.col("location_key").isNull(), "missing location"))
    return (flat.withColumn("location_key", location_key("latitude", "longitude"))
            .withColumn("error", error)
            .select(*carried, *READING_KEYS, *names, "original_data", "error",
                    F.current_timestamp().alias("ingestion_timestamp")))


def _measure(path: str, name: str):
    return F.col(path).try_cast("int" if name == "us_aqi" else "double").alias(name)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("original_data", "error")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNotNull()).select("original_data", "error")


def detect_kind(columns: list[str]) -> tuple[str, list[str]]:
    """Reading kind and the columns it requires that are absent."""
    kind = "weather" if "weather_code" in columns else "air_quality"
    required = {"weather": ["timestamp", "temperature_2m", "weather_code"],
                "air_quality": ["timestamp", "us_aqi", "pm2_5"]}[kind]
    return kind, [name for name in required if name not in columns]
