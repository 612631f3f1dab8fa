"""Micro-batch processing and the streaming query."""

from __future__ import annotations

import datetime
import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from breezemart.operators.quality import DataQualityError, Rules, judge
from breezemart.plans.facts import FACT_BUILDERS, processed
from breezemart.schemas import READING_KEYS, measures_of
from breezemart.sources import snapshots
from breezemart.sources.writers import dead_letters, write_partitioned
from breezemart.streaming import store
from breezemart.streaming.live import kept_history, late_rows, with_history
from breezemart.streaming.messages import detect_kind, parse_topics, read_topics

log = logging.getLogger(__name__)
WRITE_ATTEMPTS = 3
STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
METRICS = ("stream_batch string, stream_name string, record_count bigint, null_percentage double, "
           "records_per_second double, late_count bigint, repeat_count bigint, rejected_count bigint")


def written(write: Callable[[], object], what: str) -> None:
    """Tried up to three times: a micro-batch's folders are its own, and nothing reads them before
    they are committed."""
    for attempt in range(1, WRITE_ATTEMPTS + 1):
        try:
            write()
            return
        except Exception:
            if attempt == WRITE_ATTEMPTS:
                raise
            log.warning("writing %s failed, attempt %s", what, attempt)


def _table(df: DataFrame, path: str) -> str:
    written(lambda: df.write.mode("overwrite").parquet(path), path)
    return path


def batch_counts(columns: list[str], keep=None) -> list:
    """Rows, and nulls per column: the one aggregate behind metrics and gate of a micro-batch."""
    keep = F.lit(True) if keep is None else keep
    return [F.count_if(keep).alias("n_rows"),
            *[F.count_if(keep & F.col(name).isNull()).alias(f"nulls_{i}")
              for i, name in enumerate(columns)]]


def metrics_row(counts: dict, columns: list[str], batch_id: int, stream: str, seconds: float,
                late: int = 0, repeats: int = 0, rejected: int = 0) -> tuple:
    rows = counts["n_rows"]
    shares = [100.0 * counts[f"nulls_{i}"] / rows for i in range(len(columns))] if rows else []
    mean = sum(shares) / len(shares) if shares else 0.0
    return (str(batch_id), stream, rows, mean, rows / seconds if seconds > 0 else 0.0, late, repeats, rejected)


def batch_processor(out: str, kinds: list[str], run_id: str, stream: Callable[[SparkSession], str],
                    threshold: float | None = None, delay: datetime.timedelta = datetime.timedelta(minutes=10),
                    merge: int = store.MERGE) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function over rows of `parse_topics`.

    By kind: gate, late rows aside, row history, facts, metrics before and after; then one commit of
    everything (`streaming.store`). `threshold` is the limit on null % per measure and micro-batch;
    None reports without failing. A failed gate ends the query before anything of that batch is
    stored. A micro-batch that is committed already is skipped. The watermark of a kind is the latest
    time in the micro-batches before, less `delay`.
    """
    def process(batch: DataFrame, batch_id: int) -> None:
        spark, before = batch.sparkSession, store.state(batch.sparkSession, out)
        name = stream(spark)
        if before["notes"].get("streams", {}).get(name, -1) >= batch_id:
            log.info("%s batch %s is stored already", name, batch_id)
            return
        for kind in kinds:
            found, missing = detect_kind([c for c in measures_of(kind) if c in batch.columns] + [
                c for c in READING_KEYS if c in batch.columns])
            if missing or found != kind:
                raise DataQualityError(f"{kind} batch {batch_id}: missing columns {missing or measures_of(kind)}")
        folder = snapshots.run_folder(out, f"{name}-{batch_id}")
        # parsed once: everything below reads this copy, the text of rejected messages only
        slim = F.when(F.col("error").isNotNull(), F.col("original_data"))
        _table(batch.withColumn("original_data", slim), f"{folder}/parsed")
        parsed = spark.read.schema(batch.schema).parquet(f"{folder}/parsed")
        tables, replaced, metrics = {}, {}, []
        marks = dict(before["notes"].get("watermarks", {}))
        for kind in kinds:
            done = _process_kind(parsed.where(F.col("kind") == kind), kind, before, marks, folder, batch_id)
            tables |= done[0]
            replaced |= done[1]
            metrics += done[2]
        if metrics:
            rows = spark.createDataFrame(metrics, METRICS).withColumn("processing_time", F.current_timestamp())
            tables["metrics"] = _table(rows.coalesce(1), f"{folder}/metrics")
        store.commit(spark, out, before, name, batch_id, tables, {"watermarks": marks}, replaced)
        snapshots.remove(spark, f"{folder}/parsed")
        store.merge_segments(spark, out, merge)

    def _process_kind(rows: DataFrame, kind: str, before: dict, marks: dict, folder: str, batch_id: int) -> tuple:
        spark, started = rows.sparkSession, time.monotonic()
        columns, fine = measures_of(kind), F.col("error").isNull()
        mark = datetime.datetime.fromisoformat(marks[kind]) if kind in marks else None
        good = rows.where(fine).select(*READING_KEYS, *columns, "ingestion_timestamp")
        is_late = F.lit(False) if mark is None else fine & (F.col("timestamp") < F.lit(marks[kind]).cast("timestamp"))
        counts = rows.agg(*batch_counts(columns, fine), F.count_if(~fine).alias("n_bad"),
                          F.count_if(is_late).alias("n_late"),
                          F.date_format(F.max(F.when(fine, F.col("timestamp"))), STAMP).alias("newest")).first().asDict()
        tables, replaced = {}, {}
        if counts["n_bad"]:
            tables[f"dead_letter/{kind}"] = _table(dead_letters(rows.where(~fine)), f"{folder}/dead_letter_{kind}")
        if not counts["n_rows"]:
            return tables, replaced, []
        if threshold is not None:
            judge(counts, good, Rules(f"{kind}_batch_{batch_id}", columns, threshold=threshold))
        if counts["n_late"]:
            late = late_rows(good, mark).withColumns({"watermark": F.lit(marks[kind]).cast("timestamp"),
                                                      "stream_batch": F.lit(str(batch_id))})
            tables[f"late/{kind}"] = _table(late, f"{folder}/late_{kind}")
        held = before["tables"].get(f"history_{kind}")
        history = spark.read.parquet(f"{out}/{held}") if held else None
        settled = with_history(good, history, kind, mark)
        _table(settled, f"{folder}/settled_{kind}")
        settled = spark.read.parquet(f"{folder}/settled_{kind}")
        newest = datetime.datetime.fromisoformat(counts["newest"]) - delay
        mark = max(newest, mark) if mark else newest
        marks[kind] = mark.isoformat(sep=" ")
        replaced[f"history_{kind}"] = _table(kept_history(settled, mark), f"{folder}/history_{kind}")
        new, emitted = settled.agg(F.count_if("_new"), F.count_if("_emit")).first()
        fact = processed(FACT_BUILDERS[kind](settled.where("_emit")), run_id)
        stored = {"n_rows": 0}
        if emitted:
            path = f"{folder}/facts_{kind}"
            written(lambda: write_partitioned(fact, path, ["date"], cluster=["location_key", "timestamp"]), path)
            tables[f"facts/{kind}"] = path
            stored = spark.read.parquet(path).agg(*batch_counts(fact.columns)).first().asDict()
        snapshots.remove(spark, f"{folder}/settled_{kind}")
        repeats = counts["n_rows"] - counts["n_late"] - new
        seconds = time.monotonic() - started
        return tables, replaced, [
            metrics_row(counts, columns, batch_id, f"{kind}_pre", seconds, counts["n_late"], repeats, counts["n_bad"]),
            metrics_row(stored, fact.columns, batch_id, f"{kind}_post", seconds)]

    return process


def start_query(df: DataFrame, process: Callable[[DataFrame, int], None], name: str, checkpoint: str,
                once: bool = False) -> StreamingQuery:
    """Append mode, one-minute trigger; `once` takes what is there, in batches, and ends."""
    trigger = {"availableNow": True} if once else {"processingTime": "1 minute"}
    return (df.writeStream.foreachBatch(process).outputMode("append").queryName(name)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def start_streams(spark: SparkSession, locations: dict[str, str], out: str, run_id: str = "stream",
                  threshold: float | None = None, once: bool = False, zone: str | None = None,
                  delay: datetime.timedelta = datetime.timedelta(minutes=10), checkpoint: str | None = None,
                  merge: int = store.MERGE, **source) -> StreamingQuery:
    """One query over all topics; `locations` maps kind to topic, or to folder for files.

    Messages are read and parsed once and routed by topic inside the micro-batch. `checkpoint` is
    `<out>/checkpoints/<kinds>` unless given; another one is another stream into the same tables, which
    `streaming.store.read` gives: `facts/<kind>`, `dead_letter/<kind>`, `late/<kind>`, `metrics`.
    `source` arguments go to `read_topics`.
    """
    kinds = list(locations)
    checkpoint = checkpoint or f"{out}/checkpoints/{'-'.join(sorted(kinds))}"
    parsed = parse_topics(read_topics(spark, locations, **source), locations, zone)
    process = batch_processor(out, kinds, run_id, lambda session: store.stream_id(session, checkpoint), threshold,
                              delay, merge)
    return start_query(parsed, process, "-".join(sorted(kinds)), checkpoint, once)
