"""What streams have stored: segments of tables, committed one micro-batch at a time.

A micro-batch writes its facts, dead letters, late rows, metrics and row history into folders of its
own and commits them with one manifest (`sources.snapshots`), which also says how far each stream has
come. So a micro-batch is there whole or not at all, a replay of one that is there is skipped, and a
new checkpoint is another stream, whose segments stand beside the old ones.

Small segments are merged: `MERGE` segments of a tier become one of the next, so a table of n
micro-batches has at most `MERGE` segments in each of log n tiers, and a row is written again once a
tier. Rows of a later segment stand for those of an earlier one with the same key.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breezemart.operators.merge import latest_per_key
from breezemart.plans.harmonized import KEYS
from breezemart.sources import snapshots
from breezemart.sources.writers import write_partitioned

MERGE = 16
SEQ = "_seq"
KEYED = "facts/"  # tables whose rows have a key
SEGMENT = re.compile(r"(.+)/(\d+)-(\d{12})")


def state(spark: SparkSession, root: str) -> dict:
    """The newest manifest, or an empty one before the first commit."""
    known = snapshots.versions(spark, root)
    if not known:
        return {"version": 0, "tables": {}, "notes": {}}
    return snapshots.manifest(spark, root, known[-1])


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the query of this checkpoint: the same after a restart, another elsewhere."""
    files, path = snapshots.file_system(spark, f"{checkpoint}/metadata")
    stream = files.open(path)
    try:
        text = bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()
    return json.loads(text)["id"]


def commit(spark: SparkSession, root: str, before: dict, stream: str, batch_id: int, tables: dict[str, str],
           notes: dict, replaced: dict[str, str]) -> None:
    """Publish a micro-batch: `tables` get a new segment each, `replaced` names stand for their old ones."""
    seq = before["version"] + 1
    segments = {f"{name}/0-{seq:012d}": path for name, path in tables.items()}
    streams = {**before["notes"].get("streams", {}), stream: batch_id}
    snapshots.publish(spark, root, f"{stream}-{batch_id}", segments | replaced,
                      {**before["notes"], **notes, "streams": streams})


def segments(manifest: dict, table: str) -> list[tuple[int, int, str, str]]:
    """(seq, tier, name, path) of a table's segments, oldest first."""
    found = []
    for name, path in manifest["tables"].items():
        if (segment := SEGMENT.fullmatch(name)) and segment[1] == table:
            found.append((int(segment[3]), int(segment[2]), name, path))
    return sorted(found)


def _rows(spark: SparkSession, root: str, parts: list[tuple[int, int, str, str]]) -> DataFrame:
    schema, frames = None, []
    for seq, _, _, path in parts:
        reader = spark.read if schema is None else spark.read.schema(schema)
        frame = reader.parquet(f"{root}/{path}")
        schema = schema or frame.schema
        frames.append(frame.withColumn(SEQ, F.lit(seq).cast("long")))
    return reduce(DataFrame.unionByName, frames)


def _settled(rows: DataFrame, table: str) -> DataFrame:
    if table.startswith(KEYED):
        rows = latest_per_key(rows, KEYS, [F.col(SEQ)])
    return rows.drop(SEQ)


def tables(manifest: dict) -> list[str]:
    """Names of the tables that have segments."""
    return sorted({m[1] for m in map(SEGMENT.fullmatch, manifest["tables"]) if m})


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All rows of a table as committed: facts one row per key, the latest written."""
    parts = segments(state(spark, root), table)
    if not parts:
        raise FileNotFoundError(f"{table} has no rows under {root}")
    return _settled(_rows(spark, root, parts), table)


def unsettled(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All rows of a table's segments with their segment's number in `SEQ`: of a key the highest stands."""
    return _rows(spark, root, segments(state(spark, root), table))


def _full_tier(manifest: dict, merge: int) -> tuple[str, list[tuple[int, int, str, str]]] | None:
    for table in tables(manifest):
        parts = segments(manifest, table)
        for tier in sorted({tier for _, tier, _, _ in parts}):
            own = [part for part in parts if part[1] == tier]
            if len(own) >= merge:
                return table, own
    return None


def merge_segments(spark: SparkSession, root: str, merge: int = MERGE) -> list[str]:
    """Merge every tier that has `merge` segments; returns the new segments' names."""
    made = []
    while full := _full_tier(manifest := state(spark, root), merge):
        table, own = full
        run = f"merge-{manifest['version']}"
        name = f"{table}/{own[0][1] + 1}-{own[-1][0]:012d}"
        path = f"{snapshots.run_folder(root, run)}/{table.replace('/', '_')}"
        rows = _settled(_rows(spark, root, own), table)
        if "date" in rows.columns:
            write_partitioned(rows, path, ["date"], cluster=["location_key", "timestamp"])
        else:
            rows.hint("rebalance").write.mode("overwrite").parquet(path)
        snapshots.publish(spark, root, run, {name: path}, manifest["notes"], drop=[part[2] for part in own])
        made.append(name)
    return made
