"""Exact deduplication by a tree of merged digest runs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breezemart.llm.shared import staged

FAN_IN = 16


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run, seen = TaskContext.get().partitionId(), 0
    for batch in batches:
        texts = [(t or b"").lower() for t in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()]
        n = len(texts)
        yield pa.RecordBatch.from_arrays([
            *batch.columns[:-1], pa.array([run] * n, pa.int32()),
            pa.array(range(seen, seen + n), pa.int64()),
            pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            pa.array([len(t) for t in texts], pa.int64()),
        ], names=[*batch.schema.names[:-1], "run", "at", "digest", "size"])
        seen += n


def digest_rows(docs: DataFrame, carry: list[str] = ()) -> DataFrame:
    """doc_id, the columns of `carry`, run (the input partition), at (place in it), SHA-256 and byte length of each text
    with A-Z lower-cased. Written to the shared folder: run and at name a row from here on."""
    rows = docs.select("doc_id", *[F.col(c).alias(f"carry_{c}") for c in carry], F.col("text").cast("string"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("run", T.IntegerType()),
                           T.StructField("at", T.LongType()), T.StructField("digest", T.BinaryType()),
                           T.StructField("size", T.LongType())])
    return staged(rows.mapInArrow(_digests, schema), "digests")


def merge_runs(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per (digest, size): the row that stays and the group's size.

    Each input partition starts as one run of its digests, reduced to one row each. A round joins
    `fan_in` neighbouring runs: the exchange deals (run, digest) over all tasks, the aggregation
    merges equal digests of equal text length and retains the identifier that stays. The last round
    leaves one run, spread over the tasks by digest. A copy is thus reduced where it is read and
    at every level; no task sees more rows of a digest than runs meet there.
    """
    best = F.struct("doc_id", "run", "at")
    level = rows.select("run", "digest", "size", best.alias("keep"), F.lit(1).cast("long").alias("n"))
    runs = rows.agg(F.max("run")).first()[0]
    runs = 0 if runs is None else runs + 1
    while True:
        runs = -(-runs // fan_in)
        level = (level.withColumn("run", F.floor(F.col("run") / F.lit(fan_in)).cast("int"))
                 .groupBy("run", "digest", "size")
                 .agg(F.max("keep").alias("keep"), F.sum("n").alias("n")))
        if runs <= 1:
            return staged(level.drop("run"), "digest-groups")


def exact_dedup(docs: DataFrame, fan_in: int = FAN_IN, carry: list[str] = ()) -> DataFrame:
    """Every row of `docs` (doc_id, text) with its group of equal texts.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Returns
    doc_id, keep_id (the largest doc_id of the group), group_size, kept, text_sha256 (of the
    normalised text) and the columns of `carry`. Equality is that of SHA-256 and byte length, verified
    at every merge.

    Of rows that share the largest doc_id exactly one is kept, the last in reading order. A null
    doc_id is smaller than any other. Other columns are not looked at. An empty table gives no rows.
    """
    rows = digest_rows(docs, carry)
    groups = merge_runs(rows, fan_in).select(
        F.col("digest").alias("_digest"), F.col("size").alias("_size"), "keep", "n")
    return (rows.join(groups, (F.col("digest") == F.col("_digest")) & (F.col("size") == F.col("_size")))
            .select("doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                    ((F.col("run") == F.col("keep.run")) & (F.col("at") == F.col("keep.at"))).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"),
                    *[F.col(f"carry_{c}").alias(c) for c in carry]))
