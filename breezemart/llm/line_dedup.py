"""Line deduplication by a deletion-neighbourhood join, edit distance one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breezemart.llm.shared import sieved, staged

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
FIRST = ["none", "doc_id", "row", "line"]


def _ends(line: Column, length: Column) -> Column:
    """Hashes of the two ends of a line, (length - 1) // 2 code points each, and of those that a
    line one shorter would have. Lines one edit apart agree in one end of the shorter's size, so a
    line that shares none has no neighbour. The lowest bit says which end: 0 the start."""
    def of(size: Column) -> list[Column]:
        hashes = F.xxhash64(F.substring(line, F.lit(1), size), size), F.xxhash64(F.right(line, size), size)
        return [F.shiftleft(h, 1).bitwiseOR(F.lit(side)) for side, h in enumerate(hashes)]

    mine, shorter = F.floor((length - 1) / 2).cast("int"), F.floor((length - 2) / 2).cast("int")
    return F.array_distinct(F.array(*of(mine), *of(shorter)))


def deletion_hashes(line: str) -> np.ndarray:
    """Hash of the line, then of each line that one deletion makes of it: sum of code[k] * BASE^k."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    codes = (codes + _U(1)) * _U(0xBF58476D1CE4E5B9)
    codes ^= codes >> _U(29)
    powers = np.full(len(codes), _BASE, np.uint64)
    powers[:1] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * np.cumprod(powers), dtype=np.uint64)])
    without = sums[:-1] + (sums[-1] - sums[1:]) * _U(_INVERSE)
    return np.concatenate([sums[-1:], without])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, at, id of the lines (at -1) and of their single deletions at place `at`.

    Two lines that share their start differ behind it, two that share their end before it, so a line
    needs the deletions on the other side only of what it shares. In a run of equal code points, where
    all deletions give one line, the last one lies behind a shared start and the first before a shared end.
    """
    for batch in batches:
        ids, lines = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        start_shared, end_shared = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
        start = 0
        while start < len(lines):
            keys, size, stop = [], 0, start
            while stop < len(lines) and size < 500_000:
                keys.append(deletion_hashes(lines[stop]))
                size += len(keys[-1])
                stop += 1
            counts = [len(k) for k in keys]
            length = np.repeat([len(k) - 1 for k in keys], counts)
            at = np.concatenate([np.arange(-1, n - 1) for n in counts])
            key = np.concatenate(keys) ^ ((length - (at >= 0)).astype(np.uint64) * _U(0x94D049BB133111EB))
            same = np.maximum((length - 2) // 2, 0)
            behind, before = (np.repeat(x[start:stop], counts) for x in (start_shared, end_shared))
            kept = (at < 0) | (behind & (at >= same)) | (before & (at < length - same))
            yield pa.RecordBatch.from_arrays([
                pa.array(key[kept].astype(np.int64)), pa.array(at[kept].astype(np.int32)),
                pa.array(np.repeat(ids[start:stop], counts)[kept])], names=["key", "at", "id"])
            start = stop


def line_repeats(docs: DataFrame) -> DataFrame:
    """Every row of `docs` (doc_id, text) with the lines of it that repeat an earlier one.

    A line is a repeat when an earlier line, by doc_id and place, is equal to it or at most one
    inserted, deleted or replaced code point away, however short the lines are.
    Returns doc_id, n_lines, n_dropped and dropped_lines (their places from 0, ascending, comma-
    joined). Blank lines never count as repeats.

    Equal lines are one first. Lines that share an end with another emit themselves and their
    single deletions outside that end as hashed keys. Lines with the same deletion at the same place differ in
    one replaced code point, a line equal to another's deletion in one inserted; in each group the
    earliest line is the witness of all others, so no pairs are made. Witnesses are verified by
    edit distance.

    A null text counts as one empty line. A null doc_id is later than any other. Rows that repeat a
    doc_id are documents of their own, in reading order. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    line, length = F.col("x"), F.col("n")
    rows = staged(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64(text).alias("mark"),
                              text.alias("text"))
                  .select("row", "doc_id", "mark", F.posexplode(F.split("text", "\n")).alias("line", "x"))
                  .withColumn("n", F.length("x"))
                  .select("row", "doc_id", "mark", "line", "n", F.xxhash64(line).alias("h"), F.hash(line).alias("g"),
                          (F.trim(line) == "").alias("blank"), _ends(line, length).alias("ends")), "lines")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "line", "mark")).alias("first")
    distinct = staged(rows.where("not blank").groupBy("h", "g", "n").agg(first, F.first("ends").alias("ends")), "distinct-lines")

    ends = distinct.select("h", "g", "n", F.explode("ends").alias("end"))
    shared = ends.groupBy("end").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("end")
    side = F.col("end").bitwiseAND(F.lit(1))
    close = ends.join(shared, "end").groupBy("h", "g", "n").agg(
        F.max(side == 0).alias("start_shared"), F.max(side == 1).alias("end_shared"))
    close = staged(close.join(distinct.drop("ends"), ["h", "g", "n"])
                   .withColumn("id", F.monotonically_increasing_id()), "close-lines")

    wanted = staged(close.select(F.col("first.doc_id").alias("_id"), F.col("first.mark").alias("_mark")).distinct(), "wanted")
    texts = sieved(docs.select("doc_id", F.xxhash64(text).alias("mark"), text.alias("text")),
                   F.xxhash64("doc_id", "mark"), wanted, F.xxhash64("_id", "_mark"))
    own = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))).select(
        F.explode(F.split("text", "\n")).alias("x"))
    spelled = own.groupBy(F.xxhash64(line).alias("h"), F.hash(line).alias("g"), F.length(line).alias("n")).agg(
        F.first("x").alias("x"))
    order = F.struct(*[F.col(f"first.{c}").alias(c) for c in FIRST]).alias("first")
    lines = staged(close.join(spelled, ["h", "g", "n"]).select(
        "id", "h", "g", "n", order, "x", "start_shared", "end_shared"), "spelled-lines")

    keys = lines.select("id", "x", "start_shared", "end_shared").mapInArrow(_variants, "key long, at int, id long")
    crowded = keys.groupBy("key").agg(F.min("id").alias("_a"), F.max("id").alias("_b")).where("_a < _b").select("key")
    members = staged(keys.join(crowded, "key").join(lines.select("id", "first"), "id"), "variants")
    low = F.min(F.struct("first", "id"))
    made = members.where("at >= 0")
    whole = members.where("at < 0").groupBy("key").agg(low.alias("w"))
    by_place = made.groupBy("key", "at").agg(low.alias("w"))
    by_key = made.groupBy("key").agg(low.alias("w"))
    later = F.col("w.first") < F.col("first")
    pairs = (made.join(by_place, ["key", "at"]).where(later).select("id", "w.id")
             .union(made.join(whole, "key").where(later).select("id", "w.id"))
             .union(members.where("at < 0").join(by_key, "key").where(later).select("id", "w.id"))
             ).toDF("id", "witness").distinct()
    words = lines.select(F.col("id").alias("witness"), F.col("x").alias("y"))
    repeats = staged(pairs.join(lines.select("id", "h", "g", "n", "x"), "id").join(words, "witness")
                     .where(F.levenshtein("x", "y", 1).between(0, 1)).select("h", "g", "n").distinct()
                     .withColumn("fuzzy", F.lit(True)), "repeats")

    kept = staged(distinct.select("h", "g", "n", F.col("first.row").alias("_row"), F.col("first.line").alias("_line"))
                  .join(repeats, ["h", "g", "n"], "left")
                  .select(*[F.col(c).alias(f"_{c}") for c in "hgn"], "_row", "_line", "fuzzy"), "kept-lines")
    met = rows.join(kept, (F.col("h") == F.col("_h")) & (F.col("g") == F.col("_g")) & (F.col("n") == F.col("_n")) & ~F.col("blank"), "left")
    stays = F.col("blank") | ((F.col("row") == F.col("_row")) & (F.col("line") == F.col("_line")) & F.col("fuzzy").isNull())
    return met.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_lines"),
                                  F.sort_array(F.collect_list(F.when(~stays, F.col("line")))).alias("gone")).select(
        "doc_id", "n_lines", F.size("gone").cast("long").alias("n_dropped"),
        F.array_join(F.col("gone").cast(T.ArrayType(T.StringType())), ",").alias("dropped_lines"))


def without_repeats(text: Column, dropped_lines: Column) -> Column:
    """The text without the lines that `line_repeats` lists."""
    gone = F.split(dropped_lines, ",")
    kept = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(gone, i.cast("string")))
    return F.array_join(kept, "\n")
