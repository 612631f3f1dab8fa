"""Row lags over time series whose keys may be very uneven in size.

A window over the key alone puts a station's whole history into one task, wrong for one that holds
a third of all rows. So there is one plan for every station, however its rows lie in time:

1. rows are range-partitioned by (key, time) into parts of about equal size and written, each part
   into the bucket of its number: the only exchange of the rows;
2. a key that goes on in the next part needs the rows before that part. There are fewer such
   continuations than parts, and each needs `depth` rows: the tails of the parts, handed on by a scan
   over blocks of `BLOCK` parts, then over blocks of blocks, so that no task sees more than a block;
3. these rows are appended to the same buckets as guests of the part they are needed in;
4. a lag inside (key, part) over rows and guests, read bucket by bucket, without another exchange.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breezemart.session import staged, workspace

BLOCK = 64


def row_lags(df: DataFrame, value: str, steps: dict[str, int], key: str = "location_key",
             order: str = "timestamp") -> DataFrame:
    """Add a column per entry of `steps`: the value that many rows earlier, per key by time.

    The result does not depend on the number of parts. Times must be unique per key for the result
    to be unique; rows of one instant share a part. Rows without a key or time are not expected.
    """
    spark, depth = df.sparkSession, max(steps.values())
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"breezemart_parts_{uuid.uuid4().hex[:12]}", workspace(spark, "lag-parts")

    def store(rows: DataFrame, mode: str) -> None:
        rows.write.mode(mode).bucketBy(min(parts, most), "_part").option("path", path).saveAsTable(name)

    try:
        store(df.repartitionByRange(key, order).withColumns(
            {"_part": F.spark_partition_id(), "_guest": F.lit(False)}), "overwrite")
        cut = spark.table(name)
        guests = _guests(cut, value, depth, key, order, parts)
        if guests is not None:
            others = {f.name: F.lit(None).cast(f.dataType) for f in df.schema.fields
                      if f.name not in (key, order, value)}
            store(guests.withColumns({**others, "_guest": F.lit(True)}).select(*cut.columns)
                  .repartition(min(parts, most), "_part"), "append")
        rows = spark.table(name)  # the files stay when the name goes
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    in_part = Window.partitionBy("_part", key).orderBy(order)
    return (rows.withColumns({name: F.lag(value, step).over(in_part) for name, step in steps.items()})
            .where("not _guest").drop("_part", "_guest"))


def _guests(cut: DataFrame, value: str, depth: int, key: str, order: str, parts: int) -> DataFrame | None:
    """(key, order, value, _part): up to `depth` rows before each part a key goes on in, or none."""
    spans = staged(cut.groupBy(key).agg(F.min("_part").alias("_first"), F.max("_part").alias("_last"))
                   .where("_first < _last").select(key), "lag-spans")
    if spans.isEmpty():
        return None
    newest_first = Window.partitionBy("_part", key).orderBy(F.desc(order))
    # at most one spanning key begins for each part, so there are at most as many as parts
    ends = (cut.join(F.broadcast(spans), key).select(key, "_part", order, value)
            .withColumn("_back", F.row_number().over(newest_first)).where(F.col("_back") <= depth)
            .groupBy(key, "_part").agg(F.sort_array(F.collect_list(F.struct(order, value))).alias("_tail")))
    before = rows_before(staged(ends, "lag-ends"), key, depth, parts)
    return (before.select(key, "_part", F.explode("_before").alias("_row"))
            .select(key, F.col("_row")[order].alias(order), F.col("_row")[value].alias(value), "_part"))


def _newest(rows: Column, depth: int) -> Column:
    return F.slice(rows, F.greatest(F.size(rows) - depth + 1, F.lit(1)), depth)


def rows_before(ends: DataFrame, key: str, depth: int, parts: int) -> DataFrame:
    """(key, _part, _before): the last `depth` rows of the key before each of its parts.

    `ends` holds the last `depth` rows, oldest first, of every part that has a row of the key, as
    `_tail`. Parts are taken in blocks of `BLOCK`: inside a block by a window, and across blocks by the
    same step over the blocks' own tails, until one block is left.
    """
    def earlier(*group: str) -> Column:
        frame = Window.partitionBy(*group).orderBy("_part").rowsBetween(-depth, -1)
        return _newest(F.flatten(F.collect_list("_tail").over(frame)), depth)

    if parts <= BLOCK:
        return ends.select(key, "_part", earlier(key).alias("_before"))
    blocks = ends.withColumn("_block", F.floor(F.col("_part") / BLOCK).cast("int"))
    inside = blocks.withColumn("_inside", earlier(key, "_block"))
    in_order = F.sort_array(F.collect_list(F.struct("_part", "_tail")))
    tails = staged(blocks.groupBy(key, "_block").agg(
        _newest(F.flatten(F.transform(in_order, lambda p: p["_tail"])), depth).alias("_tail"))
        .withColumnRenamed("_block", "_part"), "lag-blocks")
    above = rows_before(tails, key, depth, -(-parts // BLOCK)).withColumnRenamed("_part", "_block")
    return (inside.join(above, [key, "_block"])
            .select(key, "_part", _newest(F.concat("_before", "_inside"), depth).alias("_before")))
