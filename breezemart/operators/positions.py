"""Positions in a total order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from breezemart.session import staged

ROW_BITS = 33  # of monotonically_increasing_id: the row's place in its partition; the partition is above


def with_position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """`df` in order, with `name`: 1, 2, 3 ... by `order`, nulls first.

    Rows are dealt out by ranges of `order`, sorted within and written, so that every later step sees
    the same places. A partition's offset is the sum of the counts before it: a window over one row
    per partition. Columns of `order` that repeat leave the places of equal rows to chance.
    """
    placed = staged(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_id", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("_id", ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    inside = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (placed.withColumn("_part", part).join(offsets, "_part")
            .withColumn(name, F.col("_offset") + inside + 1).drop("_part", "_offset", "_id"))
