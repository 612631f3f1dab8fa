"""Sharding by weighted rendezvous hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breezemart.llm.shared import numbered, staged

CHUNKS = 1024


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (0, 1, ...) with the best score for `key`: ln(u) / weight, u in (0, 1) hashed from
    key and shard.

    A shard wins rows in proportion to its weight. Scores do not depend on the other shards, so a
    new shard only takes rows into itself and a removed one only gives its own away.
    """
    def bid(shard: int, weight: float) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + F.lit(0.5)) * F.lit(2.0**-53)
        return F.struct((F.log(u) / F.lit(float(weight))).alias("score"),
                        F.lit(-shard).alias("shard"))

    bids = F.array(*[bid(j, w) for j, w in enumerate(weights)])
    return (-F.array_max(bids)["shard"]).cast("int")


def shard(docs: DataFrame, weights: list[float], new_weight: float = 1.0) -> DataFrame:
    """Every row of `docs` (doc_id, text) with its shard, its slot there and its shard among one more.

    Returns doc_id, size (UTF-8 bytes of the text, plus 8), text_crc32, law ('key': doc_id and the
    shards decide), shard, slot (gapless from 0 in each shard) and grown_shard (with one more shard
    of `new_weight`).

    Null text: size 8, text_crc32 0, as for an empty text. Rows with a null doc_id share one shard,
    as do rows that repeat a doc_id; each still has a slot of its own. Other columns are not looked
    at. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = staged(docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"),
        rendezvous(F.col("doc_id"), weights).alias("shard"),
        rendezvous(F.col("doc_id"), [*weights, new_weight]).alias("grown_shard")), "shards")
    deal = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(CHUNKS))
    return (numbered(rows, ["shard"], deal, CHUNKS, ["doc_id", "text_crc32", "size"], "slot")
            .select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long"),
                    "grown_shard"))
