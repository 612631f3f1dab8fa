"""Reading tables, working tables in the shared folder, and ranks without one large window."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_local_folders: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path under `spark.checkpoint.dir`, the folder all executors share.

    Where the setting is absent, a local session gets a temporary folder of its own and any other
    session fails.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_folders.setdefault(context.applicationId, tempfile.mkdtemp(prefix="corpus-"))
    return f"{root.rstrip('/')}/corpus/{name}-{uuid.uuid4().hex[:12]}"


#: Has Spark delete a query's shuffle files when the query ends, not when its plan is collected.
SWEPT = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """`df` written once to the shared folder and read back: later steps start from these files,
    so a lost executor costs no recomputation and joins see real sizes. The write's shuffle files go
    with its end. `folder` is a work folder to write below, which the caller removes."""
    spark = df.sparkSession
    path = work_folder(spark, name) if folder is None else f"{folder}/{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(SWEPT, None)
    spark.conf.set(SWEPT, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SWEPT) if before is None else spark.conf.set(SWEPT, before)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a working table that nothing reads any more."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


#: Bits of a sieve for each wanted key, and words of 64 bits at most: a sieve is broadcast.
SIEVE_BITS, SIEVE_WORDS = 16, 2**20


def sieved(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """The rows whose `key` (a long hash) may be among those of `wanted`, and about one in 16 others.

    A bit is set for each wanted key. The words that hold any are broadcast: `SIEVE_WORDS` at most,
    whatever the size of `wanted`. Above four million keys the sieve lets more through, in the end
    everything; the join that follows is what decides, so nothing depends on it but how much moves.
    """
    words = min(SIEVE_WORDS, max(1, -(-wanted.count() * SIEVE_BITS // 64)))

    def word(of: Column) -> Column:
        return F.pmod(F.shiftright(of, 6), F.lit(words))

    def bit(of: Column) -> Column:
        return of.bitwiseAND(F.lit(63)).cast("int")

    held = staged(wanted.groupBy(word(wanted_key).alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit(wanted_key))).alias("_bits")), "sieve")
    met = rows.join(F.broadcast(held), word(key) == F.col("_word"))
    hit = F.call_function("shiftright", F.col("_bits"), bit(key)).bitwiseAND(F.lit(1)) == 1
    return met.where(hit).drop("_word", "_bits")


def numbered(df: DataFrame, group: list[str], chunk: Column, chunks: int, order: list[str],
             name: str) -> DataFrame:
    """`df` with the column `name`: 0, 1, 2 ... within each `group`, by `chunk` and then `order`.

    `chunk` deals the rows of a group to 0 .. `chunks` - 1, so that no window holds more than one
    chunk of a group; the starts of the chunks come from a count of each. `df` is read twice.
    """
    dealt = df.withColumn("_chunk", chunk)
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy(*group, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .select(*[F.col(c).alias(f"_of_{c}") for c in group], F.col("_chunk").alias("_of_chunk"),
                      "_start"))
    inside = Window.partitionBy(*group, "_chunk").orderBy(*order)
    same = F.col("_chunk") == F.col("_of_chunk")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return (dealt.withColumn("_at", F.row_number().over(inside) - 1).join(starts, same)
            .withColumn(name, F.col("_start") + F.col("_at"))
            .drop("_chunk", "_at", "_start", "_of_chunk", *[f"_of_{c}" for c in group]))
