"""How five filters act on each other, counted by a stream that takes counts back.

Whether a text repeats one of a smaller doc_id depends on all files, so a document's failures are
final only at the end. The stream does not wait: every micro-batch counts its documents by part and
mask of failures, the smallest doc_id of each text is kept as state, and where a smaller one arrives
the former holder is taken out of its old mask (a count of -1) and put into the one with E.

A micro-batch of files is worked on in built-ins alone:

1. in the scan: mask of A to D and the text's SHA-256; texts go no further. The narrow rows, with
   their labels, are written once;
2. all rows are counted by (part, mask) as if they repeated a smaller doc_id;
3. per text the rows of the smallest doc_id of the micro-batch are candidates: a minimum, reduced in
   the map tasks, so a text with a third of all rows is one row per task;
4. candidates against the state by the text's digest: those that are not larger than the smallest so
   far leave E and are added to the state; holders that they beat are taken back into E;
5. the state only grows by a written level for each micro-batch; a text's holders are its rows with
   the smallest doc_id over the levels. Levels and changes are folders of the micro-batch, which reads
   the levels before its own, so a replay replaces what it wrote and gives the same.

The sum over the changes of all micro-batches is the table's count.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from breezemart.llm.shared import remove, work_folder

LETTERS = "ABCDE"
REPEAT = 1 << LETTERS.index("E")
#: Micro-batches a table is read in, at most: each reads the state of those before it.
BATCHES = 8

COUNTS = ["n", "good", "toxic"]
HOLDERS = "digest binary, least bigint, mask int, part string, n bigint, good bigint, toxic bigint"
CHANGES = "part string, mask int, n bigint, good bigint, toxic bigint"


def failures(docs: DataFrame) -> DataFrame:
    """doc_id (0 where null), known (whether it is not), part, digest, mask of A to D. Built-ins only."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    cut = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"), words.alias("words"))
    count = F.size("words").cast("long")
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long")
    failed = [count < 100, 100 * F.size(F.array_distinct("words")).cast("long") < 80 * count,
              100 * capitals > 10 * F.length("text").cast("long"), F.col("text").rlike(r"[#$%&*|]")]
    mask = sum(F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(failed))
    return cut.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
                      F.col("doc_id").isNotNull().alias("known"), "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                      mask.cast("int").alias("mask"))


def _counted(rows: DataFrame, mask: Column, sign: int = 1) -> DataFrame:
    return rows.select("part", mask.cast("int").alias("mask"), *[(sign * F.col(c)).alias(c) for c in COUNTS])


def _candidates(rows: DataFrame) -> DataFrame:
    """Per text the rows of its smallest doc_id, summed by part (rows may repeat a doc_id).

    The join is on text and doc_id, so the rows of a common text are spread.
    """
    numbered = rows.where("known")
    least = numbered.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    return (numbered.join(least, ["digest", "doc_id"]).groupBy("digest", F.col("doc_id").alias("least"), "mask", "part")
            .agg(*[F.sum(c).alias(c) for c in COUNTS]))


def settle(rows: DataFrame, levels: list[str], level: str, changes: str) -> None:
    """One micro-batch: `rows` against the state in `levels`; writes its own `level` and `changes`."""
    spark = rows.sparkSession
    plain, repeated = F.col("mask"), F.col("mask").bitwiseOR(F.lit(REPEAT))
    state = spark.read.schema(HOLDERS).parquet(*levels) if levels else spark.createDataFrame([], HOLDERS)
    known = state.groupBy("digest").agg(F.min("least").alias("_before"))
    won = _candidates(rows).join(known, "digest", "left").where("_before is null or least <= _before")
    won.drop("_before").write.mode("overwrite").parquet(level)

    won = spark.read.schema(HOLDERS).parquet(level)
    beaten = won.groupBy("digest").agg(F.min("least").alias("_now")).join(known, "digest").where("_now < _before")
    former = state.join(beaten, "digest").where("least = _before")
    parts = [_counted(rows, F.when(F.col("known"), repeated).otherwise(plain)),
             _counted(won, plain), _counted(won, repeated, -1),
             _counted(former, plain, -1), _counted(former, repeated)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionAll(part)
    (union.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS])
     .where(" or ".join(f"{c} <> 0" for c in COUNTS)).write.mode("overwrite").parquet(changes))


def mask_counts(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """part, mask, n, good, toxic: documents of the Parquet files at `path` by what they fail.

    All files are processed as available-now micro-batches, `batches` at most. `labels` (doc_id,
    quality, toxic) is written once, reduced to one row per doc_id, and joined to narrow rows.
    """
    out = work_folder(spark, "filter-audit")
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).cast("long").alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).cast("long").alias("toxic"))
    marked.write.parquet(f"{out}/labels")

    def process(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        marks = session.read.parquet(f"{out}/labels").withColumnRenamed("doc_id", "_labelled")
        rows = batch.join(marks, F.col("known") & (F.col("doc_id") == F.col("_labelled")), "left").select(
            "doc_id", "known", "digest", "part", "mask", F.lit(1).cast("long").alias("n"),
            *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS[1:]])
        own = f"{out}/rows/batch={number}"
        rows.write.mode("overwrite").parquet(own)
        settle(session.read.schema(rows.schema).parquet(own), [f"{out}/state/batch={k}" for k in range(number)],
               f"{out}/state/batch={number}", f"{out}/changes/batch={number}")
        remove(session, own)

    named = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"  # as a pattern it may also be a single file
    raw = (spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, -(-files // batches)))
           .parquet(named))
    (failures(raw).writeStream.foreachBatch(process).option("checkpointLocation", f"{out}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    if not files:
        return spark.createDataFrame([], CHANGES)
    stored = spark.read.schema(f"{CHANGES}, batch int").parquet(f"{out}/changes")
    return stored.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS])


def _bit(letter: Column) -> Column:
    return sum(F.when(letter == name, F.lit(1 << i)).otherwise(F.lit(0)) for i, name in enumerate(LETTERS))


def interactions(counts: DataFrame) -> DataFrame:
    """The effect of every filter at every place of every order, from rows of `mask_counts`.

    At most 32 rows per part come in, and each is held against the fixed 120 x 5 places.
    """
    orders = F.array(*[F.lit("".join(p)) for p in itertools.permutations(LETTERS)])
    placed = (counts.select("*", F.explode(orders).alias("filter_order"))
              .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step")))
    before = F.expr("substring(filter_order, 1, step - 1)")
    bit = _bit(F.expr("substring(filter_order, step, 1)"))
    earlier = sum(F.when(F.instr(before, name) > 0, F.lit(1 << i)).otherwise(F.lit(0)) for i, name in enumerate(LETTERS))
    marked = placed.select("part", "filter_order", "step", "mask", *COUNTS, bit.alias("bit"), earlier.alias("earlier"))
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("earlier")) != 0

    def total(where: Column, count: str = "n") -> Column:
        return F.sum(F.when(where, F.col(count)).otherwise(F.lit(0))).cast("long")

    steps = marked.groupBy("part", "filter_order", "step").agg(
        total(~gone & ~fails).alias("kept"), total(~gone & fails).alias("removed"),
        total(gone & fails).alias("redundant"), total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(~gone & fails, "good").alias("good_lost"), total(~gone & fails, "toxic").alias("toxic_lost"))
    letter = F.expr("substring(filter_order, step, 1)")
    steps = steps.withColumn("_letter", letter)
    shares = steps.groupBy(F.col("part").alias("_part"), F.col("_letter").alias("_of")).agg(
        F.sum("removed").alias("shapley"))
    return (steps.join(shares, (F.col("part") == F.col("_part")) & (F.col("_letter") == F.col("_of")))
            .drop("_letter", "_part", "_of"))


def filter_audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The audit of the documents (doc_id, text, lang) in the Parquet files at `path`.

    Returns per part (lang; null: empty), filter_order (all 120) and step (1 to 5) the documents kept
    after the step, removed there, redundant (fail its filter, gone before), unique_fails (fail it
    alone), good_lost and toxic_lost (removed there with quality or toxic 1 in `labels`), and shapley
    (what its filter removes, over all orders). A null text is empty. A null doc_id is smaller than
    none and larger than none: such rows never fail E and make no other row fail it. Rows that repeat
    the smallest doc_id of their text pass E together. A doc_id that `labels` holds several times is
    good, or toxic, if one of its rows says so. An empty table gives no rows; other columns are not read.
    """
    return interactions(mask_counts(spark, path, labels, batches))
