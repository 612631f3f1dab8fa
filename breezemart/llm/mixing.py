"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breezemart.llm.shared import staged

#: Key ranges per source and level; two levels leave a millionth of a source to one window.
BINS, LEVELS = 1024, 2
WORD = r"[^\x20\x09-\x0D]+"
JUNK = r"[#$%&*|!]"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column, size: Column) -> Column:
    """In (0, 1]: 1 / (1 + marks of `#$%&*|!` per word); 1 for no words."""
    marks = F.length(text) - F.length(F.regexp_replace(text, JUNK, ""))
    return F.coalesce(F.when(size > 0, size.cast("double") / (size + marks)), F.lit(1.0))


def draw(key: Column) -> Column:
    """Uniform in (0, 1), the same for a key in every run: 48 bits of its MD5."""
    bits = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, 12), 16, 10)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(2.0**48)


def targets(sizes: DataFrame, weights: list[float], most: float, share: float = 1.0) -> DataFrame:
    """`target` for each row of `sizes` (source, source_size).

    Sources weigh `weights` in turn, by code point, null last, and split `share` of all sizes by
    weight; a target stops at `most` times its source's size and the excess goes to the others by
    weight, until none is above. That fixed point is min(most * size, level * weight): sources are
    taken as full in the order of most * size / weight until the level of the rest exceeds no
    next one. The windows run over one row per source.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    caps = (sizes.withColumn("_w", F.get(cycle, (F.row_number().over(ordered) - 1) % len(weights)))
            .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
            .withColumn("_ratio", F.col("_cap") / F.col("_w")))
    everything = Window.partitionBy(F.lit(0))
    by_ratio = Window.partitionBy(F.lit(0)).orderBy("_ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    since = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(since)
    found = caps.withColumn("_level", level).withColumn(
        "_open", F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(everything))
    return found.select("source", "source_size", F.coalesce(
        F.least("_cap", F.col("_open") * F.col("_w")), F.col("_cap")).alias("target"))


def mix(docs: DataFrame, weights: list[float] = (1, 2, 3), most: float = 3.0, share: float = 1.0,
        carry: list[str] = ()) -> DataFrame:
    """What a mix of the sources takes of each row of `docs` (doc_id, text, source).

    Returns doc_id, size (words of the text), source_size, target (of its source), taken (words the
    mix takes, repeats counted: a multiple of size) and the columns of `carry`. Whole epochs of a
    source come first: every document as often as its target holds its size. The rest of the target
    is drawn without replacement with probability by quality: keys -ln(u) / quality, u hashed from
    doc_id, in ascending order, as long as the words fit; the document that crosses the budget is
    taken if that comes nearer to it.

    The running sum needs no window over a source: words are summed per key range, the range in
    which the budget ends is divided again, and only what is left there is summed row by row.

    Null text: size 0, nothing taken. A null source is a source. Rows that repeat a doc_id are rows
    of their own. An empty table gives no rows; without any words all targets are 0.
    """
    text, size = F.col("text").cast("string"), F.col("size")
    key = -F.log(draw(F.col("doc_id"))) / quality(F.col("_text"), size)
    rows = staged(docs.select("doc_id", "source", words(text).alias("size"), text.alias("_text"),
                              *[F.col(c).alias(f"_carry_{c}") for c in carry])
                  .withColumn("_key", key)
                  .withColumn("_bin", F.floor((1 - F.exp(-F.col("_key"))) * F.lit(float(BINS**LEVELS))))
                  .drop("_text"), "mix-keys")

    # from here on a table of one row per source: goals, then the key range the budget ends in
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    edge = staged(targets(sums, weights, most, share).select(
        F.col("source").alias("_source"), "source_size", "target", epochs.cast("long").alias("_epochs"),
        (F.col("target") - epochs * F.col("source_size")).alias("_rest"),
        F.lit(0).cast("long").alias("_edge"), F.lit(0).cast("long").alias("_before")), "mix-goals")
    same = F.col("source").eqNullSafe(F.col("_source"))
    for level in range(LEVELS):
        width = BINS ** (LEVELS - 1 - level)
        here = F.floor(F.col("_bin") / F.lit(width))
        up_to = Window.partitionBy("_source").orderBy("_here")
        sums = (rows.select("source", "size", "_bin").join(edge, same)
                .where(F.floor(F.col("_bin") / F.lit(width * BINS)) == F.col("_edge"))
                .groupBy(*edge.columns, here.alias("_here")).agg(F.sum("size").alias("_n"))
                .withColumn("_sum", F.col("_before") + F.sum("_n").over(up_to)))
        ends = F.struct("_here", (F.col("_sum") - F.col("_n")).alias("before"))
        hits = sums.groupBy(F.col("_source").alias("_with")).agg(
            F.min(F.when(F.col("_sum") > F.col("_rest"), ends)).alias("_hit"))
        edge = staged(edge.join(hits, F.col("_source").eqNullSafe(F.col("_with")), "left").select(
            "_source", "source_size", "target", "_epochs", "_rest",
            F.coalesce("_hit._here", F.lit(-1).cast("long")).alias("_edge"),
            F.coalesce("_hit.before", "_before").alias("_before")), "mix-edge")

    met = rows.join(edge, same)
    apart = met.where(F.col("_bin") != F.col("_edge")).withColumn(
        "_chosen", (F.col("_bin") < F.col("_edge")) | (F.col("_edge") < 0))
    so_far = F.col("_before") + F.sum("size").over(
        Window.partitionBy("_source").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    near = (F.col("_so_far") <= F.col("_rest")) | (
        (F.col("_so_far") - size < F.col("_rest"))
        & (F.col("_so_far") - F.col("_rest") <= F.col("_rest") - (F.col("_so_far") - size)))
    inside = (met.where(F.col("_bin") == F.col("_edge")).withColumn("_so_far", so_far)
              .withColumn("_chosen", near).drop("_so_far"))
    times = F.col("_epochs") + F.col("_chosen").cast("long")
    return apart.unionByName(inside).select(
        "doc_id", "size", "source_size", "target", (size * times).alias("taken"),
        *[F.col(f"_carry_{c}").alias(c) for c in carry])


def mixed_rows(docs: DataFrame, weights: list[float] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """The rows of `docs` (all columns), each as often as the mix takes it; rows without words go."""
    own = [c for c in docs.columns if c != "doc_id"]
    taken = mix(docs.select("doc_id", "text", "source", F.struct(*own).alias("kept_columns")), weights, most,
                carry=["kept_columns"])
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    return taken.withColumn("copies", F.array_repeat(F.lit(1), times)).where(F.size("copies") > 0).select(
        "doc_id", "kept_columns", F.explode("copies")).select(
        *[F.col(c) if c == "doc_id" else F.col("kept_columns")[c].alias(c) for c in docs.columns])
