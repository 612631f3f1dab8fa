"""Personal data by bootstrapped contextual extraction, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breezemart.llm.shared import staged

KINDS = ["email", "ip", "card", "phone"]
#: The fixed patterns. Possessive repeats and the look-behind give the same leftmost matches as plain
#: ones in time linear in the text: a match begins where a run begins or where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Words with a digit or an at sign, the instances that a context may reveal.
CANDIDATE = r"(?:\G|(?<!\S))[^\s0-9@]*+[0-9@]\S*+"
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "candidate": None}

ROUNDS, SURE, SUPPORT = 3, 0.9, 5
#: Code points before an instance in which its context word is looked for.
CONTEXT = 40


def _matches(text: Column, pattern: str, need: str | None) -> Column:
    """Array of (gap: code points since the last match, left: the end of that gap, value), null
    where the text can hold no match."""
    gaps = F.split(text, pattern, -1)
    found = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), gaps, lambda value, gap: F.struct(
        F.length(gap).alias("gap"), F.right(gap, F.lit(CONTEXT)).alias("left"), value.alias("value")))
    may = text.rlike("[0-9@]") if need is None else text.contains(need)
    return F.when(may, F.filter(found, lambda m: m["value"].isNotNull()))


def _luhn(digits: Column) -> Column:
    """Whether 12 to 19 digits pass; longer strings are not walked through."""
    length = F.least(F.length(digits), F.lit(19))

    def worth(i: Column) -> Column:
        digit = F.substring(digits, length - i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.transform(F.sequence(F.lit(0), length - 1), worth), F.lit(0), lambda a, x: a + x)
    return F.length(digits).between(12, 19) & (total % 10 == 0)


def _holds(kind: Column, value: Column) -> Column:
    """Whether a match of a fixed pattern stands: parts up to 255, Luhn, numbers of digits."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    part_fits = F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike(
        "^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    return (F.when(kind == "email", F.lit(True)).when(kind == "ip", part_fits)
            .when(kind == "card", F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False))
            .when(kind == "phone", F.length(digits).between(9, 15)).otherwise(F.lit(True)))


def _word_before(left: Column) -> Column:
    """The lower-case letters of the last word before an instance; null where there are none."""
    word = F.lower(F.regexp_replace(F.regexp_extract(left, r"(\S+)\s*$", 1), r"[^\p{L}]", ""))
    return F.when(word != "", word)


def _instances(rows: DataFrame) -> DataFrame:
    """row, kind ('candidate' too), start, stop, value, word of all matches that stand. The starts are
    running sums over the matches of one document and kind."""
    each = rows.where("found is not null").select("row", F.posexplode("found").alias("_", "m")).select(
        "row", "m.kind", F.posexplode("m.matches").alias("at", "x"))
    so_far = F.sum(F.col("x.gap") + F.length("x.value")).over(
        Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    spans = each.withColumn("stop", so_far).where(_holds(F.col("kind"), F.col("x.value")))
    # a candidate is taken without the punctuation around it
    plain = F.col("kind") != "candidate"
    lead = F.when(plain, 0).otherwise(F.length(F.regexp_extract("x.value", r"^[^\p{L}0-9@+]*", 0)))
    tail = F.when(plain, 0).otherwise(F.length(F.regexp_extract("x.value", r"[^\p{L}0-9]*$", 0)))
    size = F.length("x.value")
    return spans.withColumn("lead", lead).withColumn("tail", tail).where(F.col("lead") + F.col("tail") < size).select(
        "row", "kind", (F.col("stop") - size + F.col("lead")).alias("start"), (F.col("stop") - F.col("tail")).alias("stop"),
        F.substring("x.value", F.col("lead") + 1, size - F.col("lead") - F.col("tail")).alias("value"),
        _word_before(F.col("x.left")).alias("word"))


def _unseen(instances: DataFrame) -> DataFrame:
    """The candidates that overlap no fixed match of their document."""
    known = F.col("kind") != "candidate"
    ordered = Window.partitionBy("row").orderBy("start", "stop")
    before = F.max(F.when(known, F.col("stop"))).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(known, F.col("start"))).over(ordered.rowsBetween(1, Window.unboundedFollowing))
    return (instances.withColumn("_before", before).withColumn("_after", after)
            .where(~known & (F.coalesce("_before", F.lit(0)) <= F.col("start"))
                   & (F.coalesce("_after", F.col("stop")) >= F.col("stop"))).drop("_before", "_after"))


def learn_patterns(seeds: DataFrame, unseen: DataFrame, rounds: int = ROUNDS, sure: float = SURE,
                   support: int = SUPPORT) -> DataFrame:
    """word, kind, score: contexts whose instances are of one kind, scored over the graph of
    pattern words and instances.

    A seed has score 1 for its own kind. A pattern scores the mean of its distinct instances; an
    unseen instance scores 1 - product of (1 - score) over its patterns that are sure. After
    each round instances found raise the patterns they share. Patterns need `support` distinct seeds
    and a score of `sure`.
    """
    links = staged(seeds.where("word is not null").select("word", "value", "kind").distinct().union(
        unseen.where("word is not null").select("word", "value", F.lit(None).cast("string").alias("kind")).distinct()),
        "pii-links")
    facts = links.where("kind is not null").withColumn("score", F.lit(1.0))
    per_word = staged(links.select("word", "value").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("n")), "pii-words")
    open_links = links.where("kind is null").select("word", "value")
    found = None
    for step in range(rounds):
        held = facts.withColumn("seed", F.lit(1))
        if found is not None:
            held = held.unionByName(open_links.join(found, "value").withColumn("seed", F.lit(0)).select(*held.columns))
        patterns = staged(held.groupBy("word", "kind").agg(F.sum("score").alias("s"), F.sum("seed").alias("seeds"))
                          .where(F.col("seeds") >= support).join(per_word, "word")
                          .select("word", "kind", F.least(F.col("s") / F.col("n"), F.lit(1.0)).alias("score"))
                          .where(F.col("score") >= sure), f"pii-patterns-{step}")
        doubt = F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-6))))
        found = staged(open_links.join(patterns, "word").groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("score")),
                       f"pii-found-{step}")
    best = F.max(F.struct("score", "kind")).alias("best")
    return patterns.groupBy("word").agg(best).select("word", "best.kind", "best.score")


def find_pii(docs: DataFrame) -> DataFrame:
    """Every row of `docs` (doc_id, text) with the personal data in it.

    Returns doc_id, n_email, n_ip, n_card, n_phone (matches of the fixed patterns), base_sha256 (of
    these matches as kind:start:end, by start and kind, comma-joined; code points, end exclusive)
    and spans (the same with what the contexts reveal added).

    The matches of the fixed patterns seed a bootstrap: the word before an instance is its pattern,
    patterns and instances score each other over the whole table, and an unseen word with a digit or an at
    sign becomes a span of the kind of its pattern where that is sure. Fixed matches always stay.

    A null text counts as empty: no spans. A null doc_id and rows that repeat one are documents of
    their own. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kinds = [(k, PATTERNS[k]) for k in KINDS] + [("candidate", CANDIDATE)]
    found = F.array(*[F.struct(F.lit(k).alias("kind"), _matches(text, p, NEEDS[k]).alias("matches")) for k, p in kinds])
    rows = staged(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.when(
        text.rlike("[0-9@]"), F.filter(found, lambda m: F.size(m["matches"]) > 0)).alias("found")), "pii-matches")
    instances = staged(_instances(rows), "pii-instances")
    unseen = staged(_unseen(instances), "pii-unseen")
    seeds = instances.where("kind <> 'candidate'")
    patterns = learn_patterns(seeds, unseen)
    added = unseen.drop("kind").join(patterns, "word").select("row", "kind", "start", "stop", F.lit(False).alias("base"))
    spans = seeds.select("row", "kind", "start", "stop", F.lit(True).alias("base")).unionByName(added)

    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    listed = spans.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", order.alias("k"), "stop", "kind", "base"))).alias("spans"),
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS])

    def told(column: Column) -> Column:
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    every = F.coalesce("spans", F.array().cast(listed.schema["spans"].dataType))
    listed = listed.select(F.col("row").alias("_row"), "spans", *[f"n_{k}" for k in KINDS])
    return rows.select("row", "doc_id").join(listed, F.col("row") == F.col("_row"), "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(told(F.filter(every, lambda s: s["base"])), 256).alias("base_sha256"), told(every).alias("spans"))
