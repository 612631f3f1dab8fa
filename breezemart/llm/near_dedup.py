"""Near-duplicate documents by ProbMinHash, banding and verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breezemart.llm.components import components
from breezemart.llm.shared import remove, sieved, staged, work_folder

WORDS, LEAST = 5, 0.8
#: 25 bands of 5 registers miss a pair of similarity 0.8 with probability (1 - 0.8^5)^25 = 5e-5.
BANDS, ROWS = 25, 5
#: Words a worker remembers the hash of, and shingles sketched at once.
CACHE_WORDS, SLICE = 300_000, 400_000
#: Passes in which each bucket is compared with one member before all that is left is compared.
HUB_ROUNDS = 2
#: Buckets up to this size are compared as pairs of rows, larger ones block against block.
PAIRED = 64
#: Bytes of shingles in a block of either side, and blocks that a worker reads at once.
NEAR_BYTES, FAR_BYTES, BLOCKS_READ = 128 * 1024, 256 * 1024, 32

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode())
        if len(self) < CACHE_WORDS:
            self[word] = value
        return value


_hashes = _Hashes()


def shingles(words: list[str]) -> np.ndarray:
    """A hash per run of `WORDS` words; fewer words make one shingle, none make none."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        out = out * _U(0x9E3779B97F4A7C15) + hashes[k:k + len(out)]
    return mix(out)


def prob_min_hash(docs: list[np.ndarray], registers: int) -> np.ndarray:
    """Signatures (document x register) whose registers agree with the probability Jaccard
    similarity of two documents' shingles, weighted by how often each stands there.

    Every shingle is a Poisson process of rate its weight, whose points fall on random registers; a
    register holds the shingle of its earliest point. The points come from the shingle's hash. All
    first points are laid down, then all second points and so on; a shingle ends as soon as its last
    point is later than every register of its document.
    """
    sizes = np.array([len(d) for d in docs])
    if not sizes.sum():
        return np.zeros((len(docs), registers), np.uint64)
    keys = np.sort((np.repeat(np.arange(len(docs), dtype=np.uint64), sizes) << _U(44)) | (np.concatenate(docs) >> _U(20)))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    weight = np.diff(first, append=len(keys)).astype(np.float64)
    keys = keys[first]
    doc = (keys >> _U(44)).astype(np.int64)
    item = mix(keys & _U(2**44 - 1))
    seed, now = item.copy(), np.zeros(len(item))
    earliest = np.full(len(docs) * registers, np.inf)
    holder = np.zeros(len(docs) * registers, np.uint64)
    latest = np.full(len(docs), np.inf)
    while len(item):
        seed = seed + _U(0x9E3779B97F4A7C15)
        drawn = mix(seed)
        now = now - np.log1p(-((drawn >> _U(24)).astype(np.float64) * 2.0**-40)) / weight
        at = doc * registers + (((drawn & _U(0xFFFFFF)) * _U(registers)) >> _U(24)).astype(np.int64)
        ahead = np.flatnonzero(now < earliest[at])
        np.minimum.at(earliest, at[ahead], now[ahead])
        won = ahead[now[ahead] == earliest[at[ahead]]]
        holder[at[won]] = item[won]
        touched = np.unique(doc[won])
        latest[touched] = earliest.reshape(-1, registers)[touched].max(axis=1)
        go_on = now < latest[doc]
        if not go_on.all():
            doc, item, seed, now, weight = (x[go_on] for x in (doc, item, seed, now, weight))
    return holder.reshape(-1, registers)


def _words(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _digest(words: list[str]) -> bytes | None:
    return hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest() if words else None


def _slices(sizes: list[int]) -> Iterator[slice]:
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > SLICE:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        for run in _slices([len(t) // 6 if t else 0 for t in texts.to_pylist()]):
            words = [_words(t) for t in texts[run.start:run.stop].to_pylist()]
            signs = prob_min_hash([shingles(w) for w in words], BANDS * ROWS).reshape(len(words), BANDS, ROWS)
            bands = np.zeros((len(words), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for k in range(ROWS):
                bands = mix(bands * _U(0x9E3779B97F4A7C15) + signs[:, :, k])
            flat = pa.array(bands.astype(np.int64).ravel())
            offsets = np.arange(len(words) + 1, dtype=np.int32) * BANDS
            own = batch.slice(run.start, run.stop - run.start)
            yield pa.RecordBatch.from_arrays(
                [*own.columns[:-1], pa.array([_digest(w) for w in words], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), flat)],
                names=[*batch.schema.names[:-1], "digest", "bands"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 200):
            rows = []
            for text in batch.column(0)[i:i + 200].to_pylist():
                words = _words(text)
                items, counts = np.unique(shingles(words), return_counts=True)
                rows.append((_digest(words), items.astype("<u8").tobytes(),
                             b"" if counts.max(initial=1) == 1 else counts.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows)],
                                             names=["digest", "items", "counts"])


def probability_jaccard(a: np.ndarray, v: np.ndarray, b: np.ndarray, w: np.ndarray) -> float:
    """The chance that two documents' earliest points agree: over common items d the sum of
    1 / sum over d' of max(v[d'] / v[d], w[d'] / w[d]). Equals Jaccard where all weights are one."""
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    v, w = v.astype(float), w.astype(float)
    if (v == 1).all() and (w == 1).all():
        return len(both) / (len(a) + len(b) - len(both))
    ratio = v[i] / w[j]
    order = np.argsort(ratio, kind="stable")
    ratio, v_in, w_in = ratio[order], v[i][order], w[j][order]
    low = np.searchsorted(ratio, ratio, "left")
    v_above = np.concatenate([np.cumsum(v_in[::-1])[::-1], [0.0]])[low] + (v.sum() - v_in.sum())
    w_below = np.concatenate([[0.0], np.cumsum(w_in)])[low] + (w.sum() - w_in.sum())
    return float((1 / (v_above / v_in + w_below / w_in)).sum())


def _unpack(items: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    items = np.frombuffer(items, "<u8")
    return items, np.frombuffer(counts, "<u4") if counts else np.ones(len(items))


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in (whole.slice(i, 500) for i in range(0, whole.num_rows, 500)):
            found = [probability_jaccard(*_unpack(*row[:2]), *_unpack(*row[2:]))
                     for row in zip(*(c.to_pylist() for c in batch.columns[2:]))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.float64())],
                                             names=["a", "b", "similarity"])


def _alike(near: list[dict], far: list[dict], bucket: int, least: float) -> Iterator[tuple[int, int]]:
    """(class, part): members of one block and the parts of the other that they link with, for pairs of
    different parts that have met in no earlier band. The share of a document's shingles, by weight, that another one has is never below their
    similarity, so the similarity itself is worked out only where that share is `least` or more."""
    shapes = [_unpack(f["items"], f["counts"]) for f in far]
    items = np.concatenate([i for i, _ in shapes])
    weight = np.concatenate([c / c.sum() for _, c in shapes])
    starts = np.concatenate([[0], np.cumsum([len(i) for i, _ in shapes])[:-1]])
    bands = np.array([f["bands"] for f in far])
    parts = np.array([f["part"] for f in far])
    for one in near:
        own, counts = _unpack(one["items"], one["counts"])
        same = bands == np.array(one["bands"])
        first = bands[np.arange(len(far)), same.argmax(axis=1)] == bucket
        at = np.minimum(np.searchsorted(own, items), len(own) - 1)
        share = np.add.reduceat(np.where(own[at] == items, weight, 0.0), starts)
        linked = set()
        for k in np.flatnonzero(first & (parts != one["part"]) & (share >= least - 1e-9)):
            part = int(parts[k])
            if part not in linked and probability_jaccard(own, counts, *shapes[k]) >= least:
                linked.add(part)
                yield one["class"], part


def _block_links(members: DataFrame, minor: DataFrame, vectors: DataFrame, least: float, folder: str) -> DataFrame:
    """a, b: links between `minor` (bucket, class, part) and the parts of `members` of the same buckets (a
    part is named by one of its classes). Both sides are cut into blocks of bounded size and every
    block of one meets every block of the other, so a large bucket is spread over many tasks and gives
    one row for each part that a member links with. The shingles move twice: to their block and
    to the blocks they meet. The blocks go once their links are written."""
    spark, cut = members.sparkSession, f"{folder}/blocks"

    def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
        heavy = vectors.select("class", (F.octet_length("items") + 200).alias("_bytes"))
        sizes = rows.join(heavy, "class").groupBy("bucket").agg(F.ceil(F.sum("_bytes") / size).alias("_blocks"))
        entry = F.struct("class", "part", "bands", "items", "counts")
        return staged(rows.join(sizes, "bucket").withColumn("_block", F.pmod(F.xxhash64("class"), F.col("_blocks")))
                      .join(vectors, "class").groupBy("bucket", "_block").agg(F.collect_list(entry).alias(name))
                      .drop("_block"), f"{name}-blocks", cut)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                bucket, near, far = (batch.column(c)[row].as_py() for c in ("bucket", "near", "far"))
                links = list(_alike(near, far, bucket, least))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    met = blocks(minor, NEAR_BYTES, "near").join(blocks(members, FAR_BYTES, "far"), "bucket")
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(BLOCKS_READ))
    try:
        return staged(met.mapInArrow(compare, "a long, b long").distinct(), "block-links", folder)
    finally:
        spark.conf.set(setting, before)
        remove(spark, cut)


def _verify(pairs: DataFrame, vectors: DataFrame, name: str, folder: str) -> DataFrame:
    """a, b, similarity of the pairs, written. A hub's pairs are cut up by the skew join."""
    left = vectors.select(F.col("class").alias("a"), F.col("items").alias("a_items"), F.col("counts").alias("a_counts"))
    right = vectors.select(F.col("class").alias("b"), F.col("items").alias("b_items"), F.col("counts").alias("b_counts"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "a_items", "a_counts", "b_items", "b_counts")
    return staged(met.mapInArrow(_similar, "a long, b long, similarity double"), name, folder)


def _joined(members: DataFrame, edges: DataFrame, name: str, folder: str) -> DataFrame:
    """bucket, class, part: the members with the component of their class so far."""
    parts = components(edges, name, folder).select(F.col("node").alias("class"), "component")
    return staged(members.select("bucket", "class").join(parts, "class", "left").select(
        "bucket", "class", F.coalesce("component", "class").alias("part")), f"{name}-members", folder)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_dedup(docs: DataFrame, least: float = LEAST, carry: list[str] = ()) -> DataFrame:
    """Every row of `docs` (doc_id, text) with its class of near-duplicates.

    Words are lower-cased and split at white space; documents are near-duplicates when the
    probability Jaccard similarity of their shingles of five words, weighted by count, is `least` or
    more, and a class holds all that such links connect. Returns doc_id, class_id (the smallest
    doc_id of the class), class_size, kept (one row per class, of the smallest doc_id) and the columns
    of `carry`.

    Equal word sequences are one node, found by digest, so copies cost no pairs. Nodes that share a
    band meet in a bucket. First each member is compared with one member of its bucket, the first in
    an order that all buckets share, so that a group which meets in many buckets has few such pairs, and
    what is found alike is joined; then, exactly, every member outside its
    bucket's largest part is compared with all members of other parts, in large buckets block by block. Members of one part need no
    comparison, since the class is the same either way. Only documents that share a band with
    another text have their shingles shuffled.

    A text without words (null or empty) links with nothing and stays. Rows that repeat a doc_id
    are rows of their own; of several with the smallest doc_id of a class one is kept. A null doc_id
    is the smallest only where a class has no other. An empty table gives no rows.
    """
    text = F.col("text").cast("string")
    folder = work_folder(docs.sparkSession, "near-dedup")  # of all tables that the result does not read
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64(text).alias("mark"),
                       *[F.col(c).alias(f"carry_{c}") for c in carry], text.alias("text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("digest", T.BinaryType()),
                           T.StructField("bands", T.ArrayType(T.LongType()))])
    rows = staged(rows.mapInArrow(_sketch, schema), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "mark", "bands"))
    nodes = staged(rows.where("digest is not null").groupBy("digest").agg(first.alias("f"), F.count(F.lit(1)).alias("n"))
                   .select("digest", F.col("f.row").alias("class"), "f.doc_id", "f.mark", "f.bands", "n"), "nodes", folder)

    entries = nodes.select("class", F.explode("bands").alias("bucket"))
    crowded = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("bucket")
    members = staged(entries.join(crowded, "bucket").select("bucket", "class"), "members", folder)
    wanted = staged(members.select("class").distinct().join(nodes, "class").select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("class"), "bands", F.col("digest").alias("_digest")), "wanted", folder)
    texts = docs.select("doc_id", F.xxhash64(text).alias("mark"), text.alias("text"))
    texts = sieved(texts, F.xxhash64("doc_id", "mark"), wanted, F.xxhash64("_id", "_mark"))
    own = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))).select("text")
    shapes = own.mapInArrow(_vectors, "digest binary, items binary, counts binary").groupBy("digest").agg(
        F.first("items").alias("items"), F.first("counts").alias("counts"))
    vectors = staged(wanted.join(shapes, F.col("digest") == F.col("_digest")).select("class", "bands", "items", "counts"), "vectors", folder)

    members = members.withColumn("part", F.col("class"))
    seen = None
    for step in range(HUB_ROUNDS + 1):
        if step < HUB_ROUNDS:
            hubs = members.groupBy("bucket").agg(
                F.min(F.struct(F.xxhash64("class", F.lit(step)).alias("h"), "class", "part")).alias("hub"))
            meet = members.join(hubs, "bucket").where(F.col("part") != F.col("hub.part")).select(
                F.col("class").alias("a"), F.col("hub.class").alias("b"))
        else:
            sizes = members.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"))
            largest = sizes.groupBy("bucket").agg(F.max(F.struct("n", "part")).alias("top"), F.count(F.lit(1)).alias("parts"),
                                                  (F.sum("n") <= PAIRED).alias("paired"))
            open_members = staged(members.join(largest.where("parts > 1"), "bucket"), "open-members", folder)
            minor = open_members.where(F.col("part") != F.col("top.part"))
            small = minor.where("paired").select("bucket", F.col("class").alias("a"), F.col("part").alias("_part"))
            meet = small.join(open_members.where("paired"), "bucket").where(F.col("part") != F.col("_part")).select(
                "a", F.col("class").alias("b"))
            large = _block_links(open_members.where("not paired").select("bucket", "class", "part"),
                                 minor.where("not paired").select("bucket", "class", "part"), vectors, least, folder)
        pairs = _ordered(meet)
        if seen is not None:
            pairs = pairs.join(seen.select("a", "b"), ["a", "b"], "left_anti")
        found = _verify(staged(pairs, f"pairs-{step}", folder), vectors, f"verified-{step}", folder)
        seen = found if seen is None else seen.unionByName(found)
        edges = seen.where(F.col("similarity") >= least).select("a", "b")
        if step < HUB_ROUNDS:
            members = _joined(members, edges, f"round-{step}", folder)

    parts = components(edges.union(large), "classes", folder).select(F.col("node").alias("class"), "component")
    whole = nodes.join(parts, "class", "left").withColumn("component", F.coalesce("component", "class"))
    low = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("class").alias("row"))
    ends = whole.groupBy("component").agg(F.min(low).alias("low"), F.sum("n").alias("class_size"))
    classes = staged(whole.join(ends, "component").select(
        F.col("digest").alias("_digest"), F.col("low.doc_id").alias("class_id"), F.col("low.row").alias("_row"),
        "class_size"), "classes")
    remove(docs.sparkSession, folder)
    alone = F.col("_digest").isNull()
    return rows.join(classes, F.col("digest") == F.col("_digest"), "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        (alone | (F.col("row") == F.col("_row"))).alias("kept"), *[F.col(f"carry_{c}").alias(c) for c in carry])
