"""Near-duplicate embeddings by a forest of random-projection trees with spill."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breezemart.llm.components import components
from breezemart.llm.shared import staged

TREES, SPILL, THRESHOLD = 8, 0.06, 0.93
#: Rows that the upper levels are fitted on, rows of that sample in a leaf, and rows of a leaf of all
#: data that are compared without a further split.
SAMPLE, SAMPLE_LEAF, LEAF, DEPTH = 20_000, 128, 512, 40
BLOCK = 2048


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def direction(seed: tuple[int, ...], dims: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal(dims)


def halves(shadow: np.ndarray) -> tuple[float, float, float]:
    """The median and the edges of the overlap around it, in quantiles."""
    return tuple(np.quantile(shadow, [0.5 - SPILL, 0.5, 0.5 + SPILL]))


class Tree:
    """Random splits at the medians of a sample, with overlap: node k has the children 2k and 2k + 1."""

    def __init__(self, tree: int, sample: np.ndarray):
        self.tree, self.splits = tree, {}
        self._grow(1, sample)

    def _grow(self, node: int, sample: np.ndarray) -> None:
        if len(sample) <= SAMPLE_LEAF or node.bit_length() > DEPTH:
            return
        shadow = sample @ direction((self.tree, node), sample.shape[1])
        low, middle, high = halves(shadow)
        if not low < high:
            return
        self.splits[node] = low, high
        self._grow(2 * node, sample[shadow <= middle])
        self._grow(2 * node + 1, sample[shadow > middle])

    def leaves(self, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows) for all leaves that hold a row; overlaps put a row into several."""
        waiting = [(1, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            if node not in self.splits:
                yield node, rows
                continue
            low, high = self.splits[node]
            shadow = vectors[rows] @ direction((self.tree, node), vectors.shape[1])
            for child, inside in ((2 * node, shadow <= high), (2 * node + 1, shadow >= low)):
                if inside.any():
                    waiting.append((child, rows[inside]))


def pairs_within(vectors: np.ndarray, seed: tuple[int, ...], least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows with cosine of at least `least`: groups above `LEAF` rows go on splitting as the
    tree above them does; what cannot be split is compared block by block."""
    waiting = [(1, np.arange(len(vectors)))]
    while waiting:
        node, rows = waiting.pop()
        if len(rows) > LEAF and node.bit_length() <= DEPTH:
            shadow = vectors[rows] @ direction((*seed, node), vectors.shape[1])
            low, _, high = halves(shadow)
            left, right = rows[shadow <= high], rows[shadow >= low]
            if max(len(left), len(right)) < 0.9 * len(rows):
                waiting += [(2 * node, left), (2 * node + 1, right)]
                continue
        for i in range(0, len(rows), BLOCK):
            for j in range(i, len(rows), BLOCK):
                near = vectors[rows[i:i + BLOCK]] @ vectors[rows[j:j + BLOCK]].T >= least
                a, b = np.nonzero(np.triu(near, 1) if i == j else near)
                yield rows[i + a], rows[j + b]


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        digests, dims = [], []
        for vector, label in zip(frame["embedding"], frame["label"]):
            v = None if vector is None or pd.isna(label) else np.asarray(vector, np.float64)
            good = v is not None and len(v) and np.isfinite(v).all() and v.any()
            digests.append(hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest() if good else None)
            dims.append(len(v) if good else 0)
        yield pd.DataFrame({"row": frame["row"], "vec_id": frame["vec_id"], "label": frame["label"],
                            "dims": np.array(dims, np.int32), "digest": digests, "embedding": frame["embedding"]})


def near_embeddings(table: DataFrame, least: float = THRESHOLD, trees: int = TREES) -> DataFrame:
    """Every row of `table` (vec_id, embedding, label) with its links of cosine >= `least`.

    Returns vec_id, n_links (other rows linked directly), component_id (the smallest vec_id reachable
    by links), kept (vec_id = component_id). Rows link only under equal labels and dimensions. Equal
    vectors are one class, found by digest, so copies cost no pairs; n_links counts their rows.

    The upper levels of each tree are fitted on at most `SAMPLE` rows (by a hash order); every
    row is dealt through them to (label, leaf), a few leaves where it falls into overlaps. A leaf that
    is still large goes on splitting inside its task. Pairs are verified by the cosine in double
    precision and united over the trees.

    A null label, a null, empty or zero vector and one with null or non-finite components link with
    nothing: n_links 0, a component of its own, kept. Rows that repeat a vec_id are vectors of their
    own under that id. A null vec_id is never the smallest of a component that has another. An empty
    table gives no rows.
    """
    ids, labels = table.schema["vec_id"].dataType, table.schema["label"].dataType
    fields = [T.StructField("row", T.LongType()), T.StructField("vec_id", ids), T.StructField("label", labels),
              T.StructField("dims", T.IntegerType()), T.StructField("digest", T.BinaryType()),
              T.StructField("embedding", table.schema["embedding"].dataType)]
    rows = staged(table.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "embedding")
                  .mapInPandas(_read, T.StructType(fields)), "vectors")
    good = rows.where("digest is not null")
    classes = staged(good.groupBy("label", "dims", "digest").agg(
        F.min(F.struct("row", "embedding")).alias("first"), F.count(F.lit(1)).alias("n"),
        F.min("vec_id").alias("least_id")).select(
            "label", "dims", "digest", F.col("first.row").alias("class"), "first.embedding", "n", "least_id"), "classes")

    taken = classes.select("dims", "embedding").orderBy(F.xxhash64("class")).limit(SAMPLE).toPandas()
    forest = {int(dims): [Tree(t, unit(np.stack(own["embedding"].to_numpy()).astype(np.float64))) for t in range(trees)]
              for dims, own in taken.groupby("dims")}
    shared = table.sparkSession.sparkContext.broadcast(forest)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dims, own in frame.groupby("dims"):
                vectors = unit(np.stack(own["embedding"].to_numpy()).astype(np.float64))
                for tree in shared.value.get(int(dims)) or [Tree(t, vectors[:0]) for t in range(trees)]:
                    for leaf, at in tree.leaves(vectors):
                        part = own.iloc[at]
                        yield part.assign(tree=np.int32(tree.tree), leaf=np.int64(leaf))

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        if len(frame) < 2:
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        vectors = unit(np.stack(frame["embedding"].to_numpy()).astype(np.float64))
        found = list(pairs_within(vectors, (int(key[2]), int(key[3])), least))
        at, ids = (np.concatenate(x) for x in zip(*found)), frame["class"].to_numpy()
        a, b = (ids[x] for x in at)
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    dealt = classes.select("class", "label", "dims", "embedding")
    spread = dealt.mapInPandas(deal, T.StructType([
        *dealt.schema.fields, T.StructField("tree", T.IntegerType()), T.StructField("leaf", T.LongType())]))
    pairs = staged(spread.groupBy("label", "dims", "tree", "leaf")
                   .applyInPandas(compare, "a long, b long").distinct(), "vector-pairs")

    sizes = classes.select(F.col("class").alias("b"), "n")
    linked = (pairs.union(pairs.select("b", "a")).join(sizes, "b").groupBy(F.col("a").alias("class"))
              .agg(F.sum("n").alias("others")))
    parts = components(pairs, "vectors").select(F.col("node").alias("class"), "component")
    whole = classes.join(linked, "class", "left").join(parts, "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    ends = whole.groupBy("component").agg(F.min("least_id").alias("component_id"))
    found = staged(whole.join(ends, "component").select(
        "label", "dims", "digest", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        "component_id"), "vector-classes")
    at = (F.col("r.digest") == F.col("f.digest")) & (F.col("r.label") == F.col("f.label")) & (F.col("r.dims") == F.col("f.dims"))
    own = F.when(F.col("f.digest").isNull(), F.col("r.vec_id")).otherwise(F.col("f.component_id"))
    return rows.drop("embedding").alias("r").join(found.alias("f"), at, "left").select(
        F.col("r.vec_id").alias("vec_id"), F.coalesce("f.n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"), F.col("r.vec_id").eqNullSafe(own).alias("kept"))
