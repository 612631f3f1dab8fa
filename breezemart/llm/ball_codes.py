"""Vectors as short codes: product quantisation whose codebooks come from ball k-means.

Vectors are scaled to integers and cut into parts; each part position has a codebook, improved by
rounds of k-means. All arithmetic is on integers, so results do not depend on partitions or order.

A round compares only what can change. In a block of vectors, the parts of one entry are a ball
around it. An entry nearer to the ball's entry than twice the ball's radius is a neighbour; no other
can win a part. Neighbours sorted by distance cut the ball into rings: a part at distance d is
compared with the neighbours within 2d, and below half the nearest neighbour it lies in the stable
core and is compared with none. A ball whose entry and neighbours did not move is skipped whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breezemart.llm.shared import remove, staged, work_folder

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a block at most: a block and its temporary arrays are what a task holds.
BLOCK = 4096
#: Largest scaled component: squared distances of parts up to 256 wide stay below 2^63.
LARGEST = 2**26


class Codes(NamedTuple):
    """`codes`: vec_id, label, code (one byte per part), error. `books`: part, entry, position."""

    codes: DataFrame
    books: np.ndarray


def _distances(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    return ((x - entry) ** 2).sum(axis=1)


def first_codes(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries and squared distances, by comparison with every entry."""
    codes, best = np.zeros(len(x), np.uint8), _distances(x, book[0])
    for j in range(1, len(book)):
        d = _distances(x, book[j])
        closer = d < best
        codes[closer], best[closer] = j, d[closer]
    return codes, best


def ball_codes(x: np.ndarray, codes: np.ndarray, radii: np.ndarray, book: np.ndarray, still: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entries of parts that were nearest to `codes` in the round before.

    `radii` are squared bounds of the balls then, `still` marks entries that have not moved since.
    Returns new codes, new radii and how many distances were computed. Ties go to the lower index.
    """
    gaps = ((book[:, None] - book[None]) ** 2).sum(axis=2)
    out, computed = codes.copy(), 0
    grown = np.full(len(book), -1, np.int64)
    for i in np.unique(codes):
        others = np.flatnonzero(np.arange(len(book)) != i)
        if still[i] and still[others[gaps[i, others] <= 4 * radii[i]]].all():
            grown[i] = max(grown[i], radii[i])
            continue
        rows = np.flatnonzero(codes == i)
        best, at = _distances(x[rows], book[i]), np.full(len(rows), i, np.uint8)
        computed += len(rows)
        near = others[gaps[i, others] <= 4 * best.max()]
        near = near[np.argsort(gaps[i, near], kind="stable")]
        ring = np.searchsorted(gaps[i, near], 4 * best, side="right")
        for k, j in enumerate(near):
            inside = np.flatnonzero(ring > k)
            d = _distances(x[rows[inside]], book[j])
            computed += len(inside)
            closer = (d < best[inside]) | ((d == best[inside]) & (j < at[inside]))
            best[inside[closer]], at[inside[closer]] = d[closer], j
        out[rows] = at
        np.maximum.at(grown, at, best)
    return out, grown, computed


def _narrow(values: np.ndarray) -> np.ndarray:
    """The smallest integer type that holds the values; blocks are written once a round."""
    most = np.abs(values).max(initial=0)
    return values.astype(np.int16 if most < 2**15 else np.int32)


def _scaled(batches: Iterator[pa.RecordBatch], dims: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            ids, labels, vectors = batch.slice(start, BLOCK).columns
            values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
            if np.abs(values).max(initial=0) > LARGEST:
                raise OverflowError(f"a component is beyond {LARGEST / SCALE}")
            values = _narrow(values.reshape(len(ids), dims))
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays([0, len(ids)], ids), pa.ListArray.from_arrays([0, len(ids)], labels),
                pa.array([values.itemsize], pa.int32()), pa.array([values.tobytes()], pa.binary()),
                pa.array([b""], pa.binary()), pa.array([b""], pa.binary()),
                pa.array([[]], pa.list_(pa.int64()))], schema=schema)


class _Block(NamedTuple):
    values: np.ndarray
    codes: np.ndarray
    radii: np.ndarray


def _read(row: dict, parts: int, entries: int, dims: int) -> _Block:
    values = np.frombuffer(row["values"], f"<i{row['width']}").reshape(-1, parts, dims // parts).astype(np.int64)
    return _Block(values, np.frombuffer(row["codes"], np.uint8).reshape(-1, parts).copy(),
                  np.frombuffer(row["radii"], "<i8").reshape(-1, entries).copy())


def _moved(block: _Block, books: np.ndarray, still: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes and radii of a block, and what its moves add to sums and counts: (part, entry, width + 1)."""
    parts, entries, width = books.shape
    new = np.zeros((len(block.values), parts), np.uint8)
    radii = np.full((parts, entries), -1, np.int64)
    change = np.zeros((parts, entries, width + 1), np.int64)
    for p in range(parts):
        x = block.values[:, p]
        if len(block.codes) == 0:
            new[:, p], best = first_codes(x, books[p])
            np.maximum.at(radii[p], new[:, p], best)
            rows = np.arange(len(x))
        else:
            new[:, p], radii[p], _ = ball_codes(x, block.codes[:, p], block.radii[p], books[p], still[p])
            rows = np.flatnonzero(new[:, p] != block.codes[:, p])
            np.subtract.at(change[p, :, :width], block.codes[rows, p], x[rows])
            np.subtract.at(change[p, :, width], block.codes[rows, p], 1)
        np.add.at(change[p, :, :width], new[rows, p], x[rows])
        np.add.at(change[p, :, width], new[rows, p], 1)
    return new, radii, change


def compress(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codes:
    """Codes for every row of `table` (vec_id, label, embedding) that has a usable vector.

    Rows whose vector is null or holds null or non-finite components are left out. Components become
    floor(4096 x). Codebooks start as the parts of the `entries` smallest vec_ids (null ids last;
    among equal ids the smaller vectors), and with fewer rows have fewer entries. Each of `rounds`
    rounds assigns the parts and puts floor(sum / count) in an entry's place; entries without parts
    stay. A last assignment gives code and error (squared distances summed over parts). Repeated
    rows are rows of their own; null labels stay null. The vector with the smallest id sets the
    dimension, which `parts` must divide; vectors of other lengths are left out. An empty table gives
    no rows and no entries. A component beyond 16,384 ends the job: sums would not be exact.

    Codes, radii and vectors are written once a round, as blocks; sums are kept by what moved.
    """
    spark = table.sparkSession
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    good = (table.select("vec_id", "label", "embedding")
            .where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite))
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    head = good.orderBy(*order).limit(1).collect()
    ids, labels = good.schema["vec_id"].dataType, good.schema["label"].dataType
    out = T.StructType([T.StructField("vec_id", ids), T.StructField("label", labels),
                        T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])
    if not head:
        return Codes(spark.createDataFrame([], out), np.zeros((parts, 0, 0), np.int64))
    dims = len(head[0].embedding)
    if dims % parts:
        raise ValueError(f"{parts} equal parts do not make up {dims} components")
    good = good.where(F.size("embedding") == dims)
    start = np.array([r.embedding for r in good.orderBy(*order).limit(entries).collect()], np.float64)
    books = np.floor(start * SCALE).astype(np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2).copy()
    entries, width = books.shape[1:]

    shape = T.StructType([
        T.StructField("ids", T.ArrayType(ids)), T.StructField("labels", T.ArrayType(labels)),
        T.StructField("width", T.IntegerType()), T.StructField("values", T.BinaryType()),
        T.StructField("codes", T.BinaryType()), T.StructField("radii", T.BinaryType()),
        T.StructField("change", T.ArrayType(T.LongType()))])

    def arrow(kind: T.StructType) -> pa.Schema:
        from pyspark.sql.pandas.types import to_arrow_schema

        return to_arrow_schema(kind)

    blocks_of, rows_of = arrow(shape), arrow(out)
    path = work_folder(spark, "blocks")
    good.mapInArrow(lambda batches: _scaled(batches, dims, blocks_of), shape).write.parquet(path)

    sums = np.zeros((parts, entries, width + 1), np.int64).astype(object)
    still = np.zeros((parts, entries), bool)
    for step in range(rounds):
        def move(batches: Iterator[pa.RecordBatch], books=books, still=still) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    one = batch.slice(k, 1)
                    row = one.select(["width", "values", "codes", "radii"]).to_pylist()[0]
                    new, radii, change = _moved(_read(row, parts, entries, dims), books, still)
                    yield pa.RecordBatch.from_arrays([
                        *one.columns[:4], pa.array([new.tobytes()], pa.binary()),
                        pa.array([radii.astype("<i8").tobytes()], pa.binary()),
                        pa.array([change.ravel()], pa.list_(pa.int64()))], schema=blocks_of)

        before, path = path, work_folder(spark, f"blocks-{step}")
        spark.read.schema(shape).parquet(before).mapInArrow(move, shape).write.parquet(path)
        remove(spark, before)
        # one row per number of the codebooks, summed in the tasks first
        changed = (spark.read.schema(shape).parquet(path).select(F.posexplode("change").alias("at", "by"))
                   .where("by <> 0").groupBy("at").agg(F.sum(F.col("by").cast("decimal(38,0)")).alias("by")).collect())
        for at, by in changed:
            sums[np.unravel_index(at, sums.shape)] += int(by)
        following = books.copy()
        for p, e in zip(*np.nonzero(sums[:, :, width])):
            following[p, e] = [s // int(sums[p, e, width]) for s in sums[p, e, :width]]
        still = (following == books).all(axis=2)
        books = following

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                block = _read(one.select(["width", "values", "codes", "radii"]).to_pylist()[0], parts, entries, dims)
                new, _, _ = _moved(block, books, still)
                error = sum(((block.values[:, p] - books[p][new[:, p]]) ** 2).sum(axis=1) for p in range(parts))
                yield pa.RecordBatch.from_arrays([
                    pc.list_flatten(one.column(0)), pc.list_flatten(one.column(1)),
                    pa.array([c.tobytes() for c in new], pa.binary()), pa.array(error, pa.int64())], schema=rows_of)

    codes = staged(spark.read.schema(shape).parquet(path).mapInArrow(finish, out), "vector-codes")
    remove(spark, path)
    return Codes(codes, books)


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Adds `label_error`, the errors summed over equal labels; null labels are one.

    Summed in the tasks first, then one written row per label is joined back, so a label with a third
    of all rows is neither a window nor a group of rows.
    """
    sums = staged(codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
