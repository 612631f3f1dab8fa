"""Best-fit packing of token sequences with large items matched first."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breezemart.llm.shared import numbered, staged
from breezemart.llm.tokens import encoder

CHUNKS = 512


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece of each document: its ids with `end_id` after them, cut from the back into
    full sequences, so that only the first piece may be shorter. Written to the shared folder."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = encoder(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for i, ids in enumerate(tokens.encode_all(batch.column(1))):
                ids += end
                n = len(ids) // 4
                stop = n % capacity or min(n, capacity)
                start = piece = 0
                while start < n:
                    rows.append((i, piece, start, stop - start, zlib.crc32(ids[4 * start:4 * stop])))
                    start, stop, piece = stop, stop + capacity, piece + 1
            source, *columns = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(source, pa.int64())),
                 *[pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType())])
    return staged(docs.select("doc_id", F.col("text").cast("string")).mapInArrow(cut, schema), "pieces")


class Plan:
    """Where the items of each length go, worked out on the counts of the lengths alone.

    `slots` has rows (length, first rank, end rank, first sequence, items per sequence, offset): the
    item of that rank among its length stands in sequence first + (rank - first rank) // items, at
    offset + length * ((rank - first rank) % items). Sequences filled alike are handled together,
    so the plan grows with the capacity, not with the number of items.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = {length: n for length, n in counts.items() if n}
        self.rank: dict[int, int] = defaultdict(int)
        self.slots: list[tuple[int, int, int, int, int, int]] = []
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.capacity, self.sequences = capacity, 0
        large = sorted((n for n in self.left if 3 * n > capacity), reverse=True)
        for length in large:
            self._match(length, large)
        for length in sorted(self.left, reverse=True):
            self._best_fit(length)

    def _take(self, length: int, n: int, first: int, per: int, offset: int) -> None:
        lo = self.rank[length]
        self.slots.append((length, lo, lo + n, first, per, offset))
        self.rank[length] = lo + n
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]

    def _open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _match(self, length: int, large: list[int]) -> None:
        """Pair the largest unmatched items with the largest that still fit beside them."""
        for other in large:
            n = self.left.get(length, 0)
            if not n:
                return
            if other > length or length + other > self.capacity or other not in self.left:
                continue
            pairs = n // 2 if other == length else min(n, self.left[other])
            if pairs:
                first = self._open(pairs)
                self._take(length, pairs, first, 1, 0)
                self._take(other, pairs, first, 1, length)
                self.gaps[self.capacity - length - other].append((first, pairs))
        if n := self.left.get(length, 0):
            first = self._open(n)
            self._take(length, n, first, 1, 0)
            self.gaps[self.capacity - length].append((first, n))

    def _best_fit(self, length: int) -> None:
        """Put the items of one length into the tightest gaps, new sequences when none is left."""
        for gap in sorted(g for g in self.gaps if g >= length):
            while self.gaps[gap] and (n := self.left.get(length, 0)):
                first, count = self.gaps[gap].pop()
                self._fill(length, n, first, count, gap)
            if not self.gaps[gap]:
                del self.gaps[gap]
        if n := self.left.get(length, 0):
            count = -(-n // (self.capacity // length))
            self._fill(length, n, self._open(count), count, self.capacity)

    def _fill(self, length: int, n: int, first: int, count: int, gap: int) -> None:
        per = gap // length
        full = min(count, n // per)
        if full:
            self._take(length, full * per, first, per, self.capacity - gap)
            self.gaps[gap - per * length].append((first, full))
        if rest := min(n - full * per, (count - full) * per):
            self._take(length, rest, first + full, rest, self.capacity - gap)
            self.gaps[gap - rest * length].append((first + full, 1))
            full += 1
        if full < count:
            self.gaps[gap].append((first + full, count - full))


def pack(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """All of `docs` (doc_id, text) packed into sequences of at most `capacity` tokens.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Pieces
    above a third of the capacity are matched, at most two to a sequence, the largest with the
    largest that fits; smaller ones fill the tightest gaps, long ones first. The plan is made on
    the counts of at most `capacity` lengths; Spark numbers the pieces of each length and looks
    their places up, so nothing that grows with the table passes the driver or one task.

    A null or empty text is the end id alone. Rows that repeat a doc_id are documents of their own.
    Other columns are not looked at. An empty table gives no rows.
    """
    rows = pieces(docs, path, end_id, capacity)
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # at most `capacity` rows
    slots = np.array(sorted(Plan(counts, capacity).slots), np.int64).reshape(-1, 6)
    plan = docs.sparkSession.sparkContext.broadcast(slots)
    most = int(max(counts.values(), default=0)) + 1

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        length, lo, _, first, per, offset = plan.value.T
        starts = length * most + lo
        for frame in frames:
            rank = frame.pop("_rank").to_numpy()
            at = np.searchsorted(starts, frame["length"].to_numpy() * most + rank, "right") - 1
            inside = rank - lo[at]
            frame["sequence_id"] = first[at] + inside // per[at]
            frame["offset"] = offset[at] + inside % per[at] * length[at]
            yield frame

    order = ["doc_id", "piece", "start", "ids_crc32"]
    deal = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(CHUNKS))
    ranked = numbered(rows, ["length"], deal, CHUNKS, order, "_rank").select(*rows.columns, "_rank")
    schema = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return ranked.mapInPandas(place, schema)
