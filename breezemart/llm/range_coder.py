"""Token ids in files of blocks coded by an adaptive context-mixing range coder."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breezemart.llm.shared import staged
from breezemart.llm.tokens import encoder

#: Ids of a block, which starts from nothing; ids of a file row at most, unless one text has more.
BLOCK, CHUNK = 4096, 4_000_000
#: Ids of the file rows that a worker codes side by side, unless one row has more.
BESIDE = 10_000_000
SLOTS = 2048  # a power of two
MAGIC = b"CMR1"
_U = np.uint64
_WORD = _U(32)
_LOW = _U(2**32 - 1)
_TWELVE = _U(12)

#: ln(p / (1 - p)) of twelve-bit chances in units of 1/256, and back from -2047 .. 2047.
STRETCH = np.round(256 * np.log((np.arange(4096) + 0.5) / (4095.5 - np.arange(4096)))).astype(np.int64)
SQUASH = np.clip(np.round(4096 / (1 + np.exp(-np.arange(-2047, 2048) / 256))), 32, 4064).astype(np.int64)
WIDTH = np.array([n.bit_length() for n in range(65536)], np.int64)
#: The twelve-bit chance of a sixteen-bit rate, kept off the ends.
CHANCE = np.clip(np.arange(65537) >> 4, 32, 4064).astype(np.uint64)
#: The next confidence, in the upper half, by confidence + 8 if the prediction was right.
SURER = np.array([1, 1, *(s >> 1 for s in range(2, 8)), *range(1, 8), 7], np.int32) << 16


class Lanes:
    """The blocks of a chunk, coded side by side: step t handles id t of every block.

    Each block has its own order-2 and order-1 tables of a predicted id and its confidence, an order-0
    favourite, and order-0 counts of id sizes. Per id, one flag says whether the order-2 prediction
    is right; its chance is mixed in the logistic domain from the success rates of all three orders,
    those that predict another id voting against, with weights learnt as coding goes. After a miss a
    flag says the same of the order-1 prediction, and then the id follows as its size in bits, by
    the order-0 counts, and the bits below the first. Encoder and decoder keep the same state.

    Arrays hold a lane per block, the longest first, and a row per order where the orders are
    handled alike. The counts are held as running sums, so that an id reads two of them.
    """

    def __init__(self, lengths: np.ndarray):
        n = self.n = len(lengths)
        self.lengths = lengths
        self.low, self.range = np.zeros(n, np.uint64), np.full(n, 2**64 - 1, np.uint64)
        self.tables, self.rates = np.zeros(2 * n * SLOTS, np.int32), np.full(3 * n * 8, 32768, np.int32)
        self.second = np.full(3 * n * 8, 16384, np.int32)  # at the cells of order 1
        self.guess, self.votes = np.zeros((3, n), np.int32), np.zeros(n, np.int32)
        self.weights = np.repeat(np.array([[8000], [20000], [40000]], np.int64), n, axis=1)
        self.sums = np.repeat(np.arange(18, dtype=np.int16)[:, None], n, axis=1)
        self.slots = np.arange(2 * n).reshape(2, n) * SLOTS
        self.cells = np.arange(3 * n).reshape(3, n) * 8

    def run(self) -> None:
        k = self.n
        one = two = np.zeros(k, np.int32)
        for t in range(int(self.lengths.max(initial=0))):
            while self.lengths[k - 1] <= t:
                k -= 1
            two, one = one[:k], self._step(t, k, one[:k], two[:k])

    def _step(self, t: int, k: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        guess, votes, weights = self.guess[:, :k], self.votes[:k], self.weights[:, :k]
        at = np.empty((2, k), np.int32)
        np.multiply(one, 40503, out=at[0])
        np.multiply(two, 30011, out=at[1])
        at[1] += at[0]
        at >>= _SHIFTS
        at &= SLOTS - 1
        at = at + self.slots[:, :k]
        held = self.tables.take(at)
        sure = np.empty((3, k), np.int32)
        np.minimum(votes, 7, out=sure[0])
        np.right_shift(held, 16, out=sure[1:])
        np.bitwise_and(held, 0xFFFF, out=guess[1:])
        cells = sure + self.cells[:, :k]
        rates = self.rates.take(cells)
        inputs = STRETCH.take(rates >> 4)
        apart = guess[:2] != guess[2]
        np.negative(inputs[:2], out=inputs[:2], where=apart)
        mixed = np.add.reduce(weights * inputs, axis=0)
        mixed += 2047 << 16
        mixed >>= 16
        chance = SQUASH.take(mixed, mode="clip")

        state = self._state(k)
        hit = self._flag(t, None, state, chance.view(np.uint64), guess[2])
        missed = ~hit
        ids = guess[2].copy()
        rest = (missed & apart[1]).nonzero()[0]
        if len(rest):
            cell, second, first = cells[1].take(rest), None, guess[1].take(rest)
            second = self.second.take(cell)
            part = [x.take(rest) for x in state]
            right = self._flag(t, rest, part, CHANCE.take(second), first)
            for x, y in zip(state, part):
                x[rest] = y
            self.second[cell] = second + ((np.where(right, np.int32(65536), np.int32(0)) - second) >> 5)
            met = rest[right]
            ids[met] = first[right]
            missed[met] = False
        last = missed.nonzero()[0]
        if len(last):
            part = [x.take(last) for x in state]
            ids[last] = self._literal(t, k, last, part)
            for x, y in zip(state, part):
                x[last] = y

        error = np.where(hit, 4096, 0)
        error -= chance
        error *= 6
        inputs *= error
        inputs += 0x2000
        inputs >>= 14
        weights += inputs
        good = guess == ids
        change = np.where(good, np.int32(65535), np.int32(0))
        change -= rates
        change >>= 5
        change += rates
        self.rates[cells] = change
        key = (good[1:].view(np.int8) << 3) + sure[1:]
        self.tables[at] = np.where(key > 1, guess[1:], ids) | SURER.take(key)
        empty = votes == 0
        np.copyto(guess[0], ids, where=empty)
        empty |= good[0]
        votes += np.where(empty, np.int32(1), np.int32(-1))
        return ids

    def _shift(self, lanes: np.ndarray | None, state: list[np.ndarray]) -> None:
        """Give out a word where the range got short."""
        low, width, *rest = state
        short = (width <= _LOW).nonzero()[0]
        if len(short):
            far, wide = low.take(short), width.take(short)
            torn = (far ^ (far + wide)) > _LOW
            width[short] = np.where(torn, np.negative(far) & _LOW, wide) << _WORD
            low[short] = far << _WORD
            self._word(short if lanes is None else lanes.take(short), far, short, *rest)

    def _count(self, k: int, lanes: np.ndarray, size: np.ndarray, total: np.ndarray) -> None:
        grown = np.full(k, 16, np.int16)
        grown[lanes] = size - 1
        grown = grown - _SIZES
        grown >>= 15
        grown &= 24
        sums = self.sums[1:, :k]
        sums += grown
        full = lanes[total > 8000]
        if len(full):
            self.sums[1:, full] = np.cumsum((np.diff(self.sums[:, full], axis=0) >> 1) | 1, axis=0)


#: Of order 1 and 2; and id sizes, as a column.
_SHIFTS, _SIZES = np.array([[5], [4]], np.int32), np.arange(17, dtype=np.int16)[:, None]


class Encoder(Lanes):
    def __init__(self, blocks: list[np.ndarray]):
        super().__init__(np.array([len(b) for b in blocks]))
        self.ids = np.zeros((max(map(len, blocks), default=0), len(blocks)), np.int32)
        for i, block in enumerate(blocks):
            self.ids[:len(block), i] = block
        self.most = 2 * len(self.ids) + 16
        self.words = np.zeros(len(blocks) * self.most, np.uint32)
        self.filled = np.arange(len(blocks)) * self.most

    def _state(self, k: int) -> list[np.ndarray]:
        return [self.low[:k], self.range[:k]]

    def _word(self, lanes: np.ndarray, low: np.ndarray, *_: np.ndarray) -> None:
        at = self.filled.take(lanes)
        self.words[at] = low >> _WORD
        self.filled[lanes] = at + 1

    def _flag(self, t: int, lanes: np.ndarray | None, state: list[np.ndarray], chance: np.ndarray, guess: np.ndarray) -> np.ndarray:
        low, width = state
        own = self.ids[t]
        hit = (own[:len(low)] if lanes is None else own.take(lanes)) == guess
        step = width >> _TWELVE
        bound = chance * step
        np.add(low, bound, out=low, where=~hit)
        step <<= _TWELVE
        step -= bound
        width[:] = np.where(hit, bound, step)
        self._shift(lanes, state)
        return hit

    def _literal(self, t: int, k: int, lanes: np.ndarray, state: list[np.ndarray]) -> np.ndarray:
        low, width = state
        ids = self.ids[t].take(lanes)
        size, sums = WIDTH.take(ids), self.sums.reshape(-1)
        at = size * self.n + lanes
        below, above, total = sums.take(at), sums.take(at + self.n), self.sums[17].take(lanes)
        step = width // total.astype(np.uint64)
        low += below.astype(np.uint64) * step
        np.multiply((above - below).astype(np.uint64), step, out=width)
        self._shift(lanes, state)
        bits = np.maximum(size - 1, 0)
        width >>= bits.view(np.uint64)
        low += (ids & ((1 << bits) - 1)).view(np.uint64) * width
        self._shift(lanes, state)
        self._count(k, lanes, size, total)
        return ids

    def result(self) -> list[bytes]:
        self.run()
        lanes = np.arange(self.n)
        for _ in range(2):
            self._word(lanes, self.low)
            self.low = self.low << _WORD
        return [self.words[i * self.most:end].astype("<u4").tobytes() for i, end in enumerate(self.filled)]


class Decoder(Lanes):
    def __init__(self, blocks: list[bytes], lengths: np.ndarray):
        super().__init__(lengths)
        most = max(map(len, blocks), default=0) // 4 + 2
        words = np.zeros((len(blocks), most), np.uint32)
        for i, block in enumerate(blocks):
            words[i, :len(block) // 4] = np.frombuffer(block, "<u4")
        self.words, self.ends = words.reshape(-1), np.arange(1, len(blocks) + 1) * most - 1
        self.taken = self.ends - most + 3
        self.ahead = (words[:, 0].astype(np.uint64) << _WORD) | words[:, 1]  # the code less the low end
        self.ids = np.zeros((int(lengths.max(initial=0)), len(blocks)), np.int32)

    def _state(self, k: int) -> list[np.ndarray]:
        return [self.low[:k], self.range[:k], self.ahead[:k]]

    def _word(self, lanes: np.ndarray, low: np.ndarray, short: np.ndarray, ahead: np.ndarray) -> None:
        at = self.taken.take(lanes)
        ahead[short] = (ahead.take(short) << _WORD) | self.words.take(np.minimum(at, self.ends.take(lanes)))
        self.taken[lanes] = at + 1

    def _flag(self, t: int, lanes: np.ndarray | None, state: list[np.ndarray], chance: np.ndarray, guess: np.ndarray) -> np.ndarray:
        low, width, ahead = state
        step = width >> _TWELVE
        bound = chance * step
        hit = ahead < bound
        missed = ~hit
        np.add(low, bound, out=low, where=missed)
        np.subtract(ahead, bound, out=ahead, where=missed)
        step <<= _TWELVE
        step -= bound
        width[:] = np.where(hit, bound, step)
        self._shift(lanes, state)
        return hit

    def _literal(self, t: int, k: int, lanes: np.ndarray, state: list[np.ndarray]) -> np.ndarray:
        low, width, ahead = state
        total = self.sums[17].take(lanes)
        step = width // total.astype(np.uint64)
        value = np.zeros(k, np.int16)
        value[lanes] = np.minimum(ahead // step, _U(32767))
        found = np.add.reduce((self.sums[1:, :k] <= value).view(np.int8), axis=0, dtype=np.int8)
        size = np.minimum(found.take(lanes), 16).astype(np.int64)
        at, sums = size * self.n + lanes, self.sums.reshape(-1)
        below, above = sums.take(at), sums.take(at + self.n)
        start = below.astype(np.uint64) * step
        low += start
        ahead -= start
        np.multiply((above - below).astype(np.uint64), step, out=width)
        self._shift(lanes, state)
        bits = np.maximum(size - 1, 0)
        top = 1 << bits
        width >>= bits.view(np.uint64)
        rest = np.minimum(ahead // width, (top - 1).view(np.uint64))
        start = rest * width
        low += start
        ahead -= start
        self._shift(lanes, state)
        self._count(k, lanes, size, total)
        return np.where(size > 0, top | rest.view(np.int64), 0)

    def _step(self, t: int, k: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        self.ids[t, :k] = found = super()._step(t, k, one, two)
        return found

    def result(self) -> list[np.ndarray]:
        self.run()
        return [self.ids[:n, i] for i, n in enumerate(self.lengths)]


def write_chunks(rows: list[tuple[list[int], np.ndarray]]) -> list[bytes]:
    """File rows of (lengths of the documents, their ids). A row: magic, numbers of documents, blocks
    and ids; lengths of the documents; per block its ids, bytes and the crc32 of its ids; then the
    blocks. All numbers are little-endian and unsigned. The blocks of all rows are coded side by side."""
    cut = [[ids[i:i + BLOCK] for i in range(0, len(ids), BLOCK)] for _, ids in rows]
    blocks = sorted((b for found in cut for b in found), key=len, reverse=True)
    coded = dict(zip(map(id, blocks), Encoder(blocks).result() if blocks else []))
    payloads = []
    for (lengths, ids), found in zip(rows, cut):
        heads = [struct.pack("<III", len(b), len(coded[id(b)]), zlib.crc32(b.astype("<u4").tobytes())) for b in found]
        payloads.append(b"".join([MAGIC, struct.pack("<IIQ", len(lengths), len(found), len(ids)),
                                  np.array(lengths, "<u4").tobytes(), *heads, *[coded[id(b)] for b in found]]))
    return payloads


def write_chunk(lengths: list[int], ids: np.ndarray) -> bytes:
    return write_chunks([(lengths, ids)])[0]


def ids_of(payload: bytes) -> int:
    return struct.unpack_from("<Q", payload, 12)[0] if payload[:4] == MAGIC else 0


def read_chunks(payloads: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(lengths of the documents, all ids) of file rows, read side by side; a damaged row raises."""
    rows, parts = [], []
    for payload in payloads:
        if payload[:4] != MAGIC:
            raise ValueError("not a row of coded ids")
        docs, n, total = struct.unpack_from("<IIQ", payload, 4)
        heads = np.frombuffer(payload, "<u4", 3 * n, 20 + 4 * docs).reshape(-1, 3)
        ends = 20 + 4 * docs + 12 * n + np.concatenate([[0], np.cumsum(heads[:, 1], dtype=np.int64)])
        rows.append((np.frombuffer(payload, "<u4", docs, 20), total, range(len(parts), len(parts) + n)))
        parts += [(int(size), int(crc), payload[a:b]) for (size, _, crc), a, b in zip(heads, ends, ends[1:])]
    order = sorted(range(len(parts)), key=lambda i: -parts[i][0])
    found = Decoder([parts[i][2] for i in order], np.array([parts[i][0] for i in order], np.int64)).result() if parts else []
    blocks = dict(zip(order, found))
    for i, block in blocks.items():
        if zlib.crc32(block.astype("<u4").tobytes()) != parts[i][1]:
            raise ValueError("a block does not match its checksum")
    out = []
    for lengths, total, own in rows:
        ids = np.concatenate([*[blocks[i] for i in own], np.zeros(0, np.int32)]).astype(np.uint32)
        if len(ids) != total or lengths.sum() != total:
            raise ValueError("a row of coded ids is cut short")
        out.append((lengths, ids))
    return out


def read_chunk(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    return read_chunks([payload])[0]


def write_ids(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """The ids of `docs` (doc_id, text) in files under the shared folder, in ascending doc_id order.

    Returns the files as a table: part, chunk (the order of the rows), doc_ids and payload (see
    `write_chunk`). A vocabulary may have up to 65,536 ids. Texts go once over the network, to
    ranges of (doc_id, hash of the text), so that even a doc_id of many rows is cut up.
    """
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = encoder(path), np.array([end_id], "<u4").tobytes()
        part, chunk, size, names, held = TaskContext.get().partitionId(), 0, 0, [], []
        waiting, beside = [], 0  # doc_ids, lengths and ids of file rows

        def rows():
            payloads = write_chunks([(lengths, ids) for _, lengths, ids in waiting])
            for i, ((doc_ids, _, _), payload) in enumerate(zip(waiting, payloads)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([chunk - len(waiting) + i], pa.int32()),
                     pa.array([doc_ids], pa.list_(kind)), pa.array([payload], pa.binary())],
                    names=["part", "chunk", "doc_ids", "payload"])

        def full():
            return names, [len(x) // 4 for x in held], np.frombuffer(b"".join(held), "<u4")

        for batch in batches:
            kind = batch.column(0).type
            for name, ids in zip(batch.column(0).to_pylist(), tokens.encode_all(batch.column(1))):
                names.append(name)
                held.append(ids + end)
                size += len(held[-1]) // 4
                if size >= CHUNK:
                    if waiting and beside + size > BESIDE:
                        yield from rows()
                        waiting, beside = [], 0
                    waiting.append(full())
                    chunk, beside, size, names, held = chunk + 1, beside + size, 0, [], []
        if held:
            if waiting and beside + size > BESIDE:
                yield from rows()
                waiting = []
            waiting.append(full())
            chunk, held = chunk + 1, []
        if waiting:
            yield from rows()

    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("chunk", T.IntegerType()),
        T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)), T.StructField("payload", T.BinaryType())])
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("_mark"))
    dealt = rows.repartitionByRange("doc_id", "_mark").sortWithinPartitions("doc_id", "_mark").drop("_mark")
    return staged(dealt.mapInArrow(code, schema), "coded-ids")


def read_ids(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, decoded from the files."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            while first < batch.num_rows:
                payloads, beside = [], 0
                for i in range(first, batch.num_rows):
                    payload = batch.column("payload")[i].as_py()
                    beside += ids_of(payload)
                    if payloads and beside > BESIDE:
                        break
                    payloads.append(payload)
                for i, (lengths, ids) in enumerate(read_chunks(payloads), first):
                    raw, ends = ids.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
                    n = len(lengths)
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_ids")[i].values, pa.array(np.full(n, batch.column("part")[i].as_py(), np.int32)),
                        pa.array(np.full(n, batch.column("chunk")[i].as_py(), np.int32)), pa.array(ends[:-1]),
                        pa.array(lengths.astype(np.int64)),
                        pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends, ends[1:])], pa.int64())],
                        names=["doc_id", "part", "chunk", "at", "n_tokens", "ids_crc32"])
                first += len(payloads)

    numbers = [T.StructField(c, T.LongType()) for c in ("at", "n_tokens", "ids_crc32")]
    schema = T.StructType([T.StructField("doc_id", files.schema["doc_ids"].dataType.elementType),
                           *files.schema.fields[:2], *numbers])
    docs = staged(files.mapInArrow(decode, schema), "decoded-ids")
    # one row per file row, which holds some four million ids
    before = Window.orderBy("part", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = docs.groupBy("part", "chunk").agg(F.sum("n_tokens").alias("n")).select(
        "part", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    return docs.join(starts, ["part", "chunk"]).select(
        "doc_id", (F.col("_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def coded_ids(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Write the ids of `docs` (doc_id, text), each text with `end_id` after it, and read them back.

    A null text counts as empty: the end id alone. A null doc_id comes first; rows that repeat a
    doc_id stand in the order of a hash of their texts. Other columns are not looked at. An empty
    table gives no rows.
    """
    return read_ids(write_ids(docs, path, end_id))
