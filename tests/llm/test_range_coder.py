"""Exact round trips of the range coder, and its files against the tokenizer."""

import random
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from breezemart.llm import range_coder as rc
from breezemart.llm.tokens import Encoder, vocabulary


def trip(ids, lengths=None):
    ids = np.array(ids, np.uint32)
    payload = rc.write_chunk(lengths or [len(ids)], ids)
    got, back = rc.read_chunk(payload)
    assert got.tolist() == (lengths or [len(ids)]) and back.tolist() == ids.tolist()
    return payload


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 65535), max_size=300), st.integers(1, 70))
def test_any_ids(ids, block):
    before, rc.BLOCK = rc.BLOCK, block
    try:
        trip(ids)
    finally:
        rc.BLOCK = before


def test_long_runs_and_noise():
    rng = random.Random(1)
    assert len(trip([7] * 50_000)) < 3000
    assert len(trip([rng.randrange(50_000) for _ in range(9000)])) < 9000 * 2.6
    phrase = [rng.randrange(50_000) for _ in range(50)]
    assert len(trip(phrase * 400)) < 20_000 * 0.5
    trip([65535, 0] * 3000 + [1] * 5000 + list(range(4000)))


def test_damage_is_noticed():
    payload = bytearray(trip(list(range(3000))))
    payload[-400] ^= 8
    with pytest.raises(ValueError):
        rc.read_chunk(bytes(payload))


def check(docs):
    tokens, at, want = Encoder(vocabulary()), 0, []
    found = sorted(rc.coded_ids(docs, vocabulary()).collect(), key=lambda r: r.start)
    for r in found:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    for r in docs.select("doc_id", "text").collect():
        raw = tokens.encode(r.text) + bytes(4)
        want.append((r.doc_id, len(raw) // 4, zlib.crc32(raw)))
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in found), key=key) == sorted(want, key=key)


def test_documents(documents, edge, empty, monkeypatch):
    check(documents)
    check(edge)
    assert rc.coded_ids(empty, vocabulary()).count() == 0


def test_files_keep_their_bytes():
    rng = random.Random(5)
    ids = [rng.choice([7, 9, rng.randrange(65536), rng.randrange(300)]) for _ in range(9000)] + [3] * 2000
    payload = trip(ids, [4000, 0, 7000])
    assert (len(payload), zlib.crc32(payload)) == (10848, 286523151)


def test_rows_coded_side_by_side_keep_their_bytes(monkeypatch):
    rng, whole = np.random.default_rng(6), rc.Encoder
    rows = [rng.integers(0, top, n).astype(np.uint32) for top, n in ((50_000, 9000), (300, 1), (65_536, 4096), (9, 0), (40, 8191))]
    alone, made = [rc.write_chunk([len(x)], x) for x in rows], []
    monkeypatch.setattr(rc, "Encoder", lambda blocks: made.append(len(blocks)) or whole(blocks))
    assert rc.write_chunks([([len(x)], x) for x in rows]) == alone
    assert made == [7]  # one run for the blocks of all rows
    assert [ids.tolist() for _, ids in rc.read_chunks(alone)] == [x.tolist() for x in rows]


def test_many_rows_a_task(spark, monkeypatch):
    monkeypatch.setattr(rc, "CHUNK", 50)
    monkeypatch.setattr(rc, "BESIDE", 130)
    docs = spark.createDataFrame([(i, f"word{i} " * (i % 30 if i != 70 else 400)) for i in range(140)], "doc_id long, text string")
    check(docs.repartition(2))
    files = rc.write_ids(docs, vocabulary()).collect()
    assert len(files) > 20 and all(sorted(r.chunk for r in files if r.part == p) == list(range(sum(r.part == p for r in files)))
                                   for p in {r.part for r in files})


def counted(work):
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        result = work()
    finally:
        sys.setprofile(None)
    return result, len(calls)


def test_few_calls_a_step():
    ids = np.random.default_rng(8).integers(0, 50_000, 3 * rc.BLOCK).astype(np.uint32)
    payload, coded = counted(lambda: rc.write_chunk([len(ids)], ids))
    _, decoded = counted(lambda: rc.read_chunk(payload))
    assert coded < 120 * rc.BLOCK and decoded < 120 * rc.BLOCK
