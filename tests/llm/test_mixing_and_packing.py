"""Source mix against its SQL and its rules; packing against the tokenizer."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from breezemart.llm import queries
from breezemart.llm.mixing import mix
from breezemart.llm.packing import Plan, pack
from breezemart.llm.tokens import Encoder, vocabulary


def by_sql(frame):
    con = duckdb.connect()
    con.register("documents", frame.select("doc_id", "text", "source").toArrow())
    return Counter(con.sql(f"with {queries.MIX} select doc_id, size, source_size, target, taken from mixed").fetchall())


def check_mix(docs):
    rows = mix(docs).collect()
    assert Counter(tuple(r) for r in rows) == by_sql(docs)
    sources = {}
    for r in rows:
        assert r.taken == 0 if r["size"] == 0 else r.taken % r["size"] == 0 and r.taken <= 3 * r["size"]
        got = sources.setdefault((r.source_size, r.target), [0, 0])
        got[0] += r.taken
        got[1] = max(got[1], r["size"])
    return rows, sources


def test_mix_of_documents(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows, sources = check_mix(documents)
    for (size, target), (taken, largest) in sources.items():
        assert target <= 3 * size + 1e-6 and abs(taken - target) <= largest / 2 + 1
    assert all(r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])) for r in rows)
    assert abs(sum(t for _, t in sources) - sum(s for s, _ in sources)) < 1


def test_mix_of_odd_rows(spark, edge, empty):
    check_mix(edge)
    assert mix(empty).count() == 0
    assert [r.target for r in mix(edge.where("text is null")).collect()] == [0.0, 0.0]


def test_targets_stop_at_three_times_the_size(spark):
    docs = spark.range(1200).selectExpr(
        "id as doc_id", "case when id < 10 then 'c' when id < 400 then 'a' else 'b' end as source",
        "repeat('w ', 10) as text")
    rows, sources = check_mix(docs)
    assert sources.keys() == {(100, 300.0), (3900, 3900.0), (8000, 7800.0)} or sum(t for _, t in sources) == pytest.approx(12000)
    assert max(t / s for s, t in sources) == 3.0


def test_words_are_encoded_as_in_the_whole_text(documents, edge):
    whole = Tokenizer.from_file(vocabulary())
    own = Encoder(vocabulary())
    texts = [r.text for r in documents.collect() + edge.collect() if r.text is not None]
    texts += ["", " ", "  ", " a", "a ", "a  b", "\n a", "a\n b", "a \n b", "   x", "it's  it 's", "x　 y",
              "a\x1c b", "\r\n \r\n", "tab\t x", "1 2  3", "…  … …", "👩‍🚀 👩‍🚀", "a  b"]
    rng = random.Random(1)
    texts += ["".join(rng.choice(" \n\tab1é.'s ") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    for _ in range(2):  # the second time from the cache
        for t in texts:
            assert own.encode(t) == np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def check_pack(docs, capacity=1024):
    tokens, rows = Encoder(vocabulary()), pack(docs, vocabulary(), 2, capacity).collect()
    end = np.array([2], "<u4").tobytes()
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = tokens.encode(r.text) + end
        n = len(ids) // 4
        first = n % capacity or min(n, capacity)
        edges = [0, *range(first, n + 1, capacity)]
        want.update((r.doc_id, k, a, b - a, zlib.crc32(ids[4 * a:4 * b])) for k, (a, b) in enumerate(zip(edges, edges[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in held) <= 2
    return len(bins), sum(n for held in bins.values() for _, n in held)


def test_packing(documents, edge, empty):
    bins, tokens = check_pack(documents)
    assert bins <= -(-tokens // 1024) * 1.03 + 1
    check_pack(edge)
    check_pack(edge, 7)
    assert pack(empty, vocabulary()).count() == 0


def test_the_plan_places_every_item_once():
    rng = random.Random(7)
    for _ in range(30):
        capacity = rng.choice([3, 10, 64, 1024])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 2000)))
        plan = Plan(dict(counts), capacity)
        used, ranks = defaultdict(list), defaultdict(list)
        for length, lo, hi, first, per, offset in plan.slots:
            for rank in range(lo, hi):
                at = rank - lo
                used[first + at // per].append((offset + length * (at % per), length))
                ranks[length].append(rank)
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
        for held in used.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            assert at <= capacity
        low = -(-sum(k * n for k, n in counts.items()) // capacity)
        assert len(used) == plan.sequences <= max(low * 1.25 + 2, sum(n for k, n in counts.items() if 2 * k > capacity))
