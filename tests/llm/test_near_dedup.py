"""Near-duplicate classes and embeddings against all pairs."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from breezemart.llm import near_dedup as near
from breezemart.llm.components import components
from breezemart.llm.embeddings import near_embeddings


def smallest(nodes, links):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def plain_similarity(a, b):
    def weights(text):
        words, out = near._words(text), defaultdict(float)
        width = min(5, len(words))
        for k in range(len(words) - width + 1 if words else 0):
            out[tuple(words[k:k + 5])] += 1
        return out

    v, w = weights(a), weights(b)
    every = set(v) | set(w)
    return sum(1 / sum(max(v[e] / v[d], w[e] / w[d]) for e in every) for d in set(v) & set(w)
               if v[d] and w[d])


def text(rng, n, words=4000):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def planted(rng):
    docs = []
    for _ in range(15):
        base = text(rng, rng.choice([3, 8, 40, 120]))
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 3])):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
            docs.append(" ".join(copy))
    shared = text(rng, 30)
    docs += [" ".join(text(rng, 30) + shared) for _ in range(10)]
    docs += [" ".join(text(rng, 6) * rng.randint(1, 4)) for _ in range(5)]
    docs += ["", None, "   ", "One", "one", "one two", "ONE  two"]
    rng.shuffle(docs)
    return docs


def test_similarity_is_probability_jaccard():
    rng = random.Random(3)
    texts = [" ".join(text(rng, rng.randint(1, 30), 3)) for _ in range(40)]
    for a, b in zip(texts, texts[1:]):
        va, vb = (np.unique(near.shingles(near._words(t)), return_counts=True) for t in (a, b))
        assert near.probability_jaccard(*va, *vb) == pytest.approx(plain_similarity(a, b))


def test_registers_agree_as_often_as_the_similarity_says():
    rng = random.Random(5)
    base = text(rng, 400)
    other = base[:300] + text(rng, 60)
    a, b = near.shingles(base), near.shingles(other)
    signs = near.prob_min_hash([a, b, a[:1], a[:0], np.concatenate([a, a])], 4000)
    want = plain_similarity(" ".join(base), " ".join(other))
    assert (signs[0] == signs[1]).mean() == pytest.approx(want, abs=0.03)
    assert (signs[0] == signs[4]).all() and len(set(signs[2])) == 1 and not signs[3].any()


def test_classes_against_all_pairs(spark):
    docs = planted(random.Random(11))
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in near.near_dedup(frame).collect()}
    links = [(i, j) for i in range(len(docs)) for j in range(i) if plain_similarity(docs[i], docs[j]) >= 0.8]
    want = smallest(range(len(docs)), links)
    assert {i: r.class_id for i, r in rows.items()} == want
    assert all(r.kept == (r.class_id == i) for i, r in rows.items())
    assert all(r.class_size == sum(c == r.class_id for c in want.values()) for r in rows.values())


def test_a_large_bucket_is_compared_in_blocks(spark, monkeypatch):
    rng = random.Random(12)
    base, docs = text(rng, 60), []
    for _ in range(140):  # two changed words keep most above 0.8 of the first text, three do not
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
        docs.append(" ".join(copy * rng.choice([1, 1, 1, 3])))
    monkeypatch.setattr(near, "PAIRED", 8)
    monkeypatch.setattr(near, "NEAR_BYTES", 3000)
    monkeypatch.setattr(near, "FAR_BYTES", 8000)
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    links = [(i, j) for i in range(len(docs)) for j in range(i) if plain_similarity(docs[i], docs[j]) >= 0.8]
    assert {r.doc_id: r.class_id for r in near.near_dedup(frame).collect()} == smallest(range(len(docs)), links)


def test_odd_documents(edge, empty):
    rows = near.near_dedup(edge, carry=["source", "run"]).collect()
    assert len(rows) == edge.count() and {r.class_id for r in rows if r.doc_id in (1, 2)} == {1}
    assert [r.kept for r in rows if r.doc_id == 6].count(True) == 1
    assert all(r.kept for r in rows if r.doc_id in (3, 4)) and near.near_dedup(empty).count() == 0


def test_long_chains_are_one_component(spark):
    chain = spark.range(1, 200).selectExpr("id as a", "id - 1 as b").union(
        spark.sql("select 1000L as a, 2000L as b union all select 3000L, 2000L"))
    found = {r.node: r.component for r in components(chain).collect()}
    assert found == {i: 0 for i in range(200)} | {1000: 1000, 2000: 1000, 3000: 1000}


VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("n", T.StringType()), T.StructField("row", T.StringType())])


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = []
    for base in rng.standard_normal((60, 16)):
        for _ in range(rng.integers(1, 6)):
            rows.append(base + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.2]))
    rows = [(i, [float(x) for x in v], int(i % 7 == 0)) for i, v in enumerate(rows)]
    n = len(rows)
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, rows[0][1][:8], [None] + [1.0] * 15]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)] + [(n + 50, rows[1][1], None), (None, rows[2][1], rows[2][2])]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS).repartition(3)
    found = {r.vec_id: r for r in near_embeddings(frame).collect()}

    def good(v):
        return v and None not in v and np.isfinite(v).all() and np.any(v)

    links = []
    for x, (i, v, a) in enumerate(rows):
        for y, (j, w, b) in enumerate(rows[:x]):
            if a is not None and a == b and good(v) and good(w) and len(v) == len(w):
                v32, w32 = np.float32(v).astype(float), np.float32(w).astype(float)
                if v32 @ w32 / np.linalg.norm(v32) / np.linalg.norm(w32) >= 0.93:
                    links.append((x, y))
    want = smallest(range(len(rows)), links)
    counts = defaultdict(int)
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    for x, (i, v, a) in enumerate(rows):
        assert found[i].n_links == counts[x] and found[i].component_id == rows[want[x]][0], (i, found[i])
        assert found[i].kept == (found[i].component_id == i)


def test_no_embeddings(spark):
    assert near_embeddings(spark.createDataFrame([], VECTORS)).count() == 0
