"""Held-out accuracy of the toxicity score, and its counts and ratios against plain Python."""

import math
import random
import zlib

import numpy as np
import pytest

from breezemart.llm import toxicity as tox


def corpus(n=600, seed=4):
    rng = random.Random(seed)
    calm, rude = ["table", "river", "über", "stone", "talk", "green", "walk"], ["zorgig", "kwubble"]
    rows = []
    for i in range(n):
        words = [rng.choice(calm) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(5, 80))]
        label = int(rng.random() < 0.3)
        if label:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(rude)
        rows.append((i, " ".join(words), label))
    return rows


def test_held_out_rows(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int")
    texts = tox.prepared(docs)
    found = {r.doc_id: r for r in tox.toxicity(texts, tox.fit(texts, labels)).collect()}
    for i, _, label in rows:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= found[i].score <= 1 and found[i].predicted == int(found[i].score >= 0.5)
    held = [(found[i].predicted, label) for i, _, label in rows if found[i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.95

    swapped = [(i, 1, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in rows]
    again = tox.fit(texts, spark.createDataFrame(swapped, "doc_id long, quality int, toxic int"))
    assert {r.doc_id: r.score for r in tox.toxicity(texts, again).collect()} == {
        i: r.score for i, r in found.items()}


#: Toxic and harmless words that differ in letters of one script, digits, marks or accents only.
PAIRS = {"cyrillic": ("абвг", "вгаб"), "digits": ("zor9", "zor4"), "marks": ("zo$r", "zo!r"),
         "accents": ("zorà", "zorê"), "cjk": ("一丂丄", "丄一丂")}


def test_words_that_differ_little(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        toxic = int(rng.random() < 0.4)
        text = [rng.choice(["table", "river", "stone", "walk"]) for _ in range(rng.randint(5, 30))]
        for bad, calm in PAIRS.values():
            text[rng.randrange(len(text)):0] = [bad if toxic else calm]
        rows.append((i, " ".join(text), toxic))
    texts = tox.prepared(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3))
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    found = {r.doc_id: r for r in tox.toxicity(texts, tox.fit(texts, labels)).collect()}
    assert len(found) == len(rows)
    assert np.mean([found[i].predicted == y for i, _, y in rows if found[i].held_out]) > 0.95


def test_odd_rows(spark, edge, empty):
    labels = spark.createDataFrame([(1, 0), (5, 1), (6, None), (None, 1), (7, 3)], "doc_id long, toxic int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    texts, nothing = tox.prepared(edge, ["run", "size", "text"]), tox.prepared(empty)
    for known in (labels, none):
        model = tox.fit(texts, known)
        rows = tox.toxicity(texts, model).collect()
        assert sorted(map(str, [(r.doc_id, r.run, r["size"], r.text) for r in rows])) == sorted(
            map(str, [(r.doc_id, r.run, r["size"], r.text) for r in edge.collect()]))
        assert all(0 <= r.score <= 1 and not math.isnan(r.score) for r in rows)
        assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
        assert tox.toxicity(nothing, model).count() == 0
