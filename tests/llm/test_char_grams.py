"""Counts, probabilities, ratios and features against plain Python."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from breezemart.llm import char_grams as cg

PAD = "\U0010ffff"


def plain_grams(text):
    text = PAD * 4 + text.lower()
    return [text[i - 4:i + 1] for i in range(4, len(text))]


class Plain:
    """Two classes over one shared interpolated Kneser-Ney model, as `ratios` describes it, in dictionaries."""

    def __init__(self, ordinary, toxic):
        self.n = {}
        for texts, c in ((ordinary, 0), (toxic, 1)):
            for gram, k in Counter(g for t in texts for g in plain_grams(t)).items():
                self.n.setdefault(gram, [0, 0])[c] += k
        self.both = {5: Counter({g: sum(n) for g, n in self.n.items()})}
        for k in (4, 3, 2, 1):
            self.both[k] = Counter(g[1:] for g in self.both[k + 1])
        self.after = {k: defaultdict(list) for k in range(1, 6)}
        for k, counts in self.both.items():
            for g, n in counts.items():
                self.after[k][g[:-1]].append(n)
        self.contexts = defaultdict(lambda: [[0, 0], [0, 0]])
        for g, counts in self.n.items():
            for c in range(2):
                self.contexts[g[:-1]][c][0] += counts[c]
                self.contexts[g[:-1]][c][1] += counts[c] > 0

    def shared(self, gram):
        if not gram:
            return 1 / (len(self.both[1]) + 1)
        own = self.after[len(gram)].get(gram[:-1])
        if own is None:
            return self.shared(gram[1:])
        left = max(self.both[len(gram)][gram] - 0.75, 0) + 0.75 * len(own) * self.shared(gram[1:])
        return left / sum(own)

    def weight(self, context, c):
        total, kinds = self.contexts.get(context, [[0, 0], [0, 0]])[c]
        return 0.75 * kinds / total if total else 1.0

    def p(self, gram, c):
        total = self.contexts.get(gram[:-1], [[0, 0], [0, 0]])[c][0]
        own = max(self.n.get(gram, [0, 0])[c] - 0.75, 0) / total if total else 0
        return own + self.weight(gram[:-1], c) * self.shared(gram)

    def ratio(self, gram):
        """Of any gram, whether known or not: nothing is looked up."""
        return math.log(self.p(gram, 1) / self.p(gram, 0))

    def features(self, text):
        scores = [self.ratio(g) for g in plain_grams(text)]
        if not scores:
            return [0.0, 0.0]
        sums = np.concatenate([[0], np.cumsum(scores)])
        peak = max(sums[i] - sums[max(0, i - cg.PASSAGE)] for i in range(1, len(sums)))
        return [sums[-1] / len(scores), max(peak, 0) / cg.PASSAGE]


CALM = ["the river runs by the stone table", "green walks and long talks", "Über alles läuft der Fluss", "a b a b",
        "stones and tables by the river " * 4, "日本語の文"]
RUDE = ["you zorgig kwubble go away", "zorgig zorgig table", "kwubble talk, zo$r", "日本悪い"]
OTHERS = ["the zorgig river", "unseen wörds ☃ entirely", "", "z", "kwubble " * 30, "table", "日本悪の"]


@pytest.fixture(scope="module")
def fitted(spark):
    rows = [(i, text, c) for i, (text, c) in enumerate([(t, 0) for t in CALM] + [(t, 1) for t in RUDE])]
    rows += [(100 + i, t, None) for i, t in enumerate(OTHERS)] + [(200, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, c int").repartition(3)
    texts = cg.chunked(docs, {"doc_id": F.col("doc_id"), "c": F.col("c")})
    cells = texts.table.where("c is not null").select("_chunk", "_row", F.col("c").alias("cell"))
    counts = cg.count(texts, cells)
    return texts, counts, cg.ratios(counts, F.col("n0"), F.col("n1")), {r[0]: r[1] for r in rows}


def unpacked(high, low):
    return "".join(PAD if s == cg.START else chr(s) for s in (
        high >> 21, high & cg.LOW, low >> 42, low >> 21 & cg.LOW, low & cg.LOW))


def test_counts(fitted):
    found = {unpacked(r.high, r.low): [r.n0, r.n1] for r in fitted[1].collect()}
    assert found == Plain(CALM, RUDE).n


def test_ratios_and_context_weights(fitted):
    plain = Plain(CALM, RUDE)
    rows = fitted[2].collect()
    found = {(r.order, unpacked(r.high, r.low)[5 - r.order:]): r.number for r in rows}
    assert len(found) == len(rows) == len(plain.n) + len(plain.contexts)
    for gram in plain.n:
        assert found[5, gram] == pytest.approx(plain.ratio(gram), abs=1e-5), gram
    for context in plain.contexts:
        want = math.log(plain.weight(context, 1) / plain.weight(context, 0))
        assert found[4, context] == pytest.approx(want, abs=1e-5), context


def test_probabilities_of_a_context_sum_to_one():
    plain = Plain(CALM, RUDE)
    alphabet = [*plain.both[1], "\x00"]  # one more for the unknown
    for context in list(plain.contexts)[:60]:
        for c in range(2):
            assert sum(plain.p(context + x, c) for x in alphabet) == pytest.approx(1, abs=1e-9)


def test_features_of_every_text(fitted):
    texts, _, table, all_texts = fitted
    plain = Plain(CALM, RUDE)
    found = {r.doc_id: [r.whole, r.peak] for r in cg.scored(texts, table).collect()}
    assert found.keys() == all_texts.keys()
    for doc_id, text in all_texts.items():
        assert found[doc_id] == pytest.approx(plain.features(text or ""), abs=1e-5), text


def test_an_unseen_word_after_a_known_context_pays_what_the_context_hands_on():
    letters = "cdefghijklmnopqrstuv"
    plain = Plain([f"a b {x}" for x in letters], ["a b x"] * 20)
    assert plain.ratio("a b z") == pytest.approx(math.log(0.0375 / 0.75))
    found = cg.of_grams(np.array([1, 2, 3]), np.array([7, 8, 8]), pd.Index([1, 7, 8]), np.array([0.5, 0.25, -3.0]))
    assert found.tolist() == [0.5, -3.0, -3.0]
    assert cg.of_grams(np.array([1]), np.array([2]), pd.Index([1, 2]), np.array([np.nan, np.nan])).tolist() == [0.0]


def test_chunks_and_runs_change_nothing(spark, fitted, monkeypatch):
    texts, _, table, all_texts = fitted
    whole = {r.doc_id: [r.whole, r.peak] for r in cg.scored(texts, table).collect()}
    monkeypatch.setattr(cg, "RUN", 7)
    docs = spark.createDataFrame(list(all_texts.items()), "doc_id long, text string").coalesce(1)
    again = cg.scored(cg.chunked(docs, {"doc_id": F.col("doc_id")}), table).collect()
    assert {r.doc_id: [r.whole, r.peak] for r in again} == {k: pytest.approx(v) for k, v in whole.items()}


def test_distinct_grams_and_their_contexts():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab \U0001f600é") for _ in range(rng.randint(0, 40))) for _ in range(50)]
    keys, high, low = cg.distinct(texts)
    want = {g for t in texts for g in plain_grams(t)}
    assert {unpacked(h, lo) for h, lo in zip(high.tolist(), low.tolist())} == want and len(keys) == len(want)
    assert (np.diff(keys) > 0).all()
    gram, context = cg.keys_of(high, low)
    names = [unpacked(h, lo) for h, lo in zip(high.tolist(), low.tolist())]
    assert (gram == keys).all()
    by_text = pd.Series(context).groupby([n[:4] for n in names]).nunique()
    assert (by_text == 1).all() and len(set(context.tolist())) == len(by_text)


def test_a_subset_carries_its_columns(fitted):
    texts = fitted[0]
    chosen = texts.table.where("doc_id in (0, 102)").select("_chunk", "_row", (F.col("doc_id") * 2).alias("twice"))
    part = cg.subset(texts, chosen)
    assert sorted((r.twice, r["_text"]) for r in part.table.collect()) == [(0, CALM[0]), (204, "")]


def test_grouping_by_chunk_moves_no_text(fitted):
    plan = cg.scored(fitted[0], fitted[2])._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert not [line for line in plan.splitlines() if "Exchange" in line and "_text" in line]
