"""The pipeline against plain versions of its stages, over its own inputs, and on odd and empty tables."""

import collections
import math
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from breezemart.llm import toxicity
from breezemart.llm.mixing import mix
from breezemart.llm.shared import staged, table
from breezemart.llm.tokens import vocabulary


def stages(spark, folder):
    """(name, input, output) of every stage, each written and read again."""
    docs, found = table(spark, folder, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result = staged(stage(spark, docs, folder), "tried")
        found.append((name, docs, result))
        docs = result
    return found


def similarity(a, b):
    """Probability Jaccard of two texts' shingles of five words, by its definition."""
    def shingles(text):
        words = (text or "").lower().split()
        width = min(5, len(words))
        return collections.Counter(tuple(words[i:i + width]) for i in range(len(words) - width + 1)) if words else {}

    v, w = shingles(a), shingles(b)
    return sum(1 / sum(max(v.get(d, 0) / v[c], w.get(d, 0) / w[c]) for d in {*v, *w}) for c in v if c in w)


def one_of_each_class(rows, least=0.8):
    """doc_ids that stay: the smallest of every class that links of `least` or more connect."""
    top = {r.doc_id: r.doc_id for r in rows}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    sets = {r.doc_id: set(zip(*[(r.text or "").lower().split()[k:] for k in range(5)])) for r in rows}
    for i, a in enumerate(rows):
        for b in rows[:i]:
            small, large = sorted((len(sets[a.doc_id]), len(sets[b.doc_id])))
            if small < 0.3 * large or (large and 3 * len(sets[a.doc_id] & sets[b.doc_id]) < large):
                continue  # too far apart for 0.8 in any case: weights are small whole numbers here
            if similarity(a.text, b.text) >= least:
                x, y = root(a.doc_id), root(b.doc_id)
                top[max(x, y)] = min(x, y)
    return {i for i in top if root(i) == i}


def check_mix(before, after):
    copies = {r.doc_id: r.taken // r["size"] for r in mix(before).collect() if r["size"]}
    assert collections.Counter(r.doc_id for r in after) == {k: n for k, n in copies.items() if n}
    assert set(after) <= set(before.collect())
    assert max(copies.values(), default=0) <= 3


def check_packed(mixed, packed):
    """Every piece of every copy, with the ids the plain library gives, in gapless sequences."""
    library = Tokenizer.from_file(vocabulary())
    want = collections.Counter()
    for r in mixed:
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        edges = [0, *range(first, len(ids) + 1, 1024)]
        want.update((r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:])))
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    held = collections.defaultdict(list)
    for r in packed:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= 1024
    tokens = sum(r.length for r in packed)
    assert len(held) <= math.ceil(tokens / 1024) * 1.05 + 2


def test_stages(spark, sf_dir):
    found = stages(spark, sf_dir)
    (_, docs, civil), (_, _, single), (_, _, apart), (_, _, mixed), (_, _, packed) = found
    assert all(out.columns == docs.columns for _, _, out in found[:-1])

    texts = toxicity.prepared(docs)
    model = toxicity.fit(texts, table(spark, sf_dir, "labels"))
    rejected = {r.doc_id for r in toxicity.toxicity(texts, model).collect() if r.predicted}
    assert set(civil.collect()) == {r for r in docs.collect() if r.doc_id not in rejected}
    toxic = {r.doc_id for r in table(spark, sf_dir, "labels").where("toxic = 1").collect()}
    assert len(rejected - toxic) <= 0.05 * docs.count()

    last = {}
    for r in civil.collect():
        key = (r.text or "").encode().lower()
        last[key] = max(last.get(key, -1), r.doc_id)
    assert set(single.collect()) == {r for r in civil.collect() if r.doc_id in last.values()}

    assert {r.doc_id for r in apart.collect()} == one_of_each_class(single.collect())
    assert set(apart.collect()) <= set(single.collect())
    check_mix(apart, mixed.collect())
    check_packed(mixed.collect(), packed.collect())


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_run_on_odd_and_empty_tables(spark, edge, empty, tmp_path, kind):
    folder = str(tmp_path / kind)
    (edge if kind == "odd" else empty).write.parquet(f"{folder}/documents.parquet")
    labels = [(1, 1, 0), (5, 1, 1), (None, 1, 1), (8, None, None)] if kind == "odd" else []
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    packed = corpus_pipeline.run(spark, folder).collect()
    assert (len(packed) > 0) == (kind == "odd")
    if kind == "odd":
        found = stages(spark, folder)
        for (name, before, after) in found[:-1]:
            assert set(after.columns) == set(edge.columns), name
            assert {(r.doc_id, r.text) for r in after.collect()} <= {(r.doc_id, r.text) for r in before.collect()}, name
        check_packed(found[3][2].collect(), packed)
        # texts equal but for case are one, and of a doc_id that repeats one row stays
        assert sum((r.text or "").lower() == "the same text" for r in found[1][2].collect()) <= 1
    else:
        assert packed == []


def test_run_gives_the_last_stage(spark, sf_dir):
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    mixed = stages(spark, sf_dir)[3][2].collect()
    check_packed(mixed, packed)
