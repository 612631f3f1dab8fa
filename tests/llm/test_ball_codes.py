"""Codes, errors and codebooks against plain k-means over every entry."""

import hashlib
import math

import numpy as np
import pytest

from breezemart.llm import ball_codes as balls
from breezemart.llm.ball_codes import ball_codes, books_digest, compress, first_codes, with_label_errors

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=8, entries=16, rounds=6):
    """{row: (code, error)} and codebooks, in Python integers, one comparison after the other."""
    good = [r for r in rows if r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vectors = [[math.floor(4096 * v) for v in r[1]] for r in good]
    width = len(vectors[0]) // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for v in vectors]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        found = [[nearest(p, v[p])[1] for p in range(parts)] for v in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p] for v, f in zip(cut, found) if f[p] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    coded = []
    for r, v in zip(good, cut):
        ends = [nearest(p, v[p]) for p in range(parts)]
        coded.append((r[0], r[2], bytes(e for _, e in ends), sum(d for d, _ in ends)))
    return coded, books


def same(spark, rows, files=1, **options):
    found = compress(spark.createDataFrame(rows, SCHEMA).repartition(files), **options)
    coded, books = plain(rows, **options)
    assert sorted(map(str, map(tuple, [(r.vec_id, r.label, bytes(r.code), r.error) for r in found.codes.collect()]))) \
        == sorted(map(str, coded))
    assert found.books.tolist() == books
    text = ",".join(str(c) for part in books for entry in part for c in entry)
    assert books_digest(found.books) == hashlib.sha256(text.encode()).hexdigest()
    return found


def vectors(n, dims, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (12, dims))
    return [(int(i * 7919 % 100_003), (centres[i % 12] + rng.normal(0, 0.2 * spread, dims)).tolist(), int(i % 5))
            for i in range(n)]


def test_blocks_and_partitions_change_nothing(spark, monkeypatch):
    rows = vectors(700, 16, 1)
    one = same(spark, rows)
    monkeypatch.setattr(balls, "BLOCK", 37)
    spread = same(spark, rows, files=3)
    assert one.books.tolist() == spread.books.tolist()


def test_ties_repeats_and_unused_entries(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(-2, 3, 8) / 4096).tolist(), 0) for i in range(150)]  # a few values: many ties
    rows += [(3, [0.0] * 8, 1), (3, [0.0] * 8, 1), (3, [-1 / 8192] * 8, None)]
    rows += [(-1, rows[0][1], 2), (None, [0.5] * 8, None)]
    same(spark, rows)
    same(spark, [(i, [0.25] * 8, None) for i in range(40)])
    same(spark, vectors(9, 24, 3))  # fewer rows than entries


def test_unusable_vectors_are_left_out(spark):
    rows = vectors(60, 8, 4)
    odd = [(1, None, 0), (2, [None] + [0.0] * 7, 0), (4, [float("nan")] * 8, 0), (5, [float("inf")] + [0.0] * 7, None)]
    same(spark, rows + odd)
    longer = rows + [(10**9, [0.0] * 16, 1), (10**9 + 1, [], 1)]
    assert compress(spark.createDataFrame(longer, SCHEMA)).codes.count() == 60
    assert compress(spark.createDataFrame(odd, SCHEMA)).codes.count() == 0
    assert compress(spark.createDataFrame([], SCHEMA)).codes.columns == ["vec_id", "label", "code", "error"]
    with pytest.raises(ValueError, match="equal parts"):
        compress(spark.createDataFrame([(1, [1.0] * 12, 1)], SCHEMA))


def test_single_precision_and_clashing_names(spark):
    schema = "vec_id long, embedding array<float>, label int, code string, error string, values int, ids int"
    rows = [(i, np.float32(v).tolist(), k) for i, v, k in vectors(80, 8, 5)]
    found = compress(spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], schema))
    assert sorted((r.vec_id, r.error) for r in found.codes.collect()) == sorted((c[0], c[3]) for c in plain(rows)[0])


def test_label_errors_put_nulls_together(spark):
    rows = [(i, v, None if k == 4 else k) for i, v, k in vectors(90, 8, 6)]
    found = with_label_errors(compress(spark.createDataFrame(rows, SCHEMA)).codes).collect()
    assert len(found) == 90
    for r in found:
        assert r.label_error == sum(o.error for o in found if o.label == r.label)


def test_balls_give_the_nearest_entries_with_less_work():
    rng = np.random.default_rng(7)
    saved = 0
    for trial in range(60):
        k, width = int(rng.integers(1, 17)), int(rng.integers(1, 9))
        if trial % 2:
            x = rng.integers(-6, 7, (400, width))
        else:
            x = rng.integers(-400, 401, (k, width))[rng.integers(0, k, 400)] + rng.integers(-20, 21, (400, width))
        book = x[:k].copy()
        codes, best = first_codes(x, book)
        radii = np.full(k, -1, np.int64)
        np.maximum.at(radii, codes, best)
        for _ in range(8):
            moved = np.array([x[codes == j].sum(axis=0) // max(1, (codes == j).sum()) if (codes == j).any() else book[j]
                              for j in range(k)])
            still = (moved == book).all(axis=1)
            book = moved
            codes, radii, computed = ball_codes(x, codes, radii, book, still)
            want, best = first_codes(x, book)
            assert (codes == want).all()
            for j in np.unique(codes):
                assert radii[j] >= best[codes == j].max()
            saved += 400 * k - computed
    assert saved > 0.3 * 60 * 8 * 400 * 8
