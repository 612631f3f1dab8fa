"""Line repeats against all pairs of lines."""

import random

from pyspark.sql import functions as F

from breezemart.llm.line_dedup import deletion_hashes, line_repeats, without_repeats


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return a == b
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else (a[i + 1:] == b[i:] or a[i:] == b[i + 1:])


def plain(docs):
    seen, gone = [], {}
    for i, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        lines = (text or "").split("\n")
        gone[i] = []
        for k, line in enumerate(lines):
            if not line.strip(" "):
                continue
            if any(line == other or near(line, other) for other in seen):
                gone[i].append(k)
            seen.append(line)
    return gone


def check(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = line_repeats(frame)
    want = plain(docs)
    got = {r.doc_id: r for r in found.collect()}
    assert {i: r.dropped_lines for i, r in got.items()} == {i: ",".join(map(str, g)) for i, g in want.items()}
    assert all(r.n_dropped == len(want[i]) for i, r in got.items())
    cleaned = frame.join(found, "doc_id").select("doc_id", without_repeats(F.col("text"), F.col("dropped_lines")).alias("t"))
    texts = dict(docs)
    for r in cleaned.collect():
        lines = (texts[r.doc_id] or "").split("\n")
        assert texts[r.doc_id] is None or r.t == "\n".join(x for k, x in enumerate(lines) if k not in want[r.doc_id])


def edited(rng, line):
    i, how = rng.randrange(len(line)), rng.randrange(4)
    return [line, line[:i] + line[i + 1:], line[:i] + rng.choice("abé") + line[i:], line[:i] + "z" + line[i + 1:]][how]


def test_lines_against_all_pairs(spark):
    rng = random.Random(6)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.choice([5, 18, 19, 20, 21, 22, 40, 90]))) for _ in range(60)]
    pool += ["page 1 of the whole document", "aaaaaaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaaaa"]
    docs = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 8)):
            line = rng.choice(pool)
            for _ in range(rng.choice([0, 1, 1, 2])):
                line = edited(rng, line)
            lines.append(line)
        docs.append((i, "\n".join(lines)))
    docs += [(500, None), (501, ""), (502, "\n\n  \n"), (503, "x" * 50_000), (504, "y" + "x" * 49_999), (None, pool[0])]
    check(spark, docs)


def test_documents(spark, documents):
    rows = [(r.doc_id, r.text[:3000]) for r in documents.limit(60).collect()]
    check(spark, rows)


def test_odd_rows(spark, edge, empty):
    rows = line_repeats(edge).collect()
    assert len(rows) == edge.count() and line_repeats(empty).count() == 0
    assert sorted(r.n_dropped for r in rows if r.doc_id == 6) == [0, 1]


def test_deletion_hashes():
    line = "any line é 👩‍🚀"
    found = deletion_hashes(line)
    want = [line] + [line[:i] + line[i + 1:] for i in range(len(line))]
    assert [int(x) for x in found] == [int(deletion_hashes(w)[0]) for w in want]
    assert len(deletion_hashes("")) == 1
