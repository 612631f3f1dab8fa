"""The stream's counts against a plain count, with files that arrive in an order that takes counts back."""

import itertools
import os
import re
import time
from collections import Counter

import pytest

from breezemart.llm import filter_audit as audit
from breezemart.llm.filter_audit import filter_audit, mask_counts

LABELS = "doc_id long, quality int, toxic int"


def mask_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    failed = [len(words) < 100, 100 * len(set(words)) < 80 * len(words),
              100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search(r"[#$%&*|]", text))]
    return sum(1 << i for i, f in enumerate(failed) if f)


def plain(rows, labels):
    """{(part, order, step): counts} of (doc_id, text, lang) rows."""
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    docs = [(lang or "", mask_of(text or "") | 16 * (doc_id is not None and doc_id > least[text or ""]),
             doc_id in good, doc_id in toxic) for doc_id, text, lang in rows]
    found, shares = {}, Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {d[0] for d in docs}:
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                before = sum(1 << "ABCDE".index(x) for x in order[:step - 1])
                own = [d for d in docs if d[0] == part]
                here = [d for d in own if d[1] & bit and not d[1] & before]
                shares[part, letter] += len(here)
                found[part, order, step] = [
                    sum(not d[1] & (before | bit) for d in own), len(here),
                    sum(bool(d[1] & bit and d[1] & before) for d in own), sum(d[1] == bit for d in own),
                    sum(d[2] for d in here), sum(d[3] for d in here)]
    return {(p, o, s): (*v, shares[p, o[s - 1]]) for (p, o, s), v in found.items()}


def counted(frame):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = frame.collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in rows}
    assert len(found) == len(rows)
    return found


def land(spark, folder, files, schema):
    """One file per list of rows, in order of modification time."""
    os.makedirs(folder)
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}-{k}")
        part = next(f for f in os.listdir(f"{folder}-{k}") if f.endswith(".parquet"))
        os.rename(f"{folder}-{k}/{part}", f"{folder}/part-{k}.parquet")
        os.utime(f"{folder}/part-{k}.parquet", (time.time() - 1000 + k,) * 2)
    return folder


LONG = " ".join(f"w{i}" for i in range(150))
TEXTS = [LONG, LONG + " #", LONG.upper(), "few words", "a a a a a", "", None, "FEW", "#", LONG + " w1" * 60]


def test_smaller_ids_in_later_files_take_counts_back(spark, tmp_path):
    rows = [(1000 - i, TEXTS[i * 7 % len(TEXTS)], ["en", "de", None][i % 3]) for i in range(240)]
    rows += [(500, TEXTS[3], "fr"), (500, TEXTS[3], "fr"), (None, TEXTS[0], "en"), (None, None, None)]
    labels = [(i, i % 2, i % 3 % 2) for i in range(700, 1000)] + [(990, 1, 1), (None, 1, 1), (991, None, None)]
    schema = "doc_id long, text string, lang string"
    path = land(spark, str(tmp_path / "docs"), [rows[k::6] for k in range(3)] + [rows[k::6] for k in (3, 4, 5)], schema)
    marked = spark.createDataFrame(labels, LABELS)
    want = plain(rows, labels)
    for batches in (1, 6):
        assert counted(filter_audit(spark, path, marked, batches)) == want
    backwards = land(spark, str(tmp_path / "sorted"), [sorted(rows, key=lambda r: -(r[0] or 0))[k * 50:k * 50 + 50]
                                                       for k in range(5)], schema)
    assert counted(filter_audit(spark, backwards, marked, 5)) == want


def test_each_micro_batch_corrects_the_ones_before(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(audit, "work_folder", lambda _, name: str(tmp_path / name))
    schema = "doc_id long, text string, lang string"
    path = land(spark, str(tmp_path / "docs"), [[(9, "x #", "en")], [(5, "x #", "de")], [(7, "x #", "de")]], schema)
    sums = mask_counts(spark, path, spark.createDataFrame([(9, 1, 0)], LABELS), 3).where("n <> 0")
    assert sorted(map(tuple, sums.collect())) == [("de", 9, 1, 0, 0), ("de", 25, 1, 0, 0), ("en", 25, 1, 1, 0)]
    steps = spark.read.parquet(str(tmp_path / "filter-audit/changes"))
    assert sorted((r.batch, r.part, r["mask"], r.n) for r in steps.collect()) == [
        (0, "en", 9, 1), (1, "de", 9, 1), (1, "en", 9, -1), (1, "en", 25, 1), (2, "de", 25, 1)]


def test_a_common_text_and_a_replayed_micro_batch(spark, tmp_path):
    rows = [(i, "the same text", "en") for i in range(5000)]
    path = land(spark, str(tmp_path / "docs"), [rows[2500:], rows[:2500]], "doc_id long, text string, lang string")
    found = counted(filter_audit(spark, path, spark.createDataFrame([], LABELS)))
    assert found["en", "EABCD", 1] == (1, 4999, 0, 0, 0, 0, sum(v[1] for k, v in found.items() if k[1][k[2] - 1] == "E"))

    schema = "doc_id long, known boolean, digest binary, part string, mask int, n long, good long, toxic long"
    first = spark.createDataFrame([(5, True, bytearray(b"x"), "en", 1, 1, 1, 0)], schema)
    second = spark.createDataFrame([(3, True, bytearray(b"x"), "de", 1, 1, 0, 0), (4, True, bytearray(b"x"), "de", 1, 1, 0, 1)], schema)
    level = [str(tmp_path / f"state-{k}") for k in range(2)]
    audit.settle(first, [], level[0], str(tmp_path / "c0"))
    for _ in range(2):  # the same again
        audit.settle(second, level[:1], level[1], str(tmp_path / "c1"))
    changes = sorted(map(tuple, spark.read.parquet(str(tmp_path / "c1")).collect()))
    assert changes == [("de", 1, 1, 0, 0), ("de", 17, 1, 0, 1), ("en", 1, -1, -1, 0), ("en", 17, 1, 1, 0)]


def test_odd_rows_and_an_empty_table(spark, edge, empty, tmp_path):
    edge.withColumn("n", edge.size).write.parquet(str(tmp_path / "edge"))
    labels = spark.createDataFrame([(1, 1, 1), (2, None, 1)], LABELS)
    rows = [(r.doc_id, r.text, r.lang) for r in edge.collect()]
    assert counted(filter_audit(spark, str(tmp_path / "edge"), labels)) == plain(rows, [(1, 1, 1), (2, None, 1)])
    empty.coalesce(1).write.parquet(str(tmp_path / "empty"))
    assert filter_audit(spark, str(tmp_path / "empty"), labels).count() == 0


@pytest.mark.parametrize("extra", ["digest", "known", "mask", "part", "n", "good", "batch"])
def test_columns_with_clashing_names(spark, tmp_path, extra):
    frame = spark.createDataFrame([(1, "a b", "en", "q")], f"doc_id long, text string, lang string, {extra} string")
    frame.write.parquet(str(tmp_path / "docs"))
    labels = spark.createDataFrame([(1, 1, 0, "q")], f"{LABELS}, {extra if extra != 'good' else 'x'} string")
    found = counted(filter_audit(spark, str(tmp_path / "docs"), labels))
    assert found["en", "ABCDE", 1] == (0, 1, 0, 1, 1, 0, 120)
