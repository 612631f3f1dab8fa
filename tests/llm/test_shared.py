"""The sieve before a join loses no wanted row, whatever its size."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from breezemart.llm import near_dedup as near
from breezemart.llm import shared
from breezemart.llm.shared import sieved


@pytest.mark.parametrize("words", [1, 7, 2**20])
def test_a_sieve_loses_nothing_and_stops_most(spark, monkeypatch, words):
    monkeypatch.setattr(shared, "SIEVE_WORDS", words)
    rows = spark.range(20_000).select(F.when(F.col("id") % 1000 != 999, F.col("id")).alias("a"), F.lit("x").alias("_w"))
    wanted = spark.range(0, 20_000, 20).select(F.col("id").alias("b")).union(spark.sql("select cast(null as bigint) as b"))
    kept = sieved(rows, F.xxhash64("a"), wanted, F.xxhash64("b"))
    assert kept.columns == rows.columns
    assert kept.join(wanted, F.col("a").eqNullSafe(F.col("b"))).count() == 1020
    if words > 100:
        assert kept.count() < 20_000 * 0.13


def test_a_sieve_of_nothing_and_of_an_empty_table(spark):
    rows = spark.range(10).select("id")
    assert sieved(rows, F.xxhash64("id"), rows.limit(0), F.xxhash64("id")).count() == 0
    assert sieved(rows.limit(0), F.xxhash64("id"), rows.withColumnRenamed("id", "w"), F.xxhash64("w")).count() == 0


def test_near_dedup_leaves_only_what_its_result_reads(spark, monkeypatch, documents, tmp_path):
    for module in (shared, near):
        monkeypatch.setattr(module, "work_folder", lambda _, name: f"{tmp_path}/corpus/{name}-{uuid.uuid4().hex[:12]}")
    found = near.near_dedup(documents, carry=["text"])
    assert found.count() == documents.count()
    left = {name.rsplit("-", 1)[0] for name in os.listdir(tmp_path / "corpus")}
    assert left == {"sketches", "sieve", "classes"}


def test_a_written_table_leaves_no_shuffle_files(spark, monkeypatch, tmp_path):
    for module in (shared, near):
        monkeypatch.setattr(module, "work_folder", lambda _, name: f"{tmp_path}/corpus/{name}-{uuid.uuid4().hex[:12]}")
    folders = [str(f) for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
               .localDirs()]

    def files():
        return {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    before = files()
    rows = shared.staged(spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count(), "counts")
    for _ in range(50):  # they are deleted in the background
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert rows.count() == 7 and spark.conf.get(shared.SWEPT) == "false"
