"""Streamed facts merged into those of the batch job, day by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breezemart.operators.merge import latest_per_key
from breezemart.plans.harmonized import KEYS
from breezemart.plans.pipeline import FACTS
from breezemart.session import staged
from breezemart.sources import snapshots
from breezemart.sources.writers import write_clustered, write_partitioned
from breezemart.streaming import store

CLUSTER = ["location_key"]


def upsert_days(spark: SparkSession, path: str, rows: DataFrame, rank: str | None = None) -> list[str]:
    """Merge `rows` into the table at `path`, which has a folder per date; returns the days written.

    Only days that occur in `rows` are read and replaced; the files of all others stay. Rows of a
    (timestamp, location) that both have are taken from `rows`, of several there the one of the highest
    `rank`, a column the table does not get. Doing it again changes nothing, so a run that failed
    half-way is simply repeated.
    """
    dated = rows.withColumn("date", F.to_date("timestamp"))
    days = [r[0] for r in dated.select("date").distinct().collect()]  # bounded by the calendar
    if not days:
        return []
    stored = spark.read.parquet(path).where(F.col("date").isin(days))
    both = (stored.withColumn("_from", F.lit(0))
            .unionByName(dated.withColumn("_from", F.lit(1)), allowMissingColumns=True))
    order = ["_from", *([rank] if rank else [])]
    merged = staged(latest_per_key(both, KEYS, [F.col(name) for name in order]).drop(*order), "merged-days")
    write_partitioned(merged, path, ["date"], whole_table=False, cluster=[*CLUSTER, "timestamp"])
    return sorted(map(str, days))


def merge_facts(spark: SparkSession, mart: str, live: str, out: str) -> dict[str, str]:
    """Facts of the newest snapshot under `mart` with those streamed to `live`; fact name to path.

    Each snapshot has a table of its own under `out`, with a folder per day and rows in cluster order;
    it is written once and then only the days that were streamed are replaced.
    """
    manifest = snapshots.manifest(spark, mart)
    streamed = store.tables(store.state(spark, live))
    done = {}
    for kind, name in FACTS.items():
        path = f"{out}/{name}/snapshot={manifest['version']}"
        files, folder = snapshots.file_system(spark, f"{path}/_SUCCESS")
        if not files.exists(folder):
            history = spark.read.parquet(f"{mart}/{manifest['tables'][name]}").drop("year", "month")
            write_clustered(history, path, "date", CLUSTER)
        if f"facts/{kind}" in streamed:
            # one reduction settles segments and history together
            upsert_days(spark, path, store.unsettled(spark, live, f"facts/{kind}").drop("date"), store.SEQ)
        done[name] = path
    return done
