"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


SHUFFLE_BYTES_PER_TASK = 256 * 1024 * 1024
FEWEST_SHUFFLE_TASKS = 200
MOST_SHUFFLE_TASKS = 32_768
MOST_SCAN_TASKS = 100_000
FEWEST_SCAN_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle partitions for an input size: 256 MB each, so that a sort fits a task's memory, up to
    32,768, which 8 TB reach. Beyond, tasks grow, to 3 GB at 100 TB, and sorts spill: the shuffle's
    blocks number map tasks times reduce tasks, and many small ones cost more than spilling.

    Adaptive execution joins small partitions later; it cannot cut up aggregations.
    """
    return min(MOST_SHUFFLE_TASKS, max(FEWEST_SHUFFLE_TASKS, -(-input_bytes // SHUFFLE_BYTES_PER_TASK)))


def scan_bytes(input_bytes: int) -> int:
    """Bytes a scan task reads: 128 MB, and as many as keep a large input under 100,000 tasks."""
    return max(FEWEST_SCAN_BYTES, -(-input_bytes // MOST_SCAN_TASKS))


def build_session(app: str = "breezemart", master: str | None = None,
                  input_bytes: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine counts on; `conf` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.broadcastTimeout": "600",
        "spark.ui.enabled": "false",
    }
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
        settings["spark.sql.files.maxPartitionBytes"] = str(scan_bytes(input_bytes))
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return pin_utc(builder.getOrCreate())


def pin_utc(spark: SparkSession) -> SparkSession:
    """Zone-less stamps are read as UTC everywhere, whatever the machine says."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder path for staged tables, under the cluster's shared checkpoint folder.

    The folder comes from `spark.checkpoint.dir` (or the context's checkpoint folder). Only a
    local session without either gets a temporary folder; a cluster session without one fails
    here, because a machine-local folder is lost with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="breezemart-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/breezemart/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the working folder and read back.

    Joins against it then plan with its real size, in place of a guess from its inputs.
    """
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
