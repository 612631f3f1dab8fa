"""Snapshots of a set of tables: all of them change at once, or none does.

A run writes its tables into a folder of its own, `<root>/_snapshots/<run>`. Publishing puts one
small file in place, `<root>/_manifests/<number>.json`, which names the folder of every table. It is
written under another name and renamed, which a file system does whole or not at all, to a number
that does not exist yet: of two runs that publish at once one gets the number and the other the next.
Readers take the highest number once and then read tables of one run. Nothing that a manifest names
is ever changed or moved, so a failure at any step leaves the last snapshot as it was.

Old snapshots expire: first their manifest goes, then the folders no other manifest names, so what a
remaining manifest names is always there. A reader that took an older manifest has `keep` runs' time.
"""

from __future__ import annotations

import json
import logging
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)
KEEP = 3
DIGITS = 12


class PublishError(Exception):
    """A snapshot could not be published; the last one is still what readers get."""


def file_system(spark: SparkSession, path: str):
    """The file system a path is on, and the path, as Spark itself resolves them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def remove(spark: SparkSession, path: str) -> None:
    files, found = file_system(spark, path)
    files.delete(found, True)


def run_folder(root: str, run: str) -> str:
    return f"{root}/_snapshots/{run}"


def _manifest(root: str, version: int) -> str:
    return f"{root}/_manifests/{version:0{DIGITS}d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the manifests that are there, ascending."""
    files, folder = file_system(spark, f"{root}/_manifests")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """The newest manifest, or a given one: version, run, tables (name to path), notes."""
    if version is None:
        known = versions(spark, root)
        if not known:
            raise FileNotFoundError(f"nothing is published under {root}")
        version = known[-1]
    files, path = file_system(spark, _manifest(root, version))
    stream = files.open(path)
    try:
        size = files.getFileStatus(path).getLen()
        text = bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream))[:size]
    finally:
        stream.close()
    return json.loads(text.decode())


def _write(spark: SparkSession, path: str, text: str) -> None:
    files, found = file_system(spark, path)
    stream = files.create(found, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    files, path = file_system(spark, source)
    return files.rename(path, file_system(spark, target)[1])


def publish(spark: SparkSession, root: str, run: str, tables: dict[str, str], notes: dict | None = None,
            keep: int = KEEP, drop: list[str] | None = None) -> int:
    """Make `tables` (name to path below `root`) what readers get; returns the snapshot's number.

    Tables of the snapshot before that `tables` does not name are carried over, but for those in
    `drop`. `keep` snapshots stay.
    """
    known = versions(spark, root)
    before = manifest(spark, root, known[-1])["tables"] if known else {}
    before = {name: path for name, path in before.items() if name not in (drop or ())}
    number = known[-1] + 1 if known else 1
    prefix = f"{root.rstrip('/')}/"
    own = {name: path.removeprefix(prefix) for name, path in tables.items()}
    draft = f"{root}/_manifests/.{uuid.uuid4().hex}"
    body = {"run": run, "published": time.time(), "tables": {**before, **own}, "notes": notes or {}}
    _write(spark, draft, json.dumps({"version": number, **body}))
    # a rename onto an existing name fails, or on some file systems replaces: look first
    files, target = file_system(spark, _manifest(root, number))
    if files.exists(target) or not _rename(spark, draft, _manifest(root, number)):
        remove(spark, draft)
        raise PublishError(f"{root}: snapshot {number} was published by another run")
    try:
        expire(spark, root, keep)
    except Exception:  # the snapshot is out; what should have gone goes next time
        log.warning("old snapshots of %s could not be removed", root, exc_info=True)
    return number


def published(spark: SparkSession, root: str, run: str) -> bool:
    """Whether a manifest names tables of `run`."""
    folder = f"_snapshots/{run}/"
    return any(path.startswith(folder) for version in versions(spark, root)
               for path in manifest(spark, root, version)["tables"].values())


def paths(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """Table name to path, all of one snapshot."""
    return {name: f"{root}/{path}" for name, path in manifest(spark, root, version)["tables"].items()}


def read(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """Every table of a snapshot, found through one manifest."""
    return {name: spark.read.parquet(path) for name, path in paths(spark, root, version).items()}


def expire(spark: SparkSession, root: str, keep: int = KEEP) -> list[str]:
    """Drop all but the newest `keep` snapshots; returns the folders that went."""
    known = versions(spark, root)
    old, kept = known[:-max(1, keep)], known[-max(1, keep):]
    named = {p for v in kept for p in manifest(spark, root, v)["tables"].values()}
    gone = []
    for version in old:
        tables = set(manifest(spark, root, version)["tables"].values())
        remove(spark, _manifest(root, version))
        for path in sorted(tables - named):
            remove(spark, f"{root}/{path}")
            gone.append(path)
    for folder in {p.rsplit("/", 1)[0] for p in gone}:
        files, found = file_system(spark, f"{root}/{folder}")
        if files.exists(found) and not list(files.listStatus(found)):
            files.delete(found, False)
    return gone


def sweep(spark: SparkSession, root: str, older_than: float = 7 * 24 * 3600) -> list[str]:
    """Remove run folders that no manifest names and that nothing has changed for so many seconds:
    what a run leaves that ended without its clean-up."""
    named = {p.split("/")[1] for v in versions(spark, root) for p in manifest(spark, root, v)["tables"].values()}
    files, folder = file_system(spark, f"{root}/_snapshots")
    if not files.exists(folder):
        return []
    gone = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name not in named and time.time() - status.getModificationTime() / 1000 > older_than:
            files.delete(status.getPath(), True)
            gone.append(name)
    return gone
