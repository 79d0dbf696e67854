"""Partition writes that a crash cannot leave half done (W3, W5 sinks).

1. ``stage`` writes the new content of the touched partitions to a hidden folder beside the
   table's partitions, while the old ones are still read — no copy in between is needed.
2. ``commit`` writes a marker that names the staged partitions and those to remove. From here
   on the new content is the table's.
3. ``publish`` moves the staged partitions to their place, one rename each, and removes the
   marker last. Every step may be repeated, so whoever comes next — ``recover`` is called
   before a table is read or written — finishes what a crash has left: without a marker
   the staged folder is dropped, with one it is published.

One writer at a time per table, as with the other sinks.
"""

from __future__ import annotations

import json
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from lodgeflow.session import delete_path, path_exists

STAGED, MARKER = "_staged-", "_commit-"


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def folders(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names directly under ``path`` that begin with ``prefix``, sorted (a table's partitions)."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(jpath)) if n.startswith(prefix))


def partition_folder(spark: SparkSession, column: str, value) -> str:
    """The folder of a partition value, escaped as Spark's writer does it."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    text = names.DEFAULT_PARTITION_NAME() if value is None or value == "" else names.escapePathName(str(value))
    return f"{names.escapePathName(column)}={text}"


def stage(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """Write ``df`` to a hidden folder of the table; returns the name of the attempt."""
    attempt = uuid.uuid4().hex
    df.write.partitionBy(*partition_by).parquet(f"{path}/{STAGED}{attempt}")
    return attempt


def commit(spark: SparkSession, path: str, attempt: str, removed: Sequence[str] = ()) -> None:
    """Name the partitions of the attempt, and those to remove, in a marker."""
    told = {"replaced": [n for n in folders(spark, f"{path}/{STAGED}{attempt}") if "=" in n], "removed": list(removed)}
    fs, jpath = _fs(spark, f"{path}/{STAGED}{attempt}/_told")
    out = fs.create(jpath, True)
    out.write(bytearray(json.dumps(told).encode()))
    out.close()
    # the rename is what commits: a marker is there as a whole or not at all
    if not fs.rename(jpath, _fs(spark, f"{path}/{MARKER}{attempt}")[1]):
        raise OSError(f"cannot commit {attempt} of {path}")


def _told(spark: SparkSession, path: str, attempt: str) -> dict:
    fs, jpath = _fs(spark, f"{path}/{MARKER}{attempt}")
    file = fs.open(jpath)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
    finally:
        file.close()


def publish(spark: SparkSession, path: str, attempt: str) -> None:
    """Move what the marker names to its place; may be repeated from any point."""
    told, staged = _told(spark, path, attempt), f"{path}/{STAGED}{attempt}"
    for name in told["removed"]:
        delete_path(spark, f"{path}/{name}")
    for name in told["replaced"]:
        fs, new = _fs(spark, f"{staged}/{name}")
        if fs.exists(new):  # else an earlier attempt has moved it
            delete_path(spark, f"{path}/{name}")
            if not fs.rename(new, _fs(spark, f"{path}/{name}")[1]):
                raise OSError(f"cannot publish {name} of {path}")
    delete_path(spark, f"{path}/{MARKER}{attempt}")
    delete_path(spark, staged)


def recover(spark: SparkSession, path: str, drop_uncommitted: bool = False) -> int:
    """Publish committed attempts that a crash has left; a writer also drops those without a
    marker. Returns how many were published."""
    if getattr(spark, "_jvm", None) is None or not path_exists(spark, path):
        return 0
    waiting = [n.removeprefix(MARKER) for n in folders(spark, path, MARKER)]
    for attempt in waiting:
        publish(spark, path, attempt)
    if drop_uncommitted:
        for name in folders(spark, path, STAGED):
            delete_path(spark, f"{path}/{name}")
    return len(waiting)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], removed=lambda: ()) -> None:
    """Replace the partitions that ``df`` holds (which may be computed from the table itself),
    and remove those that ``removed()`` names once ``df`` has been written."""
    spark = df.sparkSession
    attempt = stage(df, path, partition_by)
    commit(spark, path, attempt, removed())
    publish(spark, path, attempt)
