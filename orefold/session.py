"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Broadcast joins are never hinted on tables that grow. Spark compares a side's measured size with
# this limit (at plan time from file sizes, at run time from shuffle sizes) and falls back to a
# sort-merge join with skew splitting above it.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Many small partitions to begin with, which adaptive execution puts together; a large shuffle stays
    # within executor memory. Sessions for small data set fewer.
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.parquet.compression.codec": "zstd",
    # Shuffled rows are full of hashes and ids in hex, which lz4 leaves as long as they are.
    "spark.io.compression.codec": "zstd",
    # Recording the call site of every column expression takes longer than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def create_session(app: str = "orefold", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; ``extra`` keys use ``_`` for ``.``-free overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate tables, below the shared folder named by the session.

    Every executor must be able to read it back, so ``spark.checkpoint.dir`` decides where it is.
    Only when that setting is absent on a single machine, as in tests, a temporary folder stands in; on a
    cluster its absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), f"orefold-{os.getuid()}")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object for ``path`` (local, HDFS or object store)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def create_file(spark: SparkSession, path: str, content: str) -> None:
    """Writes a small file; fails if there is one of that name."""
    fs, target = file_system(spark, path)
    stream = fs.create(target, False)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when it does not exist."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs: that follows the driver's garbage collection, which may
    come late by itself. Results in written tables do not need them any more."""
    spark.sparkContext._jvm.System.gc()


_LOCK = threading.Lock()
_HELD: dict[str, list[str | None]] = {}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings that hold meanwhile. Threads may hold a setting side by side; the first gives its value, and the last
    that ends gives the session its own back."""
    with _LOCK:
        for key, value in values.items():
            held = _HELD.setdefault(key, [])
            held.append(held[0] if held else spark.conf.get(key, None))
            if len(held) == 1:
                spark.conf.set(key, value)
    try:
        yield
    finally:
        with _LOCK:
            for key in values:
                before = _HELD[key].pop()
                if _HELD[key]:
                    continue
                if before is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, before)


#: Bytes of a side that is broadcast on the strength of its file sizes, and of one whose rows were measured, at most.
LISTED_BYTES, MEASURED_BYTES = 256 << 10, 4 << 20


def measured_joins(spark: SparkSession):
    """Joins planned meanwhile broadcast a side by its measured rows, or if its files are tiny; never beyond the session's own limit.

    Spark's estimate of a stored table is the size of its compressed files, times the share of the columns read: a table of
    10 MB by that count can be a hundred or more in the driver, which loads side by side broadcast several at once.
    """
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return settings(spark, {"spark.sql.autoBroadcastJoinThreshold": str(min(limit, LISTED_BYTES)),
                            "spark.sql.adaptive.autoBroadcastJoinThreshold": str(min(limit, MEASURED_BYTES))})


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)
