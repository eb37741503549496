"""Written intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
# Files of shuffles go when their query ends, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Frames stored within each open ``temporaries``, the innermost last.
_TEMPORARY: list[list[DataFrame]] = []


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A setting of the session for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def temporaries():
    """Delete at the end what ``materialize`` stored within, but for frames that are kept. For
    steps whose result is written within as well, so that nobody reads them afterwards."""
    _TEMPORARY.append([])
    try:
        yield
    finally:
        for frame in _TEMPORARY.pop():
            remove(frame)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table.

    The folder comes from ``spark.checkpoint.dir``, which every executor of a
    cluster can reach. Where it is unset, the table goes below the warehouse,
    which a cluster has to share as well.
    """
    root = spark.conf.get(_CONF, None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/spendlens/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write the frame once and go on from the stored copy.

    Unlike a cache it survives lost executors, and unlike an RDD checkpoint the
    readers still prune columns and push filters. Keys are digests in hexadecimal, which
    only an entropy code packs, hence zstd. What is left of its shuffles is deleted, and the
    frame itself at the end of ``temporaries`` unless it is to ``keep``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with setting(spark, CLEANUP, "true"):
        df.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    if _TEMPORARY and not keep:
        _TEMPORARY[-1].append(stored)
    return stored


def remove(df: DataFrame) -> None:
    """Delete the files of a materialized frame that nobody reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
