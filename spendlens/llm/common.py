"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_AT_ONCE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text column with null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def by_slices(batches: Iterator[pa.RecordBatch], make: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Apply ``make`` to slices of a few hundred rows, so that what a task holds
    besides one input batch stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield make(batch.slice(start, ROWS_AT_ONCE))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept out of training: crc32 of the id as text leaves 1 modulo 3."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1


def number_of(spans: str, kind: int) -> Column:
    """How many spans of an array are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
