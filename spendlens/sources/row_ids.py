"""A row id that is unique, and the same on every run and layout.

Equal rows share ``txn_key``, so a number among them makes the id. Nothing tells equal
rows apart, so they are not numbered where they are but counted and made again: a row
that occurs n times comes back with the numbers 0 to n-1. Counts are partial sums in each
task, so a row with very many copies is one row in the shuffle, and its copies are made
in pieces that are dealt over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

COPIES_A_PIECE = 4096


def add_row_ids(df: DataFrame, key: str = "txn_key", piece: int = COPIES_A_PIECE) -> DataFrame:
    """Add ``txn_copy`` (0 for the first row of a key) and ``txn_row_id``, its text with the key.

    Rows whose key is unique are left where they are. Rows of one key that differ in other
    columns are numbered in the order of these. Pieces are dealt over a fixed number of
    tasks: they are a few bytes each, so a number chosen by size would be one task.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = df.columns
    shared = df.groupBy(key).agg(F.count("*").alias("_rows")).where(F.col("_rows") > 1).select(key)
    single = df.join(shared, key, "left_anti").select(*names, F.lit(0).cast("long").alias("txn_copy"))
    counted = df.join(shared, key, "left_semi").groupBy(*names).agg(F.count("*").alias("_copies"))
    before = Window.partitionBy(key).orderBy(F.struct(*names)).rowsBetween(Window.unboundedPreceding, -1)
    pieces = counted.withColumn("_first", F.coalesce(F.sum("_copies").over(before), F.lit(0))).withColumn(
        "_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / piece))))
    last = F.least(F.col("_copies"), (F.col("_piece") + 1) * piece) - 1
    copies = pieces.repartition(tasks, key, "_first", "_piece").withColumn(
        "_copy", F.explode(F.sequence(F.col("_piece") * piece, last)))
    repeated = copies.select(*names, (F.col("_first") + F.col("_copy")).alias("txn_copy"))
    return single.unionAll(repeated).withColumn("txn_row_id", F.concat_ws("-", key, "txn_copy"))
