"""Small reference tables: building, checking and joining them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def dimension(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A typed frame from literal rows; an empty list gives an empty frame."""
    return spark.createDataFrame(rows, ddl)


def attach_dimension(
    df: DataFrame, dim: DataFrame, keys: list[str], condition: Column, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Left join to a reference table after checking it.

    A key that occurs twice is an error, since it would multiply transactions.
    The table is broadcast only if it has at most ``broadcast_rows`` rows;
    beyond that the join shuffles, where AQE splits hot keys.
    """
    found = dim.groupBy(*keys).count().agg(F.sum("count").alias("rows"), F.max("count").alias("most")).first()
    if (found["most"] or 0) > 1:
        raise ValueError(f"reference keys occur more than once: {', '.join(keys)}")
    if (found["rows"] or 0) <= broadcast_rows:
        dim = F.broadcast(dim)
    return df.join(dim, condition, "left")
