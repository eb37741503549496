"""Connected components of a table of links, by alternating star contractions.

Each round hangs every vertex on the smallest vertex next to it: first its larger
neighbours, then its smaller ones. Links are written after each round, so lineage
stays short and a lost executor costs one round. Long chains need a logarithmic
number of rounds. A vertex with very many links is the key of one side of a join,
which Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import materialize, remove


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every vertex of the links (a, b) that has one; the
    component is its smallest id."""
    a, b = F.col("a"), F.col("b")
    links = materialize(
        links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    before = _state(links)
    while before[0]:
        # Larger neighbours move to the smallest neighbour.
        both = links.select("a", "b").union(links.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), a).alias("least"))
        large = both.where(b > a).join(least, "a").select(b.alias("a"), F.col("least").alias("b"))
        # Smaller neighbours move to the smallest one, and so does the vertex itself.
        lowest = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(lowest, "a").select(b.alias("a"), F.col("least").alias("b")).union(
            lowest.select("a", F.col("least").alias("b")))
        after = materialize(small.where(a != b).distinct(), "links")
        remove(links)
        links, state = after, _state(after)
        if state == before:
            break
        before = state
    return links.select(a.alias("id"), b.alias("component")).union(
        links.select(b.alias("id"), b.alias("component")).distinct())
