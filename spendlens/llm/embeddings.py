"""Near duplicates among embeddings: spherical k-means cells and blocked products.

1. Spherical k-means on a bounded sample (``SAMPLE`` vectors by hash of the id) gives
   the cells; every vector is indexed in the cell of its nearest centroid. There is
   about one cell for every ``CELL_ROWS`` vectors, at most ``MAX_CELLS``.
2. A vector is compared within its own cell and in every other cell that a link can
   reach: with c its own centroid and d another, a vector nearer to d than to c is at
   least asin((x.c - x.d) / |c - d|) away from x, so cells beyond the angle of the
   threshold hold no link. ``probes`` bounds the number of cells per vector instead;
   then recall is below 1 and has to be measured. The default is exact.
3. Cells are cut into blocks of at most ``BLOCK`` vectors on either side of the
   product, so no task holds more, however many vectors share a cell.
4. A block counts the links of its vectors and returns, of the links themselves, only
   a spanning forest: what a group of links amounts to is linear in its members.

Vectors with the same components are compared as one and counted as many. Vectors that
are null, empty or zero, that hold null or non-finite components, or whose label is
null link with nothing, as do vectors of different lengths. Repeated rows get a row
each and count as other vectors only if their id differs; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import materialize
from .common import table
from .graph import components

LEAST = 0.93
SAMPLE = 20_000
CELL_ROWS = 8192
MAX_CELLS = 1024
ITERATIONS = 8
BLOCK = 2048


def fit_cells(unit: np.ndarray, cells: int, iterations: int = ITERATIONS) -> np.ndarray:
    """Unit centroids of spherical k-means; starts from evenly spaced vectors."""
    centroids = unit[np.linspace(0, len(unit) - 1, cells).astype(int)].copy()
    for _ in range(iterations):
        nearest = np.argmax(unit @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, unit)
        lengths = np.linalg.norm(sums, axis=1)
        filled = lengths > 1e-12
        centroids[filled] = sums[filled] / lengths[filled, None]
    return np.unique(centroids, axis=0)


def _unit(batch: pa.RecordBatch) -> np.ndarray:
    vectors = np.array(batch.column("embedding").to_pylist(), np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _assign(centroids: dict[int, np.ndarray], least: float, probes: int | None):
    """The own cell of each vector, and the cells that it has to be compared in."""
    reach = math.sqrt(1 - least * least) + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, visits = [], []
            sizes = np.array(batch.column("size").to_pylist())
            homes = np.zeros(batch.num_rows, np.int64)
            visited: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for size in np.unique(sizes):
                rows, c = np.flatnonzero(sizes == size), centroids.get(int(size))
                if c is None:  # no vector of this length was sampled: one cell
                    for r in rows:
                        visited[r] = [0]
                    continue
                near = _unit(batch.take(pa.array(rows))) @ c.T
                home = np.argmax(near, axis=1)
                apart = np.linalg.norm(c[:, None, :] - c[None, :, :], axis=2)[home]
                margin = (near[np.arange(len(rows)), home][:, None] - near) / np.maximum(apart, 1e-12)
                margin[np.arange(len(rows)), home] = -1.0
                for r, h, m in zip(rows, home, margin):
                    cells = np.flatnonzero(m <= reach)
                    if probes is not None:
                        cells = cells[np.argsort(m[cells], kind="stable")[:probes]]
                    homes[r] = h
                    visited[r] = cells.tolist()
            own, visits = pa.array(homes, pa.int32()), pa.array(visited, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, own, visits], [*batch.schema.names, "cell", "visits"])
    return run


def _products(least: float):
    """Links between the members (side 0) and the visitors (side 1) of each block."""
    def forest(pairs: np.ndarray) -> list[tuple[int, int]]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = []
        for a, b in pairs.tolist():
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((a, b))
        return out

    def links(rows: list[tuple]) -> tuple[list, list]:
        ids = np.array([r[0] for r in rows])
        side = np.array([r[1] for r in rows])
        times = np.array([r[2] for r in rows])
        vectors = np.array([r[3] for r in rows], np.float64)
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        members, visitors = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        counts, edges = [], []
        for start in range(0, len(visitors), 256):
            some = visitors[start:start + 256]
            near = vectors[some] @ vectors[members].T >= least
            near &= ids[some][:, None] != ids[members][None, :]
            found = near @ times[members]
            counts += [(int(i), int(n)) for i, n in zip(ids[some], found) if n]
            x, y = np.nonzero(near)
            edges += forest(np.stack([ids[some[x]], ids[members[y]]], axis=1)) if len(x) else []
        return counts, forest(np.array(edges)) if edges else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def out(counts, edges):
            a = [c[0] for c in counts] + [e[0] for e in edges]
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array([None] * len(counts) + [e[1] for e in edges], pa.int64()),
                 pa.array([c[1] for c in counts] + [0] * len(edges), pa.int64())], ["a", "b", "links"])

        names = ("label", "size", "cell", "block", "visit", "id", "side", "times", "embedding")
        for batch in batches:
            for *key, i, s, t, v in zip(*[batch.column(c).to_pylist() for c in names]):
                if key != now:
                    if rows:
                        yield out(*links(rows))
                    now, rows = key, []
                rows.append((i, s, t, v))
        if rows:
            yield out(*links(rows))
    return run


def near_vectors(vectors: DataFrame, least: float = LEAST, probes: int | None = None, sample: int = SAMPLE,
                 cell_rows: int = CELL_ROWS, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row (columns vec_id, embedding, label)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    length = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    usable = rows.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & whole).where(length > 0)
    # Equal vectors as one, under their smallest id.
    distinct = materialize(
        usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.countDistinct("vec_id").alias("times"))
        .withColumn("size", F.size("embedding")), "vectors")
    total = distinct.count()
    cells = max(1, min(MAX_CELLS, total // cell_rows))
    by_size: dict[int, list] = {}
    for row in distinct.orderBy(F.xxhash64("id"), "id").limit(sample).select("embedding").collect():
        by_size.setdefault(len(row.embedding), []).append(row.embedding)
    centroids = {}
    for size, found in by_size.items():
        unit = np.array(found, np.float64)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        centroids[size] = fit_cells(unit, min(cells, len(unit)))
    placed = materialize(distinct.mapInArrow(
        _assign(centroids, least, probes),
        "label string, embedding array<double>, id long, times long, size int, cell int, visits array<int>"), "cells")

    where = ["label", "size", "cell"]
    homes = placed.select(*where, "id", "times", "embedding")
    visits = placed.select("label", "size", F.explode("visits").alias("cell"), "id", "times", "embedding")
    sizes = homes.groupBy(*where).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).join(
        visits.groupBy(*where).agg(F.ceil(F.count("*") / block).cast("int").alias("turns")), where)
    sizes = materialize(sizes, "sizes")
    out = ["label", "size", "cell", "block", "visit", "id", "side", "times", "embedding"]
    members = homes.join(sizes, where).select(
        *where, F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("visit"), "id", F.lit(0).alias("side"), "times", "embedding")
    visitors = visits.join(sizes, where).select(
        *where, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("id"), F.col("turns")).cast("int").alias("visit"), "id", F.lit(1).alias("side"), "times", "embedding")
    key = out[:5]
    found = materialize(
        members.select(*out).union(visitors.select(*out)).repartition(*key).sortWithinPartitions(*key)
        .mapInArrow(_products(least), "a long, b long, links long"), "links")
    joined = materialize(components(found.where(F.col("b").isNotNull()).select("a", "b")), "components")
    counts = found.where(F.col("b").isNull()).groupBy("a").agg(F.sum("links").alias("links"))
    known = distinct.select("label", "embedding", "id", "times").join(counts, F.col("id") == F.col("a"), "left").drop("a")
    known = known.join(joined.withColumnRenamed("id", "v"), F.col("id") == F.col("v"), "left").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("links"),
        F.coalesce("component", "id").alias("component"))
    known = materialize(known, "known")
    every = rows.join(known, ["label", "embedding"], "left")
    component = F.coalesce("component", "vec_id")
    return every.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT x AS id, x AS c FROM p UNION SELECT r.id, p.y FROM r JOIN p ON r.c = p.x),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id),
n AS (SELECT x AS id, count(*) AS n FROM p GROUP BY x)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(least(m.c, vec_id), vec_id) AS component_id,
  vec_id = coalesce(least(m.c, vec_id), vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.id = vec_id LEFT JOIN m ON m.id = vec_id"""
