"""Near duplicates by fast similarity sketching, banding and exact verification.

1. Each text becomes its set of word shingles (64-bit hashes). Texts with equal sets
   form a class and go on as one vertex, so groups of copies cost nothing further.
2. The sketch has ``SIZE`` coordinates. In the first ``SIZE`` rounds every element is
   thrown into a random coordinate, in the rounds after that into the coordinate of
   the round, so all of them fill; a coordinate keeps the smallest (round, hash). The
   rounds end as soon as every coordinate is filled, after about
   ``SIZE * ln(SIZE) / n`` rounds, so the work is O(n + SIZE log SIZE). Coordinates
   agree with the similarity as probability, and their mean is as concentrated as
   for independent ones.
3. ``BANDS`` bands of ``ROWS`` coordinates give buckets. A pair at 0.8 misses all 32
   bands of 4 with a probability of 5e-8.
4. Each class is compared with the smallest class of each of its buckets, on full
   sets computed from the texts. Verified links give components.
5. Buckets that still hold more than one component are gone through once more, in
   blocks of bounded size. Members whose sketch agrees with one of another component in
   ``NEAR`` of the coordinates (0.8 less 5.7 standard deviations) get their texts, and
   these pairs are verified on full sets within their block, each in the first band whose
   key it shares and only while its ends are not joined. Blocks return the links that join
   components, so no bucket is capped and no group emits its pairs.

Null and empty texts have no shingles and link with nothing. Texts with fewer words
than a shingle have their whole word sequence as one. Repeated rows get a row each,
rows with one id count as one document, and an empty table gives no rows. Other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import materialize
from .common import by_slices, table, text_of
from .graph import components

WORDS = 4
LEAST = 80
SIZE = 128
ROWS = 4
BANDS = SIZE // ROWS
NEAR = 0.60
BLOCK = 1024
MAX_WORDS = 200_000
_LOW = np.uint64((1 << 48) - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers without visible structure."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_word_hash = _WordHash()


def shingles(text: str, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    # bytes.split() cuts at ASCII white space only, bytes.lower() changes A-Z only.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_word_hash.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total = mix(total * _STEP + hashes[i:len(hashes) - n + 1 + i])
    return np.unique(total)


def sketch(elements: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The fast similarity sketch of a non-empty set; ``size`` is a power of two."""
    shift = np.uint64(64 - size.bit_length() + 1)
    filled = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    at_once = max(1, math.ceil(size * (math.log(size) + 4) / len(elements)))
    first = 0
    while first < size:
        rounds = np.arange(first, min(first + at_once, size), dtype=np.uint64)
        hashes = mix(elements[:, None] + (rounds + np.uint64(1)) * _STEP)
        np.minimum.at(filled, (hashes >> shift).ravel().astype(np.int64), ((hashes & _LOW) | (rounds << np.uint64(48))).ravel())
        if filled.max() != np.iinfo(np.uint64).max:
            return filled
        first += at_once
    for i in np.flatnonzero(filled == np.iinfo(np.uint64).max):
        hashes = mix(elements + np.array(size + i + 1, np.uint64).reshape(1) * _STEP)
        filled[i] = (hashes & _LOW).min() | np.uint64(size + i) << np.uint64(48)
    return filled


def bands(filled: np.ndarray) -> np.ndarray:
    """One key per band; keys of different bands differ."""
    key = np.arange(len(filled) // ROWS, dtype=np.uint64)
    for column in filled.reshape(-1, ROWS).T:
        key = mix(key * _STEP + column)
    return key.view(np.int64)


_SIGNATURE = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, short binary"


def _signatures(size: int):
    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, keys, keys2, all_bands, shorts = [], [], [], [], []
        for text in batch.column("text").to_pylist():
            elements = shingles(text, size)
            digest = hashlib.blake2b(elements.tobytes(), digest_size=16).digest()
            counts.append(len(elements))
            keys.append(int.from_bytes(digest[:8], "big", signed=True))
            keys2.append(int.from_bytes(digest[8:], "big", signed=True))
            filled = sketch(elements) if len(elements) else None
            all_bands.append([] if filled is None else bands(filled))
            shorts.append(b"" if filled is None else mix(filled).astype(np.uint8).tobytes())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(keys, pa.int64()), pa.array(keys2, pa.int64()),
             pa.array(all_bands, pa.list_(pa.int64())), pa.array(shorts, pa.binary())],
            ["doc_id", "n_shingles", "k1", "k2", "bands", "short"])
    return lambda batches: by_slices(batches, make)


def _verify(size: int, least: int):
    """Pairs (a, b, text_a, text_b) that hold on full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, np.ndarray] = (None, np.zeros(0, np.uint64))

        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal last
            keep = []
            for a, x, y in zip(*[batch.column(c).to_pylist() for c in ("a", "text_a", "text_b")]):
                if last[0] != a:
                    last = (a, shingles(x, size))
                one, two = last[1], shingles(y, size)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= least * (len(one) + len(two) - both))
            mask = pa.array(keep, pa.bool_())
            return pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], ["a", "b"])

        return by_slices(batches, make)
    return run


_MEMBER = ["key", "band", "i", "j", "rep", "component", "n_shingles", "short", "side", "earlier"]
_MEMBERS = ("key long, band int, i int, j int, rep long, component long, n_shingles long, short binary, side int, "
            "earlier array<long>")


class _Block:
    """Members of a bucket, or of a pair of its parts, and which of them are near."""

    def __init__(self, rows: list[tuple], least: int):
        self.rows, self.least = rows, least
        self.component = np.array([r[5] for r in rows])
        self.count = np.array([r[6] for r in rows])
        self.shorts = np.frombuffer(b"".join(r[7] for r in rows), np.uint8).reshape(len(rows), SIZE)
        self.side = np.array([r[8] for r in rows])
        self.earlier = np.stack([r[9] for r in rows])
        names, sizes = np.unique(self.component, return_counts=True)
        self.largest = names[np.argmax(sizes)]

    def outside(self) -> np.ndarray:
        return np.flatnonzero(self.component != self.largest)

    def near(self, i: int) -> np.ndarray:
        """Members of other components that may be similar, each pair at one of its ends
        and in the first band that it shares."""
        other = (self.component != self.component[i]) & ((self.side != self.side[i]) | (self.side == 2))
        other &= 100 * np.minimum(self.count, self.count[i]) >= self.least * np.maximum(self.count, self.count[i])
        other &= (self.component == self.largest) | (np.arange(len(self.rows)) > i)
        at = np.flatnonzero(other)
        at = at[(self.shorts[at] == self.shorts[i]).mean(axis=1) >= NEAR]
        # Whole keys: the short values agree by chance, and a pair that never met would be skipped.
        return at[~(self.earlier[at] == self.earlier[i]).any(axis=1)]


def _values(column: pa.Array) -> list:
    """The values of a column; lists of numbers as arrays."""
    if not pa.types.is_list(column.type):
        return column.to_pylist()
    values, at = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(at[:-1] - at[0], at[1:] - at[0])]


def _by_block(columns: list[str], schema: pa.Schema, make):
    """Run ``make`` on the rows of each block; rows come sorted by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def out(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], field.type) for i, field in enumerate(schema)], schema=schema)

        for batch in batches:
            found: list[tuple] = []
            for row in zip(*[_values(batch.column(c)) for c in columns]):
                if row[:4] != now:
                    found += make(rows) if len(rows) > 1 else []
                    now, rows = row[:4], []
                rows.append(row)
            yield out(found)
        if len(rows) > 1:
            yield out(make(rows))
    return run


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _near_members(least: int):
    """The members of a block that are near to any of another component."""
    schema = pa.schema([("key", pa.int64()), ("band", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("rep", pa.int64()),
                        ("component", pa.int64()), ("n_shingles", pa.int64()), ("short", pa.binary()), ("side", pa.int32()),
                        ("earlier", pa.list_(pa.int64()))])

    def make(rows: list[tuple]) -> list[tuple]:
        block, chosen = _Block(rows, least), set()
        for i in block.outside():
            at = block.near(i)
            if len(at):
                chosen.update([i], at.tolist())
        return [rows[i] for i in sorted(chosen)]
    return _by_block(_MEMBER, schema, make)


def _verify_members(words: int, least: int):
    """Links of different components in a block, on full sets; one per pair of them."""
    def make(rows: list[tuple]) -> list[tuple]:
        block, out = _Block(rows, least), []
        sets: dict[int, np.ndarray] = {}
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        def elements(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = shingles(rows[k][10], words)
            return sets[k]

        for i in block.outside():
            for k in block.near(i).tolist():
                x, y = root(rows[i][5]), root(rows[k][5])
                if x == y:
                    continue
                one, two = elements(i), elements(k)
                both = len(np.intersect1d(one, two, assume_unique=True))
                if 100 * both >= least * (len(one) + len(two) - both):
                    parent[max(x, y)] = min(x, y)
                    out.append((min(rows[i][4], rows[k][4]), max(rows[i][4], rows[k][4])))
        return out
    return _by_block([*_MEMBER, "text"], _PAIR, make)


def _blocks(reps: DataFrame, members: DataFrame, joined: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, in blocks."""
    labelled = reps.select("rep", "n_shingles", "short", "bands").join(joined, F.col("rep") == F.col("id"), "left").select(
        "rep", "n_shingles", "short", "bands", F.coalesce("component", "rep").alias("component"))
    # Buckets of two have had their only pair checked.
    placed = materialize(
        members.where(F.col("members") > 2).select("key", "band", "rep", "members").join(
            labelled.select("rep", "component"), "rep"), "placed")
    mixed = materialize(
        placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where(F.col("low") != F.col("high")).select("key"), "mixed")
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), parts).cast("int")
    spread = (
        placed.join(mixed, "key").withColumns({"parts": parts, "own": own})
        .join(labelled.select("rep", "n_shingles", "short", "bands"), "rep")
        .withColumn("earlier", F.slice("bands", 1, F.col("band"))).drop("bands")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumns({
            "i": F.least("own", "other"), "j": F.greatest("own", "other"),
            "side": F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)}))
    return _in_order(spread.select(*_MEMBER))


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def near_duplicates(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row (columns doc_id, text).
    ``least`` is the similarity in percent."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    signed = materialize(texts.mapInArrow(_signatures(words), _SIGNATURE), "signatures")
    reps = materialize(
        signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()).groupBy("k1", "k2")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
             F.first("bands").alias("bands"), F.first("short").alias("short")), "classes")
    keys = reps.select("rep", "n_shingles", F.posexplode("bands").alias("band", "key"))
    buckets = materialize(
        keys.groupBy("key").agg(F.min(F.struct("rep", "n_shingles")).alias("first"), F.count("*").alias("members"))
        .where(F.col("members") > 1), "buckets")
    members = materialize(keys.join(buckets, "key"), "members")
    # Only texts that share a bucket are needed from here on.
    needed = members.select(F.col("rep").alias("doc_id")).distinct()
    compared = materialize(texts.join(needed, "doc_id", "left_semi"), "texts")

    def fit(x, y):
        return 100 * F.least(x, y) >= least * F.greatest(x, y)

    def verified(pairs: DataFrame) -> DataFrame:
        side_b = pairs.join(compared.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        both = side_b.join(compared.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        return materialize(
            both.select("a", "b", "text_a", "text_b").mapInArrow(_verify(words, least), "a long, b long"), "verified")

    stars = materialize(
        members.where((F.col("rep") != F.col("first.rep")) & fit(F.col("n_shingles"), F.col("first.n_shingles")))
        .select(F.col("first.rep").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    links = verified(stars)
    joined = materialize(components(links), "components")
    near = materialize(_blocks(reps, members, joined).mapInArrow(_near_members(least), _MEMBERS), "near")
    with_text = near.join(compared, F.col("rep") == F.col("doc_id")).select(*_MEMBER, "text")
    more = materialize(_in_order(with_text).mapInArrow(_verify_members(words, least), "a long, b long"), "verified")
    if more.limit(1).count():
        joined = materialize(components(links.union(more)), "components")

    classes = reps.select("k1", "k2", "rep").join(joined, F.col("rep") == F.col("id"), "left").select(
        "k1", "k2", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "k1", "k2").join(materialize(classes, "classes"), ["k1", "k2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near duplicates among all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
                    GROUP BY ALL) JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * k >= 80 * (a.n + b.n - k)),
r AS (SELECT x AS id, x AS c FROM p UNION SELECT r.id, p.y FROM r JOIN p ON r.c = p.x),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.c, d.doc_id) AS component_id,
  d.doc_id = coalesce(m.c, d.doc_id) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.id = d.doc_id"""
