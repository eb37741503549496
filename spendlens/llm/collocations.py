"""Phrase collocations by multikey quicksort of suffix pointers.

A phrase is two to four words in a row within a piece of text, frequent if it occurs at
least ``least`` times in its language. Frequent phrases are found in three scans:

1. *Words.* Tasks tokenise blocks of text with array operations and count words, which
   Spark sums up.
2. *Leading pairs.* Tasks count pairs of neighbours in hashed buckets of a fixed number.
   Bucket ranges are dealt over tasks, summed in flat arrays, and come back as one bit a
   bucket (2**27 bits, whatever the input): a pair whose bucket is not frequent cannot
   be frequent itself. Buckets with more than a 2**16th of all pairs are listed too.
3. *Suffixes.* A suffix starts at a word and runs up to four words, as far as its pairs
   may be frequent; equal ones of a block become one with a weight. Suffixes are routed by
   language and leading pair, so that all occurrences of a phrase meet in one task, and
   sorted there by a three-way quicksort with words for characters: the pointers less
   than, equal to, or greater than the pivot at the present depth make three parts. The
   weight of an equal part is the count of the phrase so far, and its pointers go on one
   word deeper. Parts that weigh less than ``least`` are abandoned. All parts of a
   level are split at once, by array operations.

A leading pair that is listed as hot may hold a large share of all suffixes. Its suffixes
are routed by all their words; four words still meet in one task, and the weights of
shorter phrases are then summed over tasks. Nothing is dropped either way: buckets only
spare work, and counts are exact (words of a block are told apart by two 64-bit hashes, in
tasks that sort by their text).

Candidates are scored at their weakest cut and dropped inside longer ones by joins.

Null texts are empty and null languages are ``und``. Repeated rows count again. Pieces
end with the text, so a very long text is one row of one block and no phrase spans two
rows. An empty table has no phrases; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.store import materialize
from .common import table, text_of

LEAST = 30
DEPTH = 4
INSIDE = 80
TOP = 2000
NO_LANG = "und"

BUCKET_BITS = 27
RANGE_BITS = 19
HOT_SHARE = 1 << 16
BLOCK_BYTES = 4 << 20
WORDS_A_SHARD = 1 << 22

BLANKS = b" \t"
BREAKS = b".,;:!?\n\x0b\x0c\r"


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    kind, lower = np.zeros(256, np.uint8), np.arange(256, dtype=np.uint8)
    kind[list(BLANKS)], kind[list(BREAKS)] = 1, 2
    lower[65:91] += 32
    return kind, lower


KIND, LOWER = _kinds()


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# ---------------------------------------------------------------- blocks of words

class Block(NamedTuple):
    """Words of some texts: places in the lower-cased bytes, whether the next word follows
    within the piece, two hashes, and the language by number."""

    data: bytes
    start: np.ndarray
    end: np.ndarray
    linked: np.ndarray
    high: np.ndarray
    low: np.ndarray
    lang: np.ndarray
    langs: list[str]

    def texts(self, at: np.ndarray) -> list[str]:
        return [self.data[s:e].decode() for s, e in zip(self.start[at].tolist(), self.end[at].tolist())]


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each word, eight bytes at a time over all words that are long enough."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
    length = end - start
    order = np.argsort(-length, kind="stable")
    place, left = start[order], length[order]
    high = _mix(left.astype(np.uint64) + np.uint64(1))
    low = _mix(left.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    while len(left) and left[0] > 0:
        m = int(np.searchsorted(-left, 0, side="left"))
        place, left = place[:m], left[:m]
        chunk = eight[place] & masks[np.minimum(left, 8)]
        high[:m] = _mix(high[:m] * np.uint64(0xC2B2AE3D27D4EB4F) + chunk)
        low[:m] = _mix((low[:m] ^ chunk) * np.uint64(0x165667B19E3779F9))
        place, left = place + 8, left - 8
    out_high, out_low = np.empty_like(high), np.empty_like(low)
    out_high[order], out_low[order] = high, low
    return out_high, out_low


def block_of(data: np.ndarray, offsets: np.ndarray, lang: np.ndarray, langs: list[str]) -> Block:
    """The words of texts that lie behind one another; a text is a piece of its own."""
    data = LOWER[data]
    kind = KIND[data]
    word = kind == 0
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    before[edges] = False
    after[edges[1:] - 1] = False
    start, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    piece = np.cumsum(kind == 2, dtype=np.int32)[start] + row
    linked = np.zeros(len(start), bool)
    linked[:-1] = piece[1:] == piece[:-1]
    return Block(data.tobytes(), start, end, linked, *_hashes(data, start, end), lang[row], langs)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Blocks of some megabytes; a longer text is a block by itself."""
    held, size = [], 0

    def whole():
        langs: dict[str, int] = {}
        codes = [np.array([langs.setdefault(x, len(langs)) for x in names], np.int64) for _, _, names in held]
        ends = np.concatenate([np.diff(offsets) for _, offsets, _ in held]).cumsum()
        return block_of(np.concatenate([d for d, _, _ in held]), np.append(0, ends), np.concatenate(codes), list(langs))

    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column("text").cast(pa.large_string())
        _, places, content = text.buffers()
        offsets = np.frombuffer(places, np.int64)[text.offset:text.offset + len(text) + 1]
        content = np.frombuffer(content, np.uint8) if content is not None else np.empty(0, np.uint8)
        names = batch.column("lang").to_pylist()
        first = 0
        while first < len(names):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES - size, side="right")) - 1)
            last = min(last, len(names))
            held.append((content[offsets[first]:offsets[last]].copy(), offsets[first:last + 1].copy(), names[first:last]))
            size += int(offsets[last] - offsets[first])
            first = last
            if size >= BLOCK_BYTES or first < len(names):
                yield whole()
                held, size = [], 0
    if held:
        yield whole()


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal rows together, and where their groups start. The first key
    is most selective."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order, np.flatnonzero(new)


def _sizes(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


# ---------------------------------------------------------------- words and pairs

def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        order, starts = _groups(block.high, block.low, block.lang)
        at = order[starts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([block.langs[i] for i in block.lang[at].tolist()], pa.string()), pa.array(block.texts(at), pa.string()),
             pa.array(_sizes(starts, len(order)), pa.int64())], ["lang", "word", "n"])


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest()) for x in langs], np.uint64)


def pair_buckets(block: Block, bits: int) -> np.ndarray:
    """Buckets of the pairs (word, next word) in the block, for every word but the last."""
    lang = _lang_hashes(block.langs)[block.lang[:-1]] if len(block.lang) else np.empty(0, np.uint64)
    key = _mix(block.high[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ _mix(block.high[1:] + lang))
    return (key >> np.uint64(64 - bits)).astype(np.int64)


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest bytes first, which compresses well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _pair_counts(bits: int, range_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            bucket, n = np.unique(pair_buckets(block, bits)[block.linked[:-1]], return_counts=True)
            part = bucket >> range_bits
            starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.empty(0, np.int64)
            cuts = list(zip(starts, np.append(starts[1:], len(part))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[starts], pa.int64()),
                 pa.array([_planes(np.diff(bucket[a:b], prepend=part[a] << range_bits)) for a, b in cuts], pa.binary()),
                 pa.array([_planes(n[a:b]) for a, b in cuts], pa.binary())], ["part", "steps", "counts"])
    return run


def _frequent_buckets(range_bits: int, least: int, hot: int):
    """Sorted rows of counts to one row of bits for each range, and its hot buckets."""
    def row(part, sums):
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([np.packbits(sums >= least).tobytes()]),
             pa.array([((part << range_bits) + np.flatnonzero(sums > hot)).tolist()], pa.list_(pa.int64()))],
            ["part", "bits", "hot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, None
        for batch in batches:
            for part, steps, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "steps", "counts"))):
                if part != now:
                    if now is not None:
                        yield row(now, sums)
                    now, sums = part, np.zeros(1 << range_bits, np.int64)
                sums[np.cumsum(_from_planes(steps), dtype=np.int64)] += _from_planes(counts)
        if now is not None:
            yield row(now, sums)
    return run


class Filter(NamedTuple):
    """One bit for each bucket of pairs, and the sorted hot buckets."""

    bits: int
    frequent: np.ndarray
    hot: np.ndarray

    def passes(self, bucket: np.ndarray) -> np.ndarray:
        return (self.frequent[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8)) & 1 == 1

    def is_hot(self, bucket: np.ndarray) -> np.ndarray:
        return np.isin(bucket, self.hot)


def pair_filter(docs: DataFrame, pairs: int, least: int, bits: int, hot_share: int) -> Filter:
    """The filter of leading pairs; its size depends on ``bits`` and ``hot_share`` only."""
    range_bits = min(RANGE_BITS, bits - 3)
    # At least a range for every 2**22 words, as long as a range keeps 2**12 buckets.
    while range_bits > 12 and (pairs >> (bits - range_bits)) > WORDS_A_SHARD:
        range_bits -= 1
    counts = docs.mapInArrow(_pair_counts(bits, range_bits), "part long, steps binary, counts binary")
    ranges = counts.repartition("part").sortWithinPartitions("part").mapInArrow(
        _frequent_buckets(range_bits, least, max(pairs // hot_share, least)), "part long, bits binary, hot array<long>")
    frequent = np.zeros(1 << (bits - 3), np.uint8)
    hot: list[int] = []
    for row in ranges.toLocalIterator():  # 2**bits bits and at most hot_share numbers in all
        place = row["part"] << (range_bits - 3)
        frequent[place:place + (1 << (range_bits - 3))] = np.frombuffer(row["bits"], np.uint8)
        hot += row["hot"]
    return Filter(bits, frequent, np.sort(np.array(hot, np.int64)))


# ---------------------------------------------------------------- suffixes

def _suffixes(pairs: Filter, shards: int):
    """Blocks to rows (shard, lang, hot, words, matrix, weights): distinct suffixes with their
    weights as a matrix of word numbers, -1 behind the last word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            n = len(block.start)
            if n < 2:
                continue
            bucket = pair_buckets(block, pairs.bits)
            goes = np.zeros(n + DEPTH, bool)
            goes[:n - 1] = block.linked[:-1] & pairs.passes(bucket)
            heads = np.flatnonzero(goes[:n - 1])
            if not len(heads):
                continue
            used = np.flatnonzero(goes[:n] | np.append(False, goes[:n - 1]))
            order, starts = _groups(block.high[used], block.low[used])
            number = np.full(n, -1, np.int32)
            number[used[order]] = np.repeat(np.arange(len(starts)), _sizes(starts, len(order)))
            spelled = block.texts(used[order[starts]])
            matrix = np.full((len(heads), DEPTH), -1, np.int32)
            alive, route = np.ones(len(heads), bool), np.zeros(len(heads), np.uint64)
            for k in range(DEPTH):
                matrix[alive, k] = number[heads[alive] + k]
                route[alive] = _mix(route[alive] + block.high[heads[alive] + k])
                alive = alive & goes[heads + k]
            hot = pairs.is_hot(bucket[heads])
            shard = np.where(hot, (route % np.uint64(shards)).astype(np.int64), (bucket[heads] * shards) >> pairs.bits)
            lang = block.lang[heads]
            order, starts = _groups(shard, lang, hot, *matrix.T)
            weight, order = _sizes(starts, len(order)), order[starts]
            matrix, shard, lang, hot = matrix[order], shard[order], lang[order], hot[order]
            cuts = np.flatnonzero(np.append(True, (shard[1:] != shard[:-1]) | (lang[1:] != lang[:-1]) | (hot[1:] != hot[:-1])))
            rows = []
            for a, b in zip(cuts, np.append(cuts[1:], len(order))):
                ids, own = np.unique(matrix[a:b], return_inverse=True)
                own = own.reshape(-1, DEPTH) - (ids[0] < 0)
                rows.append((shard[a], block.langs[lang[a]], bool(hot[a]), " ".join(spelled[i] for i in ids[ids >= 0].tolist()),
                             own.astype("<i4").tobytes(), weight[a:b].astype("<i8").tobytes()))
            for at in range(0, len(rows), 64):
                columns = list(zip(*rows[at:at + 64]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1]), pa.array(columns[2]), pa.array(columns[3]),
                     pa.array(columns[4], pa.binary()), pa.array(columns[5], pa.binary())],
                    ["shard", "lang", "hot", "words", "matrix", "weights"])
    return run


def quicksort(matrix: np.ndarray, weights: np.ndarray, least: list[int]) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Three-way quicksort of rows by their columns from the first on; -1 ends a row. Yields
    (a row of each, length, weight) of prefixes that weigh ``least[length - 1]`` or more."""
    pointer = np.arange(len(matrix))
    low, high, depth = np.array([0]), np.array([len(matrix)]), np.array([0])
    least_at = np.array(least)
    # Abandoning a part needs a bound that holds for all longer prefixes too.
    abandon = np.minimum.accumulate(least_at[::-1])[::-1]
    while len(low) and len(matrix):
        size = high - low
        part = np.repeat(np.arange(len(low)), size)
        first = np.cumsum(size) - size
        place = np.arange(size.sum()) - first[part] + low[part]
        row = pointer[place]
        key = matrix[row, depth[part]]
        three = np.sort(np.stack([key[first], key[first + size // 2], key[first + size - 1]]), axis=0)
        pivot = three[1]
        side = 1 + (key > pivot[part]).astype(np.int64) - (key < pivot[part])
        slot = part * 3 + side
        count = np.bincount(slot, minlength=3 * len(low))
        weight = np.zeros(3 * len(low), np.int64)
        np.add.at(weight, slot, weights[row])
        begin = (low[:, None] + np.cumsum(count.reshape(-1, 3), axis=1)).ravel() - count
        rank = np.empty(len(slot), np.int64)
        for k in range(3):
            mine = side == k
            seen = np.cumsum(mine)
            rank[mine] = seen[mine] - (seen - mine)[first][part[mine]] - 1
        pointer[begin[slot] + rank] = row
        equal = np.tile([False, True, False], len(low))
        depths = np.repeat(depth, 3)
        ended = equal & (np.repeat(pivot, 3) < 0)
        told = equal & ~ended & (weight >= least_at[depths])
        for length in np.unique(depths[told]) + 1:
            these = told & (depths == length - 1)
            yield pointer[begin[these]], int(length), weight[these]
        deeper = np.minimum(depths + equal, len(least) - 1)
        stays = (count > 0) & ~ended & ~(equal & (depths == len(least) - 1)) & (weight >= abandon[deeper])
        low, high, depth = begin[stays], (begin + count)[stays], deeper[stays]


def _phrases(least: int):
    """Rows of suffixes in order of (shard, lang, hot) to phrases with their weights."""
    def counted(lang, hot, words, matrices, weights):
        # Under hot pairs only whole suffixes are all in one task.
        bounds = [1, 1 if hot else least, 1 if hot else least, least]
        matrix, names = np.concatenate(matrices), list(words)
        for row, length, weight in quicksort(matrix, np.concatenate(weights), bounds):
            if length < 2:
                continue
            for a in range(0, len(row), 1 << 14):
                some = matrix[row[a:a + (1 << 14)], :length].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some)), pa.array([" ".join([names[i] for i in r]) for r in some]),
                     pa.array(weight[a:a + (1 << 14)], pa.int64())], ["lang", "phrase", "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, words, matrices, weights = None, {}, [], []
        for batch in batches:
            for shard, lang, hot, said, matrix, weight in zip(*(batch.column(c).to_pylist() for c in (
                    "shard", "lang", "hot", "words", "matrix", "weights"))):
                if (shard, lang, hot) != now:
                    if now is not None:
                        yield from counted(*now[1:], words, matrices, weights)
                    now, words, matrices, weights = (shard, lang, hot), {}, [], []
                number = np.array([words.setdefault(w, len(words)) for w in said.split(" ")] + [-1], np.int32)
                matrices.append(number[np.frombuffer(matrix, "<i4").reshape(-1, DEPTH)])
                weights.append(np.frombuffer(weight, "<i8"))
        if now is not None:
            yield from counted(*now[1:], words, matrices, weights)
    return run


# ---------------------------------------------------------------- counts and scores

def frequent_phrases(docs: DataFrame, least: int = LEAST, bits: int = BUCKET_BITS, hot_share: int = HOT_SHARE,
                     words_a_shard: int = WORDS_A_SHARD) -> tuple[DataFrame, DataFrame]:
    """Words (lang, word, n), and phrases (lang, phrase, a) that occur ``least`` times, of
    documents (lang, text) without nulls."""
    words = materialize(docs.mapInArrow(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n")), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    pairs = pair_filter(docs, total, least, bits, hot_share)
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // words_a_shard))
    rows = docs.mapInArrow(_suffixes(pairs, shards),
                           "shard long, lang string, hot boolean, words string, matrix binary, weights binary")
    keys = ["shard", "lang", "hot"]
    counts = rows.repartition(shards, *keys).sortWithinPartitions(*keys).mapInArrow(
        _phrases(least), "lang string, phrase string, a long")
    phrases = counts.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return words, materialize(phrases, "phrases")


def scored(words: DataFrame, phrases: DataFrame, least: int = LEAST, inside: int = INSIDE) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases by their weakest cut, without those of which
    a longer one that holds them has ``inside`` percent of the occurrences."""
    listed = phrases.withColumn("words", F.split("phrase", " ")).withColumn("size", F.size("words"))
    known = phrases.unionAll(words.where(F.col("n") >= least).select("lang", "word", "n"))
    joined = lambda start, size: F.array_join(F.slice("words", start, size), " ")
    cuts = listed.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"),
        joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    for name, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(known.toDF("lang", name, count), ["lang", name])
    wide = lambda name: f"cast({name} as decimal(20, 0))"
    cuts = cuts.withColumn("score", F.expr(f"({wide('a')} * 2000000) div ({wide('l')} + {wide('r')})"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    within = listed.where("size > 2").select("lang", "a", "words", "size", F.explode(
        F.expr("sequence(2, size - 1)")).alias("n")).withColumn("i", F.explode(F.expr("sequence(1, size - n + 1)"))).select(
        "lang", joined(F.col("i"), F.col("n")).alias("phrase"), "a")
    longest = within.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    return best.join(longest, ["lang", "phrase"], "left").where(
        F.expr(f"longer is null or {wide('longer')} * 100 < {wide('a')} * {inside}")).select(
        "lang", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, least: int = LEAST, inside: int = INSIDE, top: int = TOP, lang_col: str = "lang",
                 text_col: str = "text", **settings) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), text_of(text_col).alias("text"))
    words, phrases = frequent_phrases(docs, least, **settings)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(words, phrases, least, inside).withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    n = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language of the documents."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), numbered AS (
  SELECT lang, w, row_number() OVER () AS piece FROM words
), placed AS (
  SELECT lang, piece, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM numbered
), leads AS (
  SELECT lang, word AS w1, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3, lead(word, 3) OVER p AS w4
  FROM placed WINDOW p AS (PARTITION BY piece ORDER BY i)
), grams AS (
  SELECT lang, 1 AS k, w1 AS phrase FROM leads
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM leads WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM leads WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM leads WHERE w4 IS NOT NULL
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase
), total AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k, string_split(phrase, ' ') AS w, phrase, f AS a FROM f WHERE k > 1 AND f >= 30
), split AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:k], ' ') AS rest
  FROM cand, (SELECT unnest([1, 2, 3]) AS cut) t WHERE cut < k
), cuts AS (
  SELECT s.lang, s.phrase, s.a, s.cut, l.f AS l, r.f AS r, ((2000000::HUGEINT * s.a) // (l.f + r.f))::BIGINT AS score
  FROM split s JOIN f l ON l.lang = s.lang AND l.phrase = s.first JOIN f r ON r.lang = s.lang AND r.phrase = s.rest
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM cuts
), inner_phrases AS (
  SELECT c.lang, c.a, array_to_string(c.w[i:i + n - 1], ' ') AS phrase
  FROM cand c, (SELECT unnest([2, 3]) AS n) s, (SELECT unnest([1, 2, 3]) AS i) p WHERE n < c.k AND i + n - 1 <= c.k
), longest AS (
  SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY lang, phrase
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN longest g ON b.lang = g.lang AND b.phrase = g.phrase
  WHERE b.place = 1 AND (g.longer IS NULL OR 100 * g.longer < 80 * b.a)
)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, k.score
FROM ranked k JOIN total t ON k.lang = t.lang WHERE k.rank <= 2000
"""
