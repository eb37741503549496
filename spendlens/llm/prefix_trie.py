"""Prefix trie of conversations in hashed slots of flat arrays.

A node is a distinct sequence of leading turns (role, text). It is known by a digest
of 128 bits that is chained turn by turn, so a turn costs the same at any depth and
texts are read once.

1. *Digests.* Turns in order, streamed per conversation with one digest as state, give
   a narrow row for each prefix. A conversation may be of any length.
2. *Busy nodes.* Nodes with many members are counted with partial sums: a node is busy
   from ``least_busy`` members on, and from a 2**20th of all rows on, so at most 2**20
   nodes are busy. All ancestors of a busy node are busy; the root is one by definition.
   A conversation in very many copies, or a first turn of a third of all conversations,
   is a few busy nodes.
3. *Shards.* What hangs from a busy node is a subtree with few members and goes to one
   shard as a whole, by the digest of its top. A shard enumerates its distinct digests
   and gives each a slot by a minimal perfect hash: rounds of bit arrays in which a
   digest that is alone in its place takes the place's rank. The slot keeps the digest,
   and every look-up compares it. Members, smallest ids and children are scattered into
   flat arrays by slot, and leaves and savings run through the array of parent slots
   from the deepest level up.
4. The busy nodes are one more such table, at most 2**20 slots; it starts from the sums
   of the subtrees that hang from it.
5. *Ends.* Ids of conversations that end at a node are sorted by node and id over all
   tasks and joined in pieces of a few thousand; one stream per node digests its pieces,
   so a node with very many ends costs a row per piece.

A digest that two different turn sequences share would show as two depths, parents, or
text lengths in one slot, and stops the job.

Turns are ordered by ``turn`` (null first), then role, then the digest of the text;
null roles and texts are empty. Rows without a conversation id belong to none and are
left out. Repeated rows are repeated turns. A conversation without turns left after
rebuilding is a member of the root. An empty table has no nodes; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.store import materialize, remove
from .common import table

HEADS = 6
FAMILY = 100
LEAST_BUSY = 64
MOST_BUSY = 1 << 20
ROWS_A_SHARD = 1 << 20
IDS_A_PIECE = 4096
ROWS_OUT = 1 << 16
ROOT = (0x243F6A8885A308D3, 0x13198A2E03707344)
NOTHING = hashlib.sha256(b"").hexdigest()

PATHS = ("conv_id long, depth long, high long, low long, parent_high long, parent_low long, chars long, ended boolean")
NODES = ("high long, low long, conv_id long, depth long, parent_conv_id long, parent_high long, parent_low long, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long, top boolean")


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# ---------------------------------------------------------------- turns

def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, k, high, low, chars): turns numbered from 1, with digests in place of texts."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col)]
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), said[0].alias("role"),
        F.xxhash64(*said).alias("high"), F.xxhash64(F.lit("low"), *said).alias("low"),
        F.char_length(said[1]).cast("long").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "high", "low")
    return turns.select("conv_id", F.row_number().over(order).cast("long").alias("k"), "high", "low", "chars")


def head_of(conv: Column) -> Column:
    """How many leading turns a conversation takes from the first of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, part, k, high, low, chars) of conversations whose first turns are those
    of the first conversation of their family; each has a row of part 0 besides."""
    conv = F.col("conv_id")
    convs = turns.where("k = 1").select("conv_id")
    zero = [F.lit(0).cast("long").alias(c) for c in ("k", "high", "low", "chars")]
    first = turns.where((conv % FAMILY == 0) & (F.col("k") < HEADS)).withColumnRenamed("conv_id", "first")
    heads = convs.withColumn("first", conv - conv % FAMILY).join(first, "first").where(F.col("k") <= head_of(conv))
    columns = ["conv_id", "part", "k", "high", "low", "chars"]
    parts = [convs.select("conv_id", *zero).withColumn("part", F.lit(0)),
             heads.withColumn("part", F.lit(1)),
             turns.where(F.col("k") > head_of(conv)).withColumn("part", F.lit(2))]
    return parts[0].select(columns).unionAll(parts[1].select(columns)).unionAll(parts[2].select(columns))


# ---------------------------------------------------------------- digests of prefixes

def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of conversation and turn to rows of prefixes. A row is given out
    when the next one tells whether the conversation ends with it."""
    names = [f.split()[0] for f in PATHS.split(", ")]
    held, held_high, held_low = None, None, None

    def given(columns):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv, chars = (batch.column(c).to_numpy() for c in ("conv_id", "chars"))
        own = [batch.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("high", "low")]
        goes_on = held is not None and held[0][-1] == conv[0]
        new = np.empty(n, bool)
        new[0], new[1:] = not goes_on, conv[1:] != conv[:-1]
        starts = np.flatnonzero(new) if not goes_on else np.concatenate([[0], np.flatnonzero(new)])
        rank = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        depth = rank.astype(np.int64)
        if goes_on:
            depth[:starts[1] if len(starts) > 1 else n] += held[1][-1] + 1
        high, low = np.empty(n, np.uint64), np.empty(n, np.uint64)
        up_high, up_low = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        order = np.argsort(rank, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(rank[order])) + 1):
            if rank[at[0]]:
                up_high[at], up_low[at] = high[at - 1], low[at - 1]
            elif goes_on:
                up_high[0], up_low[0] = held_high, held_low
            high[at] = _mix(up_high[at] * np.uint64(0x9E3779B97F4A7C15) + own[0][at])
            low[at] = _mix((up_low[at] ^ (high[at] >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F) + own[1][at])
            roots = at[new[at]]
            high[roots], low[roots] = np.uint64(ROOT[0]), np.uint64(ROOT[1])
        columns = [conv, depth, *(x.view(np.int64) for x in (high, low, up_high, up_low)), chars]
        if held is not None:
            yield given([*held, np.array([not goes_on])])
        if n > 1:
            yield given([*(c[:-1] for c in columns), new[1:]])
        held, held_high, held_low = [c[-1:].copy() for c in columns], high[-1], low[-1]
    if held is not None:
        yield given([*held, np.array([True])])


def prefixes(turns: DataFrame) -> DataFrame:
    """A row for each conversation and depth: digests of the prefix and of the one before."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "k").mapInArrow(_chained, PATHS)


# ---------------------------------------------------------------- slots

class Slots:
    """Minimal perfect hash of distinct digests: each has a slot below their number."""

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.high, self.low = np.empty_like(high), np.empty_like(low)
        self.levels: list[tuple[int, np.ndarray]] = []
        left, base = np.arange(len(high)), 0
        while len(left):
            place = self._place(high[left], low[left], len(self.levels), size := max(8, 2 * len(left)))
            alone = np.bincount(place, minlength=size)[place] == 1
            rank = np.full(size, -1, np.int64)
            rank[place[alone]] = 0
            taken = np.flatnonzero(rank == 0)
            rank[taken] = base + np.arange(len(taken))
            self.levels.append((size, rank))
            slot = rank[place[alone]]
            self.high[slot], self.low[slot] = high[left[alone]], low[left[alone]]
            left, base = left[~alone], base + len(taken)

    @staticmethod
    def _place(high, low, level, size):
        return (_mix(high ^ _mix(low + np.uint64((level + 1) * 0xD6E8FEB86659FD93 % 2**64))) % np.uint64(size)).astype(np.int64)

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Slots, -1 for digests that are not in the table."""
        slot = np.full(len(high), -1, np.int64)
        left = np.arange(len(high))
        for level, (size, rank) in enumerate(self.levels):
            found = rank[self._place(high[left], low[left], level, size)]
            slot[left], left = found, left[found < 0]
        known = slot >= 0
        known[known] = (self.high[slot[known]] == high[known]) & (self.low[slot[known]] == low[known])
        slot[~known] = -1
        return slot


def distinct(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.ones(len(high), bool)
    first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    return high[first], low[first]


def _same(slot: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """The value of each slot, which all rows of the slot must share."""
    out = np.zeros(size, values.dtype)
    out[slot] = values
    if (out[slot] != values).any():
        raise ValueError("two sequences of turns share a digest")
    return out


def accumulate(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Nodes of a table of prefixes. Rows have digests of the prefix and its parent, depth,
    chars, conv_id, members and, of subtrees that hang from the node elsewhere, children,
    leaves and savings."""
    high, low = rows["high"], rows["low"]
    slots = Slots(*distinct(high, low))
    size = len(slots.high)
    slot = slots.find(high, low)
    depth, chars, up_high, up_low = (
        _same(slot, rows[c], size) for c in ("depth", "chars", "parent_high", "parent_low"))
    members, children, leaves, saved = (np.zeros(size, np.int64) for _ in range(4))
    for total, name in ((members, "members"), (children, "children"), (leaves, "leaves"), (saved, "savings")):
        np.add.at(total, slot, rows[name])
    conv = np.full(size, np.iinfo(np.int64).max)
    np.minimum.at(conv, slot, rows["conv_id"])
    parent = slots.find(up_high, up_low)
    parent[depth == 0] = -1
    inner = parent >= 0
    np.add.at(children, parent[inner], 1)
    leaves[children == 0] += 1
    saved += (members - 1) * chars
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    parent_conv = np.where(inner, conv[parent], 0) if size else conv
    return {"high": slots.high, "low": slots.low, "conv_id": conv, "depth": depth, "parent_conv_id": parent_conv,
            "parent_high": up_high, "parent_low": up_low, "n_convs": members, "n_children": children,
            "n_leaves": leaves, "saved_tokens": saved, "top": ~inner}


def _unsigned(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy().astype(np.int64, copy=False).view(np.uint64)


def _read(batches: Iterator[pa.RecordBatch], extra: tuple[str, ...] = ()) -> dict[str, np.ndarray]:
    digests, numbers = ("high", "low", "parent_high", "parent_low"), ("depth", "chars", "conv_id", *extra)
    parts = [{**{c: _unsigned(b, c) for c in digests}, **{c: b.column(c).to_numpy() for c in numbers}}
             for b in batches if b.num_rows]
    return {c: np.concatenate([p[c] for p in parts]) for c in (*digests, *numbers)} if parts else {}


def _written(nodes: dict[str, np.ndarray], parent_known: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in NODES.split(", ")]
    for start in range(0, len(parent_known), ROWS_OUT):
        part = slice(start, start + ROWS_OUT)
        columns = [nodes[c][part].view(np.int64) if nodes[c].dtype == np.uint64 else nodes[c][part] for c in names]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, mask=~parent_known[part]) if c == "parent_conv_id" else pa.array(v)
             for c, v in zip(names, columns)], names)


class _Busy:
    """Digests of the busy nodes and their smallest members, sent to every task."""

    def __init__(self, high: np.ndarray, low: np.ndarray, conv: np.ndarray):
        self.slots = Slots(high, low)
        self.conv = np.empty(len(conv), np.int64)
        self.conv[self.slots.find(high, low)] = conv

    def holds(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        return self.slots.find(high, low) >= 0


def _keyed(busy: _Busy):
    """Rows in order of conversation and depth that are not busy, with the digest of the
    topmost such node of their conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # conversation and key where the last batch ended
        for batch in batches:
            rare = batch.filter(pa.array(~busy.holds(_unsigned(batch, "high"), _unsigned(batch, "low"))))
            if not rare.num_rows:
                continue
            conv = rare.column("conv_id").to_numpy()
            high, low = (rare.column(c).to_numpy() for c in ("high", "low"))
            starts = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            lengths = np.diff(np.append(starts, len(conv)))
            key_high, key_low = high[starts].copy(), low[starts].copy()
            if last is not None and last[0] == conv[0]:
                key_high[0], key_low[0] = last[1:]
            last = conv[-1], key_high[-1], key_low[-1]
            for name, key in (("key_high", key_high), ("key_low", key_low)):
                rare = rare.append_column(name, pa.array(np.repeat(key, lengths)))
            yield rare
    return run


def _shard(busy: _Busy):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _read(batches)
        if not rows:
            return
        n = len(rows["high"])
        rows["members"] = np.ones(n, np.int64)
        for name in ("children", "leaves", "savings"):
            rows[name] = np.zeros(n, np.int64)
        nodes = accumulate(rows)
        at = busy.slots.find(nodes["parent_high"][nodes["top"]], nodes["parent_low"][nodes["top"]])
        if (at < 0).any():
            raise ValueError("a subtree hangs from no node")
        nodes["parent_conv_id"][nodes["top"]] = busy.conv[at]
        yield from _written(nodes, np.ones(len(nodes["top"]), bool))
    return run


def _busy_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _read(batches, ("members", "children", "leaves", "savings"))
    if rows:
        nodes = accumulate(rows)
        yield from _written(nodes, nodes["depth"] > 0)


# ---------------------------------------------------------------- ends

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, id) rows to pieces (node, first id, ids joined)."""
    for batch in batches:
        for start in range(0, batch.num_rows, IDS_A_PIECE):
            part = batch.slice(start, IDS_A_PIECE)
            high, low, conv = (part.column(c).to_numpy() for c in ("high", "low", "conv_id"))
            cut = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
            ids = [",".join(map(str, x)) for x in np.split(conv, cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(high[cut]), pa.array(low[cut]), pa.array(conv[cut]), pa.array(ids)],
                ["high", "low", "first", "ids"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to one digest a node."""
    node, sha = None, None
    for batch in batches:
        done: list[tuple] = []
        for high, low, ids in zip(*(batch.column(c).to_pylist() for c in ("high", "low", "ids"))):
            if node == (high, low):
                sha.update(b"," + ids.encode())
                continue
            if node is not None:
                done.append((*node, sha.hexdigest()))
            node, sha = (high, low), hashlib.sha256(ids.encode())
        if done:
            yield _ends(done)
    if node is not None:
        yield _ends([(*node, sha.hexdigest())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2])],
        ["high", "low", "ends_sha256"])


def ends(paths: DataFrame) -> DataFrame:
    """(high, low, ends_sha256) of nodes at which conversations end."""
    last = paths.where("ended").select("high", "low", "conv_id")
    pieces = last.repartitionByRange("high", "low", "conv_id").sortWithinPartitions("high", "low", "conv_id").mapInArrow(
        _pieces, "high long, low long, first long, ids string")
    return pieces.repartition("high", "low").sortWithinPartitions("high", "low", "first").mapInArrow(
        _digested, "high long, low long, ends_sha256 string")


# ---------------------------------------------------------------- trie

def trie(turns: DataFrame, least_busy: int = LEAST_BUSY, most_busy: int = MOST_BUSY,
         rows_a_shard: int = ROWS_A_SHARD) -> DataFrame:
    """Nodes of the trie of turns (conv_id, part, k, high, low, chars). Every conversation has
    a row of part 0 that stands for the root."""
    spark = turns.sparkSession
    paths = materialize(prefixes(turns), "prefixes")
    total = paths.count()
    least = max(least_busy, -(-total // most_busy))
    busy = materialize(paths.groupBy("high", "low").agg(
        F.count("*").alias("members"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.max("depth").alias("depth_too"), F.min("chars").alias("chars"), F.max("chars").alias("chars_too"),
        F.min("parent_high").alias("parent_high"), F.max("parent_high").alias("parent_high_too"),
        F.min("parent_low").alias("parent_low")).where((F.col("members") >= least) | (F.col("depth") == 0)), "busy")
    if busy.where("depth != depth_too or chars != chars_too or parent_high != parent_high_too").count():
        raise ValueError("two sequences of turns share a digest")
    known = busy.select("high", "low", "conv_id").toPandas()  # at most most_busy rows and the root
    sent = _Busy(*(known[c].to_numpy(np.int64).view(np.uint64) for c in ("high", "low")), known["conv_id"].to_numpy(np.int64))
    columns = "conv_id long, depth long, high long, low long, parent_high long, parent_low long, chars long, " \
              "ended boolean, key_high long, key_low long"
    keyed = paths.repartition("conv_id").sortWithinPartitions("conv_id", "depth").mapInArrow(_keyed(sent), columns)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // rows_a_shard))
    rare = materialize(keyed.drop("ended").repartition(shards, "key_high", "key_low").mapInArrow(_shard(sent), NODES), "nodes")
    hanging = rare.where("top").groupBy(F.col("parent_high").alias("high"), F.col("parent_low").alias("low")).agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("savings"))
    zero = F.lit(0).cast("long")
    filled = busy.join(hanging, ["high", "low"], "left").select(
        "high", "low", "parent_high", "parent_low", "depth", "chars", "conv_id", "members",
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("children", "leaves", "savings")])
    nodes = rare.unionAll(filled.coalesce(1).mapInArrow(_busy_table, NODES))
    return nodes.join(ends(paths), ["high", "low"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt on the first turns of their family."""
    turns = materialize(ordered_turns(table(spark, sf_dir, "conversations")), "turns")
    nodes = materialize(trie(rebuilt_turns(turns)), "trie")
    remove(turns)
    return nodes


ORACLE = """
WITH said AS (
  SELECT conv_id, sha256(coalesce(role, '')) || sha256(coalesce(text, '')) AS turn, length(coalesce(text, '')) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS first,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
             lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))),
             4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM said)
), parts AS (
  SELECT c.conv_id, 1 AS part, s.k, s.turn, s.chars FROM convs c JOIN said s ON s.conv_id = c.first AND s.k <= c.h
  UNION ALL
  SELECT c.conv_id, 2, s.k, s.turn, s.chars FROM convs c JOIN said s ON s.conv_id = c.conv_id AND s.k > c.h
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, k) AS d FROM parts
), prefixes AS (
  SELECT conv_id, d, chars, sha256(string_agg(turn, '') OVER (
           PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING)) AS node FROM placed
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs
), followed AS (
  SELECT *, lag(node) OVER w AS parent, lead(node) OVER w IS NULL AS last
  FROM prefixes WINDOW w AS (PARTITION BY conv_id ORDER BY d)
), nodes AS (
  SELECT node, min(conv_id) AS conv_id, min(d) AS depth, min(parent) AS parent, count(*) AS n_convs, min(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM followed GROUP BY node
), children AS (
  SELECT parent AS node, count(*) AS n FROM nodes GROUP BY parent
), below AS (
  SELECT DISTINCT a.node AS top, b.node FROM prefixes a JOIN prefixes b ON a.conv_id = b.conv_id AND a.d <= b.d
), sums AS (
  SELECT b.top AS node, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM below b JOIN nodes n ON n.node = b.node LEFT JOIN children c ON c.node = b.node GROUP BY b.top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.parent = p.node LEFT JOIN children c ON n.node = c.node JOIN sums s ON n.node = s.node
"""
