"""Prefix trie against a plain version."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from spendlens.llm import prefix_trie
from spendlens.llm.prefix_trie import Slots, distinct, ordered_turns, rebuilt_turns, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(said)] for c, said in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = turns.get(c - int(np.fmod(c, 100)), [])[:h] + own[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def found(df, **bounds):
    return Counter(map(tuple, trie(rebuilt_turns(ordered_turns(df)), **bounds).collect()))


def made(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(0, 330), *range(-40, -30), 10**12]:
        script = rng.choice(["abc", "abd", "hot first", None])
        for turn in range(rng.randint(1, 9)):
            text = f"{script} {turn}" if script and rng.random() < 0.8 else rng.choice(["é", "", None, "x" * 50])
            rows.append((conv, turn, rng.choice(["user", "user", None]), text))
    rows += rows[:30] + [(None, 1, "user", "no id"), (5, None, "user", "first"), (5, None, None, None)]
    rows += [(600 + i, t, "user", "the same") for i in range(90) for t in range(7)]
    rng.shuffle(rows)
    return rows


# Ties of one turn and role are broken by digest here and by text there: they are made equal.
def untied(rows):
    texts = {}
    return [(c, t, r, texts.setdefault((c, t, r or ""), x)) for c, t, r, x in rows]


@pytest.mark.parametrize("bounds", [{}, {"least_busy": 3}, {"least_busy": 1}, {"least_busy": 10**6, "rows_a_shard": 50},
                                    {"least_busy": 1, "most_busy": 40}])
def test_trie(spark, bounds):
    rows = untied(made(len(bounds)))
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as depth", "'y' as high", "1 as part")
    assert found(df, **bounds) == plain(rows)


def test_long_conversations_and_small_batches(spark):
    rows = [(100, t, "user", f"turn {t}") for t in range(300)] + [(101, t, "user", f"turn {t}") for t in range(250)]
    rows += [(200 + i, t, "user", "same") for i in range(50) for t in range(5)] + [(7, 1, "a", "z" * 300_000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_and_turnless(spark):
    assert not found(spark.createDataFrame([], SCHEMA))
    assert not found(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA))
    turnless = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 == 3)
    rows = [(turnless, 0, None, None), (turnless, 1, "user", "lost")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


@pytest.mark.parametrize("size", [0, 1, 2, 1000, 100_000])
def test_slots_are_minimal_and_verified(size):
    rng = np.random.default_rng(size)
    high, low = distinct(*(rng.integers(0, 2**63, size).astype(np.uint64) for _ in range(2)))
    high[: size // 2] = high[0] if size else 0  # equal halves differ in the other half
    slots = Slots(high, low)
    assert sorted(slots.find(high, low)) == list(range(len(high)))
    assert (slots.find(high, low + np.uint64(1)) == -1).all()


def test_a_shared_digest_stops_the_job():
    rows = {c: np.array([5, 5], np.uint64) for c in ("high", "low", "parent_high", "parent_low")}
    rows |= {c: np.array([1, 2]) for c in ("depth", "chars", "conv_id")}
    rows |= {c: np.array([1, 1]) for c in ("members", "children", "leaves", "savings")}
    with pytest.raises(ValueError, match="digest"):
        prefix_trie.accumulate(rows)
