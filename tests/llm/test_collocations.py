"""Collocations against a plain version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from spendlens.llm import collocations
from spendlens.llm.collocations import quicksort


def plain(texts, least, inside, top):
    f, n = Counter(), Counter()
    for lang, text in texts:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", lower):
            words = tuple(re.findall("[^\x20\x09]+", piece))
            n[lang] += len(words)
            f.update((lang, words[i:i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    cand = {x: a for x, a in f.items() if a >= least and len(x[1]) > 1}
    ranked = defaultdict(list)
    for (lang, words), a in cand.items():
        cuts = [(2000000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        longer = [b for (other, w), b in cand.items() if other == lang and len(w) > len(words)
                  and any(w[i:i + len(words)] == words for i in range(len(w) - len(words) + 1))]
        if not any(100 * b >= inside * a for b in longer):
            ranked[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return Counter((lang, rank, phrase.decode(), -a, left, right, n[lang], -score) for lang, rows in ranked.items()
                   for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1))


def found(df, **settings):
    return Counter(map(tuple, collocations.collocations(df, **settings).collect()))


def made(seed):
    rng = random.Random(seed)
    words = ["the", "The", "new", "york", "é", "É", "日本", "x" * 30, "x" * 31, "of", "a\x00b", "😀", "w1", "w2", "w3"]
    texts = []
    for i in range(400):
        parts = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t ", ", ", "\n", ".", " - "]) for w in parts)
        texts.append((rng.choice(["en", "en", "de", None, ""]), rng.choice([text, text, text + "new york times today", None, ""])))
    return texts + texts[:60]


SETTINGS = [{}, {"bits": 16, "hot_share": 1 << 16}, {"hot_share": 4}, {"bits": 12, "hot_share": 1, "words_a_shard": 100}]


@pytest.mark.parametrize("settings", SETTINGS)
def test_collocations(spark, monkeypatch, settings):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 3000)
    texts = made(len(str(settings)))
    df = spark.createDataFrame(texts, "lang string, text string").selectExpr("*", "1 as n", "'x' as phrase", "2 as part")
    for least, inside, top in ((5, 80, 2000), (3, 60, 7)):
        assert found(df, least=least, inside=inside, top=top, **settings) == plain(texts, least, inside, top)


def test_hot_pairs_are_found_and_exact(spark):
    rng = random.Random(2)
    texts = [("en", " ".join(f"hot pair w{rng.randint(0, 12)}" for _ in range(30))) for _ in range(200)]
    df = spark.createDataFrame(texts, "lang string, text string")
    docs = df.select("lang", "text")
    total = 200 * 90
    assert len(collocations.pair_filter(docs, total, 30, 20, 10).hot) >= 1
    assert found(df, hot_share=10) == plain(texts, 30, 80, 2000)


def test_hostile_rows(hostile, empty):
    rows = [(r["lang"], r["text"]) for r in hostile.select("lang", "text").collect()]
    assert found(hostile, least=2) == plain(rows, 2, 80, 2000)
    assert not found(empty)


@pytest.mark.parametrize("seed", range(4))
def test_quicksort_counts(seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(0, 1 + 3 ** seed, (3000, 4)).astype(np.int32)
    for k in range(1, 4):
        rows[rng.random(3000) < 0.1, k:] = -1
    weights = rng.integers(1, 5, 3000)
    for least in ([30, 30, 30, 30], [1, 1, 1, 30], [1, 1, 1, 1], [10**9] * 4):
        want = Counter()
        for row, w in zip(rows.tolist(), weights.tolist()):
            for k in range(1, 5):
                if row[k - 1] >= 0:
                    want[tuple(row[:k])] += w
        want = {p: w for p, w in want.items() if w >= least[len(p) - 1]}
        got = Counter()
        for at, length, weight in quicksort(rows, weights, least):
            for i, w in zip(at.tolist(), weight.tolist()):
                got[tuple(rows[i, :length].tolist())] += w
        assert got == want
    assert not list(quicksort(rows[:0], weights[:0], [1] * 4))
