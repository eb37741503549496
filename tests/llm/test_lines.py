"""Line dedup against a plain version."""

import random
from collections import Counter, defaultdict

from spendlens.llm import line_dedup

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def plain(texts, least_chars, least_docs):
    """(id, lines, dropped, kept) of each row; rows without an id are left whole."""
    holders = defaultdict(set)
    for i, text in texts:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= least_chars:
                holders[key(line)].add(i)
    found = Counter()
    for i, text in texts:
        lines = (text or "").split("\n")
        kept = [x for x in lines
                if i is None or len(holders[key(x)]) < least_docs or i == max(holders[key(x)])]
        found[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return found


def found(df, **bounds):
    return Counter(map(tuple, line_dedup.dedup_lines(df, **bounds).collect()))


def test_hostile_rows(hostile, empty, texts):
    for chars, docs in ((20, 3), (1, 2)):
        assert found(hostile, least_chars=chars, least_docs=docs) == plain(texts, chars, docs)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_random_lines(spark):
    rng = random.Random(4)
    pool = ["the same line of twenty characters", " The Same line of twenty characters\t", "short", "", "\x0b",
            "ÉTÉ comme été vingt et un signes", "été comme été vingt et un signes", "Étage A" + "x" * 20]
    texts = [(rng.choice([None, *range(60)]), "\n".join(rng.choice([*pool, f"own line number {i} of its text"])
                                                        for _ in range(rng.randint(0, 8)))) for i in range(200)]
    texts += texts[:20]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert found(df) == plain(texts, 20, 3)


def test_a_long_text_and_a_line_of_all_documents(spark):
    line = "a license line that every document holds"
    long = "\n".join([line, *(f"line {i} of a very long document" for i in range(50_000)), line.upper()])
    texts = [(i, f"{line}\nown {i}") for i in range(2000)] + [(5000, long), (5001, line + "\n" + line)]
    assert found(spark.createDataFrame(texts, "doc_id long, text string")) == plain(texts, 20, 3)
