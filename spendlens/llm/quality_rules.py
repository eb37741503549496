"""Quality rules: a threshold table compiled into one projection.

Every measure is a built-in expression over the words and lines of the whole
text, every rule compares a measure or a ratio of two with bounds from a table,
and the verdict is their conjunction. There is no shuffle and no user function.

Words are runs of characters that are not ASCII white space. A word is repeated
if a window of three words that holds it occurs at least twice in the text. The
windows are compared by 64-bit hashes, sorted within the text, so long texts cost
``n log n``; two different windows of a text share a hash with a probability
below ``n * n / 2**64``.

A null or empty text has no words, fails the base rule, and all its measures are
0. Repeated rows get a row each, an empty table gives no rows, and other columns
are not looked at.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_of

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3

#: Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it on with as was by be this from are at an or a "
    "der die das und ist von zu ein eine mit sich nicht auf für den im dem als des "
    "le la les de et un une du dans que qui pour par sur pas au avec est "
    "el los las del y en se por con para al su una lo no").split()


class Rule(NamedTuple):
    """Keep a text if measure / per lies within the bounds; None is no bound."""

    name: str
    measure: str
    per: str | None
    least: float | None
    most: float | None


RULES = [
    Rule("length", "n_words", None, 50, None),
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.2),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.5),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.6),
]


def _repeat_positions(text_hashes: str) -> Column:
    """Windows (hash, position) in hash order; empty if no hash occurs twice."""
    hashes = F.col(text_hashes)
    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(pairs))


def _covered(positions: Column) -> Column:
    """How many words the windows at the sorted positions hold."""
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("sum"))
    return F.aggregate(
        positions, start,
        lambda acc, p: F.struct(
            p.alias("last"), (acc["sum"] + F.least(p - acc["last"], F.lit(WINDOW))).cast("long").alias("sum")),
        lambda acc: acc["sum"])


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and all measures of the whole text."""
    text, words = F.col("_text"), F.col("_words")
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    none = F.array().cast("array<string>")
    split = docs.select(F.col(id_col), text_of(text_col).alias("_text")).select(
        id_col, "_text",
        F.when(trimmed == "", none).otherwise(F.split(trimmed, SPACE + "+", -1)).alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(" \t\n\x0b\f\r")) != "").alias("_lines"))
    firsts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
    hashed = split.select(
        id_col, "_text", "_words", "_lines",
        F.transform(firsts, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)])).alias("_hashes"))
    ordered = hashed.withColumn("_order", _repeat_positions("_hashes"))
    order = F.col("_order")
    repeated = F.transform(
        F.filter(order, lambda x, i: (x["h"] == F.get(order, i - 1)["h"]) | (x["h"] == F.get(order, i + 1)["h"])),
        lambda x: x["i"])
    counted = [
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS + "+", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.sort_array(repeated)), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_words", lambda w: w.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
    ]
    # A generator of one row keeps filters on the measures above them. Pushed below, a
    # filter would hold copies of their expressions, down into the lambdas.
    return ordered.select(id_col, F.inline(F.array(F.struct(*counted))))


def _holds(rule: Rule) -> Column:
    value = F.col(rule.measure).cast("double")
    if rule.per:
        value = F.coalesce(value / F.nullif(F.col(rule.per).cast("double"), F.lit(0.0)), F.lit(0.0))
    holds = F.lit(True)
    if rule.least is not None:
        holds &= value >= rule.least
    if rule.most is not None:
        holds &= value <= rule.most
    return holds


def apply_rules(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Measures, ``base_failed``, ``kept`` and the names of the broken rules."""
    rules = RULES if rules is None else rules
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    broken = F.array_compact(F.array(*[F.when(~_holds(rule), F.lit(rule.name)) for rule in rules]))
    return measures(docs, id_col, text_col).select(
        "*", base_failed.alias("base_failed"), broken.alias("broken")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken") == 0))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of all documents."""
    found = apply_rules(table(spark, sf_dir, "documents")).withColumn("broken", F.array_join("broken", ","))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select(*first, *[c for c in found.columns if c not in first])


def _sql() -> str:
    tests = []
    for rule in RULES:
        value = f"{rule.measure}::DOUBLE"
        if rule.per:
            value = f"coalesce({value} / nullif({rule.per}::DOUBLE, 0), 0)"
        bounds = [f"{value} >= {rule.least}"] if rule.least is not None else []
        bounds += [f"{value} <= {rule.most}"] if rule.most is not None else []
        tests.append(f"CASE WHEN NOT ({' AND '.join(bounds)}) THEN '{rule.name}' END")
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return rf"""
WITH d AS (
  SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
win AS (
  SELECT doc_id, i, struct_pack(a := w[i], b := w[i + 1], c := w[i + 2]) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
hit AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM hit) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines,
    len(list_filter(w, lambda x: x IN ({stop})))::BIGINT AS n_stop_words
  FROM d LEFT JOIN rep USING (doc_id)),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    concat_ws(',', {', '.join(tests)}) AS broken
  FROM m)
SELECT *, NOT base_failed AND broken = '' AS kept FROM f"""


ORACLE = _sql()
