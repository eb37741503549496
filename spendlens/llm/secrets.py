"""Secret scans by patterns and character Markov models, in DataFrame operations only.

1. Three base patterns (assignments, access keys, long hexadecimal runs) are matched
   in every whole text. Places follow from the lengths of the matches and of the
   text between them: matches of one text are numbered rows, and a running sum in
   their order gives starts in code points. A text is matched only if a plain
   substring test allows it.
2. Other runs of at least ``LEAST_CHARS`` key characters with both letters and digits
   are candidates.
3. Two first-order Markov models over key characters are trained on all documents, one
   on the distinct values that the base patterns found, and one on the identifiers of
   documents without any that recur in different texts (copies of a text prove nothing:
   an identifier recurs if the least and the greatest digest of its texts differ, which
   tasks add up without keeping texts). A model has at most one count per pair of
   characters, so the table of log-likelihood ratios is a small constant.
4. A candidate whose mean log-likelihood ratio reaches ``LEAST_RATIO`` per character
   is a secret as well. Base spans are never dropped; a candidate that overlaps one
   adds none.

Null texts are empty. Repeated rows get a row each; an empty table gives no rows;
other columns are not looked at. Without any base match there is no model, and no
candidate counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.store import materialize
from .common import number_of, table, text_of

KINDS = ("assign", "access", "hex", "random")
LEAST_CHARS = 20
LEAST_RATIO = 0.7
BACK_OFF = 5.0

# Without the lower bounds on length, so that a match that is too short still uses up its characters.
ASSIGN = (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
          r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
# A run is at least 32 characters or drops out, so the bound can be in the pattern.
HEX = r"[0-9a-f]{32,}"
_KEY = r"A-Za-z0-9+/_=-"
RANDOM = rf"(?<![{_KEY}])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[{_KEY}]{{{LEAST_CHARS},}}+"
PATTERNS = (ASSIGN, ACCESS, HEX, RANDOM)
WORDS_FOR_ASSIGN = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_LENGTHS = (8, 16, 32, LEAST_CHARS)

ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-."


def _matches(kind: int) -> Column:
    """Per match of a pattern: the text before it, the match, and what has to be long enough."""
    hits = F.col(f"hits_{kind}")
    core = F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(2)) if kind == 0 else hits
    gaps = F.slice(F.split("text", PATTERNS[kind], -1), F.lit(1), F.size(hits))
    found = F.zip_with(
        F.zip_with(gaps, hits, lambda gap, hit: F.struct(F.length(gap).alias("before"), F.length(hit).alias("chars"))),
        core, lambda m, c: F.struct(
            F.lit(kind).alias("kind"), m["before"].alias("before"), m["chars"].alias("chars"),
            c.alias("value"), (F.length(c) >= LEAST_LENGTHS[kind]).alias("holds")))
    none = F.array().cast("array<struct<kind:int,before:int,chars:int,value:string,holds:boolean>>")
    return F.when(F.size(hits) > 0, found).otherwise(none)


def find_matches(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Each row with all matches of all patterns, in order (columns doc_id, text, and
    those to keep, by ``keep_`` and their place)."""
    may_assign = F.lit(False)
    for word in WORDS_FOR_ASSIGN:
        may_assign |= F.contains("low", F.lit(word))
    allowed = (may_assign, F.contains("text", F.lit("AKIA")), F.lit(True), F.lit(True))
    others = [f"keep_{i}" for i in range(len(keep))]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", F.lower("text").alias("low"), *others)
    hits = rows.select("row", "doc_id", "text", *others, *[
        F.when(allowed[kind], F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias(f"hits_{kind}")
        for kind, pattern in enumerate(PATTERNS)])
    some = F.lit(False)
    for kind in range(len(KINDS)):
        some |= F.coalesce(F.size(f"hits_{kind}") > 0, F.lit(False))
    text = F.col("text") if keep else F.when(some, F.col("text"))
    matched = hits.select("row", "doc_id", *others, text.alias("text"), F.xxhash64("text").alias("same"),
                          F.col("text").alias("whole"), F.concat(*[_matches(kind) for kind in range(len(KINDS))]).alias("matches"))
    based = F.exists("matches", lambda m: (m["kind"] < 3) & m["holds"])
    named = F.regexp_extract_all("whole", F.lit(rf"[A-Za-z_][{_KEY}]{{7,}}"), F.lit(0))
    return matched.withColumn("names", F.when(~based, F.array_distinct(named))).drop("whole")


def locate(found: DataFrame) -> DataFrame:
    """One row per match that is long enough: row, kind, start, end, value."""
    in_order = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spread = found.where(F.size("matches") > 0).select("row", F.posexplode("matches").alias("at", "m"))
    placed = spread.select("row", "at", "m.*").withColumn("end", F.sum(F.col("before") + F.col("chars")).over(in_order))
    return placed.where("holds").select("row", "kind", (F.col("end") - F.col("chars")).alias("start"), "end", "value")


def _pairs(values: DataFrame) -> dict[tuple[str, str], int]:
    """Counts of neighbouring characters; at most one row per pair of the alphabet."""
    long_enough = values.where(F.length("value") > 1)
    at = long_enough.select("value", F.explode(F.sequence(F.lit(1), F.length("value") - 1)).alias("i"))
    a, b = F.col("value").substr(F.col("i"), F.lit(1)), F.col("value").substr(F.col("i") + 1, F.lit(1))
    inside = F.contains(F.lit(ALPHABET), F.col("a")) & F.contains(F.lit(ALPHABET), F.col("b"))
    counted = at.select(a.alias("a"), b.alias("b")).where(inside).groupBy("a", "b").count()
    return {(r["a"], r["b"]): r["count"] for r in counted.collect()}


def _log_odds(random: dict, ordinary: dict) -> list[float]:
    """For each pair of characters the log ratio of its transition probabilities, where
    a rare character falls back on how frequent the next one is at all."""
    size = len(ALPHABET)

    def rows(counts):
        total = sum(counts.values())
        alone = {b: (sum(counts.get((a, b), 0) for a in ALPHABET) + 0.5) / (total + 0.5 * size) for b in ALPHABET}
        sums = {a: sum(counts.get((a, b), 0) for b in ALPHABET) for a in ALPHABET}
        return [math.log((counts.get((a, b), 0) + BACK_OFF * alone[b]) / (sums[a] + BACK_OFF))
                for a in ALPHABET for b in ALPHABET]

    return [x - y for x, y in zip(rows(random), rows(ordinary))]


def train(found: DataFrame, spans: DataFrame) -> list[float] | None:
    random = _pairs(spans.where(F.col("kind") < 3).select("value").distinct())
    if not random:
        return None
    # What occurs in one text only may itself be a secret.
    names = found.select("same", F.explode("names").alias("value")).groupBy("value").agg(
        F.min("same").alias("least"), F.max("same").alias("most")).where(F.col("least") < F.col("most"))
    return _log_odds(random, _pairs(names))


def ratio(value: Column, odds: list[float]) -> Column:
    """Mean log-likelihood ratio per transition."""
    weights = F.split(F.lit(",".join(f"{x:.6f}" for x in odds)), ",").cast("array<double>")
    size = len(ALPHABET)

    def place(i):
        return F.position(value.substr(i, F.lit(1)), F.lit(ALPHABET)) - 1

    steps = F.sequence(F.lit(1), F.length(value) - 1)
    total = F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + F.coalesce(
        F.get(weights, (place(i) * size + place(i + 1)).cast("int")), F.lit(0.0)))
    return total / (F.length(value) - 1)


def scan(docs: DataFrame, least_ratio: float = LEAST_RATIO, keep: list[str] | None = None) -> DataFrame:
    """doc_id, ``spans`` (start, kind, end; in this order) and ``masked``, the text with
    every span replaced by its kind (null without spans), for every row. Columns used:
    doc_id, text. With ``keep``, the result holds the text and these columns as well."""
    keep = keep or []
    docs = docs.select("doc_id", text_of().alias("text"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    found = materialize(find_matches(docs, keep), "secret-matches")
    spans = materialize(locate(found), "secret-spans")
    odds = train(found, spans)
    random = spans.where(F.col("kind") == 3)
    random = random.where(F.lit(False)) if odds is None else random.where(ratio(F.col("value"), odds) >= least_ratio)
    fields = F.struct("start", "kind", "end")
    per_row = spans.where(F.col("kind") < 3).union(random).groupBy("row").agg(F.sort_array(F.collect_list(fields)).alias("all"))
    base = F.filter("all", lambda s: s["kind"] < 3)
    free = F.filter("all", lambda s: (s["kind"] < 3) | ~F.exists(
        "base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    per_row = per_row.select("row", base.alias("base"), "all").select("row", free.alias("spans"))
    joined = found.drop("matches", "names", "same").join(per_row, "row", "left")
    more = ["text", *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)]] if keep else []
    return joined.select(
        "doc_id", *more, F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")).alias("spans"),
        masked(F.col("text"), F.col("spans")).alias("masked"))


def masked(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by the kind of its first;
    null without spans."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    names = F.array(*[F.lit(f"[{name.upper()}]") for name in KINDS])
    joined = F.aggregate(
        spans, start,
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
            s["end"].alias("at"),
            F.concat(acc["out"], text.substr((acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                     F.get(names, s["kind"])).alias("out"))
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(acc["out"], text.substr((acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, joined)


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(name) for name in KINDS])
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest of the base spans, and all spans of all documents."""
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        *[number_of("spans", k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        number_of("spans", 3).alias(f"n_{KINDS[3]}"))
