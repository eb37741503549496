"""Mixing sources to target weights, in DataFrame operations only.

The weights belong to the nodes of a tree, by default domain, language, source. A
budget of tokens runs from the root to the leaves:

1. One scan gives each document its leaf and its tokens; the supply of a leaf times
   ``max_epochs`` is its capacity, that of an inner node the sum of its children.
2. A node's budget goes to its children by weight. A child takes at most its
   capacity, and what it leaves goes to its siblings by weight (water filling: with
   children in order of capacity per weight, the level that fits is the largest of
   the levels that each child would see). Only what the whole node cannot take is
   left to its own siblings. So shortages meet siblings before ancestors.
3. A leaf passes its documents as often as whole epochs fit. The rest is the longest
   prefix of one more epoch, in the order of a hash of seed, epoch and id, that does
   not exceed the budget.

The prefix needs no sort of a leaf: tokens are added up per leaf and leading hash
digits (at most 4096 rows a leaf after partial sums), the running sum over these
finds the digits where the budget ends, and only documents with these digits are
ordered. What comes out is one hash per leaf to compare with, so documents are
chosen by a projection and never shuffle.

Null labels are the label ''. Null texts have no tokens and are chosen with the whole
epochs and as long as they come before the end of a prefix. Leaves without a weight
are not chosen. Rows with one id are one document: chosen or not together. Empty tables give no
rows; other columns of the documents are kept by ``mix`` and not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.store import materialize
from .common import table, text_of

LEVELS = ("domain", "lang", "source")
SHARE = 0.8
MAX_EPOCHS = 4
SEED = "2024"
DIGITS = 3
DOMAINS = 4

#: Weights of languages within a domain; the others share as much as the least.
LANGUAGES = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def words_in(text: Column) -> Column:
    """Runs of characters that are not ASCII white space, as the unit of tokens."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.size(F.split(trimmed, r"[\x20\x09-\x0D]+", -1))).cast("long")


def domain_of(source: Column) -> Column:
    """The sources' numbers modulo ``DOMAINS`` stand for their domains."""
    number = F.coalesce(F.regexp_extract(source, r"([0-9]{1,9})$", 1).try_cast("int"), F.lit(0))
    return F.concat(F.lit("domain"), F.pmod(number, F.lit(DOMAINS)).cast("string"))


def default_weights(leaves: DataFrame) -> DataFrame:
    """Equal domains, ``LANGUAGES`` within a domain, equal sources within a language."""
    lang = F.lit(min(LANGUAGES.values()))
    for name, weight in LANGUAGES.items():
        lang = F.when(F.col("lang") == name, F.lit(weight)).otherwise(lang)
    return leaves.select(*LEVELS, F.lit(1.0).alias("domain_weight"), lang.alias("lang_weight"),
                         F.lit(1.0).alias("source_weight"))


def order_of(epoch: Column, seed: str = SEED, id_col: str = "doc_id") -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def _pour(nodes: DataFrame, parents: list[str], level: str) -> DataFrame:
    """Budgets of the children of each node, from ``budget``, ``weight``, ``capacity``."""
    group = Window.partitionBy(*[F.col(p) for p in parents]) if parents else Window.partitionBy(F.lit(0))
    in_order = group.orderBy(F.col("capacity") / F.col("weight"), level)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    after = in_order.rowsBetween(0, Window.unboundedFollowing)
    amount = F.least("budget", F.sum("capacity").over(group))
    seen = (amount - F.coalesce(F.sum("capacity").over(before), F.lit(0))) / F.sum("weight").over(after)
    leveled = nodes.where(F.col("weight") > 0).withColumn("_seen", seen)
    return leveled.withColumn("_level", F.max("_seen").over(group)).select(
        *parents, level, F.least(F.col("capacity").cast("double"), F.col("_level") * F.col("weight")).alias("budget"))


def leaf_budgets(supply: DataFrame, weights: DataFrame, budget: Column, max_epochs: int = MAX_EPOCHS,
                 levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """The budget of every leaf. ``supply``: levels and tokens; ``weights``: levels and
    a weight per level, in a column named after it."""
    leaves = supply.join(weights, list(levels)).withColumn("capacity", F.col("tokens") * max_epochs)
    for level in levels:
        leaves = leaves.where((F.col(f"{level}_weight") > 0))
    budgets = None
    for depth, level in enumerate(levels):
        path = list(levels[:depth + 1])
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.max(f"{level}_weight").alias("weight"))
        if budgets is None:
            nodes = nodes.withColumn("budget", budget)
        else:
            nodes = nodes.join(budgets, path[:-1])
        budgets = _pour(nodes, path[:-1], level)
    return budgets


def leaf_cuts(narrow: DataFrame, supply: DataFrame, budgets: DataFrame, seed: str = SEED,
              levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """Per leaf the number of whole epochs and the last hash of the prefix after them."""
    keys = list(levels)
    plan = supply.join(budgets, keys).select(
        *keys, "tokens", F.floor(F.col("budget") + 1e-6).cast("long").alias("target")).withColumn(
        "epochs", F.when(F.col("tokens") > 0, F.floor(F.col("target") / F.col("tokens"))).otherwise(F.lit(1)).cast("long"))
    plan = materialize(plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("tokens")), "mix-plan")
    ordered = narrow.join(plan.where("rest > 0").select(*keys, "epochs", "rest"), keys).select(
        *keys, "rest", "n_tokens", order_of(F.col("epochs"), seed).alias("hash")).withColumn(
        "digits", F.substring("hash", 1, DIGITS))
    running = Window.partitionBy(*keys).orderBy("digits").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = ordered.groupBy(*keys, "digits").agg(F.sum("n_tokens").alias("here"), F.max("rest").alias("rest")).withColumn(
        "upto", F.sum("here").over(running))
    # The first digits that do not fit as a whole, and the room that is left for them.
    edge = materialize(
        sums.where(F.col("upto") > F.col("rest")).groupBy(*keys).agg(
            F.min(F.struct("digits", (F.col("rest") - F.col("upto") + F.col("here")).alias("room"))).alias("edge")), "mix-edge")
    same = Window.partitionBy(*keys).orderBy("hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = (
        ordered.join(edge, keys).where(F.col("digits") == F.col("edge.digits"))
        .groupBy(*keys, "hash").agg(F.sum("n_tokens").alias("here"), F.max("edge.room").alias("room"))
        .withColumn("upto", F.sum("here").over(same)).where(F.col("upto") <= F.col("room"))
        .groupBy(*keys).agg(F.max("hash").alias("last")))
    found = plan.select(*keys, "tokens", "target", "epochs", "rest").join(edge, keys, "left").join(within, keys, "left")
    # Without anything that fits at the edge, the prefix ends before its digits.
    return found.select(
        *keys, F.col("tokens").alias("supply"), "target", "epochs",
        F.when(F.col("rest") > 0, F.coalesce("last", "edge.digits", F.lit(""))).otherwise(F.lit("")).alias("cut"))


def copies(cut: Column, epochs: Column, seed: str = SEED) -> Column:
    """How often a document is chosen."""
    return (epochs + F.when(order_of(epochs, seed) <= cut, 1).otherwise(0)).cast("long")


def narrow_table(docs: DataFrame) -> DataFrame:
    """doc_id, the labels and the tokens of every document."""
    label = {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("lang", "source")}
    return docs.select(
        "doc_id", domain_of(label["source"]).alias("domain"), label["lang"].alias("lang"), label["source"].alias("source"),
        words_in(text_of()).alias("n_tokens"))


def plan_mix(docs: DataFrame, weights: DataFrame | None = None, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
             seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """The narrow table and the cuts of its leaves. The budget is ``share`` of all tokens."""
    narrow = materialize(narrow_table(docs), "mix-documents")
    supply = materialize(narrow.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "mix-supply")
    total = supply.agg(F.sum("tokens")).first()[0] or 0
    weights = default_weights(supply) if weights is None else weights
    budgets = leaf_budgets(supply, weights, F.lit(share * total), max_epochs)
    return narrow, materialize(leaf_cuts(narrow, supply, budgets, seed), "mix-cuts")


def mix(docs: DataFrame, weights: DataFrame | None = None, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """The chosen documents with all their columns, each as often as it was chosen."""
    _, cuts = plan_mix(docs, weights, share, max_epochs, seed)
    names = {"domain": "_mix_domain", "lang": "_mix_lang", "source": "_mix_source"}
    cuts = cuts.select(*[F.col(k).alias(v) for k, v in names.items()], F.col("epochs").alias("_mix_epochs"),
                       F.col("cut").alias("_mix_cut"))
    label = {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("lang", "source")}
    chosen = docs.join(
        cuts, (label["lang"] == F.col("_mix_lang")) & (label["source"] == F.col("_mix_source"))
        & (domain_of(label["source"]) == F.col("_mix_domain"))
    ).withColumn("_mix_times", copies(F.col("_mix_cut"), F.col("_mix_epochs"), seed)).where(F.col("_mix_times") > 0)
    if max_epochs > 1:
        chosen = chosen.withColumn("_mix_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_times"))))
    return chosen.select(*docs.columns)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each of all documents is chosen, with what its leaf has and gets."""
    narrow, cuts = plan_mix(table(spark, sf_dir, "documents"))
    return narrow.join(cuts, list(LEVELS), "left").select(
        "doc_id", *LEVELS, "n_tokens", "supply", "target",
        F.coalesce(copies(F.col("cut"), F.col("epochs")), F.lit(0)).cast("long").alias("copies"))


def _sql() -> str:
    def pour(nodes: str, parents: list[str], level: str) -> str:
        group = f"PARTITION BY {', '.join(parents)}" if parents else ""
        order = f"{group} ORDER BY cap / w, {level} ROWS BETWEEN"
        return f"""
  SELECT {', '.join([*parents, level])}, least(cap::DOUBLE, lev * w) AS b FROM (SELECT *, max(seen) OVER ({group}) AS lev FROM (
    SELECT *, (least(b, sum(cap) OVER ({group})::DOUBLE)
               - coalesce(sum(cap) OVER ({order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
              / sum(w) OVER ({order} CURRENT ROW AND UNBOUNDED FOLLOWING) AS seen FROM ({nodes})))"""

    lang = " ".join(f"WHEN '{name}' THEN {weight}" for name, weight in LANGUAGES.items())
    domains = pour(f"SELECT domain, sum(cap)::DOUBLE AS cap, 1::DOUBLE AS w, "
                   f"(SELECT {SHARE}::DOUBLE * sum(tokens) FROM s) AS b FROM s GROUP BY domain", [], "domain")
    langs = pour("SELECT domain, lang, sum(cap)::DOUBLE AS cap, max(lw) AS w, any_value(b) AS b FROM s JOIN db USING (domain) "
                 "GROUP BY domain, lang", ["domain"], "lang")
    leaves = pour("SELECT domain, lang, source, cap::DOUBLE AS cap, 1::DOUBLE AS w, b FROM s JOIN lb USING (domain, lang)",
                  ["domain", "lang"], "source")
    return rf"""
WITH n AS (
  SELECT doc_id, 'domain' || (coalesce(TRY_CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INTEGER), 0) % {DOMAINS}) AS domain,
    lang, source, len(list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS n_tokens
  FROM (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents)),
s AS (
  SELECT *, tokens * {MAX_EPOCHS} AS cap, CASE lang {lang} ELSE {min(LANGUAGES.values())} END::DOUBLE AS lw
  FROM (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM n GROUP BY ALL)),
db AS ({domains}),
lb AS ({langs}),
sb AS ({leaves}),
plan AS (
  SELECT *, target - epochs * supply AS rest
  FROM (SELECT *, CASE WHEN supply > 0 THEN target // supply ELSE 1 END AS epochs
        FROM (SELECT domain, lang, source, tokens AS supply, floor(b + 1e-6)::BIGINT AS target FROM s JOIN sb USING (domain, lang, source))))
SELECT doc_id, domain, lang, source, n_tokens, supply, target,
  (epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY hash) AS upto
      FROM (SELECT *, md5('{SEED}:' || epochs || ':' || doc_id) AS hash FROM n JOIN plan USING (domain, lang, source)))"""


ORACLE = _sql()
