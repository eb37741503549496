"""Prioritised regex rules and the per-text profile.

Rules and tag patterns depend on the match text alone, and few texts account for
most transactions. So the patterns run once per distinct text and the result is
joined back. The distinct step combines on the map side, so a text with a third
of all rows leaves each task once. Nothing is hinted in the join back: the number
of texts grows with the data, so AQE picks broadcast from the measured size and
otherwise splits hot texts of the shuffle join.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import any_of, constant, flag, label_by, matching, required_literals
from ..sources import dimension, materialize

RULE_DDL = (
    "priority int not null, rule_name string not null, regex_pattern string not null, "
    "rule_l1 string not null, rule_l2 string not null, rule_l3 string not null, place int not null"
)
GRAM = 3
SALTS = 64
RULE_COLUMNS = ["priority", "matched_rule_name", "rule_l1", "rule_l2", "rule_l3"]

TEXT_FLAGS = {
    "is_topup": fv.TOPUP,
    "is_wallet": fv.WALLET,
    "is_processor_mediated": fv.PROCESSOR,
    "is_food_delivery": fv.FOOD_DELIVERY,
    "is_ride_hailing": fv.RIDE_HAILING,
    "is_subscription": fv.SUBSCRIPTION,
    "is_grocery": fv.GROCERY,
    "is_risky_merchant": fv.RISKY,
    "is_mall_pattern": fv.MALL,
    "names_app": fv.IN_APP,
    "names_premium_brand": fv.PREMIUM_BRAND,
}


def rule_frame(spark: SparkSession, rules: list[tuple] | None = None) -> DataFrame:
    """The rules as a table; ``place`` is their position in the list."""
    return dimension(spark, [(*rule, place) for place, rule in enumerate(rules or fv.MERCHANT_RULES)], RULE_DDL)


def hierarchy_frame(spark: SparkSession) -> DataFrame:
    return dimension(spark, fv.HIERARCHY, "ref_l1 string, ref_l2 string, ref_l3 string")


def settle(texts: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed here and nowhere else. A filter on them (or on
    what follows from them) stays above the generator; otherwise the planner would
    push all pattern tests below the distinct step, onto every transaction."""
    return texts.select("*", F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def classify_texts(texts: DataFrame, rules: list[tuple] | None = None) -> DataFrame:
    """Names of all rules that match ``match_text``, how many, and the best one.
    The lowest priority wins, of equal ones the first in the list; unmatched texts get
    NULL and 0. Rules are told apart by their position, so names may repeat."""
    ordered = sorted(rules or fv.MERCHANT_RULES, key=lambda rule: rule[0])
    details = constant(
        [{"priority": rule[0], "name": rule[1], "l1": rule[3], "l2": rule[4], "l3": rule[5]} for rule in ordered],
        "array<struct<priority:int,name:string,l1:string,l2:string,l3:string>>")
    found = F.transform(
        matching("match_text", [(str(place), rule[2]) for place, rule in enumerate(ordered)]),
        lambda place: F.get(details, place.cast("int")))
    matched = settle(texts, _found=found)
    best = F.get("_found", F.lit(0))
    return matched.withColumns({
        "rule_hits": F.col("_found.name"),
        "matched_rule_name": best["name"],
        "priority": best["priority"],
        "rule_l1": best["l1"],
        "rule_l2": best["l2"],
        "rule_l3": best["l3"],
        "rule_match_cnt": F.size("_found"),
    }).drop("_found")


def add_conflict_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("rule_conflict_flag", label_by([
        ("MULTIPLE_RULES", F.col("rule_match_cnt") > 1),
        ("SINGLE_RULE", F.col("rule_match_cnt") == 1),
    ], "NO_RULE"))


def flag_texts(texts: DataFrame) -> DataFrame:
    """Pattern flags and the platform label for each row of ``match_text``."""
    flags = matching("match_text", [(name, any_of(patterns)) for name, patterns in TEXT_FLAGS.items()])
    platforms = matching("match_text", fv.PLATFORMS)
    return settle(texts, _flags=flags, _platforms=platforms).withColumns({
        **{name: flag(F.array_contains("_flags", name)) for name in TEXT_FLAGS},
        "platform_ecosystem": F.coalesce(F.get("_platforms", F.lit(0)), F.lit("NONE")),
    }).drop("_flags", "_platforms")


def distinct_texts(df: DataFrame) -> DataFrame:
    return df.select("match_text").distinct()


def add_rules(df: DataFrame, rules: list[tuple] | None = None) -> DataFrame:
    """Rule result of every transaction."""
    return add_conflict_flag(df.join(classify_texts(distinct_texts(df), rules), "match_text"))


def add_text_flags(df: DataFrame) -> DataFrame:
    """Pattern flags of every transaction."""
    return df.join(flag_texts(distinct_texts(df)), "match_text")


def text_profile(texts: DataFrame, rules: list[tuple] | None = None) -> DataFrame:
    """Rule result and pattern flags of each text."""
    return flag_texts(classify_texts(texts, rules))


def add_text_profile(df: DataFrame, rules: list[tuple] | None = None, profiles: DataFrame | None = None) -> DataFrame:
    """Rule result and pattern flags together, with one join back: by the text, or by the
    ``profile_id`` that rows hold where ``profiles`` have one."""
    if profiles is None:
        return add_conflict_flag(df.join(text_profile(distinct_texts(df), rules), "match_text"))
    return add_conflict_flag(join_profiles(df, profiles))


def store_profiles(profile: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(match_text, profile_id) and (profile_id, what a profile holds), stored. Many texts share
    a profile, so rows move with its number instead of the text. Both are stored first, so that
    rows stay where they are while these are small."""
    columns = [c for c in profile.columns if c != "match_text"]
    every = materialize(profile.withColumn("_all", F.to_json(F.struct(*columns))), "text_profile")
    profiles = materialize(
        every.select(*columns, "_all").dropDuplicates(["_all"]).withColumn("profile_id", F.monotonically_increasing_id()),
        "profiles")
    numbers = every.select("match_text", "_all").join(profiles.select("_all", "profile_id"), "_all")
    return materialize(numbers.drop("_all"), "profile_numbers"), profiles.drop("_all")


def join_profiles(df: DataFrame, profiles: DataFrame) -> DataFrame:
    return df.join(profiles, "profile_id").drop("profile_id")


# A pattern's grams by alternative, as rows.
_GRAMS = "array<struct<part:int,gram:string>>"


def _literal_grams(patterns: pd.Series) -> pd.Series:
    """The grams of the literals that a pattern requires, once per rule; the gram '' where it
    requires none."""
    def grams(literal: str) -> list[str]:
        size = min(GRAM, len(literal))
        return sorted({literal[i:i + size] for i in range(len(literal) - size + 1)}) if literal else [""]

    return patterns.map(lambda pattern: [
        {"part": part, "gram": gram} for part, literal in enumerate(required_literals(pattern)) for gram in grams(literal)])


def text_grams(texts: DataFrame) -> DataFrame:
    """(match_text, gram): every distinct run of one to ``GRAM`` characters of each text."""
    runs = [F.regexp_extract_all("match_text", F.lit(f"(?s)(?=(.{{{size}}}))"), 1) for size in range(1, GRAM + 1)]
    return texts.select("match_text", F.explode(F.array_distinct(F.concat(*runs))).alias("gram"))


def rule_index(rules: DataFrame, grams: DataFrame) -> DataFrame:
    """The rules with the grams under which they are filed: of each alternative's literal
    the gram that the fewest texts hold. Rules that require no literal are filed under ''
    with every salt."""
    listed = rules.select("rule_id", F.inline(F.pandas_udf(_literal_grams, _GRAMS)("regex_pattern")))
    texts_with = grams.join(listed.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(
        F.count("*").alias("texts"))
    rarest = listed.join(texts_with, "gram", "left").groupBy("rule_id", "part").agg(
        F.min_by("gram", F.struct(F.coalesce("texts", F.lit(0)), "gram")).alias("gram"))
    salts = F.when(F.col("gram") == "", F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return rarest.select("rule_id", "gram").distinct().withColumn("salt", F.explode(salts)).join(rules, "rule_id")


def match_by_index(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """(match_text, rule columns) of each text and each rule that it matches.

    Texts meet rules over a gram that the rule requires, in an equi-join; only such pairs
    are tested. Pairs of a text are in one task, in order of the rules, so that a pattern
    is compiled once for each run of its pairs (``regexp_instr`` keeps the last pattern).
    """
    rules = materialize(rules.withColumn("rule_id", F.monotonically_increasing_id()), "rules")
    grams = text_grams(texts)
    spread = F.pmod(F.xxhash64("match_text"), F.lit(SALTS)).cast("int")
    filed = grams.withColumn("salt", F.lit(0)).unionAll(
        texts.select("match_text", F.lit("").alias("gram"), spread.alias("salt")))
    found = filed.join(rule_index(rules, grams), ["gram", "salt"]).drop("gram", "salt")
    candidates = found.repartition("match_text").dropDuplicates(["match_text", "rule_id"])
    return candidates.sortWithinPartitions("rule_id").where(F.regexp_instr("match_text", F.col("regex_pattern")) > 0)


def add_rules_by_join(df: DataFrame, rules: DataFrame, stored: bool = False) -> DataFrame:
    """The same rule result for rules that live in a table of any size. Equal priorities
    are settled by ``place`` if the table has it, else by name. With ``stored`` the
    results of the distinct texts are written first, so transactions stay where they are
    while these are small."""
    tie = F.col("place") if "place" in rules.columns else F.col("rule_name")
    best = F.min_by(
        F.struct("priority", F.col("rule_name").alias("matched_rule_name"), "rule_l1", "rule_l2", "rule_l3"),
        F.struct(F.col("priority"), tie.alias("tie")))
    texts = distinct_texts(df)
    matched = match_by_index(texts, rules).groupBy("match_text").agg(
        best.alias("best"), F.count("*").cast("int").alias("rule_match_cnt")).select(
        "match_text", *[F.col(f"best.{c}").alias(c) for c in RULE_COLUMNS], "rule_match_cnt")
    joined = df.join(materialize(matched, "matched_texts") if stored else matched, "match_text", "left")
    return add_conflict_flag(joined.withColumn("rule_match_cnt", F.coalesce("rule_match_cnt", F.lit(0))))


def rule_usage(classified: DataFrame) -> DataFrame:
    """Per rule: transactions it matched, won, and lost to an earlier rule."""
    return (
        classified.groupBy("rule_hits").agg(F.count("*").alias("txns"))
        .select("txns", F.get("rule_hits", F.lit(0)).alias("winner"), F.explode_outer("rule_hits").alias("rule_name"))
        .where(F.col("rule_name").isNotNull())
        .groupBy("rule_name")
        .agg(
            F.sum("txns").alias("matched_txns"),
            F.sum(F.when(F.col("rule_name") == F.col("winner"), F.col("txns")).otherwise(0)).alias("won_txns"),
            F.sum(F.when(F.col("rule_name") != F.col("winner"), F.col("txns")).otherwise(0)).alias("shadowed_txns"),
        )
    )


def hierarchy_check(classified: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Every (L1, L2, L3) that rules assign or the hierarchy lists, with the
    transactions it got and whether it is a listed leaf and an assigned one."""
    used = (
        classified.where(F.col("rule_l1").isNotNull())
        .groupBy("rule_l1", "rule_l2", "rule_l3").agg(F.count("*").alias("txn_cnt"))
    )
    same = (
        (F.col("rule_l1") == F.col("ref_l1")) & (F.col("rule_l2") == F.col("ref_l2"))
        & (F.col("rule_l3") == F.col("ref_l3"))
    )
    return used.join(hierarchy, same, "full").select(
        F.coalesce("rule_l1", "ref_l1").alias("l1"),
        F.coalesce("rule_l2", "ref_l2").alias("l2"),
        F.coalesce("rule_l3", "ref_l3").alias("l3"),
        F.coalesce("txn_cnt", F.lit(0)).alias("txn_cnt"),
        flag(F.col("ref_l1").isNotNull()).alias("in_hierarchy"),
        flag(F.col("rule_l1").isNotNull()).alias("is_assigned"),
    )


def rules_outside_hierarchy(rules: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Rules whose triple the hierarchy does not list."""
    return rules.join(hierarchy, [
        rules.rule_l1 == hierarchy.ref_l1, rules.rule_l2 == hierarchy.ref_l2,
        rules.rule_l3 == hierarchy.ref_l3], "left_anti")


def leaves_without_rule(rules: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Hierarchy leaves that no rule assigns."""
    return hierarchy.join(rules, [
        rules.rule_l1 == hierarchy.ref_l1, rules.rule_l2 == hierarchy.ref_l2,
        rules.rule_l3 == hierarchy.ref_l3], "left_anti")
