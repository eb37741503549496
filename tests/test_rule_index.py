"""Rules from tables, matched over an index of the literals they require."""

import random

import pytest
from pyspark.sql import functions as F

from spendlens import fixed_values as fv
from spendlens.functions.text import longest_literal, required_literals
from spendlens.operators import rules
from spendlens.operators.broad import RULES as BROAD

COLUMNS = ["match_text", *rules.RULE_COLUMNS, "rule_match_cnt", "rule_conflict_flag"]

TEXTS = [
    "", "a", "ab", "grab food bkk", "grabfood", "grab", "big c extra", "big cinema", "thai airasia", "thai air", "ais", "เซเว่น 7-11",
    "shell | fuel", "mark shop", "sho(p", "foo|bar", "x.y", "xzy", "aaa", "😀😀 netflix", "line man\nnew line", "central the mall group",
    "clinic skin", "smile dental clinic", "lotus's go fresh", "7 eleven 004521", "[en]", "a]b", "q{2}",
]
PATTERNS = [
    "grab", "grab(?!food|\\s?food)", "^a", "b$", "", "a*", "(?i)NETFLIX", "net(flix|work)", "[7-9]", "x.y", "x\\.y", "sho\\(p|foo\\|bar",
    "mar+k", "marks?", "colou?r|shell", "\\bais\\b", "(a|b)c", "(ab)?", "a{2,3}", "line\\sman", "[]|e]n", "\\x61", "\\p{L}{4}", "q\\{2\\}", "a\\]b",
    "เซเว่น", "😀 net", "clinic(?!\\s?skin)", "fuel|", "(?:grab|shell) \\|", "(gr(a|e)b)+", "[^a-z]{3}", "\\QA.B\\E", "the\\s?mall",
]


def by_theta(texts, table):
    """The definition: every text against every rule."""
    best = F.min_by(F.struct("priority", F.col("rule_name").alias("matched_rule_name"), "rule_l1", "rule_l2", "rule_l3"),
                    F.struct("priority", "place"))
    found = texts.join(table, F.expr("match_text rlike regex_pattern"), "left").groupBy("match_text").agg(
        best.alias("best"), F.count("priority").cast("int").alias("rule_match_cnt"))
    return rules.add_conflict_flag(found.select("match_text", "best.*", "rule_match_cnt")).select(COLUMNS)


def rows(df):
    return sorted(map(str, df.select(COLUMNS).collect()))


@pytest.mark.parametrize("listed", ["own", "merchant", "broad"])
def test_index_equals_theta_join(spark, listed):
    chosen = {"own": [(i % 7, f"r{i}", p, "L", "L", f"{i}") for i, p in enumerate(PATTERNS)],
              "merchant": fv.MERCHANT_RULES, "broad": BROAD}[listed]
    texts = spark.createDataFrame([(t,) for t in TEXTS], "match_text string")
    table = rules.rule_frame(spark, chosen)
    assert rows(rules.add_rules_by_join(texts, table)) == rows(by_theta(texts, table))


def test_many_rules_without_a_nested_loop(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(6000)]
    listed = [(rng.randint(1, 500), f"r{i}", rng.choice([w, f"{w}\\s?x|{w[:4]}$", f"^{w}", f"{w[:3]}[0-9]+"]), "L", "L", "L")
              for i, w in enumerate(rng.choice(words) for _ in range(20_000))]
    said = [(" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) + rng.choice(["", " 7", "x", "9"]),) for _ in range(300)]
    texts = spark.createDataFrame(sorted(set(said)), "match_text string")
    table = rules.rule_frame(spark, listed)
    indexed = rules.add_rules_by_join(texts, table)
    plan = indexed._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Sort [rule_id" in plan
    assert rows(indexed) == rows(by_theta(texts, F.broadcast(table)))


@pytest.mark.parametrize("alternative,literal", [
    ("netflix", "netflix"), ("net(flix)", "net"), ("a?bcd", "bcd"), ("abc*d", "ab"), ("abc+d", "abc"), ("ab{0,2}cde", "cde"),
    ("x\\.yz", "x.yz"), ("line\\sman", "line"), ("[abc]de", "de"), ("[]a]de", "de"), ("(a(b)c)?de", "de"), ("(?!no)yes", "yes"),
    ("a.b", "a"), ("\\x61bcd", ""), ("\\p{L}abc", ""), ("(a\\)b)cd", "cd"), ("([)])cd", "cd"), ("", ""), (".*", ""),
])
def test_longest_literal(alternative, literal):
    assert longest_literal(alternative) == literal


def test_required_literals():
    assert required_literals("abc|x?y|de") == ["abc", "y", "de"]
    assert required_literals("abc|.*") == [""] and required_literals("(?i)abc") == [""]
    assert required_literals("(shell|fuel)") == ["shell", "fuel"]


def test_transactions_stay_where_they_are_while_results_are_small(spark):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "match_text string")
    table = rules.rule_frame(spark, fv.MERCHANT_RULES)
    found = rules.add_rules_by_join(texts, table, stored=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert rows(found) == rows(by_theta(texts, table))
