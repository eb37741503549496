"""Clean-up, rule matching and tags on known and random texts."""

import random

import pytest
from pyspark.sql import functions as F

from spendlens import fixed_values as fv
from spendlens.functions import any_of, clean_text, matching
from spendlens.operators import broad, merchant, rules, tags
from spendlens.operators.rules import RULE_COLUMNS
from spendlens.sources import retail, standardize

# number | normalised | matching rules, best first
GOLDEN = """
0|grab food|GRABFOOD
1|grab car|GRAB_RIDE
2|line man|LINEMAN
3|foodpanda|FOODPANDA
4|truemoney wallet topup|TRUEMONEY
5|rabbit line pay|LINEPAY
6|shopee pay|SHOPEEPAY
7|shopee|SHOPEE
8|lazada|LAZADA
9|paypal steam games|PAYPAL,STEAM
10|netflix.com|NETFLIX
11|spotify p1a2b3|SPOTIFY
12|google youtube premium|YOUTUBE
13|apple.com/bill|APPLE_DIGITAL
14|big c extra|BIGC
15|lotus's|LOTUS
16|tops market|TOPS
17|gourmet market siam paragon|GOURMET_MKT,PARAGON
18|7-eleven|SEVEN11
19|mini big c|BIGC,MINI_BIGC
20|makro|MAKRO
21|ptt|PTT
22|shell|SHELL
23|boots|BOOTS
24|watsons|WATSONS
25|bumrungrad hospital|BUMRUNGRAD,HOSPITAL_GEN
26|abc skin clinic|CLINIC_GEN,COSMETIC_CLIN
27|smile dental clinic|CLINIC_GEN,DENTAL
28|central world|CENTRAL_MALL
29|emquartier|EMPORIUM
30|siam paragon bangkok|PARAGON
31|iconsiam|ICONSIAM
32|uniqlo|UNIQLO
33|louis vuitton|LV
34|mcdonald's|MCDONALDS
35|starbucks|STARBUCKS
36|mk restaurant|MK_REST
37|thai airways|THAI_AIRWAYS
38|thai airasia|AIRASIA
39|marriott hotel|MARRIOTT
40|agoda.com|AGODA
41|ikea|IKEA
42|ais|AIS
43|aia|AIA
44|officemate|OFFICEMATE
45|kerry express|KERRY
46|lucky casino|
47|mom and pop shop|
48||
49|pet shop hospital|HOSPITAL_GEN,PET_VET
"""


def texts_frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "match_text string")


def hits(spark, texts):
    return {r["match_text"]: r["rule_hits"] for r in rules.classify_texts(texts_frame(spark, texts)).collect()}


def test_golden_descriptors(spark):
    rows = [(i, name) for i, name in enumerate(retail.DESCRIPTORS)]
    df = spark.createDataFrame(rows, "number int, name string").withColumn("match_text", clean_text(F.col("name")))
    got = {r["number"]: r for r in rules.classify_texts(df).collect()}
    for line in GOLDEN.strip().splitlines():
        number, text, names = line.split("|")
        row = got[int(number)]
        assert row["match_text"] == text
        assert row["rule_hits"] == [n for n in names.split(",") if n]
        assert row["rule_match_cnt"] == len(row["rule_hits"])
        assert row["matched_rule_name"] == (row["rule_hits"] or [None])[0]


def test_look_ahead_patterns(spark):
    got = hits(spark, ["grabfood", "grabfood grab", "shopee shopee pay", "big cinema", "big cinema big c",
                       "clinic skin", "skin clinic", "the mall group", "the mall", "thai airasia", "เติมเงิน"])
    assert got["grabfood"] == ["GRABFOOD"]
    assert got["grabfood grab"] == ["GRABFOOD", "GRAB_RIDE"]
    assert got["shopee shopee pay"] == ["SHOPEEPAY", "SHOPEE"]
    assert got["big cinema"] == [] and got["big cinema big c"] == ["BIGC"]
    assert got["clinic skin"] == [] and got["skin clinic"] == ["CLINIC_GEN", "COSMETIC_CLIN"]
    assert got["the mall group"] == [] and got["the mall"] == ["THE_MALL"]
    assert got["thai airasia"] == ["AIRASIA"]


def test_matching_equals_rlike(spark):
    """The guarded test gives what the plain regex gives, on random texts made of
    pieces of the patterns."""
    named = [(r[1], r[2]) for r in fv.MERCHANT_RULES]
    named += [(f"flag_{n}", any_of(p)) for n, p in rules.TEXT_FLAGS.items()]
    named += [(f"broad_{i}", r[2]) for i, r in enumerate(broad.RULES)] + fv.PLATFORMS
    pieces = sorted({w for _, p in named for w in "".join(
        c if c.isalnum() or c in "&ก-๙" else " " for c in p.replace("\\s", " ").replace("\\b", " ")).split()})
    rng = random.Random(11)
    texts = {rng.choice(["", " "]).join(rng.choice(pieces) for _ in range(rng.randint(0, 4))) for _ in range(1500)}
    df = texts_frame(spark, texts)
    quick = {r[0]: r[1] for r in df.select("match_text", matching("match_text", named)).collect()}
    slow = df.select("match_text", *[F.col("match_text").rlike(p).alias(f"c{i}") for i, (_, p) in enumerate(named)])
    for row in slow.collect():
        assert quick[row[0]] == [name for (name, _), hit in zip(named, row[1:]) if hit]
    assert sum(map(len, quick.values())) > 1000


def test_join_and_list_matching_agree(spark):
    rows = [(i, d) for i, d in enumerate(retail.DESCRIPTORS)]
    df = spark.createDataFrame(rows, "n int, d string").withColumn("match_text", clean_text(F.col("d")))
    columns = ["n", *RULE_COLUMNS, "rule_match_cnt", "rule_conflict_flag"]
    listed = rules.add_rules(df).select(*columns)
    joined = rules.add_rules_by_join(df, rules.rule_frame(spark)).select(*columns)
    assert sorted(listed.collect()) == sorted(joined.collect())


def test_rules_and_hierarchy(spark):
    rule_table, tree = rules.rule_frame(spark), rules.hierarchy_frame(spark)
    assert (rule_table.count(), tree.count()) == (177, 76)
    outside = {r["priority"] for r in rules.rules_outside_hierarchy(rule_table, tree).collect()}
    assert outside == {240, 241, 242, 243, 244, 245, 246, 247, 251}
    assert rules.leaves_without_rule(rule_table, tree).count() == 9


def test_clean_text_edges(spark):
    cases = {None: "", "": "", "CAFE BANGKOK THAILAND": "cafe bangkok", "SHOP 1234": "shop 1234",
             "SHOP 12345": "shop", "  A*#B  ": "a b", "X BRANCH 12": "x"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", clean_text(F.col("t"))).collect()} == cases


def test_blank_merchant(spark):
    source = spark.createDataFrame([(1, None, 5.0, "2024-01-01")], "CUST_NUM int, MCHT_NM string, TXN_AMT double, TXN_DT string")
    row = merchant.add_merchant_tokens(merchant.add_merchant_text(standardize(source))).first()
    assert row["match_text"] == " | " and row["merchant_brand_root"] == "" and row["merchant_token_cnt"] == 1


@pytest.mark.parametrize("amount,tier", [
    (None, None), (-5.0, "MICRO"), (99.99, "MICRO"), (100.0, "SMALL"), (499.99, "SMALL"), (500.0, "STANDARD"),
    (2000.0, "MID"), (10000.0, "LARGE"), (50000.0, "PREMIUM")])
def test_size_tiers(spark, amount, tier):
    df = spark.createDataFrame([(amount,)], "txn_amount double")
    assert tags.add_size_tier(df).first()["txn_size_tier"] == tier


def test_time_tags(spark):
    cases = {
        None: ("UNKNOWN_TIME", "WEEKDAY", 0), "2024-01-06 00:00:00": ("UNKNOWN_TIME", "WEEKEND", 0),
        "2024-01-07 05:59:00": ("LATE_NIGHT", "WEEKEND", 0), "2024-01-08 06:00:00": ("MORNING_ROUTINE", "WEEKDAY", 0),
        "2024-01-24 09:00:00": ("LATE_MORNING", "WEEKDAY", 0), "2024-01-25 12:00:00": ("LUNCH", "WEEKDAY", 1),
        "2024-01-31 14:00:00": ("AFTERNOON", "WEEKDAY", 1), "2024-01-05 17:00:00": ("EVENING_SOCIAL", "WEEKDAY", 1),
        "2024-01-01 22:00:00": ("LATE_NIGHT", "WEEKDAY", 1),
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").withColumn("txn_ts", F.col("t").cast("timestamp"))
    out = tags.add_time_tags(df.withColumn("txn_date", F.col("txn_ts").cast("date"))).collect()
    assert {r["t"]: (r["time_pattern"], r["weekpart_tag"], r["payday_window_flag"]) for r in out} == cases


def test_channel_and_geography(spark):
    rows = [("Y", 0, "THB", None, "ONLINE", "DOMESTIC"), ("0", 1, "USD", "764", "OFFLINE", "DOMESTIC"),
            (None, 1, "THB", "", "IN_APP", "UNKNOWN"), ("?", 0, "USD", None, "UNKNOWN", "CROSS_BORDER"),
            (None, 0, None, None, "UNKNOWN", "UNKNOWN"), ("1", 0, "Baht", None, "ONLINE", "DOMESTIC")]
    ddl = "ONLN_FLAG string, names_app int, CURR_DESC string, TXN_CURR_CD string, channel string, geo string"
    for row in tags.add_channel_geo(spark.createDataFrame(rows, ddl)).collect():
        assert (row["channel_tag"], row["geo_tag"]) == (row["channel"], row["geo"])


def test_texts_with_nothing_to_replace_are_only_tested(spark):
    """One test for all steps together decides; what it lets through no step would change."""
    rows = ["", " ", "a b", "a  b", "a\tb", " a ", "a br", "br 7 b", "brown", "a th", "th a", "x 12345", "x 1234", "a*b", "a # b",
            "hat yai", "hat  yai", "smooth", "kiosk", "a kiosk12", "\u00a0a", "12345 th", "LOTUS TH ", "chiangmai", None]
    df = spark.createDataFrame([(text,) for text in rows], "t string")
    plain = F.lower(F.trim(F.coalesce("t", F.lit(""))))
    for pattern, replacement in fv.CLEANUP_STEPS:
        plain = F.regexp_replace(plain, pattern, replacement)
    cleaned = df.select(clean_text(F.col("t")).alias("new"), F.trim(plain).alias("old"))
    assert all(row["new"] == row["old"] for row in cleaned.collect())
    assert "RLIKE" in df.select(clean_text(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
