"""Card transactions out of the retail star schema and the event stream."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.text import alternatives

# Merchant descriptors by number, one per line (the last but one is empty)
DESCRIPTORS = """\
GRAB*FOOD #12345 Bangkok
Grab Car BKK
LINE MAN 8812345
FOODPANDA TH
TRUEMONEY WALLET TOPUP
Rabbit LINE Pay
SHOPEE PAY
SHOPEE  TH
LAZADA
PAYPAL *STEAM GAMES
NETFLIX.COM
SPOTIFY P1A2B3
GOOGLE*YOUTUBE PREMIUM
APPLE.COM/BILL
BIG C EXTRA BRANCH 12
LOTUS'S
TOPS MARKET
GOURMET MARKET SIAM PARAGON
7-ELEVEN 004521 BKK
MINI BIG C
MAKRO
PTT STATION 12 TH
SHELL
BOOTS
WATSONS
BUMRUNGRAD HOSPITAL
ABC SKIN CLINIC
SMILE DENTAL CLINIC
CENTRAL WORLD
EMQUARTIER
SIAM PARAGON BANGKOK THAILAND
ICONSIAM
UNIQLO
LOUIS VUITTON
MCDONALD'S
STARBUCKS BR 7
MK RESTAURANT
THAI AIRWAYS
THAI AIRASIA
MARRIOTT HOTEL
AGODA.COM
IKEA
AIS
AIA
OFFICEMATE
KERRY EXPRESS
LUCKY CASINO
MOM AND POP SHOP

Pet Shop Hospital""".split("\n")

# Reference rows of the two source taxonomies
B2K_DDL = "MCHT_CATG string, MCHT_SUB_CATG string, b2k_l1 string, b2k_l2 string, b2k_l3 string"
B2K_ROWS = [
    ("ECONOMY", None, "EVERYDAY_ESSENTIALS", "GROCERY_MODERN", None),
    ("PROMO", None, "SHOPPING_RETAIL", "FASHION", "COMMON_FASHION_BRANDS"),
    ("LARGE", None, "HOME_LIVING", None, None),
    ("ECONOMY", "SUB1", "HEALTH_WELLNESS", "PHARMACY_DRUGSTORE", "PHARMACY_CHAIN"),
    ("PROMO", "SUB1", "ENTERTAINMENT_LEISURE", None, None),
]
MOBIUS_DDL = "SIC_CD_DESC string, MCC_CD string, mobius_l1 string, mobius_l2 string, mobius_l3 string"
MOBIUS_ROWS = [
    ("Brand#1", None, "FOOD_DINING", "RESTAURANTS", None),
    ("Brand#2", None, "SHOPPING_RETAIL", "ELECTRONICS", "ELECTRONICS_RETAIL"),
    ("Brand#3", None, "EDUCATION", None, None),
]


def _descriptor(number: Column) -> Column:
    return F.get(F.array(*[F.lit(d) for d in DESCRIPTORS]), number.cast("int"))


def _spread(df: DataFrame) -> DataFrame:
    """Spread a scan with fewer splits than cores (a small file) over all cores;
    a scan with enough splits is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def card_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Twelve months of card transactions: line items with their order and part."""
    lineitem = _spread(spark.read.parquet(f"{folder}/lineitem.parquet"))
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    part = spark.read.parquet(f"{folder}/part.parquet").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    part_digit = F.col("l_partkey") % 10
    number = (
        F.when(part_digit < 5, F.col("o_custkey") * 7)
        .when(part_digit < 8, F.col("o_custkey") * 3 + 1)
        .otherwise(F.col("o_custkey") + F.col("l_partkey") * 13)
    ) % 50
    days = F.floor(F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date")) / 7)
    hours = F.col("l_partkey") % 24
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    joined = (
        lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
        .join(part, lineitem.l_partkey == part.p_partkey)
        .withColumn("idx", number)
    )
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("TXN_REF"),
        F.col("o_custkey").alias("CUST_NUM"),
        _descriptor(F.col("idx")).alias("MCHT_NM"),
        F.when(F.col("idx").between(10, 13), F.lit(199.0) + F.col("idx"))
        .when(F.col("l_partkey") % 25 == 0, F.col("l_extendedprice") * 0.6)
        .otherwise(F.col("l_extendedprice") * 0.04).alias("TXN_AMT"),
        F.timestamp_seconds(F.unix_timestamp(start) + days * 86400 + hours * 3600).alias("TXN_DT"),
        F.when(F.col("l_linenumber") % 4 != 0, F.col("p_name")).alias("TXN_DESC"),
        F.when(F.col("l_returnflag") == "N", F.lit("THB"))
        .when(F.col("l_returnflag") == "R", F.lit("USD")).alias("CURR_DESC"),
        F.when(F.col("l_linenumber") == 2, F.lit("764"))
        .when(F.col("l_linenumber") == 3, F.lit("")).alias("TXN_CURR_CD"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit("Y"))
        .when(F.col("l_linenumber") % 3 == 1, F.lit("N")).alias("ONLN_FLAG"),
        F.col("p_type").alias("MCHT_CATG"),
        F.lit(None).cast("string").alias("MCHT_SUB_CATG"),
        F.col("p_brand").alias("SIC_CD_DESC"),
        F.col("p_size").cast("string").alias("MCC_CD"),
    )


def event_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One month of card transactions with true timestamps, out of the events."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    number = F.get_json_object("props", "$.k").cast("bigint") % 50
    return events.select(
        F.col("event_id").cast("string").alias("TXN_REF"),
        F.col("user_id").alias("CUST_NUM"),
        _descriptor(number).alias("MCHT_NM"),
        (F.col("value") * 20.0).alias("TXN_AMT"),
        F.col("ts").cast("timestamp").alias("TXN_DT"),
        F.when(F.col("event_type").isin("click", "purchase"), F.lit("Y"))
        .when(F.col("event_type") == "view", F.lit("N")).alias("ONLN_FLAG"),
    )


def landed_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Card transactions that carry a landed taxonomy with placeholder texts."""
    size = F.col("MCC_CD").cast("int")
    return card_transactions(spark, folder).withColumns({
        "taxonomy_l1_final": F.when(size % 5 == 0, F.lit("#N/A")).when(size % 5 == 1, F.lit(""))
        .when(size % 5 == 2, F.lit("SHOPPING_RETAIL")).when(size % 5 == 3, F.lit("EDUCATION")),
        "taxonomy_l2_final": F.when(size % 3 == 0, F.lit("UNCLASSIFIED")).when(size % 3 == 1, F.lit("FASHION"))
        .otherwise(F.lit("null")),
        "taxonomy_l3_final": F.when(size % 2 == 0, F.lit("SPORTSWEAR")).otherwise(F.lit("UNCLASSIFIED")),
    })


def example_of(pattern: str) -> str:
    """A text that the first alternative of a pattern matches."""
    text = alternatives(pattern)[0]
    text = re.sub(r"\(\?![^()]*\)", "", text)
    text = re.sub(r"\((?:\?:)?([^()|]*)(?:\|[^()]*)?\)", r"\1", text)
    text = re.sub(r"\[\\?(.)[^\]]*\]", lambda found: " " if found[1] == "s" else found[1], text)
    text = text.replace("\\b", "").replace("\\s", " ").replace(".*", " ")
    text = re.sub(r"(?<!\\)\.", "x", text)
    return re.sub(r"(?<!\\)[?+*]|\\", "", text)


STRANGERS = 80


def rough_names() -> list[str | None]:
    """For every rule a text that matches it and one without its last letter, merchants no
    rule knows, and no name at all."""
    examples = [example_of(rule[2]) for rule in fv.MERCHANT_RULES] + [example_of(rule[4]) for rule in fv.BROAD_RULES]
    strangers = [f"zq vendor {chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(STRANGERS)]
    return [*examples, *[text[:-1] for text in examples], *strangers, None, ""]


def rough_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Card transactions as a careless source lands them: amounts and dates as text, some of
    them missing or unreadable, refunds, customers without a number, sub-categories, equal
    rows, and merchant names that reach every rule."""
    lineitem = _spread(spark.read.parquet(f"{folder}/lineitem.parquet"))
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    part = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_brand", "p_type")
    names = F.array(*[F.lit(name) for name in rough_names()])
    number = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 31 + F.col("l_partkey")) % len(rough_names())
    cents = F.round(F.col("l_extendedprice") * 4).cast("long")
    amount = F.concat_ws(".", F.floor(cents / 100).cast("string"), F.lpad((cents % 100).cast("string"), 2, "0"))
    days = F.floor(F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date")) / 7).cast("int")
    day = F.date_add(F.lit("2024-01-01").cast("date"), days)
    key = F.col("l_partkey")
    rows = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, key == F.col("p_partkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("TXN_REF"),
        F.when(F.col("l_orderkey") % 11 != 0, F.col("o_custkey") % 200).alias("CUST_NUM"),
        F.get(names, number.cast("int")).alias("MCHT_NM"),
        F.when(key % 29 == 0, F.lit("n/a")).when(key % 13 == 0, F.lit(None))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("-"), amount)).otherwise(amount).alias("TXN_AMT"),
        F.when(key % 17 == 0, F.lit("not a date")).when(key % 19 == 0, F.lit(None)).otherwise(
            F.concat(day.cast("string"), F.lit(" "), F.lpad((key % 24).cast("string"), 2, "0"), F.lit(":00:00"))).alias("TXN_DT"),
        F.when(F.col("l_returnflag") == "N", F.lit("THB")).when(F.col("l_returnflag") == "R", F.lit("USD")).alias("CURR_DESC"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit("Y")).when(F.col("l_linenumber") % 3 == 1, F.lit("0")).alias("ONLN_FLAG"),
        F.col("p_type").alias("MCHT_CATG"),
        F.when(key % 3 == 0, F.lit("SUB1")).when(key % 3 == 1, F.lit("")).alias("MCHT_SUB_CATG"),
        F.col("p_brand").alias("SIC_CD_DESC"),
        F.when(key % 23 == 0, F.lit(2)).otherwise(F.lit(1)).alias("_times"))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times", "_copy")
