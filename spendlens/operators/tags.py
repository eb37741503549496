"""Transaction tags: channel, geography, structure, size and time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import flag, label_by, tier_by


def add_channel_geo(df: DataFrame) -> DataFrame:
    online = F.col("ONLN_FLAG")
    currency = F.coalesce("TXN_CURR_CD", "CURR_DESC", F.lit(""))
    return df.withColumns({
        "channel_tag": label_by([
            ("ONLINE", online.isin("Y", "1")),
            ("OFFLINE", online.isin("N", "0")),
            ("IN_APP", F.col("names_app") == 1),
        ], "UNKNOWN"),
        "geo_tag": label_by([
            ("DOMESTIC", currency.rlike(fv.DOMESTIC_CURRENCY)),
            ("CROSS_BORDER", currency != ""),
        ], "UNKNOWN"),
    })


def add_taxonomy_flags(df: DataFrame) -> DataFrame:
    """Flags that follow from the final taxonomy."""
    l1, l2, l3 = F.col("tax_l1"), F.col("tax_l2"), F.col("tax_l3")
    return df.withColumns({
        "is_marketplace": flag(l2 == "MARKETPLACE_ECOM"),
        "is_mall_ecosystem": flag(l2 == "MALLS_DEPARTMENT"),
        "is_premium_merchant": flag((F.col("names_premium_brand") == 1) | l3.isin(fv.PREMIUM_L3)),
        "is_business_proxy": flag((l1 == "B2B_PROFESSIONAL") | (l2 == "WHOLESALE") | (l3 == "OFFICE_SUPPLY")),
        "is_travel_booking": flag(l2.isin(fv.TRAVEL_BOOKING_L2)),
    })


def add_size_tier(df: DataFrame) -> DataFrame:
    return df.withColumn("txn_size_tier", tier_by(F.col("txn_amount"), fv.SIZE_TIERS, fv.SIZE_TIER_TOP))


def add_risk_adjacent(df: DataFrame) -> DataFrame:
    large = F.col("txn_amount") > fv.LARGE_TOPUP
    return df.withColumn("is_risk_adjacent", flag((F.col("is_topup") == 1) & large))


def add_time_tags(df: DataFrame) -> DataFrame:
    """Hour pattern, week part and payday window. Midnight means that the source
    has no time of day; a missing timestamp has none either."""
    moment, day = F.col("txn_ts"), F.col("txn_date")
    midnight = (F.hour(moment) == 0) & (F.minute(moment) == 0) & (F.second(moment) == 0)
    hour = F.col("hour_of_day")
    timed = df.withColumns({
        "hour_of_day": F.hour(moment),
        "has_real_timestamp": F.when(midnight, F.lit(0)).otherwise(F.lit(1)),
        "txn_dow": F.dayofweek(day),
        "txn_dom": F.dayofmonth(day),
    })
    return timed.withColumns({
        "time_pattern": label_by(
            [("UNKNOWN_TIME", (F.col("has_real_timestamp") == 0) | moment.isNull())]
            + [(name, (hour >= start) & (hour < end)) for name, start, end in fv.HOUR_PATTERNS],
            fv.HOUR_PATTERN_REST),
        "weekpart_tag": label_by([("WEEKEND", F.col("txn_dow").isin(1, 7))], "WEEKDAY"),
        "payday_window_flag": flag((F.col("txn_dom") >= 25) | (F.col("txn_dom") <= 5)),
    })


def add_tags(df: DataFrame) -> DataFrame:
    """All tags of a reconciled transaction."""
    for step in (add_channel_geo, add_taxonomy_flags, add_size_tier, add_time_tags, add_risk_adjacent):
        df = step(df)
    return df
