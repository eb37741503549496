"""The small variant: a handful of features and four personas per month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import flag, label_by, sum_money, tier_by
from .monthly import MONTH
from .trends import months


def add_simple_tags(df: DataFrame) -> DataFrame:
    tagged = df.withColumns({
        "merchant_norm": F.lower(F.trim(F.regexp_replace("MCHT_NM", r"\s+", " "))),
        "channel_tag": label_by([
            ("ONLINE", F.col("ONLN_FLAG") == "Y"), ("OFFLINE", F.col("ONLN_FLAG") == "N")], "UNKNOWN"),
        "txn_size_tier": tier_by(F.col("txn_amount"), fv.SIMPLE_SIZE_TIERS, fv.SIMPLE_SIZE_TIER_TOP),
    })
    return tagged.withColumn("wallet_topup_flag", flag(F.col("merchant_norm").rlike(fv.SIMPLE_WALLET)))


def simple_personas(tagged: DataFrame) -> DataFrame:
    """One aggregate per merchant and one over them gives all features: counts and
    sums add up, and the entropy needs only the merchant sums."""
    amount = F.col("txn_amount")
    merchants = tagged.groupBy(*MONTH, "merchant_norm").agg(
        F.count("*").alias("visits"),
        F.count(amount).alias("priced"),
        sum_money(amount).alias("spend"),
        sum_money(F.when(F.col("channel_tag") == "ONLINE", amount).otherwise(0.0)).alias("online"),
        F.sum("wallet_topup_flag").alias("wallets"),
    )
    total, spend = sum_money("spend"), F.col("spend")

    def entropy(size: Column) -> Column:
        """Sum of -p*log2(p) over the merchants with a positive ``size``."""
        logged = F.sum(F.when(size > 0, size * F.log2(size)).otherwise(0.0))
        return (F.log2(F.abs(total)) * sum_money(F.when(size > 0, size).otherwise(0.0)) - logged) / F.abs(total)

    features = merchants.groupBy(*MONTH).agg(
        F.sum("visits").alias("txn_cnt_m"),
        total.alias("spend_amt_m"),
        (total / F.nullif(F.sum("priced"), F.lit(0))).alias("avg_ticket_m"),
        F.count("merchant_norm").alias("uniq_merchants_m"),
        sum_money("online").alias("online_spend_m"),
        F.sum("wallets").alias("wallet_txn_cnt"),
        # Shares p = spend/total are positive where spend and total have one sign.
        F.when(total > 0, entropy(spend)).when(total < 0, entropy(-spend)).alias("merchant_entropy"),
    )
    moved = features.withColumn("spend_prev_m", F.lag("spend_amt_m").over(months()))
    return moved.withColumns({
        "spend_velocity": F.col("spend_amt_m") - F.col("spend_prev_m"),
        "primary_persona": label_by([
            ("DIGITAL_NATIVE", F.col("online_spend_m") > 0.6 * F.col("spend_amt_m")),
            ("LOYAL_SPENDER", F.col("merchant_entropy") < 1.2),
            ("PREMIUM_AFFLUENT", F.col("avg_ticket_m") > 5000)], "EVERYDAY_ANCHOR"),
    })
