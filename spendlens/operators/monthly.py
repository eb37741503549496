"""Customer-month activity: aggregates of the enriched transactions.

All sums, counts and category pivots of a customer-month are plain aggregates of
one ``groupBy``, combined on the map side: a customer with a third of all rows
leaves each task as one row per month. Pivots have fixed value lists and a
remainder, distinct days and platforms are counted in bit masks, and distinct
categories from sums per category, so there is no pivot job and no row expansion.
Callers select what they need; Spark drops the aggregates nobody reads.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import flag, mean_of, money, money_when, share_of, spread, sql_text, squared, sum_money, units
from ..functions.columns import MONEY_UNITS

MONTH = ["CUST_NUM", "txn_month"]
# The same keys as columns that are never NULL: a value or its type's default, and whether it is missing.
PLAIN_MONTH = [name for key in MONTH for name in (f"_{key}", f"_no_{key}")]
_DEFAULTS = {"string": "", "date": "1970-01-01"}
_MASK_BITS = 62


@dataclass
class Labels:
    """The category labels that get a spend column of their own. Spend on any other
    label is kept in ``l1_remainder_spend_m``; distinct counts and concentration do
    not depend on the list."""

    l1: list[str] = field(default_factory=list)
    l2: list[str] = field(default_factory=list)
    l3: list[str] = field(default_factory=list)

    @classmethod
    def of(cls, rules: list[tuple] | None = None, triples: list[tuple] = ()) -> "Labels":
        """Labels of the hierarchy, of the rules and of further (L1, L2, L3) triples."""
        every = [*fv.HIERARCHY, *[rule[3:] for rule in rules or fv.MERCHANT_RULES], *triples]
        return cls(*[sorted({v for v in values if v} | {fv.UNCLASSIFIED}) for values in zip(*every)])


def add_plain_months(df: DataFrame) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({name: column for key in MONTH for name, column in (
        (f"_{key}", F.coalesce(key, F.lit(_DEFAULTS.get(types[key], "0")).cast(types[key]))),
        (f"_no_{key}", F.col(key).isNull()))})


def restore_months(df: DataFrame) -> DataFrame:
    """Customer and month again, NULL where they are missing, beside the plain keys."""
    return df.withColumns({key: F.when(~F.col(f"_no_{key}"), F.col(f"_{key}")) for key in MONTH})


def per_month(df: DataFrame, *measures: Column) -> DataFrame:
    """One row per customer-month. It is grouped by the plain keys and keeps them, so that
    ``join_months`` finds the rows of several aggregates where their shuffles left them; a
    null-safe join would move each of them once more."""
    return restore_months(add_plain_months(df).groupBy(*PLAIN_MONTH).agg(*measures))


def join_months(left: DataFrame, right: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Left join of aggregates that also joins NULL customers and months. Aggregates that
    ``per_month`` made are joined by their plain keys, which the result keeps."""
    if not keys and all(key in df.columns for df in (left, right) for key in PLAIN_MONTH):
        renamed = right.drop(*MONTH).withColumnsRenamed({key: f"_right{key}" for key in PLAIN_MONTH})
        same = [F.col(key) == F.col(f"_right{key}") for key in PLAIN_MONTH]
        return left.join(renamed, same, "left").drop(*[f"_right{key}" for key in PLAIN_MONTH])
    keys = keys or MONTH
    renamed = right.drop(*PLAIN_MONTH).withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    return left.join(renamed, same, "left").drop(*[f"_right_{key}" for key in keys])


def spend_column(level: str, label: str) -> str:
    return f"{level}_{label.lower()}_spend_m"


def share_column(level: str, label: str) -> str:
    return f"{level}_{label.lower()}_share_m"


def count_labels(column: str, labels: list[str]) -> Column:
    """Exact distinct count of a column over a closed label list."""
    counts = []
    for start in range(0, len(labels), _MASK_BITS):
        places = ", ".join(
            f"{sql_text(label)}, shiftleft(1L, {place})" for place, label in enumerate(labels[start:start + _MASK_BITS]))
        counts.append(F.coalesce(F.bit_count(F.expr(f"bit_or(map({places})[{column}])")), F.lit(0)))
    total = counts[0]
    for more in counts[1:]:
        total = total + more
    return total


# Spend columns by name: the tag and its value whose transactions they add up.
SPENDS = {
    "online_spend_m": ("channel_tag", "ONLINE"),
    "offline_spend_m": ("channel_tag", "OFFLINE"),
    "inapp_spend_m": ("channel_tag", "IN_APP"),
    "domestic_spend_m": ("geo_tag", "DOMESTIC"),
    "xborder_spend_m": ("geo_tag", "CROSS_BORDER"),
    "topup_spend_m": ("is_topup", 1),
    "wallet_spend_m": ("is_wallet", 1),
    "processor_spend_m": ("is_processor_mediated", 1),
    "subscription_spend_m": ("subscription_candidate_flag", 1),
    "weekend_spend_m": ("weekpart_tag", "WEEKEND"),
    "weekday_spend_m": ("weekpart_tag", "WEEKDAY"),
    "premium_spend_m": ("is_premium_merchant", 1),
    "mall_spend_m": ("is_mall_ecosystem", 1),
    "ride_hailing_spend_m": ("is_ride_hailing", 1),
    "grocery_spend_m": ("is_grocery", 1),
    "subscription_pattern_spend_m": ("is_subscription", 1),
    "risky_spend_m": ("is_risky_merchant", 1),
    "business_proxy_spend_m": ("is_business_proxy", 1),
    "food_delivery_spend_m": ("is_food_delivery", 1),
    "morning_spend_m": ("time_pattern", "MORNING_ROUTINE"),
    "lunch_spend_m": ("time_pattern", "LUNCH"),
    "evening_spend_m": ("time_pattern", "EVENING_SOCIAL"),
    "late_night_spend_m": ("time_pattern", "LATE_NIGHT"),
    "payday_window_spend_m": ("payday_window_flag", 1),
}

# Count columns by name: the 0/1 flag they add up.
COUNTS = {
    "topup_txn_cnt_m": "is_topup",
    "wallet_txn_cnt_m": "is_wallet",
    "marketplace_txn_cnt_m": "is_marketplace",
    "mall_txn_cnt_m": "is_mall_ecosystem",
    "premium_txn_cnt_m": "is_premium_merchant",
    "food_delivery_txn_cnt_m": "is_food_delivery",
    "business_proxy_txn_cnt_m": "is_business_proxy",
    "travel_booking_txn_cnt_m": "is_travel_booking",
    "ride_hailing_txn_cnt_m": "is_ride_hailing",
    "subscription_pattern_txn_cnt_m": "is_subscription",
    "grocery_txn_cnt_m": "is_grocery",
    "risky_txn_cnt_m": "is_risky_merchant",
    "subscription_txn_cnt_m": "subscription_candidate_flag",
    "payday_window_txn_cnt_m": "payday_window_flag",
}

# Shares of total spend: the part they relate to it, without its "_spend_m".
SHARES = {
    **{f"{part}_share_m": f"{part}_spend_m" for part in (
        "online", "offline", "inapp", "xborder", "domestic", "topup", "wallet", "premium", "mall",
        "weekend", "subscription", "ride_hailing", "grocery", "food_delivery", "risky",
        "business_proxy", "late_night")},
    "payday_share_m": "payday_window_spend_m",
}

_PLATFORM_SPEND = "_{}_spend"


def month_totals(txns: DataFrame, labels: Labels) -> DataFrame:
    """Every additive number of a customer-month."""
    amount = F.col("txn_amount")
    platforms = [name for name, _ in fv.PLATFORMS]
    platform = F.col("platform_ecosystem")
    totals = per_month(
        txns,
        F.count("*").alias("txn_cnt_m"),
        sum_money(amount).alias("spend_amt_m"),
        mean_of(sum_money(amount), F.count(amount)).alias("avg_ticket_m"),
        F.max(amount).alias("max_ticket_m"),
        F.min(amount).alias("min_ticket_m"),
        (spread(F.count(amount), F.sum(units(amount)), F.sum(squared(units(amount)))) / float(MONEY_UNITS)).alias("stddev_ticket_m"),
        F.coalesce(F.bit_count(F.expr("bit_or(shiftleft(1L, txn_dom))")), F.lit(0)).alias("active_days_m"),
        *[money_when(F.col(tag) == value).alias(name) for name, (tag, value) in SPENDS.items()],
        *[F.sum(name).alias(column) for column, name in COUNTS.items()],
        F.sum(flag(F.col("merchant_novelty_tag") == "FIRST_TIME")).alias("new_merchant_cnt_m"),
        F.sum(flag(F.col("merchant_novelty_tag") == "REPEAT")).alias("repeat_merchant_txn_cnt_m"),
        *[money_when(F.col("tax_l1") == label).alias(spend_column("l1", label)) for label in labels.l1],
        money_when(~F.coalesce(F.col("tax_l1").isin(labels.l1), F.lit(False))).alias("l1_remainder_spend_m"),
        *[money_when(F.col("tax_l2") == label).alias(spend_column("l2", label)) for label in fv.KEY_L2],
        count_labels("platform_ecosystem", platforms).alias("platform_count_m"),
        F.sum(flag(platform != "NONE")).alias("platform_txn_cnt_m"),
        # NULL, not 0.0, where a platform was not used: it cannot be the dominant one.
        *[sum_money(F.when(platform == name, amount)).alias(_PLATFORM_SPEND.format(name)) for name in platforms],
    )
    unfilled = {_PLATFORM_SPEND.format(name) for name in platforms}
    return totals.fillna(0.0, subset=[c for c, t in totals.dtypes if t == "double" and c not in unfilled])


def month_medians(txns: DataFrame) -> DataFrame:
    """Approximate median ticket (exact lower median for small months). Kept out
    of ``month_totals`` so that one stays a generated-code hash aggregate."""
    return per_month(txns, F.percentile_approx("txn_amount", 0.5).alias("median_ticket_m")).fillna(0.0, subset=["median_ticket_m"])


def add_shares(df: DataFrame) -> DataFrame:
    total = F.col("spend_amt_m")
    return df.withColumns({name: share_of(F.col(part), total) for name, part in SHARES.items()})


def add_derived(df: DataFrame) -> DataFrame:
    """Consumption without top-ups, and intensity, repeat and novelty ratios."""
    return df.withColumns({
        "consumption_spend_m": F.greatest(money(units("spend_amt_m") - units("topup_spend_m")), F.lit(0.0)),
        "txn_per_active_day_m": F.when(
            F.col("active_days_m") > 0, F.col("txn_cnt_m") / F.col("active_days_m")).otherwise(F.lit(0.0)),
        "merchant_repeat_ratio_m": F.when(
            F.col("txn_cnt_m") > 0, F.col("repeat_merchant_txn_cnt_m") / F.col("txn_cnt_m")).otherwise(F.lit(0.0)),
        "merchant_novelty_rate_m": F.when(
            F.col("uniq_merchants_m") > 0, F.col("new_merchant_cnt_m") / F.col("uniq_merchants_m")
        ).otherwise(F.lit(0.0)),
    })


def _ranked(entries: list[tuple[Column, str]]) -> Column:
    """(spend, label) pairs by spend, largest first; ties by label, last first."""
    return F.sort_array(F.array_compact(F.array(*[
        F.when(spend.isNotNull(), F.struct(spend.alias("spend"), F.lit(label).alias("label")))
        for spend, label in entries])), asc=False)


def add_ecosystems(df: DataFrame, base: str = "spend_amt_m") -> DataFrame:
    """Ecosystem shares, the two largest ecosystems and the breadth of spend.

    ``base`` is the denominator of the shares: total spend, or
    ``consumption_spend_m`` to leave wallet top-ups out.
    """
    total = F.col(base)
    spends = {label: F.col(spend_column("l1", label)) for label in fv.ECOSYSTEMS}
    ranked = df.withColumn("_ranked", _ranked([(spend, label) for label, spend in spends.items()]))
    first, second = F.col("_ranked")[0], F.col("_ranked")[1]
    return ranked.withColumns({
        "dominant_ecosystem": F.when(first["spend"] > 0, first["label"]).otherwise(F.lit(fv.UNCLASSIFIED)),
        "second_ecosystem": F.when(second["spend"] > 0, second["label"]).otherwise(F.lit("NONE")),
        "top_l1_share": share_of(first["spend"], total),
        **{share_column("l1", label): share_of(spend, total) for label, spend in spends.items()},
        "category_breadth_m": sum(
            (flag(share_of(spend, total) > 0.05) for spend in spends.values()), F.lit(0)),
    }).drop("_ranked")


def add_key_l2_shares(df: DataFrame, base: str = "spend_amt_m") -> DataFrame:
    return df.withColumns({
        share_column("l2", label): share_of(F.col(spend_column("l2", label)), F.col(base)) for label in fv.KEY_L2})


def add_platforms(df: DataFrame) -> DataFrame:
    """Platform spend and share, and the platform with the largest spend."""
    spends = [(F.col(_PLATFORM_SPEND.format(name)), name) for name, _ in fv.PLATFORMS]
    spent = money(sum((F.coalesce(units(spend), F.lit(0)) for spend, _ in spends), F.lit(0)))
    top = F.get(_ranked(spends), F.lit(0))["label"]
    return df.withColumns({
        "platform_spend_m": spent,
        "dominant_platform": F.coalesce(top, F.lit("NONE")),
    }).withColumn("platform_share_m", share_of(F.col("platform_spend_m"), F.col("spend_amt_m"))).drop(
        *[_PLATFORM_SPEND.format(name) for name, _ in fv.PLATFORMS])


def concentration(spend: str) -> Column:
    """Sum of squared shares: one division of two exact sums."""
    total = F.sum(units(spend)).cast("double")
    return F.when(total > 0, F.sum(squared(units(spend))).cast("double") / (total * total)).otherwise(F.lit(0.0))


def label_mix(txns: DataFrame, measures: list[Column] | None = None) -> DataFrame:
    """Distinct categories, and entropy and concentration of spend over all L1 labels
    whatever they are, or other ``measures`` over the ``spend`` of each ``tax_l1``. Rows are
    summed per label first, so the sets hold a few labels, and these sums move to their month
    once, for all steps that follow."""
    parts = add_plain_months(txns).groupBy(*PLAIN_MONTH, "tax_l1", "tax_l2", "tax_l3").agg(
        sum_money("txn_amount").alias("spend")).repartition(*PLAIN_MONTH)
    distinct = {f"uniq_tax_{level}_m": F.array_distinct(F.flatten(F.collect_list(f"{level}s"))) for level in ("l2", "l3")}
    tops = parts.groupBy(*PLAIN_MONTH, "tax_l1").agg(
        sum_money("spend").alias("spend"), F.collect_set("tax_l2").alias("l2s"), F.collect_set("tax_l3").alias("l3s"))
    spend, total = F.col("spend"), sum_money("spend")
    positive = sum_money(F.when(spend > 0, spend).otherwise(0.0))
    logged = F.sum(F.when(spend > 0, spend * F.log2(spend)).otherwise(0.0))
    return restore_months(tops.groupBy(*PLAIN_MONTH).agg(
        F.count("tax_l1").alias("uniq_tax_l1_m"),
        *[F.size(found).cast("long").alias(name) for name, found in distinct.items()],
        *(measures or [
            F.when(total > 0, (F.log2(total) * positive - logged) / total).otherwise(0.0).alias("ecosystem_entropy_m"),
            concentration("spend").alias("ecosystem_hhi_m")]),
    ))
