"""Customer-month features that look at single merchants.

All of them start from one compact table, a row per customer, month and merchant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import flag, share_of, sum_money
from ..sources.store import materialize
from .monthly import MONTH, PLAIN_MONTH, add_plain_months, concentration, join_months, per_month, restore_months

MERCHANT = "mcht_nm_norm"
# Monthly transactions of mega, large and long-tail merchants
SCALE_BOUNDS = {"mega": 100_000, "large": 10_000, "longtail": 1_000}
LOYAL_VISITS = 3
TAGS = {"sub": "SUBSCRIPTION_LIKE", "rec": "RECURRING", "epi": "EPISODIC", "irr": "IRREGULAR"}


def merchant_months(txns: DataFrame) -> DataFrame:
    """Spend, visits, recurrence and retention per customer, month and merchant.

    A merchant is retained if it was visited in the calendar month before. The
    history already knows the previous visit of each transaction, so this needs
    no join of a month with the one before.
    """
    amount, tag = F.col("txn_amount"), F.col("recurrence_tag")
    last_month = F.add_months("txn_month", -1)
    seen_before = flag(F.trunc("prev_txn_dt_merchant", "month") == last_month)
    per_tag = [
        aggregate
        for short, name in TAGS.items()
        for aggregate in (
            sum_money(F.when(tag == name, amount)).alias(f"{short}_spend"),
            F.max(flag(tag == name)).alias(f"{short}_seen"),
        )
    ]
    averages = [
        F.avg(F.when(tag == TAGS[short], F.col(column))).alias(f"{short}_{name}")
        for short in ("sub", "rec")
        for name, column in (("interval", "avg_interval_merchant"), ("cv", "cv_interval"))
    ]
    return txns.groupBy(*MONTH, MERCHANT).agg(
        F.count("*").alias("visits"),
        sum_money(amount).alias("spend"),
        F.max(seen_before).alias("retained"),
        *per_tag, *averages,
    )


def merchant_sizes(months: DataFrame) -> DataFrame:
    """Transactions and customers of each merchant per month."""
    return months.groupBy(MERCHANT, "txn_month").agg(
        F.sum("visits").alias("merchant_global_txn_cnt"),
        F.count("*").alias("merchant_global_cust_cnt"),
    )


def add_merchant_sizes(months: DataFrame) -> DataFrame:
    """Join each merchant's monthly size back.

    A mega merchant is a hot join key, already reduced to one row per customer
    and month. The sizes are stored first: while there are few merchants their size is
    known, and the rows of customers stay where they are. Beyond that the sort-merge join
    leaves it to AQE to split the hot partition: the size side has one row per key, so
    replicating it is cheap.
    """
    return join_months(months, materialize(merchant_sizes(months), "merchant_sizes"), [MERCHANT, "txn_month"])


def _entropy(value: str, total: Column) -> Column:
    """Sum of -p*log2(p) over positive p = value/total, from single-pass sums."""
    v = F.col(value)
    plain = sum_money(F.when(v > 0, v).otherwise(0.0))
    logged = F.sum(F.when(v > 0, v * F.log2(v)).otherwise(0.0))
    return F.when(total > 0, (F.log2(total) * plain - logged) / total).otherwise(F.lit(0.0))


def merchant_features(months: DataFrame, bounds: dict[str, int] | None = None) -> DataFrame:
    """Concentration, scale, loyalty, retention and recurrence of a
    customer-month, in one combined aggregate over (sized) merchant rows."""
    bounds = bounds or SCALE_BOUNDS
    spend, visits = F.col("spend"), F.col("visits")
    size = F.col("merchant_global_txn_cnt")
    total = sum_money(spend)
    recurring_rows = F.sum(F.col("sub_seen") + F.col("rec_seen"))
    regular = F.coalesce("sub_spend", F.lit(0.0)) + F.coalesce("rec_spend", F.lit(0.0))

    def mean_over_tags(name: str) -> Column:
        """Average over (merchant, tag) pairs that have the value."""
        values = [F.col(f"{short}_{name}") for short in ("sub", "rec")]
        known = F.sum(sum((flag(v.isNotNull()) for v in values), F.lit(0)))
        added = F.sum(sum((F.coalesce(v, F.lit(0.0)) for v in values), F.lit(0.0)))
        return added / F.nullif(known, F.lit(0))

    def spend_at(condition: Column) -> Column:
        return sum_money(F.when(condition, spend).otherwise(0.0))

    return per_month(
        months,
        F.count("*").alias("merchant_cnt_m"),
        _entropy("spend", total).alias("merchant_entropy_m"),
        concentration("spend").alias("merchant_hhi_m"),
        (F.sum(size * visits) / F.sum(visits)).alias("avg_merchant_scale_m"),
        spend_at(size >= bounds["mega"]).alias("spend_at_mega_merchants_m"),
        spend_at((size >= bounds["large"]) & (size < bounds["mega"])).alias("spend_at_large_merchants_m"),
        spend_at(size < bounds["longtail"]).alias("spend_at_longtail_merchants_m"),
        F.avg(visits).alias("avg_visits_per_merchant_m"),
        F.max(visits).alias("max_visits_per_merchant_m"),
        F.sum(flag(visits >= LOYAL_VISITS)).alias("loyal_merchant_cnt_m"),
        F.sum("retained").alias("retained_merchant_cnt_m"),
        F.sum("sub_seen").alias("subscription_merchant_cnt_m"),
        recurring_rows.alias("recurring_merchant_cnt_m"),
        F.sum("epi_seen").alias("episodic_merchant_cnt_m"),
        F.sum("irr_seen").alias("irregular_merchant_cnt_m"),
        sum_money(F.coalesce("sub_spend", F.lit(0.0))).alias("subscription_like_spend_m"),
        sum_money(regular).alias("recurring_spend_m"),
        mean_over_tags("interval").alias("avg_recurring_interval_m"),
        mean_over_tags("cv").alias("avg_recurring_cv_m"),
    )


def top_merchants(months: DataFrame, k: int = 3) -> DataFrame:
    """Largest merchant spend and the sum of the ``k`` largest, whichever merchant of equal
    spend comes first. Spark keeps only ``k`` rows per customer-month in each task before it
    shuffles."""
    largest = Window.partitionBy(*PLAIN_MONTH).orderBy(F.desc("spend"))
    return restore_months(
        add_plain_months(months).select(*PLAIN_MONTH, "spend")
        .withColumn("rank", F.row_number().over(largest)).where(F.col("rank") <= k)
        .groupBy(*PLAIN_MONTH).agg(
            F.max(F.when(F.col("rank") == 1, F.col("spend"))).alias("top1_merchant_spend_m"),
            sum_money("spend").alias(f"top{k}_merchant_spend_m"),
        )
    )


def add_top_shares(df: DataFrame) -> DataFrame:
    total = F.col("spend_amt_m")
    return df.withColumns({
        "top1_merchant_share_m": share_of(F.col("top1_merchant_spend_m"), total),
        "top3_merchant_share_m": share_of(F.col("top3_merchant_spend_m"), total),
    }).drop("top1_merchant_spend_m")


def add_recurring_shares(df: DataFrame) -> DataFrame:
    total = F.col("spend_amt_m")
    return df.withColumns({
        "recurring_spend_share_m": share_of(F.coalesce("recurring_spend_m", F.lit(0.0)), total),
        "subscription_like_spend_share_m": share_of(F.coalesce("subscription_like_spend_m", F.lit(0.0)), total),
    })


def add_turnover(df: DataFrame) -> DataFrame:
    """Dropped merchants, and turnover, churn and retention against the previous
    calendar month. A customer has one row per month, so the window is small."""
    by_month = Window.partitionBy("CUST_NUM").orderBy("txn_month")
    adjacent = F.lag("txn_month").over(by_month) == F.add_months("txn_month", -1)
    counted = df.withColumn(
        "_before", F.when(adjacent, F.lag("uniq_merchants_m").over(by_month)).otherwise(F.lit(0)))
    before, kept = F.col("_before"), F.col("retained_merchant_cnt_m")
    dropped = F.greatest(before - kept, F.lit(0))
    both = F.col("uniq_merchants_m") + before
    return counted.withColumns({
        "dropped_merchant_cnt_m": dropped,
        "merchant_turnover_rate_m": F.when(both > 0, (F.col("new_merchant_cnt_m") + dropped) / both).otherwise(F.lit(0.0)),
        "merchant_churn_rate_m": F.when(before > 0, dropped / before).otherwise(F.lit(0.0)),
        "merchant_retention_rate_m": F.when(before > 0, kept / before),
    }).drop("_before")


def retained_by_join(txns: DataFrame) -> DataFrame:
    """Retained merchants by joining each month with the one before, for
    transactions without history columns."""
    now = txns.select(*MONTH, MERCHANT).distinct()
    before = now.withColumn("txn_month", F.add_months("txn_month", 1))
    return now.join(before, [*MONTH, MERCHANT]).groupBy(*MONTH).agg(
        F.count("*").alias("retained_merchant_cnt_m"))


def first_seen(txns: DataFrame) -> DataFrame:
    """Merchants that a customer visits in a month for the first time ever."""
    seen = txns.groupBy("CUST_NUM", MERCHANT).agg(F.min("txn_month").alias("txn_month"))
    return seen.groupBy(*MONTH).agg(F.count("*").alias("new_merchant_cnt_m"))
