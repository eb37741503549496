"""Features of a customer's months in order: rolling frames, changes, regimes.

Every window here is over one customer's months, a few dozen rows at most, and
looks at the current and earlier months only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import flag, flags_by, label_by, labels_by, mean_of, money, spread, squared, sum_money, units
from ..functions.columns import MONEY_UNITS

def months():
    return Window.partitionBy("CUST_NUM").orderBy("txn_month")


def rows(count: int):
    """The current month and the ``count - 1`` months with data before it."""
    return months().rowsBetween(1 - count, 0)


# Monthly columns whose average over three months is kept
AVERAGED_3M = [
    "online_share", "xborder_share", "wallet_share", "premium_share", "merchant_entropy",
    "grocery_share", "late_night_share", "weekend_share", "ride_hailing_share",
    "food_delivery_share",
]


def _stability(frame) -> Column:
    spend = units("spend_amt_m")
    count, total = F.count("spend_amt_m").over(frame), F.sum(spend).over(frame)
    deviation = spread(count, total, F.sum(squared(spend)).over(frame)) / float(MONEY_UNITS)
    return F.when(total > 0, deviation / mean_of(money(total), count))


def add_rolling(df: DataFrame) -> DataFrame:
    """Sums, averages and spread over 3, 6 and 12 months."""
    columns: dict[str, Column] = {}
    for count in (3, 6, 12):
        columns[f"spend_amt_{count}m"] = sum_money("spend_amt_m", rows(count))
        columns[f"txn_cnt_{count}m"] = F.sum("txn_cnt_m").over(rows(count))
    for name in AVERAGED_3M:
        columns[f"{name}_3m"] = F.avg(f"{name}_m").over(rows(3))
    mean_3m = mean_of(sum_money("spend_amt_m", rows(3)), F.count("spend_amt_m").over(rows(3)))
    columns |= {
        "spend_stability_6m": _stability(rows(6)),
        "spend_stability_12m": _stability(rows(12)),
        "dominant_ecosystem_freq_3m": F.count("dominant_ecosystem").over(rows(3)),
        "spend_vs_3m_avg_ratio": F.when(mean_3m > 0, F.col("spend_amt_m") / mean_3m),
    }
    return df.withColumns(columns).withColumns({
        f"avg_ticket_{count}m": F.when(
            F.col(f"txn_cnt_{count}m") > 0, F.col(f"spend_amt_{count}m") / F.col(f"txn_cnt_{count}m")
        ).otherwise(F.lit(0.0))
        for count in (3, 12)
    })


# Change column -> (monthly column, column for its previous value)
CHANGES = {
    "spend_velocity_m": ("spend_amt_m", "spend_prev_m"),
    "txn_cnt_velocity_m": ("txn_cnt_m", "txn_cnt_prev_m"),
    "avg_ticket_change_m": ("avg_ticket_m", "avg_ticket_prev_m"),
    "online_share_slope_m": ("online_share_m", "online_share_prev_m"),
    "xborder_share_slope_m": ("xborder_share_m", "xborder_share_prev_m"),
    "wallet_share_slope_m": ("wallet_share_m", "wallet_share_prev_m"),
    "premium_share_slope_m": ("premium_share_m", "premium_share_prev_m"),
    "entropy_trend_m": ("merchant_entropy_m", "merchant_entropy_prev_m"),
    "ecosystem_hhi_change_m": ("ecosystem_hhi_m", "ecosystem_hhi_prev_m"),
    "merchant_hhi_change_m": ("merchant_hhi_m", "merchant_hhi_prev_m"),
}


def add_trends(df: DataFrame) -> DataFrame:
    """Previous values, changes (a missing previous month counts as 0),
    acceleration, migration and diversification."""
    previous = {before: F.lag(now).over(months()) for now, before in CHANGES.values()}
    lagged = df.withColumns({**previous, "dominant_ecosystem_prev_m": F.lag("dominant_ecosystem").over(months())})
    last = F.col("spend_prev_m")
    changed = lagged.withColumns({
        **{change: F.col(now) - F.coalesce(F.col(before), F.lit(0)) for change, (now, before) in CHANGES.items()},
        "spend_pct_change_m": F.when(last > 0, (F.col("spend_amt_m") - last) / last),
        "l1_migration_flag": flag(F.col("dominant_ecosystem_prev_m") != F.col("dominant_ecosystem")),
    })
    trend = F.col("entropy_trend_m")
    return changed.withColumns({
        "spend_velocity_prev_m": F.lag("spend_velocity_m").over(months()),
        "diversification_flag": label_by([("DIVERSIFYING", trend > 0.2), ("CONCENTRATING", trend < -0.2)], "STABLE"),
    }).withColumn(
        "spend_acceleration_m",
        F.col("spend_velocity_m") - F.coalesce(F.col("spend_velocity_prev_m"), F.lit(0.0)))


def add_wallet_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({**labels_by(fv.WALLET_LABELS), **flags_by(fv.WALLET_FLAGS)})


def add_regime(df: DataFrame) -> DataFrame:
    """Spend regime, affluence and dependence labels, and the business proxy."""
    return df.withColumns({
        **labels_by(fv.REGIME_LABELS),
        "financial_services_share_m": F.coalesce("l1_financial_services_share_m", F.lit(0.0)),
    })


def add_risk_flags(df: DataFrame) -> DataFrame:
    """Monitoring flags. They are proxies, not findings about a customer."""
    return df.withColumns(flags_by(fv.RISK_FLAGS))


def add_quality(df: DataFrame) -> DataFrame:
    return df.withColumns(labels_by(fv.QUALITY_LABELS))
