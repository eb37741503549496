"""Recurrence of a customer at a merchant, from past rows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import flag, label_by, mean_of, money, spread, squared, units
from ..functions.columns import MONEY_UNITS, WIDE
from .history import LEAST_CUTS, SLICE_ROWS, add_carry, add_history_part, history_cuts, previous, running_window

_CARRY = ["history_is_cut", "history_owner", "history_part", "c_rows", "c_n", "c_s1", "c_s2", "c_gaps", "c_gap_sum",
          "c_gap_sq", "c_tail"]


def _with_carry(df: DataFrame, slice_rows: int, least_cuts: int) -> DataFrame:
    sliced = df if "history_part" in df.columns else add_history_part(
        df, history_cuts(df, lambda sample: sample, slice_rows, least_cuts))
    return add_carry(sliced)


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _variation(std: str, mean: str) -> Column:
    """Spread relative to a positive mean; a single value has no spread."""
    return F.when(F.col(mean) > 0, F.coalesce(F.col(std), F.lit(0.0)) / F.col(mean))


def add_history(df: DataFrame, slice_rows: int = SLICE_ROWS, least_cuts: int = LEAST_CUTS) -> DataFrame:
    """Previous visit, visit count, and interval and amount statistics over all
    visits up to this one. Sums are exact and divided last, so neither the cuts nor the
    order of addition show."""
    running = running_window()
    amount = units("txn_amount")
    visits = _with_carry(df, slice_rows, least_cuts).withColumns({
        "prev_txn_dt_merchant": previous("txn_date"),
        "prev_txn_amt_merchant": previous("txn_amount"),
        "merchant_visit_cnt": F.count("*").over(running) + _or_zero("c_rows"),
        "_n": F.count("txn_amount").over(running) + _or_zero("c_n"),
        "_s1": F.coalesce(F.sum(amount).over(running), F.lit(0)) + _or_zero("c_s1"),
        "_s2": (F.coalesce(F.sum(squared(amount)).over(running), F.lit(0)) + _or_zero("c_s2")).cast(WIDE),
    })
    prev_amount = F.col("prev_txn_amt_merchant")
    visits = visits.withColumns({
        "days_since_prev_merchant": F.datediff("txn_date", "prev_txn_dt_merchant"),
        "amt_delta_pct": F.when(prev_amount > 0, F.abs(F.col("txn_amount") - prev_amount) / prev_amount),
    })
    gap = F.col("days_since_prev_merchant")
    visits = visits.withColumns({
        "_gaps": F.count(gap).over(running) + _or_zero("c_gaps"),
        "_gap_sum": F.coalesce(F.sum(gap).over(running), F.lit(0)) + _or_zero("c_gap_sum"),
        "_gap_sq": F.coalesce(F.sum(gap * gap).over(running), F.lit(0)) + _or_zero("c_gap_sq"),
    })
    visits = visits.withColumns({
        "avg_interval_merchant": mean_of(F.col("_gap_sum"), F.col("_gaps")),
        "std_interval_merchant": spread(F.col("_gaps"), F.col("_gap_sum"), F.col("_gap_sq")),
        "avg_amt_merchant": mean_of(money(F.col("_s1")), F.col("_n")),
        "std_amt_merchant": spread(F.col("_n"), F.col("_s1"), F.col("_s2")) / float(MONEY_UNITS),
    })
    return visits.withColumns({
        "cv_interval": _variation("std_interval_merchant", "avg_interval_merchant"),
        "amt_cv_merchant": _variation("std_amt_merchant", "avg_amt_merchant"),
    }).drop(*_CARRY, "_n", "_s1", "_s2", "_gaps", "_gap_sum", "_gap_sq")


def add_recurrence_tags(df: DataFrame) -> DataFrame:
    """Novelty and recurrence class of a visit. An unknown variation counts as 1."""
    first_visit = F.col("prev_txn_dt_merchant").isNull()
    visits, interval = F.col("merchant_visit_cnt"), F.col("avg_interval_merchant")
    interval_cv = F.coalesce("cv_interval", F.lit(1.0))
    amount_cv = F.coalesce("amt_cv_merchant", F.lit(1.0))
    tagged = df.withColumns({
        "merchant_novelty_tag": label_by([("FIRST_TIME", first_visit)], "REPEAT"),
        "recurrence_tag": label_by([
            ("FIRST_TIME", first_visit),
            ("SUBSCRIPTION_LIKE",
             (visits >= 3) & (interval_cv < 0.25) & (amount_cv < 0.15) & interval.between(15, 45)),
            ("RECURRING", (visits >= 2) & (interval_cv < 0.40) & interval.between(10, 60)),
            ("EPISODIC", (visits >= 2) & F.col("days_since_prev_merchant").between(1, 90)),
        ], "IRREGULAR"),
    })
    return tagged.withColumn(
        "subscription_candidate_flag", flag(F.col("recurrence_tag").isin("SUBSCRIPTION_LIKE", "RECURRING")))


def add_recurrence(df: DataFrame, slice_rows: int = SLICE_ROWS, least_cuts: int = LEAST_CUTS) -> DataFrame:
    return add_recurrence_tags(add_history(df, slice_rows, least_cuts))


# What ``add_last3`` takes from earlier rows.
LAST3 = ["prev_txn_dt_same_merchant", "prev_txn_amt_same_merchant", "_date2", "_date3"]


def add_last3(df: DataFrame, slice_rows: int = SLICE_ROWS, least_cuts: int = LEAST_CUTS) -> DataFrame:
    """Dates of the last three visits and the amount of the last one."""
    return _with_carry(df, slice_rows, least_cuts).withColumns({
        "prev_txn_dt_same_merchant": previous("txn_date"),
        "prev_txn_amt_same_merchant": previous("txn_amount"),
        "_date2": previous("txn_date", 2),
        "_date3": previous("txn_date", 3),
    }).drop(*_CARRY)


def add_recurrence_last3(df: DataFrame, slice_rows: int = SLICE_ROWS, least_cuts: int = LEAST_CUTS) -> DataFrame:
    """Second recurrence class, from the last three visits only. An unknown
    variation or amount change counts as too large."""
    return add_last3_tags(add_last3(df, slice_rows, least_cuts))


def add_last3_tags(visits: DataFrame) -> DataFrame:
    """The class from what ``add_last3`` adds; no step of it looks at another row."""
    prev_amount = F.col("prev_txn_amt_same_merchant")
    visits = visits.withColumns({
        "days_since_prev_same_merchant": F.datediff("txn_date", "prev_txn_dt_same_merchant"),
        "_gap2": F.datediff("prev_txn_dt_same_merchant", "_date2"),
        "_gap3": F.datediff("_date2", "_date3"),
        "amt_delta_prev_same_merchant": F.when(
            prev_amount != 0, F.abs(F.col("txn_amount") - prev_amount) / F.abs(prev_amount)),
    })
    gap_names = ["days_since_prev_same_merchant", "_gap2", "_gap3"]
    known = sum((flag(F.col(g).isNotNull()) for g in gap_names), F.lit(0))
    total = sum((F.coalesce(F.col(g), F.lit(0)) for g in gap_names), F.lit(0))
    squares = sum((F.coalesce(F.col(g) * F.col(g), F.lit(0)) for g in gap_names), F.lit(0))
    visits = visits.withColumns({"_known": known, "_sum": total, "_sq": squares})
    count = F.nullif(F.col("_known"), F.lit(0))
    spread = F.greatest(F.col("_sq") - F.col("_sum") * F.col("_sum") / count, F.lit(0.0))
    visits = visits.withColumns({
        "avg_interval_3txns": F.col("_sum") / count,
        "std_interval_3txns": F.when(F.col("_known") > 1, F.sqrt(spread / F.nullif(F.col("_known") - 1, F.lit(0)))),
    })
    interval = F.col("avg_interval_3txns")
    visits = visits.withColumn("cv_interval", F.when(interval > 0, F.col("std_interval_3txns") / interval))
    first_visit = F.col("prev_txn_dt_same_merchant").isNull()
    gap = F.col("days_since_prev_same_merchant")
    interval_cv = F.coalesce("cv_interval", F.lit(999.0))
    change = F.coalesce("amt_delta_prev_same_merchant", F.lit(999.0))
    tagged = visits.withColumns({
        "merchant_novelty_tag": label_by([("FIRST_TIME", first_visit)], "REPEAT"),
        "recurrence_tag": label_by([
            ("FIRST_TIME", first_visit),
            ("SUBSCRIPTION_LIKE", gap.between(20, 45) & (interval_cv < 0.35) & (change < 0.20)),
            ("RECURRING", gap.between(7, 60) & (interval_cv < 0.60)),
            ("IRREGULAR", gap.between(1, 120)),
        ], "EPISODIC"),
    })
    return tagged.withColumn(
        "subscription_candidate_flag", flag(F.col("recurrence_tag").isin("SUBSCRIPTION_LIKE", "RECURRING"))
    ).drop("_date2", "_date3", "_gap2", "_gap3", "_known", "_sum", "_sq")
