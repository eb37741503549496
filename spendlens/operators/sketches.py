"""Mergeable summaries of months: distinct counts and quantiles that roll up.

Distinct counts and medians of a quarter cannot be computed from those of its months. A
sketch can: it is a small binary column, a month's sketches are stored once, and any
coarser grain (quarter, year, merchant, all) merges them without reading transactions.

* Distinct counts: HyperLogLog with ``2**LG_K`` registers. Its standard error is
  1.04 / sqrt(2**LG_K), 1.6 %; below about 200 values it keeps them and is exact but for
  collisions of 26-bit hashes. ``distinct_bound`` states three standard errors, or 1.
* Quantiles: KLL over whole ten-thousandths with parameter ``KLL_K``. Up to that many values
  it is exact; beyond, the rank of an estimate is within ``RANK_BOUND`` of the one asked for.

Sketches of NULL values alone are empty: 0 distinct values, a NULL quantile.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money, sum_money, units

LG_K = 12
KLL_K = 400
RANK_BOUND = 0.02

# Distinct counts that are kept by month, and what they count.
CUSTOMER_SETS = {"days": "txn_date", "merchants": "merchant_key", "l1": "tax_l1", "l2": "tax_l2", "l3": "tax_l3"}
MERCHANT_SETS = {"days": "txn_date", "customers": "CUST_NUM"}


def _countable(column: str, df: DataFrame) -> Column:
    """A value as something a sketch takes."""
    kind = dict(df.dtypes)[column]
    return F.unix_date(column) if kind == "date" else F.col(column) if kind in ("int", "bigint") else F.col(column).cast("string")


def month_sketches(txns: DataFrame, key: str, sets: dict[str, str], lg_k: int = LG_K, kll_k: int = KLL_K) -> DataFrame:
    """Rows, spend, and sketches of a month of each ``key``."""
    return txns.groupBy(key, "txn_month").agg(
        F.count("*").alias("txn_cnt"), sum_money("txn_amount").alias("spend"),
        F.kll_sketch_agg_bigint(units("txn_amount"), kll_k).alias("amounts"),
        *[F.hll_sketch_agg(_countable(column, txns), lg_k).alias(name) for name, column in sets.items()])


def roll_up(sketches: DataFrame, keys: list[str | Column], sets: dict[str, str]) -> DataFrame:
    """The same summary at a coarser grain."""
    return sketches.groupBy(*keys).agg(
        F.sum("txn_cnt").alias("txn_cnt"), sum_money("spend").alias("spend"),
        F.kll_merge_agg_bigint("amounts").alias("amounts"),
        *[F.hll_union_agg(name).alias(name) for name in sets])


def distinct(sketch: str) -> Column:
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0))


def distinct_bound(count: Column, lg_k: int = LG_K) -> Column:
    """How far an estimate of ``count`` values may be off."""
    return F.greatest(F.lit(1.0), count * (3 * 1.04 / math.sqrt(2 ** lg_k)))


def quantile(sketch: str, share: float) -> Column:
    """The amount below which ``share`` of the amounts lie."""
    return F.when(F.kll_sketch_get_n_bigint(sketch) > 0, money(F.kll_sketch_get_quantile_bigint(sketch, F.lit(share))))
