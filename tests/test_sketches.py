"""Sketches that roll up, against exact counts."""

import pytest
from pyspark.sql import functions as F

from spendlens.operators import sketches

SCHEMA = "CUST_NUM long, txn_month date, txn_date date, merchant_key string, tax_l1 string, tax_l2 string, tax_l3 string, " \
         "mcht_nm_norm string, txn_amount double"


@pytest.fixture(scope="module")
def txns(spark):
    """One merchant of 60,000 customers, and customers of very few rows."""
    return spark.range(120_000).selectExpr(
        "cast(id % 60000 as long) as CUST_NUM", "add_months(date'2024-01-01', cast(id % 12 as int)) as txn_month",
        "date_add(date'2024-01-01', cast(id % 300 as int)) as txn_date", "concat('m', id % 500) as merchant_key",
        "if(id % 7 = 0, null, concat('a', id % 3)) as tax_l1", "'b' as tax_l2", "cast(null as string) as tax_l3",
        "if(id % 10 = 0, 'small', 'big') as mcht_nm_norm", "if(id % 11 = 0, null, cast(id as double) / 100) as txn_amount")


def test_merged_sketches_are_as_near_as_stated(txns):
    stored = sketches.month_sketches(txns, "mcht_nm_norm", sketches.MERCHANT_SETS)
    rolled = sketches.roll_up(stored, ["mcht_nm_norm", F.trunc("txn_month", "year").alias("year")], sketches.MERCHANT_SETS)
    exact = txns.groupBy("mcht_nm_norm").agg(
        F.count_distinct("CUST_NUM").alias("n"), F.sum("txn_amount").alias("sum"), F.percentile("txn_amount", F.lit(0.9)).alias("p90"))
    rows = rolled.join(exact, "mcht_nm_norm").select(
        "n", sketches.distinct("customers").alias("near"), sketches.distinct_bound(F.col("n")).alias("bound"),
        "spend", "sum", sketches.quantile("amounts", 0.9).alias("q"), "p90").collect()
    assert len(rows) == 2 and max(r["n"] for r in rows) > 50_000
    for r in rows:
        assert abs(r["near"] - r["n"]) <= r["bound"] < r["n"] / 10
        assert r["spend"] == pytest.approx(r["sum"], abs=0.001)
        assert abs(r["q"] - r["p90"]) < sketches.RANK_BOUND * 1200


def test_small_counts_are_exact_and_nulls_are_empty(spark, txns):
    stored = sketches.month_sketches(txns.where("CUST_NUM < 50"), "CUST_NUM", sketches.CUSTOMER_SETS)
    rolled = sketches.roll_up(stored, ["CUST_NUM"], sketches.CUSTOMER_SETS)
    exact = txns.groupBy("CUST_NUM").agg(*[F.count_distinct(c).alias(f"{n}_cnt") for n, c in sketches.CUSTOMER_SETS.items()])
    for row in rolled.join(exact, "CUST_NUM").select(
            *[(sketches.distinct(n) == F.col(f"{n}_cnt")).alias(n) for n in sketches.CUSTOMER_SETS]).collect():
        assert all(row)
    nothing = sketches.month_sketches(txns.where("txn_amount is null").limit(3), "CUST_NUM", {"l3": "tax_l3"})
    assert {tuple(r) for r in nothing.select(sketches.distinct("l3"), sketches.quantile("amounts", 0.5), "spend").collect()} == {
        (0, None, None)}
