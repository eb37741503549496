"""Recurrence histories: brute force, hot customers, and known patterns."""

import math
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spendlens.operators import merchant, recurrence
from spendlens.operators.broad import add_text_basic, enrich_broad
from spendlens.operators.history import HISTORY, NARROW, SLICE, add_history_part, history_cuts, large_owners
from spendlens.plans import References, enrich
from spendlens.sources import standardize


def transactions(spark, rows):
    """rows: (customer, merchant, amount, time text)."""
    ddl = "ref int, CUST_NUM bigint, MCHT_NM string, TXN_AMT double, TXN_DT string"
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], ddl)
    return merchant.add_merchant_text(standardize(df, ["ref"]))


def random_rows(seed, count=600):
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        # customer 1 at "makro" holds about a third of all rows
        hot = rng.random() < 0.35
        customer = 1 if hot else rng.choice([1, 2, 3, None])
        name = "makro" if hot else rng.choice(["makro", "shell", "ikea", ""])
        amount = None if rng.random() < 0.03 else rng.choice([200.0, round(rng.uniform(-50, 900), 2)])
        # half of the times are exactly on the hour, many at midnight
        clock = rng.choice(["00:00:00", "00:00:00", "05:00:00", f"05:{rng.randint(0, 59):02d}:{rng.randint(0, 59):02d}"])
        when = None if rng.random() < 0.02 else f"2024-{rng.randint(1, 3):02d}-{rng.randint(1, 9):02d} {clock}"
        rows.append((customer, name, amount, when))
    return rows


def plain(df, columns):
    return {row["ref"]: [row[c] for c in columns] for row in df.collect()}


COLUMNS = [
    "prev_txn_dt_merchant", "prev_txn_amt_merchant", "days_since_prev_merchant", "amt_delta_pct",
    "merchant_visit_cnt", "avg_interval_merchant", "std_interval_merchant", "cv_interval", "avg_amt_merchant",
    "std_amt_merchant", "amt_cv_merchant", "merchant_novelty_tag", "recurrence_tag", "subscription_candidate_flag",
]
LAST3 = [
    "prev_txn_dt_same_merchant", "prev_txn_amt_same_merchant", "days_since_prev_same_merchant",
    "amt_delta_prev_same_merchant", "avg_interval_3txns", "std_interval_3txns", "cv_interval", "recurrence_tag",
]


def sliced(txns, slice_rows):
    return add_history_part(txns, history_cuts(txns, lambda sample: sample, slice_rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_cut_histories_are_equal_digit_by_digit(spark, seed):
    txns = transactions(spark, random_rows(seed))
    whole = plain(recurrence.add_recurrence(txns), COLUMNS)
    for slice_rows in (100, 7, 1):
        assert plain(recurrence.add_recurrence(txns, slice_rows=slice_rows), COLUMNS) == whole


@pytest.mark.parametrize("slice_rows", [100, 20])
def test_one_customer_with_most_rows_is_spread_over_slices(spark, slice_rows):
    """No slice holds much more than its share, whoever has the rows."""
    rows = [(1, "makro", float(i), f"2024-01-01 00:00:{i % 60:02d}") for i in range(2000)]
    rows += [(i, "shell", 1.0, "2024-01-02") for i in range(2, 400)]
    txns = transactions(spark, rows)
    parts = sliced(txns, slice_rows)
    sizes = [r["count"] for r in parts.groupBy(*SLICE).count().collect()]
    assert sum(sizes) == 2398 and max(sizes) <= 4 * slice_rows
    assert parts.where("merchant_key = sha2('makro', 256)").select("history_part").distinct().count() > 2000 / slice_rows / 4
    cuts = history_cuts(txns, lambda sample: sample, slice_rows)
    assert cuts.selectExpr("sum(size(history_cuts))").first()[0] <= 2 * 2398 / slice_rows
    # A history is in order over its slices.
    bounds = parts.groupBy(*SLICE).agg(F.min("txn_ts").alias("low"), F.max("txn_ts").alias("high")).orderBy(*SLICE).collect()
    for a, b in zip(bounds, bounds[1:]):
        assert any(a[c] != b[c] for c in HISTORY) or a["high"] <= b["low"]


def test_histories_without_cuts_have_no_carry_branch(spark):
    plan = recurrence.add_history(transactions(spark, random_rows(1)))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_small_histories_are_not_cut(spark):
    """Cuts that fall into histories of a few rows are dropped, and with them the carry."""
    rows = [(i % 300, "shell", 1.0, f"2024-01-0{1 + i % 9}") for i in range(900)]
    txns = transactions(spark, rows)
    assert history_cuts(txns, lambda sample: sample, 50).count() == 0
    assert history_cuts(txns, lambda sample: sample, 50, least=1).count() > 3
    plan = recurrence.add_history(txns, slice_rows=50)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


@pytest.mark.parametrize("step", ["main", "broad"])
def test_rows_move_to_their_history_once_and_narrow(spark, step):
    """Derived columns are made where the rows arrive, not carried there."""
    source = spark.createDataFrame(
        [(i, 1, "makro", 1.0, "2024-01-02") for i in range(20)], "ref int, CUST_NUM bigint, MCHT_NM string, TXN_AMT double, TXN_DT string")
    df = enrich(source, References.empty(spark), key_columns=["ref"]) if step == "main" else enrich_broad(source, ["ref"])
    execution = df._jdf.queryExecution()
    lines = execution.optimizedPlan().toString().splitlines()
    moved = [below for line, below in zip(lines, lines[1:]) if "RepartitionByExpression" in line]
    assert len(moved) == 1 and "mcht_nm_norm" in moved[0]
    assert not any(f" AS {name}#" in moved[0] for name in ("txn_key", "match_text", "txn_month", "txn_amount"))
    exchanges = [line for line in execution.executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert len([line for line in exchanges if "history_owner" in line]) == 1
    assert not any("match_text" in line for line in exchanges)
    assert sorted(r["ref"] for r in df.select("ref").collect()) == list(range(20))


def test_rows_of_a_broad_run_are_laid_out_by_month_while_narrow(spark):
    """A written run moves the same narrow rows once more, and the write does not move them again."""
    rows = [(i, i % 3, f"makro {i % 2}", float(i), f"2024-0{1 + i % 4}-0{1 + i % 5}") for i in range(60)] + [(60, None, None, None, None)]
    source = spark.createDataFrame(rows, "ref int, CUST_NUM bigint, MCHT_NM string, TXN_AMT double, TXN_DT string")
    df = enrich_broad(source, ["ref"], by_month=True)
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    moved = [below for line, below in zip(lines, lines[1:]) if "RebalancePartitions" in line]
    assert len(moved) == 1 and "prev_txn_dt_same_merchant" in moved[0]
    assert not any(f" AS {name}#" in moved[0] for name in ("txn_key", "merchant_key", "match_text", "tax_l1"))
    plain_df = enrich_broad(source, ["ref"])
    assert df.columns and set(df.columns) == set(plain_df.columns)
    assert sorted(map(str, df.select(*plain_df.columns).collect())) == sorted(map(str, plain_df.collect()))


@pytest.mark.parametrize("step", ["main", "broad"])
def test_source_is_read_and_cleaned_once(spark, step):
    """Cuts, texts and rows come from one stored copy, which holds the cleaned texts."""
    source = spark.createDataFrame(
        [(i, i % 3, "makro 77", 1.0, "2024-01-02") for i in range(20)],
        "ref int, CUST_NUM bigint, MCHT_NM string, TXN_AMT double, TXN_DT string")
    df = enrich(source, References.empty(spark), key_columns=["ref"]) if step == "main" else enrich_broad(source, ["ref"])
    plan = df.select("merchant_key", "tax_l1", "recurrence_tag")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "LogicalRDD [ref" not in plan


def test_a_large_customer_with_many_merchants_is_spread_over_tasks(spark):
    """No history is cut, so rows go by customer, but for those of the large customer."""
    txns = transactions(spark, [(1 if i % 2 else i, f"shop {chr(97 + i % 26)}", 1.0, "2024-01-02") for i in range(2000)])
    large = large_owners(txns, 200)
    assert [r["history_owner"] for r in large.collect()] == ["1"]
    assert large_owners(txns, 10_000) is None
    parts = add_history_part(txns, history_cuts(txns, lambda sample: sample, 10_000), large)
    one = parts.where("CUST_NUM = 1")
    assert one.select("history_part").distinct().count() == one.select("merchant_key").distinct().count() == 13
    assert parts.where("CUST_NUM <> 1 and history_part <> 0").count() == 0
    assert parts.groupBy(*HISTORY).agg(F.count_distinct("history_part").alias("n")).where("n > 1").count() == 0


def test_cut_histories_have_the_same_last_three(spark):
    txns = add_text_basic(transactions(spark, random_rows(3)))
    whole = plain(recurrence.add_recurrence_last3(txns), LAST3)
    for slice_rows in (30, 1):
        assert plain(recurrence.add_recurrence_last3(txns, slice_rows=slice_rows), LAST3) == whole


def test_history_equals_brute_force(spark):
    df = transactions(spark, [r for r in random_rows(4) if r[2] is not None and r[3] is not None])
    rows = recurrence.add_recurrence(df).collect()
    groups = defaultdict(list)
    for row in rows:
        groups[row["CUST_NUM"], row["mcht_nm_norm"]].append(row)
    for group in groups.values():
        group.sort(key=lambda r: (r["txn_date"], r["txn_ts"], r["txn_key"]))
        gaps, amounts, before = [], [], None
        for place, row in enumerate(group, 1):
            amounts.append(row["txn_amount"])
            if before is not None:
                gaps.append((row["txn_date"] - before["txn_date"]).days)
                assert row["prev_txn_amt_merchant"] == before["txn_amount"]
            assert row["merchant_visit_cnt"] == place
            close(row["avg_interval_merchant"], statistics.fmean(gaps) if gaps else None)
            close(row["std_interval_merchant"], statistics.stdev(gaps) if len(gaps) > 1 else None)
            close(row["avg_amt_merchant"], statistics.fmean(amounts))
            close(row["std_amt_merchant"], statistics.stdev(amounts) if place > 1 else None)
            before = row


@pytest.mark.parametrize("all_keys", ["true", "false"])
def test_slices_of_a_history_are_shuffled_apart(spark, all_keys):
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", all_keys)
    df = recurrence.add_history(transactions(spark, random_rows(6, 200)), slice_rows=5)
    plan = df._jdf.queryExecution().executedPlan()
    spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    detail = [line for line in plan.toString().splitlines() if "Exchange hashpartitioning(history_owner" in line][0]
    assert "history_part" in detail


def test_narrow_rows_move_once_for_their_state_and_themselves(spark):
    """Both sides of the join read one shuffle of the rows, whether their keys are texts or bytes;
    histories without cuts, which it holds as well, come out as ever."""
    txns = transactions(spark, random_rows(4, 300) + [(5, "lotus", 10.0 + i, f"2024-01-0{1 + i}") for i in range(5)])
    columns = ["merchant_visit_cnt", "prev_txn_dt_merchant", "std_interval_merchant", "amt_cv_merchant"]

    def found(df):
        return sorted(map(str, df.select("txn_key", *columns).collect()))

    narrow = txns.select(*sorted(NARROW))
    stored = narrow.withColumns({key: F.unhex(key) for key in ("txn_key", "merchant_key")})
    whole = found(recurrence.add_history(txns))
    for rows in (narrow, stored):
        cut = recurrence.add_history(rows, slice_rows=20)
        assert history_cuts(rows, lambda sample: sample, 20).count() > 0
        if rows is stored:
            cut = cut.withColumn("txn_key", F.lower(F.hex("txn_key")))
        cut = cut.select("txn_key", *columns)
        assert sorted(map(str, cut.collect())) == whole
        final = cut._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        moves = [line for line in final.splitlines() if "Exchange hashpartitioning(history_owner" in line]
        assert sorted("ReusedExchange" in line for line in moves) == [False, True]


def close(got, want):
    assert (got is None) == (want is None)
    assert want is None or math.isclose(got, want, rel_tol=1e-9, abs_tol=1e-6)


def tags(spark, rows):
    df = recurrence.add_recurrence(transactions(spark, rows))
    return [r["recurrence_tag"] for r in df.orderBy("txn_date", "ref").collect()]


def test_known_patterns(spark):
    monthly = [(1, "netflix", 199.0, f"2024-0{m}-05 10:00:00") for m in range(1, 5)]
    assert tags(spark, monthly) == ["FIRST_TIME", "RECURRING", "SUBSCRIPTION_LIKE", "SUBSCRIPTION_LIKE"]
    assert tags(spark, [(1, "a", 1.0, "2024-01-01"), (1, "a", 9.0, "2024-01-31")]) == ["FIRST_TIME", "RECURRING"]
    assert tags(spark, [(1, "a", 1.0, "2024-01-01"), (1, "a", 1.0, "2024-01-01")]) == ["FIRST_TIME", "IRREGULAR"]
    assert tags(spark, [(1, "a", 1.0, "2024-01-01"), (1, "a", 1.0, "2024-04-30")]) == ["FIRST_TIME", "IRREGULAR"]
    assert tags(spark, [(1, "a", 1.0, "2024-01-01"), (1, "a", 1.0, "2024-03-31")]) == ["FIRST_TIME", "EPISODIC"]


def test_layout_does_not_matter(spark):
    txns = transactions(spark, random_rows(5))
    shuffled = txns.orderBy(F.rand(7)).repartition(13)
    assert plain(recurrence.add_recurrence(shuffled, slice_rows=50), COLUMNS) == plain(
        recurrence.add_recurrence(txns), COLUMNS)
