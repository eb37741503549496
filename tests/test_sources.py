"""Reading, checking and writing tables."""

import os

import pytest
from pyspark.sql import functions as F

from spendlens.operators import rules, taxonomy, trends
from spendlens.operators.broad import standardize_lenient
from spendlens.operators.personas import add_persona, add_persona_shift, add_tenure
from spendlens.plans.enrichment import References
from spendlens.plans.pipeline import Targets, run_all
from spendlens.queries import SIZE_BOUNDS, phase2, references
from spendlens.sources import (
    add_row_ids, append_audit, materialize, read_transactions, retail, scratch_path, standardize, temporaries, write_table)

DDL = "CUST_NUM int, MCHT_NM string, TXN_AMT string, TXN_DT string"


def test_missing_required_column(spark):
    with pytest.raises(ValueError, match="TXN_AMT"):
        standardize(spark.createDataFrame([(1, "a", "2024-01-01")], "CUST_NUM int, MCHT_NM string, TXN_DT string"))


def test_lenient_defaults(spark):
    row = standardize_lenient(spark.createDataFrame([(1,)], "CUST_NUM int")).first()
    assert row["txn_amount"] == 0.0 and row["txn_date"] is not None and row["MCHT_NM"] == ""


def test_bad_values_become_null(spark):
    rows = [(1, "a", "12.5", "2024-02-29 10:11:12"), (1, "a", "x", "nonsense")]
    good, bad = standardize(spark.createDataFrame(rows, DDL)).orderBy(F.col("txn_amount").desc_nulls_last()).collect()
    assert str(good["txn_month"]) == "2024-02-01" and good["txn_amount"] == 12.5
    assert bad["txn_amount"] is None and bad["txn_ts"] is None and bad["CNTRY_CD"] is None


def test_key_is_stable_and_distinct(spark):
    rows = [(i, "a", "1", "2024-01-01") for i in range(50)]
    one = standardize(spark.createDataFrame(rows, DDL)).select("CUST_NUM", "txn_key")
    two = standardize(spark.createDataFrame(rows, DDL).repartition(7)).select("CUST_NUM", "txn_key")
    assert sorted(one.collect()) == sorted(two.collect())
    assert one.select("txn_key").distinct().count() == 50


def test_source_joins(spark):
    rows = [("ECONOMY", None, "Brand#2"), (None, None, None), ("PROMO", "x", "Brand#9")]
    df = spark.createDataFrame(rows, "MCHT_CATG string, MCHT_SUB_CATG string, SIC_CD_DESC string").withColumn(
        "MCC_CD", F.lit("1"))
    blank = spark.createDataFrame(
        [("", None, "EDUCATION", None, None), ("Brand#2", None, "HOME_LIVING", None, None)], retail.MOBIUS_DDL)
    out = taxonomy.add_mobius(taxonomy.add_b2k(df, references(spark).b2k), blank).collect()
    got = {r["MCHT_CATG"]: (r["b2k_l1"], r["mobius_l1"]) for r in out}
    assert got == {"ECONOMY": ("EVERYDAY_ESSENTIALS", "HOME_LIVING"), None: (None, "EDUCATION"), "PROMO": (None, None)}


def test_duplicate_reference_key(spark):
    df = spark.createDataFrame([("ECONOMY", None)], "MCHT_CATG string, MCHT_SUB_CATG string")
    twice = spark.createDataFrame(retail.B2K_ROWS + retail.B2K_ROWS[:1], retail.B2K_DDL)
    with pytest.raises(ValueError, match="more than once"):
        taxonomy.add_b2k(df, twice)


def test_large_dimension_is_not_broadcast(spark):
    from spendlens.sources import attach_dimension
    left, right = spark.range(10).toDF("a"), spark.range(10).toDF("b")
    condition = left["a"] == right["b"]
    small = attach_dimension(left, right, ["b"], condition)
    large = attach_dimension(left, right, ["b"], condition, broadcast_rows=5)
    hint = lambda df: "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert hint(small) and not hint(large)


def test_materialize_uses_the_shared_folder(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    stored = materialize(spark.range(5).toDF("n"), "numbers")
    assert stored.count() == 5 and all(spark.conf.get("spark.checkpoint.dir") in f for f in stored.inputFiles())


def test_audit_table(spark):
    rows = spark.createDataFrame([("P", "m", "1")], "phase string, metric string, metric_value string")
    append_audit(rows, "audit_rows")
    append_audit(rows, "audit_rows")
    assert spark.table("audit_rows").count() == 2


def test_pipeline_end_to_end(spark, folder, tmp_path):
    """All phases to folders and tables, from a stored table, with equal row counts."""
    source = write_table(retail.card_transactions(spark, folder), "card_source", partition_by=None)
    targets = Targets("phase_one", str(tmp_path / "two"), "phase_three", str(tmp_path / "audit"))
    txns, mart, people = run_all(
        spark, read_transactions(spark, "card_source"), targets, references(spark),
        key_columns=["TXN_REF"], bounds=SIZE_BOUNDS)
    assert txns.count() == source.count() and mart.count() == people.count()
    assert {"_processed_dtm", "_phase"} <= set(txns.columns)
    audits = spark.read.parquet(str(tmp_path / "audit"))
    assert {r["phase"] for r in audits.select("phase").distinct().collect()} == {"PHASE1", "PHASE2", "PHASE3"}
    assert spark.table("campaign_ready").count() == mart.count()
    one_month = txns.where("txn_month = date'2024-01-01'")
    assert "PartitionFilters: [isnotnull(txn_month" in one_month._jdf.queryExecution().toString()


def test_empty_references(spark):
    refs = References.empty(spark)
    assert refs.b2k.count() == 0 and "mobius_l3" in refs.mobius.columns


def numbered(df, **sizes):
    return sorted((r["CUST_NUM"] or -1, r["TXN_AMT"], r["txn_copy"], r["txn_row_id"]) for r in add_row_ids(df, **sizes).collect())


def test_row_ids_are_unique_and_stable(spark):
    rows = [(1, "a", "1", "2024-01-01")] * 700 + [(2, "a", "1", "2024-01-01")] * 3 + [(None, "b", None, None)] * 2
    rows += [(i, "c", "2", "2024-01-01") for i in range(10, 60)]
    one = standardize(spark.createDataFrame(rows, DDL).repartition(3))
    two = standardize(spark.createDataFrame(rows[::-1], DDL).repartition(11))
    ids = numbered(one, piece=50)
    assert ids == numbered(two, piece=64) and len({i[3] for i in ids}) == len(rows)
    assert [i[2] for i in ids if i[0] == 1] == list(range(700))
    assert {i[2] for i in ids if i[0] >= 10} == {0}
    assert add_row_ids(one).count() == len(rows) and add_row_ids(one.where("false")).count() == 0


def test_rows_of_one_key_that_differ_get_numbers_in_order(spark):
    rows = [(1, "a", "5", "2024-01-01")] * 4 + [(1, "a", "7", "2024-01-02")] * 2
    df = standardize(spark.createDataFrame(rows, DDL), ["CUST_NUM"])
    assert [i[1:3] for i in numbered(df, piece=3)] == [("5", 0), ("5", 1), ("5", 2), ("5", 3), ("7", 4), ("7", 5)]


@pytest.mark.parametrize("kind", ["path", "table"])
def test_a_run_replaces_the_months_it_touches_and_its_audit(spark, kind):
    name = f"touched_{kind}"
    target = scratch_path(spark, name) if kind == "path" else name
    audit_to = scratch_path(spark, name) if kind == "path" else f"{name}_audit"
    rows = spark.range(60).selectExpr("id", "add_months(date'2024-01-01', cast(id % 3 as int)) as txn_month", "id * 2 as x")
    for some, run in ((rows, "a"), (rows.where("id % 3 = 1").selectExpr("id", "txn_month", "id * 5 as x"), "b"),
                      (rows.where("id % 3 = 1").selectExpr("id", "txn_month", "id * 5 as x"), "b")):
        stored = write_table(some, target, replace_touched=True)
        metrics = some.agg(F.count("*").cast("string").alias("metric_value")).selectExpr("'P1' as phase", "'rows' as metric", "metric_value")
        append_audit(metrics, audit_to, run_id=run)
        append_audit(metrics.withColumn("phase", F.lit("P2")), audit_to, run_id=run)
    got = {r["id"]: r["x"] for r in stored.collect()}
    assert got == {i: i * (5 if i % 3 == 1 else 2) for i in range(60)} and stored.count() == 60
    audits = read_transactions(spark, audit_to, "parquet" if kind == "path" else None)
    assert sorted((r["run_id"], r["phase"], r["metric_value"]) for r in audits.collect()) == [
        ("a", "P1", "60"), ("a", "P2", "60"), ("b", "P1", "20"), ("b", "P2", "20")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"


def test_months_of_a_bucketed_table_are_windowed_without_a_shuffle(spark, folder):
    mart = write_table(phase2(spark, folder), "mart_by_customer", buckets=("CUST_NUM", 8))
    for step in (trends.add_rolling, trends.add_trends, lambda df: add_tenure(add_persona_shift(add_persona(df)))):
        plan = step(mart)._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "Exchange" not in plan
    columns = ["CUST_NUM", "txn_month", "spend_amt_3m", "spend_amt_12m"]
    assert sorted(map(str, mart.select(columns).collect())) == sorted(map(str, phase2(spark, folder).select(columns).collect()))
    again = write_table(phase2(spark, folder).where("month(txn_month) = 2"), "mart_by_customer", replace_touched=True)
    assert again.count() == mart.count() == phase2(spark, folder).count()



def test_copies_of_one_row_are_made_in_many_tasks(spark):
    """Pieces are tiny, so a number of tasks by their size would be one."""
    df = standardize(spark.range(5000).select(
        F.lit(1).alias("CUST_NUM"), F.lit("a").alias("MCHT_NM"), F.lit(1.0).alias("TXN_AMT"), F.lit("2024-01-01").alias("TXN_DT")))
    made = add_row_ids(df, piece=100)
    assert made.select("txn_row_id").distinct().count() == 5000
    assert made.select(F.spark_partition_id().alias("task")).distinct().count() > 4


def test_stored_tables_are_packed(spark):
    files = materialize(spark.range(10), "packed").inputFiles()
    assert files and all(".zstd." in name for name in files)


def test_stored_on_the_way_is_deleted_and_so_are_shuffles(spark):
    """Results of an earlier scope and kept frames stay; the setting of the session comes back."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    spark.conf.set(name, "false")
    before = materialize(spark.range(3), "before")
    with temporaries():
        way = materialize(spark.range(4), "way")
        with temporaries():
            inner = materialize(way, "inner", keep=True)
        kept = materialize(way.join(inner, "id").groupBy("id").count(), "kept", keep=True)
        path = way.inputFiles()[0]
    assert spark.conf.get(name) == "false"
    spark.conf.unset(name)
    assert before.count() == 3 and inner.count() == 4 and kept.count() == 4
    assert not os.path.exists(path.removeprefix("file://"))


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in files.mkString(",").split(",") if "/shuffle_" in name}


@pytest.mark.parametrize("kind", ["path", "table"])
def test_written_tables_are_packed_and_leave_no_shuffle_files(spark, tmp_path, kind):
    rows = spark.range(100).select("id", F.to_date(F.lit("2024-01-01")).alias("txn_month"))
    before = shuffle_files(spark)
    stored = write_table(rows, "packed_months" if kind == "table" else str(tmp_path / "months"))
    assert shuffle_files(spark) <= before
    assert stored.inputFiles() and all(".zstd." in name for name in stored.inputFiles())
    assert stored.count() == 100


def test_texts_of_one_profile_share_its_number(spark):
    """Rows move with the number of their profile, not with the text."""
    texts = spark.createDataFrame([("a mart",), ("b mart",), ("zzz",)], "match_text string")
    profile = texts.select("match_text", F.when(F.col("match_text") != "zzz", F.array(F.lit("x"))).alias("rule_hits"))
    numbers, profiles = rules.store_profiles(profile)
    assert profiles.count() == 2 and set(profiles.columns) == {"rule_hits", "profile_id"}
    found = {r.match_text: r.rule_hits for r in rules.join_profiles(numbers, profiles).collect()}
    assert found == {"a mart": ["x"], "b mart": ["x"], "zzz": None}
