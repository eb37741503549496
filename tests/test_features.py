"""Properties of the mart, and personas on hand-made rows."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from spendlens.operators import audit, broad, merchants, monthly, personas, simple, trends
from spendlens.operators import personas as people
from spendlens.operators.monthly import Labels
from spendlens.plans.enrichment import References, enrich
from spendlens.plans.features import feature_mart
from spendlens.plans.features import personas as add_personas
from spendlens import fixed_values as fv
from spendlens.queries import BROAD_TXN_COLUMNS, REGISTRY, SIZE_BOUNDS, labels, phase1, phase2, phase3
from spendlens.sources import materialize, retail, standardize

KEYS = ["CUST_NUM", "txn_month"]


def test_properties(spark, folder):
    mart = phase2(spark, folder)
    l1 = [F.col(monthly.spend_column("l1", x)) for x in labels(spark).l1]
    violations = mart.where(
        (F.abs(sum(l1[1:], l1[0]) - F.col("spend_amt_m")) > 1e-6)
        | (F.col("merchant_entropy_m") < -1e-9) | (F.col("merchant_entropy_m") > F.log2("merchant_cnt_m") + 1e-9)
        | (F.col("merchant_hhi_m") < 1 / F.col("merchant_cnt_m") - 1e-9) | (F.col("merchant_hhi_m") > 1 + 1e-9)
        | (F.col("top1_merchant_share_m") > F.col("top3_merchant_share_m") + 1e-9)
        | (F.col("top3_merchant_share_m") > 1 + 1e-9)
        | (F.col("uniq_merchants_m") != F.col("merchant_cnt_m")))
    assert violations.count() == 0
    for share in [c for c in mart.columns if c.endswith("_share_m")]:
        assert mart.where((F.col(share) < 0) | (F.col(share) > 1 + 1e-9)).count() == 0, share
    assert mart.groupBy(*KEYS).count().where("count > 1").count() == 0
    assert phase3(spark, folder).where("primary_persona is null").count() == 0


def build_mart(spark, source):
    txns = materialize(enrich(source, References.empty(spark)), "txns")
    table = materialize(merchants.merchant_months(txns), "table")
    return materialize(feature_mart(txns, table, Labels.of(), SIZE_BOUNDS), "mart")


def month(number, day=1):
    return f"2024-{number:02d}-{day:02d} 10:00:00"


DDL = "CUST_NUM int, MCHT_NM string, TXN_AMT double, TXN_DT string"


@pytest.fixture(scope="module")
def small(spark):
    rows = [
        # customer 1: makro and shell in month 1, makro again in month 2, nothing in month 3, ikea in month 4
        (1, "makro", 100.0, month(1)), (1, "shell", 300.0, month(1, 2)), (1, "makro", 200.0, month(2)),
        (1, "ikea", 50.0, month(4)),
        # customer 2: a net refund month; customer 3: only unknown merchants
        (2, "makro", -80.0, month(1)), (2, "shell", 30.0, month(1)),
        (3, "nobody knows", 10.0, month(1)),
    ]
    return build_mart(spark, spark.createDataFrame(rows, DDL))


def row_of(df, customer, number):
    return df.where((F.col("CUST_NUM") == customer) & (F.month("txn_month") == number)).first()


def test_small_mart(small):
    first, second, fourth = (row_of(small, 1, n) for n in (1, 2, 4))
    assert first["stddev_ticket_m"] == pytest.approx(141.4213562)
    assert second["stddev_ticket_m"] == 0.0
    p = [0.25, 0.75]
    assert first["merchant_entropy_m"] == pytest.approx(-sum(x * math.log2(x) for x in p))
    assert first["merchant_hhi_m"] == pytest.approx(0.625)
    assert second["merchant_entropy_m"] == 0.0
    assert (second["retained_merchant_cnt_m"], second["dropped_merchant_cnt_m"]) == (1, 1)
    assert second["merchant_retention_rate_m"] == 0.5
    # month 3 is empty: row windows look at month 2, turnover at the calendar
    assert fourth["spend_prev_m"] == 200.0 and fourth["merchant_retention_rate_m"] is None
    assert fourth["dropped_merchant_cnt_m"] == 0
    assert first["dominant_ecosystem"] == "EVERYDAY_ESSENTIALS" and first["second_ecosystem"] == "NONE"


def test_refund_and_unknown_months(small):
    refund, unknown = row_of(small, 2, 1), row_of(small, 3, 1)
    assert refund["spend_amt_m"] == -50.0 and refund["merchant_entropy_m"] == 0.0 and refund["merchant_hhi_m"] == 0.0
    assert refund["grocery_share_m"] == 0.0 and refund["consumption_spend_m"] == 0.0
    assert unknown["dominant_ecosystem"] == "UNCLASSIFIED" and unknown["category_breadth_m"] == 0
    assert unknown["l1_unclassified_spend_m"] == 10.0


def test_past_does_not_see_the_future(spark, folder):
    """Rows up to a month stay the same when all later transactions are removed."""
    source = retail.card_transactions(spark, folder)
    whole = add_personas(build_mart(spark, source))
    past = add_personas(build_mart(spark, source.where("TXN_DT < timestamp'2024-07-01'")))
    columns = KEYS + ["spend_amt_12m", "spend_acceleration_m", "merchant_turnover_rate_m", "recurring_merchant_cnt_m",
                      "merchant_scale" if "merchant_scale" in whole.columns else "avg_merchant_scale_m",
                      "primary_persona", "persona_tenure_months", "risk_use_case"]
    early = whole.where("txn_month < date'2024-07-01'")
    rounded = lambda df: sorted(
        tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*columns).na.fill(-1).collect())
    assert rounded(early) == rounded(past)


def test_retained_by_history_and_by_join(spark, folder):
    txns = phase1(spark, folder)
    by_history = merchants.merchant_months(txns).groupBy(*KEYS).agg(F.sum("retained").alias("n")).where("n > 0")
    by_join = merchants.retained_by_join(txns)
    assert sorted(by_history.collect()) == sorted(by_join.collect())


def test_tenure_and_shift(spark):
    rows = [(1, f"2024-0{i}-01", p) for i, p in enumerate("AABBA", 1)]
    df = spark.createDataFrame(rows, "CUST_NUM int, txn_month string, primary_persona string")
    out = personas.add_tenure(personas.add_persona_shift(df)).orderBy("txn_month").collect()
    assert [r["persona_shift_flag"] for r in out] == [0, 0, 1, 0, 1]
    assert [r["persona_tenure_months"] for r in out] == [1, 2, 1, 2, 1]


def test_unreachable_regimes(spark, folder):
    """Labels that months with transactions cannot reach, on changed mart rows."""
    mart = phase2(spark, folder).where("spend_regime = 'ACTIVE'").limit(1).drop("spend_regime", "feature_quality_flag")
    regime = lambda df: trends.add_quality(trends.add_regime(df)).first()
    empty = regime(mart.withColumn("txn_cnt_m", F.lit(0)))
    assert (empty["spend_regime"], empty["feature_quality_flag"]) == ("DORMANT", "ZERO_SPEND")
    assert regime(mart.withColumn("txn_cnt_prev_m", F.lit(0)))["spend_regime"] == "REACTIVATING"
    full = trends.add_quality(trends.add_regime(mart.withColumn("txn_cnt_m", F.lit(0))))
    person = add_personas(full).first()
    assert person["primary_persona"] == "DORMANT_LOW_ACTIVITY" and person["persona_confidence"] == "LOW"
    assert person["campaign_use_case"] == "reactivation|spend_stimulation|dormant_recovery"


def test_consumption_base(spark):
    rows = [(1, "truemoney topup", 100.0, month(1)), (1, "makro", 100.0, month(1))]
    txns = enrich(spark.createDataFrame(rows, DDL), References.empty(spark))
    totals = monthly.add_derived(monthly.month_totals(txns, Labels.of()).withColumn("uniq_merchants_m", F.lit(2)))
    shares = lambda base: monthly.add_ecosystems(totals, base).first()["l1_everyday_essentials_share_m"]
    assert (shares("spend_amt_m"), shares("consumption_spend_m")) == (0.5, 1.0)


def test_null_keys_and_unknown_labels(spark):
    """Customer-months with a NULL customer or month keep their joined columns, and
    spend on labels off the list stays in the remainder."""
    rows = [(None, "makro", 100.0, month(1)), (None, "shell", 300.0, month(1)), (1, "makro", 5.0, "no date"),
            (1, "makro", 7.0, month(1))]
    txns = materialize(enrich(spark.createDataFrame(rows, DDL), References.empty(spark)), "txns")
    txns = txns.withColumn("tax_l1", F.when(F.col("txn_amount") == 7.0, "CUSTOM_L1").otherwise(F.col("tax_l1")))
    table = materialize(merchants.merchant_months(txns), "table")
    found = {(r["CUST_NUM"], r["txn_month"] is None): r for r in feature_mart(txns, table, Labels.of(), SIZE_BOUNDS).collect()}
    assert found[None, False]["uniq_merchants_m"] == 2 and found[None, False]["median_ticket_m"] == 100.0
    assert found[None, False]["top3_merchant_spend_m"] == 400.0
    assert found[1, True]["uniq_merchants_m"] == 1 and found[1, True]["uniq_tax_l1_m"] == 1
    assert found[1, False]["l1_remainder_spend_m"] == 7.0 and found[1, False]["uniq_tax_l1_m"] == 1


def test_refunds_in_the_small_variant(spark):
    rows = [(1, "a", 900.0, month(1)), (1, "b", 300.0, month(1)), (1, "c", -200.0, month(1)),
            (2, "a", -30.0, month(1)), (2, "b", -10.0, month(1))]
    tagged = simple.add_simple_tags(standardize(spark.createDataFrame(rows, DDL)).withColumn("ONLN_FLAG", F.lit("Y")))
    found = {r["CUST_NUM"]: r["merchant_entropy"] for r in simple.simple_personas(tagged).collect()}
    assert found[1] == pytest.approx(0.6579, abs=1e-4) and found[2] == pytest.approx(0.8113, abs=1e-4)


def test_broad_shares_are_row_local(spark):
    columns = {"spend_amt_m": 100.0, "FOOD_DINING": 60.0}
    one = spark.createDataFrame([(100.0, 60.0, None)], "spend_amt_m double, FOOD_DINING double, HEALTH_WELLNESS double")
    two = one.union(spark.createDataFrame([(50.0, None, 50.0)], one.schema))
    first = lambda df: broad.add_l1_shares(df).where(F.col("spend_amt_m") == columns["spend_amt_m"]).first()
    assert first(one)["share_health_wellness"] == first(two)["share_health_wellness"] == 0.0
    assert first(one)["share_food_dining"] == 0.6


@pytest.mark.parametrize("metrics", ["phase1_metrics", "feature_health"])
def test_several_distinct_counts_do_not_copy_rows(spark, metrics):
    txns = spark.range(50).selectExpr(
        "id % 7 as CUST_NUM", "concat('m', id % 5) as merchant_key", "'UNCLASSIFIED' as tax_l1", "'B2K' as taxonomy_source",
        "'NONE' as rule_conflict_flag", "'NONE' as taxonomy_conflict_flag", "if(id % 3 = 0, null, current_date()) as txn_month",
        *[f"cast(id as double) as {c}" for c in (
            "spend_amt_m", "txn_cnt_m", "merchant_entropy_m", "online_share_m", "wallet_share_m")])
    df = getattr(audit, metrics)(txns)
    assert "Expand" not in df._jdf.queryExecution().optimizedPlan().toString()
    row = df.first()
    assert row["unique_customers"] == 7 and row[0] == 50
    assert row["unique_merchants" if metrics == "phase1_metrics" else "months_covered"] == (5 if metrics == "phase1_metrics" else 1)


def test_rough_rows_reach_every_rule_and_both_limits(spark, folder):
    used = REGISTRY["rough_rules"](spark, folder).collect()
    assert len({r["rule_name"] for r in used}) == len({r[1] for r in fv.MERCHANT_RULES}) and all(r["matched_txns"] for r in used)
    rows = standardize(retail.rough_transactions(spark, folder), ["TXN_REF"])
    counts = rows.selectExpr("count_if(txn_amount < 0) as refunds", "count_if(txn_amount is null) as unpriced",
                             "count_if(txn_ts is null) as undated", "count_if(CUST_NUM is null) as nobody",
                             "count(*) - count(distinct txn_key) as copies", "count_if(MCHT_NM is null) as unnamed").first()
    assert all(counts)
    unknown = REGISTRY["rough_unclassified_count"](spark, folder)
    assert unknown.count() == 50


def test_every_persona_has_a_customer_month(spark):
    """A month without any trait is an everyday anchor; one trait each gives the others."""
    nothing = dict.fromkeys("""l1_travel_mobility_share_m xborder_share_3m premium_share_3m avg_ticket_3m online_share_3m
        l1_digital_services_share_m l1_food_dining_share_m l2_restaurants_share_m l2_food_delivery_share_m l2_coffee_cafe_share_m
        top1_merchant_share_m merchant_hhi_m wallet_share_3m category_breadth_m merchant_entropy_3m""".split(), 0.0)
    nothing |= {"travel_booking_txn_cnt_m": 0, "spend_regime": "ACTIVE", "feature_quality_flag": "GOOD", "business_proxy_flag": "RETAIL_CONSUMER"}
    traits = {
        "DORMANT_LOW_ACTIVITY": {"feature_quality_flag": "ZERO_SPEND"}, "BUSINESS_PROXY": {"business_proxy_flag": "LIKELY_BUSINESS"},
        "TRAVEL_CENTRIC": {"travel_booking_txn_cnt_m": 2}, "AFFLUENT_LIFESTYLE": {"premium_share_3m": 0.11, "avg_ticket_3m": 5001.0},
        "DIGITAL_NATIVE": {"online_share_3m": 0.56},
        "LIFESTYLE_SOCIAL": {"l2_restaurants_share_m": 0.1, "l2_food_delivery_share_m": 0.1, "l2_coffee_cafe_share_m": 0.06},
        "CONCENTRATED_LOYALIST": {"merchant_hhi_m": 0.36}, "EMERGING_MOBILE": {"wallet_share_3m": 0.21, "online_share_3m": 0.31},
        "DIVERSIFIED_EXPLORER": {"category_breadth_m": 5.0, "merchant_entropy_3m": 2.6}, "EVERYDAY_ANCHOR": {}}
    near = {"AFFLUENT_LIFESTYLE": {"premium_share_3m": 0.10, "avg_ticket_3m": 5001.0}, "DIGITAL_NATIVE": {"online_share_3m": 0.55},
            "CONCENTRATED_LOYALIST": {"merchant_hhi_m": 0.35}, "DIVERSIFIED_EXPLORER": {"category_breadth_m": 5.0, "merchant_entropy_3m": 2.5},
            "unknown": dict.fromkeys([c for c in nothing if c.endswith(("share_m", "3m", "hhi_m"))])}
    rows = [(name, nothing | trait) for name, trait in traits.items()] + [("EVERYDAY_ANCHOR", nothing | trait) for trait in near.values()]
    columns = ", ".join(f"{c} {'string' if isinstance(v, str) else 'int' if isinstance(v, int) else 'double'}" for c, v in nothing.items())
    df = spark.createDataFrame([(name, *row.values()) for name, row in rows], f"want string, {columns}")
    got = people.add_persona(df).select("want", "primary_persona").collect()
    assert all(r["want"] == r["primary_persona"] for r in got) and len(set(traits)) == 10 == len(fv.PERSONAS) + 1


def test_labels_move_to_their_month_once(spark):
    """Sums by label, then one shuffle of them for both steps by month."""
    txns = spark.createDataFrame(
        [(1, datetime.date(2024, 1, 1), l1, l2, "X", amount) for l1, l2, amount in [
            ("A", "B", 3.0), ("A", "C", 1.0), ("D", "C", 4.0), (None, None, 0.0)]],
        "CUST_NUM long, txn_month date, tax_l1 string, tax_l2 string, tax_l3 string, txn_amount double")
    mix = monthly.label_mix(txns)
    assert mix._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    row = mix.first()
    assert (row["uniq_tax_l1_m"], row["uniq_tax_l2_m"], row["uniq_tax_l3_m"]) == (2, 2, 1)
    assert (row["ecosystem_entropy_m"], row["ecosystem_hhi_m"]) == (1.0, 0.5)


def test_broad_merchants_are_told_apart_by_short_keys(spark):
    txns = spark.createDataFrame(
        [(1, datetime.date(2024, 1, 1), "ab" * 32, 1.0, 0), (1, datetime.date(2024, 1, 1), "ab" * 32, 2.0, 1),
         (1, datetime.date(2024, 1, 1), "cd" * 32, 3.0, 0)],
        "CUST_NUM long, txn_month date, merchant_key string, txn_amount double, subscription_candidate_flag int")
    rows = broad.merchant_rows(txns)
    assert dict(rows.dtypes)["merchant_key"] == "binary"
    assert sorted((r["spend"], r["visits"]) for r in rows.collect()) == [(3.0, 1), (3.0, 2)]


def test_broad_labels_are_summed_once(spark):
    """Distinct labels, the largest one and concentration share the sums by label."""
    day = datetime.date(2024, 1, 1)
    txns = spark.createDataFrame(
        [(1, day, l1, "B", "X", amount) for l1, amount in [("D", 2.0), ("A", 2.0), (None, 4.0)]] + [(2, day, "A", "B", "X", None)],
        "CUST_NUM long, txn_month date, tax_l1 string, tax_l2 string, tax_l3 string, txn_amount double")
    mix = monthly.label_mix(txns, [broad.top_label(), *broad.ecosystem_concentration()])
    assert mix._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    first, second = mix.orderBy("CUST_NUM").collect()
    assert (first["top"]["tax_l1"], -first["top"]["minus"], first["ecosystem_entropy_m"]) == ("A", 2.0, 1.5)
    assert first["ecosystem_hhi_m"] == 0.375 and second["top"] is None and second["uniq_tax_l1_m"] == 1


def test_merchant_sizes_are_stored_before_the_join(spark):
    """The rows of customers do not move while there are few merchants."""
    months = spark.createDataFrame(
        [(c, datetime.date(2024, 1, 1), m, c) for c in (1, 2) for m in ("x", "y")],
        "CUST_NUM long, txn_month date, mcht_nm_norm string, visits long")
    sized = merchants.add_merchant_sizes(months)
    assert "Exchange hashpartitioning" not in sized._jdf.queryExecution().executedPlan().toString()
    assert {(r["merchant_global_txn_cnt"], r["merchant_global_cust_cnt"]) for r in sized.collect()} == {(3, 2)}


def test_few_columns_are_stored_and_computed(spark, folder):
    """Transactions are stored without the texts and digests that no month reads, and a query
    of a mart computes the columns it takes."""
    unread = {"TXN_DESC", "txn_desc_norm", "match_text", "txn_key", "merchant_tokens", "mcht_nm_raw"}
    assert not unread & set(phase1(spark, folder).columns)
    assert not unread & set(BROAD_TXN_COLUMNS)
    plan = REGISTRY["share_slopes"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "online_share_slope_m" in plan and "premium_spend_m" in plan
    assert "grocery_spend_m" not in plan and "l1_food_dining_spend_m" not in plan


def test_months_are_joined_where_their_aggregates_left_them(spark):
    """Missing keys join like any other, apart from defaults, and no aggregate moves again."""
    day = datetime.date(1970, 1, 1)
    keys = [(0, day), (None, day), (0, None), (None, None), (1, day)]
    rows = spark.createDataFrame([(*key, place) for place, key in enumerate(keys)], "CUST_NUM long, txn_month date, a long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = monthly.join_months(
            monthly.per_month(rows, F.sum("a").alias("a")), monthly.per_month(rows.where("a < 4"), F.max("a").alias("b")))
        assert both._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        found = {(r["CUST_NUM"], r["txn_month"]): (r["a"], r["b"]) for r in both.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == {key: (place, place if place < 4 else None) for place, key in enumerate(keys)}


def test_broad_merchants_move_to_their_month_once(spark):
    """The largest spends, or the smallest of a month of refunds, come with the sums."""
    day = datetime.date(2024, 1, 1)
    spends = {1: [4.0, 3.0, 2.0, 1.0, None], None: [-4.0, -3.0, -2.0, -1.0, None], 2: [None], 3: [5.0, -5.0]}
    rows = spark.createDataFrame(
        [(c, day, f"{c}-{i}", spend, 1, 0) for c, of in spends.items() for i, spend in enumerate(of)],
        "CUST_NUM long, txn_month date, merchant_key string, spend double, visits long, is_recurring int")
    found = broad.merchant_intelligence(rows, SIZE_BOUNDS)
    shares = found.select("CUST_NUM", "top3_merchant_share_m")
    assert shares._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {r[0]: r[1] for r in shares.collect()} == {1: 0.9, None: 0.9, 2: 0.0, 3: 0.0}
    assert {r["CUST_NUM"]: r["new_merchant_cnt_m"] for r in found.collect()} == {1: 5, None: 5, 2: 1, 3: 2}
