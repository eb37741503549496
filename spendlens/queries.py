"""Registered queries: every operator over the given tables.

Each entry takes (spark, folder) and returns a frame with plain, comparable
columns. Month-level entries read the transactions of phase 1, which are written once
per session and folder with the columns that entries read; marts are computed by entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed_values as fv
from .functions import sum_money
from .operators import audit, broad, merchant, merchants, monthly, personas, recurrence, rules, simple, sketches, tags, taxonomy
from .operators.history import NARROW
from .operators.monthly import MONTH
from .plans import features, variants
from .plans.enrichment import References, classify, enrich
from .plans.pipeline import Targets
from .sources import add_row_ids, complete_columns, dimension, materialize, retail, scratch_path, stamp, standardize, temporaries, write_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
KEY = ["TXN_REF"]


def comparable(df: DataFrame) -> DataFrame:
    """Dates and times as text, arrays as joined text, and doubles with six decimals,
    so that results of two engines can be compared."""
    def plain(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(col, "yyyy-MM-dd")
        if isinstance(field.dataType, T.TimestampType):
            return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        if isinstance(field.dataType, T.ArrayType):
            return F.concat_ws(" ", col)
        if isinstance(field.dataType, T.DoubleType):
            return F.floor(col * 1e6 + 0.5) / F.lit(1e6)
        return col
    return df.select(*[plain(f).alias(f.name) for f in df.schema.fields])


def query(name: str):
    def register(build: Query) -> Query:
        REGISTRY[name] = lambda spark, folder: comparable(build(spark, folder))
        return build
    return register


# ---------------------------------------------------------------- inputs

def references(spark: SparkSession) -> References:
    return References(
        dimension(spark, retail.B2K_ROWS, retail.B2K_DDL),
        dimension(spark, retail.MOBIUS_ROWS, retail.MOBIUS_DDL))


def card(spark: SparkSession, folder: str) -> DataFrame:
    return standardize(retail.card_transactions(spark, folder), KEY)


def event_card(spark: SparkSession, folder: str) -> DataFrame:
    return standardize(retail.event_transactions(spark, folder), KEY)


def named(spark: SparkSession, folder: str) -> DataFrame:
    return merchant.add_merchant_text(card(spark, folder))


def classified(spark: SparkSession, folder: str) -> DataFrame:
    return classify(named(spark, folder), references(spark))


def tagged(spark: SparkSession, folder: str) -> DataFrame:
    return tags.add_tags(classified(spark, folder))


def enriched_card(spark: SparkSession, folder: str) -> DataFrame:
    return enrich(retail.card_transactions(spark, folder), references(spark), key_columns=KEY)


_WRITTEN: dict[tuple[str, str, str], DataFrame] = {}


def written(name: str, build: Query) -> Query:
    """The result of ``build``, written once per session and folder; what is stored on the way
    is deleted then."""
    def stored(spark: SparkSession, folder: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, folder, name)
        if key not in _WRITTEN:
            with temporaries():
                _WRITTEN[key] = materialize(build(spark, folder), name, keep=True)
        return _WRITTEN[key]
    return stored


# What the months, sketches, audits and reports read of a transaction. Only these columns
# are stored, so no text or digest that nobody reads is moved or written.
TXN_COLUMNS = list(dict.fromkeys([
    *MONTH, "txn_date", "txn_dom", "txn_amount", "merchant_key", merchants.MERCHANT, "tax_l1", "tax_l2", "tax_l3",
    "taxonomy_source", "taxonomy_conflict_flag", "rule_conflict_flag", "platform_ecosystem", "merchant_novelty_tag",
    "recurrence_tag", "prev_txn_dt_merchant", "avg_interval_merchant", "cv_interval",
    *[tag for tag, _ in monthly.SPENDS.values()], *monthly.COUNTS.values()]))

phase1 = written("phase1", lambda spark, folder: enriched_card(spark, folder).select(*TXN_COLUMNS))
event_phase1 = written("event_phase1", lambda spark, folder: enrich(
    retail.event_transactions(spark, folder), references(spark), key_columns=KEY))
merchant_table = written(
    "merchant_months", lambda spark, folder: merchants.merchant_months(phase1(spark, folder)))

# The tables hold far fewer transactions than a card portfolio has, so the size
# classes of merchants are set lower.
SIZE_BOUNDS = {"mega": 150, "large": 60, "longtail": 20}


def labels(spark: SparkSession) -> monthly.Labels:
    return monthly.Labels.of(None, [row[-3:] for row in [*retail.B2K_ROWS, *retail.MOBIUS_ROWS]])



def phase2(spark: SparkSession, folder: str) -> DataFrame:
    """The mart, from the stored transactions and merchant months. A query takes few of its
    columns, so it is not stored: Spark computes and moves what these columns need."""
    return features.feature_mart(phase1(spark, folder), merchant_table(spark, folder), labels(spark), SIZE_BOUNDS)


def phase3(spark: SparkSession, folder: str) -> DataFrame:
    return features.personas(phase2(spark, folder))


def measured_columns(name: str, mart: Query) -> Query:
    """The columns of a mart that the metrics of ``name`` read, stored: a metric is one pass
    over the rows and each distinct count another."""
    columns = dict.fromkeys(parts[0] for _, _, *parts in audit.METRICS[name] if parts)
    return written(f"{name}_audit", lambda spark, folder: mart(spark, folder).select(*columns))


# ---------------------------------------------------------------- transactions


@query("txn_standardize")
def txn_standardize(spark, folder):
    return card(spark, folder).select(
        "txn_key", "CUST_NUM", "txn_date", "txn_ts", "txn_month", "txn_amount", "CNTRY_CD")


@query("merchant_normalize")
def merchant_normalize(spark, folder):
    return named(spark, folder).select(
        "txn_key", "mcht_nm_raw", "mcht_nm_norm", "txn_desc_norm", "match_text", "merchant_key")


@query("merchant_tokens")
def merchant_tokens(spark, folder):
    return merchant.add_merchant_tokens(named(spark, folder)).select(
        "txn_key", "merchant_tokens", "merchant_token_cnt", "merchant_brand_root")


RULE_RESULT = ["txn_key", *rules.RULE_COLUMNS, "rule_match_cnt", "rule_conflict_flag"]


@query("rule_match_best")
def rule_match_best(spark, folder):
    return rules.add_rules(named(spark, folder)).select(*RULE_RESULT)


@query("rule_match_theta")
def rule_match_theta(spark, folder):
    return rules.add_rules_by_join(named(spark, folder), rules.rule_frame(spark), stored=True).select(*RULE_RESULT)


@query("rule_conflicts")
def rule_conflicts(spark, folder):
    return rules.rule_usage(rules.add_rules(named(spark, folder)))


@query("rule_hierarchy_check")
def rule_hierarchy_check(spark, folder):
    return rules.hierarchy_check(rules.add_rules(named(spark, folder)), rules.hierarchy_frame(spark))


@query("rule_validation")
def rule_validation(spark, folder):
    """Rules whose triple the hierarchy lacks and leaves without a rule, with the
    transactions of either by their final category."""
    listed, every = rules.hierarchy_frame(spark), rules.rule_frame(spark)
    found = rules.rules_outside_hierarchy(every, listed).select(
        F.lit("RULE_OUTSIDE").alias("finding"), "rule_name", "rule_l1", "rule_l2", "rule_l3").union(
        rules.leaves_without_rule(every, listed).select(
            F.lit("LEAF_WITHOUT_RULE"), F.lit(None).cast("string"), "ref_l1", "ref_l2", "ref_l3"))
    used = classified(spark, folder).groupBy("tax_l1", "tax_l2", "tax_l3").agg(F.count("*").alias("txn_cnt"))
    return found.join(used, (F.col("rule_l1") == F.col("tax_l1")) & (F.col("rule_l2") == F.col("tax_l2"))
                      & (F.col("rule_l3") == F.col("tax_l3")), "left").select(
        "finding", "rule_name", "rule_l1", "rule_l2", "rule_l3", F.coalesce("txn_cnt", F.lit(0)).alias("txn_cnt"))


# Rules out of order, with escapes, a shared priority and a repeated name.
USER_RULES = [
    (20, "GENERIC", "a", "TEST_L1", "GENERIC", "GENERIC"),
    (5, "SPECIFIC", r"mar|sho\(p|foo\|bar", "TEST_L1", "SPECIFIC", "SPECIFIC"),
    (5, "TIED", "mark", "TEST_L1", "TIED", "TIED"),
    (7, "GENERIC", "[|e]n", "TEST_L1", "REPEATED", "REPEATED"),
]


@query("rule_user_list")
def rule_user_list(spark, folder):
    return rules.add_rules(named(spark, folder), USER_RULES).select(*RULE_RESULT)


@query("rule_user_table")
def rule_user_table(spark, folder):
    return rules.add_rules_by_join(named(spark, folder), rules.rule_frame(spark, USER_RULES), stored=True).select(*RULE_RESULT)


@query("source_join_b2k")
def source_join_b2k(spark, folder):
    return taxonomy.add_b2k(card(spark, folder), references(spark).b2k).select(
        "txn_key", "MCHT_CATG", "b2k_l1", "b2k_l2", "b2k_l3")


@query("source_join_mobius")
def source_join_mobius(spark, folder):
    return taxonomy.add_mobius(card(spark, folder), references(spark).mobius).select(
        "txn_key", "SIC_CD_DESC", "mobius_l1", "mobius_l2", "mobius_l3")


@query("taxonomy_reconcile")
def taxonomy_reconcile(spark, folder):
    return classified(spark, folder).select(
        "txn_key", "taxonomy_source", "tax_l1", "tax_l2", "tax_l3", "taxonomy_confidence",
        "taxonomy_match_level", "taxonomy_conflict_flag")


@query("taxonomy_no_sources")
def taxonomy_no_sources(spark, folder):
    """Rules alone: the reference frames of both sources are empty."""
    return classify(named(spark, folder), References.empty(spark)).select(
        "txn_key", "taxonomy_source", "tax_l1", "tax_l2", "tax_l3", "taxonomy_confidence", "taxonomy_match_level",
        "taxonomy_conflict_flag")


@query("output_columns")
def output_columns(spark, folder):
    """All columns that a landed table has to have, out of a source with few of them."""
    typed = event_card(spark, folder).drop("CURR_DESC")
    return complete_columns(typed, fv.BROAD_OUTPUT_COLUMNS).select("txn_key", *fv.BROAD_OUTPUT_COLUMNS)


@query("taxonomy_audit")
def taxonomy_audit(spark, folder):
    return taxonomy.coverage(classified(spark, folder)).orderBy(F.desc("count"))


@query("channel_geo_tags")
def channel_geo_tags(spark, folder):
    return tagged(spark, folder).select("txn_key", "channel_tag", "geo_tag")


@query("wallet_flags")
def wallet_flags(spark, folder):
    return tagged(spark, folder).select(
        "txn_key", "is_topup", "is_wallet", "is_processor_mediated", "is_risk_adjacent")


@query("structural_flags")
def structural_flags(spark, folder):
    return tagged(spark, folder).select(
        "txn_key", "is_marketplace", "is_mall_ecosystem", "is_premium_merchant", "is_food_delivery",
        "is_ride_hailing", "is_subscription", "is_grocery", "is_risky_merchant", "is_mall_pattern",
        "is_business_proxy", "is_travel_booking")


@query("platform_ecosystem")
def platform_ecosystem(spark, folder):
    return rules.add_text_flags(named(spark, folder)).select("txn_key", "platform_ecosystem")


@query("size_tier")
def size_tier(spark, folder):
    return tags.add_size_tier(card(spark, folder)).select("txn_key", "txn_amount", "txn_size_tier")


@query("time_tags")
def time_tags(spark, folder):
    return tags.add_time_tags(card(spark, folder)).select(
        "txn_key", "hour_of_day", "has_real_timestamp", "time_pattern", "txn_dow", "weekpart_tag")


@query("time_tags_events")
def time_tags_events(spark, folder):
    return tags.add_time_tags(event_card(spark, folder)).select(
        "txn_key", "hour_of_day", "has_real_timestamp", "time_pattern", "txn_dow", "weekpart_tag")


@query("payday_tags")
def payday_tags(spark, folder):
    return tags.add_time_tags(card(spark, folder)).select("txn_key", "txn_dom", "payday_window_flag")


# Rows of a slice in the queries that check the prefix scan.
CUT_ROWS = 10


def history_rows(name: str, build: Query) -> Query:
    """What histories read of transactions, stored: cuts and rows are several passes. Both
    keys are digests, held as bytes: half as wide as their text, and in the same order."""
    return written(name, lambda spark, folder: build(spark, folder).select(*sorted(NARROW)).withColumns(
        {key: F.unhex(key) for key in ("txn_key", "merchant_key")}))


def with_key_text(df: DataFrame) -> DataFrame:
    return df.withColumn("txn_key", F.lower(F.hex("txn_key")))


card_rows = history_rows("card_rows", lambda spark, folder: named(spark, folder))
event_rows = history_rows("event_rows", lambda spark, folder: merchant.add_merchant_text(event_card(spark, folder)))
basic_rows = history_rows("basic_rows", lambda spark, folder: broad.add_text_basic(card(spark, folder)))
rough_rows = history_rows("rough_rows", lambda spark, folder: merchant.add_merchant_text(rough(spark, folder)))
HISTORY_RESULT = [
    "txn_key", "prev_txn_dt_merchant", "prev_txn_amt_merchant", "days_since_prev_merchant",
    "amt_delta_pct", "merchant_visit_cnt", "avg_interval_merchant", "std_interval_merchant",
    "cv_interval", "avg_amt_merchant", "std_amt_merchant", "amt_cv_merchant",
]


@query("recurrence_history")
def recurrence_history(spark, folder):
    return recurrence.add_history(named(spark, folder)).select(*HISTORY_RESULT)


@query("recurrence_history_cut")
def recurrence_history_cut(spark, folder):
    """The same with a cut after every few rows, so that most histories are cut."""
    return with_key_text(recurrence.add_history(card_rows(spark, folder), slice_rows=CUT_ROWS, least_cuts=1)).select(
        *HISTORY_RESULT)


@query("recurrence_tags_events_cut")
def recurrence_tags_events_cut(spark, folder):
    return with_key_text(recurrence.add_recurrence(event_rows(spark, folder), slice_rows=CUT_ROWS, least_cuts=1)).select(
        "txn_key", "merchant_visit_cnt", "merchant_novelty_tag", "recurrence_tag", "subscription_candidate_flag")


@query("recurrence_tags")
def recurrence_tags(spark, folder):
    return recurrence.add_recurrence(named(spark, folder)).select(
        "txn_key", "merchant_novelty_tag", "recurrence_tag", "subscription_candidate_flag")


@query("recurrence_tags_events")
def recurrence_tags_events(spark, folder):
    txns = merchant.add_merchant_text(event_card(spark, folder))
    return recurrence.add_recurrence(txns).select(
        "txn_key", "merchant_visit_cnt", "merchant_novelty_tag", "recurrence_tag",
        "subscription_candidate_flag")


# ---------------------------------------------------------------- customer-months


def totals(spark, folder):
    return monthly.month_totals(phase1(spark, folder), labels(spark))


def base(spark, folder):
    merchant_rows = merchants.merchant_features(
        merchants.add_merchant_sizes(merchant_table(spark, folder)), SIZE_BOUNDS)
    return features.month_base(phase1(spark, folder), labels(spark), merchant_rows)


MONTH_BASE = [
    "txn_cnt_m", "spend_amt_m", "avg_ticket_m", "max_ticket_m", "min_ticket_m", "stddev_ticket_m",
    "median_ticket_m", "active_days_m", "uniq_merchants_m", "uniq_tax_l1_m", "uniq_tax_l2_m",
    "uniq_tax_l3_m", *monthly.SPENDS, *monthly.COUNTS, "new_merchant_cnt_m",
    "repeat_merchant_txn_cnt_m",
]
MONTH_DERIVED = ["consumption_spend_m", "txn_per_active_day_m", "merchant_repeat_ratio_m", "merchant_novelty_rate_m"]


@query("month_base")
def month_base(spark, folder):
    return base(spark, folder).select(*MONTH, *MONTH_BASE)


@query("month_base_events")
def month_base_events(spark, folder):
    txns = event_phase1(spark, folder)
    return monthly.month_totals(txns, labels(spark)).select(
        *MONTH, "txn_cnt_m", "spend_amt_m", "active_days_m", "online_spend_m", "offline_spend_m",
        "inapp_spend_m", "morning_spend_m", "lunch_spend_m", "evening_spend_m", "late_night_spend_m",
        "weekend_spend_m", "payday_window_spend_m", "new_merchant_cnt_m")


customer_sketches = written("customer_sketches", lambda spark, folder: sketches.month_sketches(
    phase1(spark, folder), "CUST_NUM", sketches.CUSTOMER_SETS))
merchant_sketches = written("merchant_sketches", lambda spark, folder: sketches.month_sketches(
    phase1(spark, folder), "mcht_nm_norm", sketches.MERCHANT_SETS))


def near(exact: str, sketch: str):
    """Whether the estimate is as near to the exact count as the sketch promises."""
    return F.abs(sketches.distinct(sketch) - F.col(exact)) <= sketches.distinct_bound(F.col(exact))


APPROXIMATE = {"active_days_m": "days", "uniq_merchants_m": "merchants", "uniq_tax_l1_m": "l1", "uniq_tax_l2_m": "l2",
               "uniq_tax_l3_m": "l3"}


@query("month_base_approx")
def month_base_approx(spark, folder):
    """Exact counts, and whether the sketches' estimates are as near as they promise."""
    exact = base(spark, folder).select(*MONTH, *APPROXIMATE)
    return monthly.join_months(exact, customer_sketches(spark, folder)).select(
        *MONTH, *APPROXIMATE, *[near(name, sketch).alias(f"{name}_near") for name, sketch in APPROXIMATE.items()])


def checked_roll_up(txns: DataFrame, stored: DataFrame, key: str, sets: dict[str, str], period: str) -> DataFrame:
    """Summaries of a longer period merged from months, beside exact counts: sums, exact
    distinct counts and whether the estimates are near, and whether the median has about
    half of the amounts on either side."""
    start = F.trunc("txn_month", period).alias("period")
    rolled = sketches.roll_up(stored, [key, start], sets).withColumn("median", sketches.quantile("amounts", 0.5))
    exact = txns.groupBy(key, start).agg(
        *[F.count_distinct(column).alias(f"{name}_cnt") for name, column in sets.items()])
    both = monthly.join_months(rolled, exact, [key, "period"])
    amounts = monthly.join_months(txns.select(key, start, "txn_amount"), rolled.select(key, "period", "median"), [key, "period"])
    sides = amounts.groupBy(key, "period").agg(
        F.avg((F.col("txn_amount") < F.col("median")).cast("int")).alias("below"),
        F.avg((F.col("txn_amount") <= F.col("median")).cast("int")).alias("up_to"))
    return monthly.join_months(both, sides, [key, "period"]).select(
        key, "period", "txn_cnt", "spend", *[f"{name}_cnt" for name in sets],
        *[near(f"{name}_cnt", name).alias(f"{name}_near") for name in sets],
        ((F.col("below") <= 0.5 + sketches.RANK_BOUND) & (F.col("up_to") >= 0.5 - sketches.RANK_BOUND)).alias("median_near"))


@query("sketch_quarters")
def sketch_quarters(spark, folder):
    return checked_roll_up(phase1(spark, folder), customer_sketches(spark, folder), "CUST_NUM", sketches.CUSTOMER_SETS, "quarter")


@query("sketch_merchant_years")
def sketch_merchant_years(spark, folder):
    return checked_roll_up(phase1(spark, folder), merchant_sketches(spark, folder), "mcht_nm_norm", sketches.MERCHANT_SETS, "year")


@query("month_shares")
def month_shares(spark, folder):
    return base(spark, folder).select(*MONTH, *monthly.SHARES, *MONTH_DERIVED)


@query("l1_pivot")
def l1_pivot(spark, folder):
    df = monthly.add_ecosystems(totals(spark, folder))
    return df.select(
        *MONTH, *[c for c in df.columns if c.startswith("l1_") and not c.startswith(("l1_other_longtail", "l1_remainder"))])


@query("l1_spend_check")
def l1_spend_check(spark, folder):
    """Spend over all ecosystems with the hierarchy's labels only, the rest as remainder."""
    few = monthly.Labels(l1=["FOOD_DINING", "EVERYDAY_ESSENTIALS"])
    df = monthly.month_totals(phase1(spark, folder), few)
    return df.select(*MONTH, "spend_amt_m", "l1_remainder_spend_m", sum(
        (F.col(c) for c in df.columns if c.startswith("l1_")), F.lit(0.0)).alias("l1_spend_m"))


@query("dominant_ecosystem")
def dominant_ecosystem(spark, folder):
    return monthly.add_ecosystems(totals(spark, folder)).select(
        *MONTH, "dominant_ecosystem", "second_ecosystem", "top_l1_share")


@query("category_breadth")
def category_breadth(spark, folder):
    return monthly.add_ecosystems(totals(spark, folder)).select(*MONTH, "category_breadth_m")


@query("platform_month")
def platform_month(spark, folder):
    return monthly.add_platforms(totals(spark, folder)).select(
        *MONTH, "platform_count_m", "platform_spend_m", "platform_txn_cnt_m", "platform_share_m", "dominant_platform")


@query("l2_pivot")
def l2_pivot(spark, folder):
    df = monthly.add_key_l2_shares(totals(spark, folder))
    return df.select(*MONTH, *[c for c in df.columns if c.startswith("l2_")])


def merchant_rows(spark, folder):
    return merchants.add_merchant_sizes(merchant_table(spark, folder))


@query("merchant_entropy")
def merchant_entropy(spark, folder):
    return merchants.merchant_features(merchant_rows(spark, folder)).select(
        *MONTH, "merchant_entropy_m", "merchant_hhi_m", "merchant_cnt_m")


@query("top_merchants")
def top_merchants(spark, folder):
    top = merchants.top_merchants(merchant_table(spark, folder))
    return merchants.add_top_shares(
        totals(spark, folder).select(*MONTH, "spend_amt_m").join(top, MONTH, "left")
    ).select(*MONTH, "top1_merchant_share_m", "top3_merchant_spend_m", "top3_merchant_share_m")


@query("ecosystem_entropy")
def ecosystem_entropy(spark, folder):
    return monthly.label_mix(phase1(spark, folder)).select(*MONTH, "ecosystem_entropy_m", "ecosystem_hhi_m")


@query("merchant_scale")
def merchant_scale(spark, folder):
    return merchants.merchant_features(merchant_rows(spark, folder), SIZE_BOUNDS).select(
        *MONTH, "avg_merchant_scale_m", "spend_at_mega_merchants_m", "spend_at_large_merchants_m",
        "spend_at_longtail_merchants_m")


@query("merchant_sizes")
def merchant_sizes(spark, folder):
    return merchants.merchant_sizes(merchant_table(spark, folder))


@query("merchant_loyalty")
def merchant_loyalty(spark, folder):
    return merchants.merchant_features(merchant_rows(spark, folder)).select(
        *MONTH, "avg_visits_per_merchant_m", "max_visits_per_merchant_m", "loyal_merchant_cnt_m")


TURNOVER = [
    "retained_merchant_cnt_m", "dropped_merchant_cnt_m", "merchant_turnover_rate_m",
    "merchant_churn_rate_m", "merchant_retention_rate_m",
]


@query("merchant_turnover")
def merchant_turnover(spark, folder):
    return merchants.add_turnover(base(spark, folder)).select(*MONTH, *TURNOVER)


@query("merchant_retained_join")
def merchant_retained_join(spark, folder):
    return merchants.retained_by_join(named(spark, folder))


@query("new_merchants_first_seen")
def new_merchants_first_seen(spark, folder):
    return merchants.first_seen(named(spark, folder))


RECURRING = [
    "subscription_merchant_cnt_m", "recurring_merchant_cnt_m", "episodic_merchant_cnt_m",
    "irregular_merchant_cnt_m", "subscription_like_spend_m", "recurring_spend_m",
    "avg_recurring_interval_m", "avg_recurring_cv_m", "recurring_spend_share_m",
    "subscription_like_spend_share_m",
]


@query("recurring_summary")
def recurring_summary(spark, folder):
    return merchants.add_recurring_shares(base(spark, folder)).select(*MONTH, *RECURRING)


# ---------------------------------------------------------------- months in order

def from_mart(name: str, columns: str) -> None:
    @query(name)
    def select(spark, folder):
        return phase2(spark, folder).select(*MONTH, *columns.split())


def from_personas(name: str, columns: str) -> None:
    @query(name)
    def select(spark, folder):
        return phase3(spark, folder).select(*MONTH, *columns.split())


from_mart("rolling_3m", """
spend_amt_3m txn_cnt_3m avg_ticket_3m online_share_3m xborder_share_3m wallet_share_3m premium_share_3m
merchant_entropy_3m grocery_share_3m late_night_share_3m weekend_share_3m ride_hailing_share_3m
food_delivery_share_3m dominant_ecosystem_freq_3m spend_vs_3m_avg_ratio""")
from_mart("rolling_6m_12m", """
spend_amt_6m txn_cnt_6m spend_stability_6m spend_amt_12m txn_cnt_12m avg_ticket_12m spend_stability_12m""")
from_mart("mom_velocity", """
spend_prev_m txn_cnt_prev_m spend_velocity_m spend_pct_change_m txn_cnt_velocity_m avg_ticket_prev_m
avg_ticket_change_m spend_velocity_prev_m spend_acceleration_m""")
from_mart("share_slopes", """
online_share_prev_m online_share_slope_m xborder_share_prev_m xborder_share_slope_m wallet_share_prev_m
wallet_share_slope_m premium_share_prev_m premium_share_slope_m""")
from_mart("migration_trend", """
dominant_ecosystem_prev_m l1_migration_flag merchant_entropy_prev_m entropy_trend_m diversification_flag
ecosystem_hhi_prev_m ecosystem_hhi_change_m merchant_hhi_prev_m merchant_hhi_change_m""")
from_mart("spend_regime", """
wallet_dependence_flag topup_heavy_flag processor_mediated_flag spend_regime premium_retail_orientation
avg_ticket_affluence_proxy travel_premium_proxy convenience_dependence fuel_dependence business_proxy_flag
financial_services_share_m""")
from_mart("risk_flags", """
concentration_shock_flag spend_drop_flag category_shock_flag high_freq_low_ticket_flag
topup_overdependence_flag unstable_flag""")
from_mart("feature_quality", "feature_quality_flag")
from_personas("persona_scores", """
score_travel score_affluent score_digital score_food_social score_everyday score_business_proxy
score_mobile_wallet score_concentration""")
from_personas("primary_persona", "primary_persona persona_confidence persona_confidence_score")
from_personas("micro_segments", " ".join(c for c in personas.CAMPAIGN_VIEW if c.startswith("ms_")))
from_personas("persona_tenure", "primary_persona primary_persona_prev_m persona_shift_flag persona_tenure_months")
from_personas("use_cases", "campaign_use_case clm_use_case pricing_use_case risk_use_case")


@query("campaign_view")
def campaign_view(spark, folder):
    return personas.campaign_view(phase3(spark, folder))


# ---------------------------------------------------------------- audits and reports

@query("phase1_audit")
def phase1_audit(spark, folder):
    return audit.tidy(audit.phase1_metrics(phase1(spark, folder)), "PHASE1")


@query("phase2_audit")
def phase2_audit(spark, folder):
    return audit.tidy(audit.phase2_metrics(measured_columns("phase2", phase2)(spark, folder)), "PHASE2")


@query("phase3_audit")
def phase3_audit(spark, folder):
    return audit.tidy(audit.phase3_metrics(measured_columns("phase3", phase3)(spark, folder)), "PHASE3")


@query("l1_distribution")
def l1_distribution(spark, folder):
    return audit.label_counts(phase1(spark, folder), "tax_l1")


@query("unclassified_top")
def unclassified_top(spark, folder):
    return audit.top_unclassified_by_spend(phase1(spark, folder))


@query("unclassified_top_count")
def unclassified_top_count(spark, folder):
    return audit.top_unclassified_by_count(phase1(spark, folder))


@query("null_rates")
def null_rates(spark, folder):
    return audit.null_rates(phase3(spark, folder))


@query("persona_counts")
def persona_counts(spark, folder):
    return audit.label_counts(phase3(spark, folder), "primary_persona")


@query("persona_distribution")
def persona_distribution(spark, folder):
    return audit.persona_distribution(phase3(spark, folder))


@query("source_coverage")
def source_coverage(spark, folder):
    return audit.source_coverage(phase1(spark, folder))


@query("feature_health")
def feature_health(spark, folder):
    return audit.feature_health(measured_columns("feature_health", phase3)(spark, folder))


@query("segment_rates")
def segment_rates(spark, folder):
    return audit.segment_rates(phase3(spark, folder))


@query("score_by_persona")
def score_by_persona(spark, folder):
    return audit.score_by_persona(phase3(spark, folder))


# ---------------------------------------------------------------- broad variant

def landed(spark, folder):
    return broad.standardize_lenient(retail.landed_transactions(spark, folder), KEY)


BROAD_TXN_COLUMNS = list(dict.fromkeys([
    *MONTH, "txn_date", "txn_amount", "merchant_key", "tax_l1", "tax_l2", "tax_l3", "taxonomy_source_used",
    "subscription_candidate_flag", *[tag for tag, _ in broad.SPENDS.values()]]))

broad_phase1 = written("broad_phase1", lambda spark, folder: broad.enrich_broad(
    retail.landed_transactions(spark, folder), KEY).select(*BROAD_TXN_COLUMNS))
broad_merchants = written("broad_merchants", lambda spark, folder: broad.merchant_rows(broad_phase1(spark, folder)))


def broad_phase2(spark: SparkSession, folder: str) -> DataFrame:
    return broad.broad_mart(broad_phase1(spark, folder), broad_merchants(spark, folder), SIZE_BOUNDS)


def broad_phase3(spark: SparkSession, folder: str) -> DataFrame:
    return broad.add_personas(broad_phase2(spark, folder))


@query("normalize_basic")
def normalize_basic(spark, folder):
    return broad.add_text_basic(card(spark, folder)).select(
        "txn_key", "mcht_nm_norm", "txn_desc_norm", "curr_desc_norm", "match_text", "merchant_tokens", "merchant_key")


@query("source_sentinel_clean")
def source_sentinel_clean(spark, folder):
    return broad.add_source_taxonomy(landed(spark, folder)).select(
        "txn_key", *[f"{s}_{level}" for s in ("mobius", "b2k") for level in broad.LEVELS])


def broad_tagged(spark, folder):
    return broad.add_rules_and_tags(broad.add_source_taxonomy(broad.add_text_basic(landed(spark, folder))))


@query("rule_match_broad")
def rule_match_broad(spark, folder):
    return broad_tagged(spark, folder).select(
        "txn_key", "matched_priority", "rule_l1", "rule_l2", "rule_l3", "matched_rule_set", "rule_match_count",
        "rule_conflict_flag")


@query("channel_geo_tags_v1")
def channel_geo_tags_v1(spark, folder):
    return broad_tagged(spark, folder).select("txn_key", "channel_tag", "geo_tag", "in_app_tag")


@query("structural_flags_v1")
def structural_flags_v1(spark, folder):
    return broad_tagged(spark, folder).select(
        "txn_key", "wallet_flag", "processor_flag", "topup_flag", "marketplace_flag", "food_delivery_flag",
        "ride_hailing_flag", "premium_merchant_flag", "business_proxy_flag", "mall_ecosystem_flag")


@query("taxonomy_reconcile_single_source")
def taxonomy_reconcile_single_source(spark, folder):
    return broad.reconcile_single_source(broad_tagged(spark, folder)).select(
        "txn_key", "taxonomy_source_used", "taxonomy_conflict_flag", "tax_l1", "tax_l2", "tax_l3",
        "taxonomy_confidence_tag", "taxonomy_match_level")


@query("recurrence_last3")
def recurrence_last3(spark, folder):
    return recurrence.add_recurrence_last3(broad.add_text_basic(card(spark, folder))).select(
        "txn_key", "prev_txn_dt_same_merchant", "days_since_prev_same_merchant", "amt_delta_prev_same_merchant",
        "avg_interval_3txns", "std_interval_3txns", "cv_interval", "merchant_novelty_tag", "recurrence_tag",
        "subscription_candidate_flag")


@query("recurrence_last3_events")
def recurrence_last3_events(spark, folder):
    return recurrence.add_recurrence_last3(broad.add_text_basic(event_card(spark, folder))).select(
        "txn_key", "avg_interval_3txns", "std_interval_3txns", "recurrence_tag")


@query("recurrence_last3_cut")
def recurrence_last3_cut(spark, folder):
    return with_key_text(recurrence.add_recurrence_last3(basic_rows(spark, folder), slice_rows=CUT_ROWS, least_cuts=1)).select(
        "txn_key", "avg_interval_3txns", "std_interval_3txns", "recurrence_tag")


def from_broad_mart(name: str, columns: str) -> None:
    @query(name)
    def select(spark, folder):
        return broad_phase2(spark, folder).select(*MONTH, *columns.split())


from_broad_mart("month_base_v1", """
txn_cnt_m spend_amt_m avg_ticket_m max_ticket_m active_days_m uniq_merchants_m uniq_tax_l1_m uniq_tax_l2_m
uniq_tax_l3_m online_spend_m offline_spend_m in_app_spend_m domestic_spend_m xborder_spend_m wallet_spend_m
topup_spend_m processor_spend_m food_delivery_spend_m ride_hailing_spend_m premium_spend_m
business_proxy_spend_m mall_spend_m recurring_spend_m recurring_txn_cnt_m recurring_merchant_cnt_m
online_spend_share_m offline_spend_share_m in_app_spend_share_m xborder_spend_share_m wallet_spend_share_m
topup_spend_share_m food_delivery_spend_share_m premium_spend_share_m business_proxy_spend_share_m
mall_spend_share_m recurring_spend_share_m dominant_ecosystem dominant_ecosystem_spend_m""")
from_broad_mart("l1_pivot_v1", " ".join(broad.L1))
from_broad_mart("merchant_intelligence_v1", """
avg_merchant_scale_txn_cnt_m max_merchant_scale_txn_cnt_m spend_at_mega_merchants_m
spend_at_large_merchants_m spend_at_longtail_merchants_m merchant_entropy_m merchant_hhi_m
top_merchant_share_m top3_merchant_share_m new_merchant_cnt_m ecosystem_entropy_m ecosystem_hhi_m""")
from_broad_mart("rolling_v1", """
spend_amt_3m txn_cnt_3m spend_amt_6m avg_ticket_3m merchant_entropy_3m_avg ecosystem_entropy_3m_avg
mom_spend_growth mom_txn_growth online_share_delta_m xborder_share_delta_m wallet_share_delta_m
premium_share_delta_m l1_migration_flag merchant_entropy_trend diversification_flag prev_txn_cnt_m2""")
from_broad_mart("regime_v1", "spend_regime_flag wallet_dependence_flag feature_quality_flag")


@query("persona_v1")
def persona_v1(spark, folder):
    return broad_phase3(spark, folder).select(
        *MONTH, *[f"share_{label.lower()}" for label in broad.L1], "primary_persona", "persona_confidence",
        "prev_persona", "persona_shift_flag")


@query("overlays_v1")
def overlays_v1(spark, folder):
    df = broad_phase3(spark, folder)
    return df.select(*MONTH, *[c for c in df.columns if c.startswith("overlay_")])


@query("campaign_view_v1")
def campaign_view_v1(spark, folder):
    return broad.views(broad_phase3(spark, folder))["campaign"]


@query("clm_view")
def clm_view(spark, folder):
    return broad.views(broad_phase3(spark, folder))["clm"]


@query("risk_view")
def risk_view(spark, folder):
    return broad.views(broad_phase3(spark, folder))["risk"]


@query("audit_v1")
def audit_v1(spark, folder):
    return (
        audit.tidy(broad.phase1_metrics(broad_phase1(spark, folder)), "PHASE1")
        .unionByName(audit.tidy(broad.phase2_metrics(broad_phase2(spark, folder)), "PHASE2"))
        .unionByName(audit.tidy(broad.phase3_metrics(broad_phase3(spark, folder)), "PHASE3")))


@query("broad_run")
def broad_run(spark, folder):
    """The audit rows of a run of all phases of the broad variant, tried twice, as stored."""
    root = scratch_path(spark, "broad_run")
    targets = Targets(f"{root}/txns", f"{root}/mart", f"{root}/people", f"{root}/audit", replace_touched=True, run_id="run-1")
    for _ in range(2):
        variants.run_broad(retail.landed_transactions(spark, folder), targets, KEY, SIZE_BOUNDS)
    return spark.read.parquet(targets.audit).select("phase", "metric", "metric_value")


# ---------------------------------------------------------------- rough input

def rough_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrich(retail.rough_transactions(spark, folder), references(spark), key_columns=KEY)


# What the rough queries but the months read of a transaction.
ROUGH_TAXONOMY = [
    "txn_key", "b2k_l1", "b2k_l2", "b2k_l3", "tax_l1", "tax_l2", "tax_l3", "taxonomy_source", "txn_size_tier",
    "time_pattern", "weekpart_tag", "payday_window_flag"]
ROUGH_COLUMNS = list(dict.fromkeys([*ROUGH_TAXONOMY, *HISTORY_RESULT, "CUST_NUM", "mcht_nm_norm", "txn_amount"]))

rough_phase1 = written("rough_phase1", lambda spark, folder: rough_enriched(spark, folder).select(*ROUGH_COLUMNS))


def rough(spark: SparkSession, folder: str) -> DataFrame:
    return standardize(retail.rough_transactions(spark, folder), KEY)


@query("rough_standardize")
def rough_standardize(spark, folder):
    return rough(spark, folder).select("txn_key", "CUST_NUM", "txn_date", "txn_ts", "txn_month", "txn_amount", "CNTRY_CD")


@query("rough_rules")
def rough_rules(spark, folder):
    """Transactions that every rule matched, won and lost; the names reach all rules."""
    return rules.rule_usage(rules.add_rules(merchant.add_merchant_text(rough(spark, folder))))


@query("rough_taxonomy")
def rough_taxonomy(spark, folder):
    return rough_phase1(spark, folder).select(*ROUGH_TAXONOMY)


@query("rough_history")
def rough_history(spark, folder):
    return rough_phase1(spark, folder).select(*HISTORY_RESULT)


@query("rough_history_cut")
def rough_history_cut(spark, folder):
    return with_key_text(recurrence.add_history(rough_rows(spark, folder), slice_rows=CUT_ROWS, least_cuts=1)).select(
        *HISTORY_RESULT)


@query("rough_months")
def rough_months(spark, folder):
    return monthly.month_totals(rough_enriched(spark, folder), labels(spark)).select(
        *MONTH, "txn_cnt_m", "spend_amt_m", "avg_ticket_m", "max_ticket_m", "min_ticket_m", "stddev_ticket_m", "active_days_m",
        "online_spend_m", "offline_spend_m", "weekend_spend_m", "payday_window_spend_m", "new_merchant_cnt_m",
        "repeat_merchant_txn_cnt_m")


@query("rough_unclassified_top")
def rough_unclassified_top(spark, folder):
    return audit.top_unclassified_by_spend(rough_phase1(spark, folder))


@query("rough_unclassified_count")
def rough_unclassified_count(spark, folder):
    return audit.top_unclassified_by_count(rough_phase1(spark, folder))


# ---------------------------------------------------------------- sinks

keyed_phase1 = written("keyed_phase1", lambda spark, folder: enriched_card(spark, folder).select(
    "txn_key", "txn_month", "txn_amount"))


@query("txn_row_ids")
def txn_row_ids(spark, folder):
    """Rows that are equal in merchant, month and channel, with a number for each copy."""
    source = retail.card_transactions(spark, folder).select(
        F.lit(None).cast("bigint").alias("CUST_NUM"), "MCHT_NM", F.lit(1.0).alias("TXN_AMT"),
        F.trunc("TXN_DT", "month").alias("TXN_DT"), "ONLN_FLAG")
    return add_row_ids(standardize(source)).groupBy("MCHT_NM", "txn_month", "ONLN_FLAG").agg(
        F.count("*").alias("rows"), F.count_distinct("txn_row_id").alias("row_ids"),
        F.min("txn_copy").alias("first_copy"), F.max("txn_copy").alias("last_copy"))


@query("sink_round_trip")
def sink_round_trip(spark, folder):
    """Stored transactions by month after a second run over every other month: what is read
    back, and whether the files of the month are those of the first run."""
    target = scratch_path(spark, "sink")
    rows = keyed_phase1(spark, folder)
    odd = F.month("txn_month") % 2 == 1

    def files():
        return spark.read.parquet(target).select(
            "txn_month", F.col("_metadata.file_name").alias("file")).distinct()

    write_table(stamp(rows, "PHASE1", "card"), target, replace_touched=True)
    before = materialize(files(), "files")
    stored = write_table(stamp(rows.where(odd), "PHASE1", "card"), target, replace_touched=True)
    kept = files().join(before, ["txn_month", "file"], "left_semi").groupBy("txn_month").agg(F.count("*").alias("old"))
    months = stored.groupBy("txn_month").agg(
        F.count("*").alias("txn_cnt"), F.count_distinct("txn_key").alias("keys"), sum_money("txn_amount").alias("spend"),
        F.max("_phase").alias("phase"), F.max("_src_table").alias("source"))
    return months.join(kept, "txn_month", "left").select(
        "txn_month", "txn_cnt", "keys", "spend", "phase", "source", F.col("old").isNotNull().alias("untouched"))


# ---------------------------------------------------------------- small variant

@query("simple_run")
def simple_run(spark, folder):
    """Personas of the small variant, written and read back."""
    return variants.run_simple(retail.card_transactions(spark, folder), scratch_path(spark, "simple_run"), key_columns=KEY)


@query("simple_tags")
def simple_tags(spark, folder):
    return simple.add_simple_tags(card(spark, folder)).select(
        "txn_key", "merchant_norm", "channel_tag", "wallet_topup_flag", "txn_size_tier")


@query("persona_simple")
def persona_simple(spark, folder):
    return simple.simple_personas(simple.add_simple_tags(card(spark, folder)))
