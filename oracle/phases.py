"""Final statements per registered query."""

from __future__ import annotations

import re

from spendlens import fixed_values as fv

from . import broad as b
from . import features as f
from .enrichment import CTES, mean, total
FINAL: dict[str, str] = {}


def num(expression: str) -> str:
    """A double as the registered queries show it: six decimals, rounded in the same steps."""
    return f"(floor(CAST({expression} AS DOUBLE) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE)"


def day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def pick(source: str, tail: str = "", **columns: str) -> str:
    return "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in columns.items()) + f" FROM {source} {tail}"


def same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def build() -> dict[str, str]:
    """Every final statement with the common table expressions it needs."""
    words = {name: re.compile(rf"(?:FROM|JOIN)\s+{name}\b") for name in CTES}

    def needed(sql: str, found: list[str]) -> list[str]:
        for name, word in words.items():
            if name not in found and word.search(sql):
                needed(CTES[name], found)
                if name not in found:
                    found.append(name)
        return found

    statements = {}
    for query, sql in FINAL.items():
        ctes = needed(sql, [])
        parts = [f"{name} AS ({CTES[name]})" for name in ctes]
        statements[query] = ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql
    return statements


# ---------------------------------------------------------------- transactions
FINAL["txn_standardize"] = pick(
    "typed", txn_key="txn_key", CUST_NUM="cust", txn_date=day("dt"),
    txn_ts="strftime(ts, '%Y-%m-%d %H:%M:%S')", txn_month=day("mon"), txn_amount=num("amt"),
    CNTRY_CD="CAST(NULL AS VARCHAR)")
FINAL["merchant_normalize"] = pick(
    "named", **same("txn_key"), mcht_nm_raw="mcht_nm", mcht_nm_norm="nm", txn_desc_norm="ds",
    **same("match_text"), merchant_key="sha256(nm)")
FINAL["merchant_tokens"] = pick(
    "named", **same("txn_key"), merchant_tokens="array_to_string(regexp_split_to_array(nm, '\\s+'), ' ')",
    merchant_token_cnt="len(regexp_split_to_array(nm, '\\s+'))",
    merchant_brand_root="regexp_split_to_array(nm, '\\s+')[1]")
FINAL["rule_match_best"] = FINAL["rule_match_theta"] = pick(
    "ruled", **same("txn_key", "priority"), matched_rule_name="rule_name",
    **same("rule_l1", "rule_l2", "rule_l3", "rule_match_cnt", "rule_conflict_flag"))
USER = [("a", 20, "GENERIC", "GENERIC"), (r"mar|sho\(p|foo\|bar", 5, "SPECIFIC", "SPECIFIC"),
        ("mark", 5, "TIED", "TIED"), ("[|e]n", 7, "GENERIC", "REPEATED")]
USER_BEST = " ".join(
    f"WHEN regexp_matches(match_text, '{pattern}') THEN {{'p': {priority}, 'n': '{name}', 'l': '{level}'}}"
    for pattern, priority, name, level in sorted(USER, key=lambda rule: rule[1]))
USER_COUNT = " + ".join(f"CASE WHEN regexp_matches(match_text, '{rule[0]}') THEN 1 ELSE 0 END" for rule in USER)
FINAL["rule_user_list"] = FINAL["rule_user_table"] = f"""
SELECT txn_key, b.p AS priority, b.n AS matched_rule_name, CASE WHEN b IS NOT NULL THEN 'TEST_L1' END AS rule_l1,
  b.l AS rule_l2, b.l AS rule_l3, n AS rule_match_cnt,
  CASE WHEN n > 1 THEN 'MULTIPLE_RULES' WHEN n = 1 THEN 'SINGLE_RULE' ELSE 'NO_RULE' END AS rule_conflict_flag
FROM (SELECT txn_key, CASE {USER_BEST} END AS b, {USER_COUNT} AS n FROM named)"""
FINAL["rule_validation"] = """
SELECT finding, rule_name, rule_l1, rule_l2, rule_l3, coalesce(n, 0) AS txn_cnt FROM (
  SELECT 'RULE_OUTSIDE' AS finding, rule_name, rule_l1, rule_l2, rule_l3 FROM rules
  ANTI JOIN hierarchy ON rule_l1 = ref_l1 AND rule_l2 = ref_l2 AND rule_l3 = ref_l3
  UNION ALL SELECT 'LEAF_WITHOUT_RULE', NULL, ref_l1, ref_l2, ref_l3 FROM hierarchy
  ANTI JOIN rules ON rule_l1 = ref_l1 AND rule_l2 = ref_l2 AND rule_l3 = ref_l3)
LEFT JOIN (SELECT tax_l1, tax_l2, tax_l3, count(*) AS n FROM taxed GROUP BY ALL) ON rule_l1 = tax_l1 AND rule_l2 = tax_l2
  AND rule_l3 = tax_l3"""
FINAL["rule_conflicts"] = """
SELECT rule_name, CAST(count(*) AS BIGINT) AS matched_txns,
       CAST(sum(CASE WHEN hit = winner THEN 1 ELSE 0 END) AS BIGINT) AS won_txns,
       CAST(sum(CASE WHEN hit <> winner THEN 1 ELSE 0 END) AS BIGINT) AS shadowed_txns
FROM (SELECT unnest(hits) AS hit, hits[1] AS winner FROM ruled) x
JOIN (SELECT priority AS p, rule_name FROM rules) r ON r.p = x.hit GROUP BY rule_name"""
FINAL["rule_hierarchy_check"] = """
SELECT coalesce(rule_l1, ref_l1) AS l1, coalesce(rule_l2, ref_l2) AS l2, coalesce(rule_l3, ref_l3) AS l3,
       coalesce(n, 0) AS txn_cnt, CASE WHEN ref_l1 IS NULL THEN 0 ELSE 1 END AS in_hierarchy,
       CASE WHEN rule_l1 IS NULL THEN 0 ELSE 1 END AS is_assigned
FROM (SELECT rule_l1, rule_l2, rule_l3, count(*) AS n FROM ruled WHERE rule_l1 IS NOT NULL GROUP BY ALL) u
FULL JOIN hierarchy ON rule_l1 = ref_l1 AND rule_l2 = ref_l2 AND rule_l3 = ref_l3"""
FINAL["source_join_b2k"] = pick(
    "sourced", **same("txn_key"), MCHT_CATG="mcht_catg", **same("b2k_l1", "b2k_l2", "b2k_l3"))
FINAL["source_join_mobius"] = pick(
    "sourced", **same("txn_key"), SIC_CD_DESC="sic", **same("mobius_l1", "mobius_l2", "mobius_l3"))
FINAL["taxonomy_reconcile"] = pick("taxed", **same(
    "txn_key", "taxonomy_source", "tax_l1", "tax_l2", "tax_l3", "taxonomy_confidence",
    "taxonomy_match_level", "taxonomy_conflict_flag"))
FINAL["taxonomy_audit"] = """
SELECT taxonomy_source, taxonomy_confidence, taxonomy_match_level, count(*) AS count
FROM taxed GROUP BY ALL"""
FINAL["channel_geo_tags"] = pick("tagged", **same("txn_key", "channel_tag", "geo_tag"))
FINAL["wallet_flags"] = pick("tagged", **same(
    "txn_key", "is_topup", "is_wallet", "is_processor_mediated", "is_risk_adjacent"))
FINAL["structural_flags"] = pick("tagged", **same(
    "txn_key", "is_marketplace", "is_mall_ecosystem", "is_premium_merchant", "is_food_delivery",
    "is_ride_hailing", "is_subscription", "is_grocery", "is_risky_merchant", "is_mall_pattern",
    "is_business_proxy", "is_travel_booking"))
FINAL["platform_ecosystem"] = pick("ruled", **same("txn_key", "platform_ecosystem"))
FINAL["size_tier"] = pick("tagged", **same("txn_key"), txn_amount=num("amt"), **same("txn_size_tier"))
TIME = same("txn_key", "hour_of_day", "has_real_timestamp", "time_pattern", "txn_dow", "weekpart_tag")
FINAL["time_tags"] = pick("tagged", **TIME)
FINAL["time_tags_events"] = pick("ev_tagged", **TIME)
FINAL["payday_tags"] = pick("tagged", **same("txn_key", "txn_dom", "payday_window_flag"))
FINAL["recurrence_history"] = pick(
    "enriched", **same("txn_key"), prev_txn_dt_merchant=day("prev_dt"), prev_txn_amt_merchant=num("prev_amt"),
    days_since_prev_merchant="gap", amt_delta_pct=num("amt_delta_pct"), merchant_visit_cnt="visits",
    avg_interval_merchant=num("avg_gap"), std_interval_merchant=num("std_gap"), cv_interval=num("cv_interval"),
    avg_amt_merchant=num("avg_amt"), std_amt_merchant=num("std_amt"), amt_cv_merchant=num("amt_cv"))
FINAL["recurrence_history_cut"] = FINAL["recurrence_history"]
FINAL["recurrence_tags"] = pick(
    "enriched", **same("txn_key"), merchant_novelty_tag="novelty", **same("recurrence_tag"),
    subscription_candidate_flag="candidate")
FINAL["recurrence_tags_events"] = pick(
    "ev_enriched", **same("txn_key"), merchant_visit_cnt="visits", merchant_novelty_tag="novelty",
    **same("recurrence_tag"), subscription_candidate_flag="candidate")
FINAL["recurrence_tags_events_cut"] = FINAL["recurrence_tags_events"]


# ---------------------------------------------------------------- customer-months
KEYS = {"CUST_NUM": "cust", "txn_month": day("mon")}
# Month-level columns that are whole numbers or text; all others are doubles.
PLAIN = re.compile(
    r"_cnt_|txn_cnt|_flag|active_days|uniq_|breadth|platform_count|dominant|second_eco|regime|orientation|proxy$"
    r"|dependence|persona|confidence$|use_case|max_visits|retained|dropped|^ms_|freq_3m|diversification|tenure")
DOUBLES = re.compile(r"score|velocity_m$|velocity_prev_m$|slope|share_m$")


def shown(name: str) -> str:
    if name == "txn_cnt_velocity_m":
        return name
    return name if PLAIN.search(name) and not DOUBLES.search(name) else num(name)


def months(source: str, columns) -> str:
    names = columns.split() if isinstance(columns, str) else columns
    return pick(source, **KEYS, **{n: shown(n) for n in names})


SPENDS = [f"{n}_spend_m" for n in f.SPENDS]
FINAL["month_base"] = months("month_rows", [
    "txn_cnt_m", "spend_amt_m", "avg_ticket_m", "max_ticket_m", "min_ticket_m", "stddev_ticket_m", "median_ticket_m",
    "active_days_m", "uniq_merchants_m", "uniq_tax_l1_m", "uniq_tax_l2_m", "uniq_tax_l3_m", *SPENDS,
    *[f"{n}_txn_cnt_m" for n in f.COUNTS], "new_merchant_cnt_m", "repeat_merchant_txn_cnt_m"])
APPROXIMATE = "active_days_m uniq_merchants_m uniq_tax_l1_m uniq_tax_l2_m uniq_tax_l3_m".split()
FINAL["month_base_approx"] = pick(
    "month_rows", **KEYS, **same(*APPROXIMATE), **{f"{name}_near": "true" for name in APPROXIMATE})
def rolled(key: str, column: str, period: str, **sets: str) -> str:
    near = {f"{name}_near": "true" for name in [*sets, "median"]}
    return pick(f"(SELECT {column}, date_trunc('{period}', mon) AS period, count(*) AS n, {total('amt')} AS spend, "
                + ", ".join(f"count(DISTINCT {sql}) AS {name}_cnt" for name, sql in sets.items())
                + " FROM enriched GROUP BY ALL)", **{key: column}, period=day("period"), txn_cnt="n", spend=num("spend"),
                **same(*[f"{name}_cnt" for name in sets]), **near)


FINAL["sketch_quarters"] = rolled(
    "CUST_NUM", "cust", "quarter", days="dt", merchants="nm", l1="tax_l1", l2="tax_l2", l3="tax_l3")
FINAL["sketch_merchant_years"] = rolled("mcht_nm_norm", "nm", "year", days="dt", customers="cust")
OTHERS = "CASE WHEN tax_l1 NOT IN ('FOOD_DINING', 'EVERYDAY_ESSENTIALS') THEN amt END"
FINAL["l1_spend_check"] = f"""
SELECT cust AS CUST_NUM, {day('mon')} AS txn_month, {num(total('amt'))} AS spend_amt_m, {num(total('amt'))} AS l1_spend_m,
  {num(f"coalesce({total(OTHERS)}, 0)")} AS l1_remainder_spend_m
FROM enriched GROUP BY cust, mon"""
FINAL["month_base_events"] = months("ev_month_sums", """
txn_cnt_m spend_amt_m active_days_m online_spend_m offline_spend_m inapp_spend_m morning_spend_m lunch_spend_m
evening_spend_m late_night_spend_m weekend_spend_m payday_window_spend_m new_merchant_cnt_m""")
FINAL["month_shares"] = months("month_rows", [f"{n}_share_m" for n in f.SHARES] + [
    "consumption_spend_m", "txn_per_active_day_m", "merchant_repeat_ratio_m", "merchant_novelty_rate_m"])
FINAL["l1_pivot"] = months("l1_month", [f"l1_{x.lower()}_spend_m" for x in f.L1]
                           + [f"l1_{x.lower()}_share_m" for x in fv.ECOSYSTEMS])
FINAL["dominant_ecosystem"] = months("l1_month", "dominant_ecosystem second_ecosystem top_l1_share")
FINAL["category_breadth"] = months("l1_month", "category_breadth_m")
FINAL["platform_month"] = months(
    "platform_months", "platform_count_m platform_spend_m platform_txn_cnt_m platform_share_m dominant_platform")
FINAL["l2_pivot"] = months("l2_month", [f"l2_{x.lower()}_{kind}_m" for kind in ("spend", "share") for x in fv.KEY_L2])
FINAL["merchant_entropy"] = months("merchant_mix", "merchant_entropy_m merchant_hhi_m merchant_cnt_m")
FINAL["top_merchants"] = months("features", "top1_merchant_share_m top3_merchant_spend_m top3_merchant_share_m")
FINAL["ecosystem_entropy"] = months("ecosystem_mix", "ecosystem_entropy_m ecosystem_hhi_m")
FINAL["merchant_scale"] = months("scale", """avg_merchant_scale_m spend_at_mega_merchants_m
spend_at_large_merchants_m spend_at_longtail_merchants_m""")
FINAL["merchant_sizes"] = pick(
    "merchant_size", mcht_nm_norm="nm", txn_month=day("mon"), merchant_global_txn_cnt="txns",
    merchant_global_cust_cnt="custs")
FINAL["merchant_loyalty"] = months("loyalty", "avg_visits_per_merchant_m max_visits_per_merchant_m loyal_merchant_cnt_m").replace(
    "avg_visits_per_merchant_m AS", num("avg_visits_per_merchant_m") + " AS")
FINAL["merchant_turnover"] = months("turnover", """retained_merchant_cnt_m dropped_merchant_cnt_m
merchant_turnover_rate_m merchant_churn_rate_m merchant_retention_rate_m""")
FINAL["merchant_retained_join"] = months("retained", "retained_merchant_cnt_m")
FINAL["new_merchants_first_seen"] = pick(
    "(SELECT cust, mon, count(*) AS n FROM (SELECT cust, nm, min(mon) AS mon FROM named GROUP BY ALL) GROUP BY ALL)",
    **KEYS, new_merchant_cnt_m="n")
FINAL["recurring_summary"] = months("features", """
subscription_merchant_cnt_m recurring_merchant_cnt_m episodic_merchant_cnt_m irregular_merchant_cnt_m
subscription_like_spend_m recurring_spend_m avg_recurring_interval_m avg_recurring_cv_m recurring_spend_share_m
subscription_like_spend_share_m""")

FINAL["rolling_3m"] = months("changed", """
spend_amt_3m txn_cnt_3m avg_ticket_3m online_share_3m xborder_share_3m wallet_share_3m premium_share_3m
merchant_entropy_3m grocery_share_3m late_night_share_3m weekend_share_3m ride_hailing_share_3m
food_delivery_share_3m dominant_ecosystem_freq_3m spend_vs_3m_avg_ratio""")
FINAL["rolling_6m_12m"] = months("changed", """
spend_amt_6m txn_cnt_6m spend_stability_6m spend_amt_12m txn_cnt_12m avg_ticket_12m spend_stability_12m""")
FINAL["mom_velocity"] = months("mart", """
spend_prev_m txn_cnt_prev_m spend_velocity_m spend_pct_change_m txn_cnt_velocity_m avg_ticket_prev_m
avg_ticket_change_m spend_velocity_prev_m spend_acceleration_m""")
FINAL["share_slopes"] = months("changed", """
online_share_prev_m online_share_slope_m xborder_share_prev_m xborder_share_slope_m wallet_share_prev_m
wallet_share_slope_m premium_share_prev_m premium_share_slope_m""")
FINAL["migration_trend"] = months("changed", """
dominant_ecosystem_prev_m l1_migration_flag merchant_entropy_prev_m entropy_trend_m diversification_flag
ecosystem_hhi_prev_m ecosystem_hhi_change_m merchant_hhi_prev_m merchant_hhi_change_m""")
FINAL["spend_regime"] = months("mart", """
wallet_dependence_flag topup_heavy_flag processor_mediated_flag spend_regime premium_retail_orientation
avg_ticket_affluence_proxy travel_premium_proxy convenience_dependence fuel_dependence business_proxy_flag
financial_services_share_m""")
FINAL["risk_flags"] = months("mart", """
concentration_shock_flag spend_drop_flag category_shock_flag high_freq_low_ticket_flag
topup_overdependence_flag unstable_flag""")
FINAL["feature_quality"] = months("mart", "feature_quality_flag")
SCORES = """score_travel score_affluent score_digital score_food_social score_everyday score_business_proxy
score_mobile_wallet score_concentration""".split()
FINAL["persona_scores"] = months("scored", SCORES)
FINAL["primary_persona"] = months("scored", "primary_persona persona_confidence persona_confidence_score")
FINAL["micro_segments"] = months("scored", [f"ms_{n}" for n in f.OVERLAYS])
FINAL["persona_tenure"] = months(
    "tenured", "primary_persona primary_persona_prev_m persona_shift_flag persona_tenure_months")
FINAL["use_cases"] = months("personas", "campaign_use_case clm_use_case pricing_use_case risk_use_case")
FINAL["campaign_view"] = months("personas", """
primary_persona persona_confidence persona_confidence_score persona_shift_flag persona_tenure_months
campaign_use_case clm_use_case pricing_use_case risk_use_case
spend_amt_m consumption_spend_m txn_cnt_m avg_ticket_m max_ticket_m txn_per_active_day_m
online_share_m xborder_share_m wallet_share_m premium_share_m
merchant_entropy_m merchant_hhi_m top3_merchant_share_m
merchant_repeat_ratio_m merchant_novelty_rate_m merchant_churn_rate_m merchant_retention_rate_m
spend_velocity_m spend_acceleration_m dominant_ecosystem second_ecosystem category_breadth_m
dominant_platform platform_count_m platform_share_m l1_migration_flag diversification_flag
spend_regime feature_quality_flag spend_amt_3m avg_ticket_3m online_share_3m spend_vs_3m_avg_ratio
spend_amt_12m txn_cnt_12m spend_stability_12m grocery_share_3m late_night_share_3m weekend_share_3m
score_travel score_affluent score_digital score_food_social score_everyday score_business_proxy
score_mobile_wallet score_concentration
ms_subscription_heavy ms_wallet_dependent ms_food_delivery_native ms_cross_border_frequent
ms_weekend_spender ms_healthcare_engaged ms_premium_retail_oriented ms_convenience_dependent
ms_installment_buyer_proxy ms_fuel_dependent ms_reactivating_user ms_business_spend_proxy
ms_risk_monitor_flag ms_grocery_anchor ms_payday_spender ms_ride_hailing_regular
concentration_shock_flag spend_drop_flag topup_overdependence_flag wallet_dependence_flag business_proxy_flag""")

# ---------------------------------------------------------------- audits and reports


def tidy(phase: str, source: str, doubles: dict[str, str], **counts: str) -> str:
    """One scan, then a row per metric."""
    whole = ", ".join(f"CAST({sql} AS BIGINT) AS {name}" for name, sql in counts.items())
    parts = ", ".join(f"CAST(round({sql}, 6) AS DECIMAL(38, 6)) AS {name}" for name, sql in doubles.items())
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS metric, CAST({name} AS VARCHAR) AS metric_value FROM a" for name in [*counts, *doubles])
    return f"SELECT '{phase}' AS phase, metric, metric_value FROM (WITH a AS (SELECT {whole}, {parts} FROM {source}) {rows})"


def cnt(condition: str) -> str:
    return f"coalesce(sum(CASE WHEN {condition} THEN 1 ELSE 0 END), 0)"


UNCLASSIFIED, RULED = cnt("tax_l1 = 'UNCLASSIFIED'"), cnt("taxonomy_source = 'MERCHANT_RULE'")
FINAL["phase1_audit"] = tidy(
    "PHASE1", "taxed", {"unclassified_rate": f"{UNCLASSIFIED}::DOUBLE / count(*)", "rule_coverage_rate": f"{RULED}::DOUBLE / count(*)"},
    total_txns="count(*)", unique_customers="count(DISTINCT cust)", unique_merchants="count(DISTINCT sha256(nm))",
    unclassified_cnt=UNCLASSIFIED, rule_matched_cnt=RULED, mobius_matched_cnt=cnt("taxonomy_source = 'MOBIUS'"),
    b2k_matched_cnt=cnt("taxonomy_source = 'B2K'"), multi_rule_conflicts=cnt("rule_conflict_flag = 'MULTIPLE_RULES'"),
    source_conflicts=cnt("taxonomy_conflict_flag = 'MOBIUS_B2K_DISAGREE'"))
FINAL["phase2_audit"] = tidy(
    "PHASE2", "mart", {"avg_txn_cnt": "avg(txn_cnt_m)", "avg_spend": mean("spend_amt_m"),
                       "avg_merchant_entropy": "avg(merchant_entropy_m)", "avg_merchant_hhi": "avg(merchant_hhi_m)"},
    total_cust_months="count(*)", unique_customers="count(DISTINCT cust)", good_quality_cnt=cnt("feature_quality_flag = 'GOOD'"),
    low_vol_cnt=cnt("feature_quality_flag = 'LOW_VOLUME'"), zero_spend_cnt=cnt("feature_quality_flag = 'ZERO_SPEND'"))
PERSONA_METRICS = {
    "everyday": "EVERYDAY_ANCHOR", "digital": "DIGITAL_NATIVE", "lifestyle": "LIFESTYLE_SOCIAL", "travel": "TRAVEL_CENTRIC",
    "affluent": "AFFLUENT_LIFESTYLE", "emerging": "EMERGING_MOBILE", "business": "BUSINESS_PROXY",
    "loyalist": "CONCENTRATED_LOYALIST", "explorer": "DIVERSIFIED_EXPLORER", "dormant": "DORMANT_LOW_ACTIVITY"}
FINAL["phase3_audit"] = tidy(
    "PHASE3", "shifted", {"avg_persona_shift_rate": "avg(persona_shift_flag)"},
    total_cust_months="count(*)", unique_customers="count(DISTINCT cust)", risk_flagged_cnt="sum(ms_risk_monitor_flag)",
    **{f"persona_{short}": cnt(f"primary_persona = '{name}'") for short, name in PERSONA_METRICS.items()})
FINAL["l1_distribution"] = "SELECT tax_l1, count(*) AS count FROM taxed GROUP BY tax_l1"
FINAL["unclassified_top"] = f"""
SELECT nm AS mcht_nm_norm, count(*) AS txn_count, {num(total('amt'))} AS total_spend, count(DISTINCT cust) AS unique_customers
FROM taxed WHERE taxonomy_source = 'UNCLASSIFIED' GROUP BY nm ORDER BY sum(amt) DESC, nm LIMIT 20"""
FINAL["unclassified_top_count"] = """
SELECT nm AS mcht_nm_norm, count(*) AS count FROM taxed WHERE tax_l1 = 'UNCLASSIFIED'
GROUP BY nm ORDER BY count(*) DESC, nm LIMIT 50"""
CRITICAL = """spend_amt_m txn_cnt_m avg_ticket_m merchant_entropy_m online_share_m wallet_share_m dominant_ecosystem
primary_persona persona_confidence spend_regime spend_amt_3m spend_amt_12m grocery_share_m late_night_share_m
payday_share_m""".split()
FINAL["null_rates"] = "SELECT " + ", ".join(
    f"{num(f'round(avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100, 2)')} AS {c}" for c in CRITICAL) + " FROM scored"
FINAL["persona_counts"] = "SELECT primary_persona, count(*) AS count FROM scored GROUP BY primary_persona"
FINAL["persona_distribution"] = f"""
SELECT primary_persona, count(*) AS customer_months, {num(f'round({mean("spend_amt_m")}, 2)')} AS avg_spend,
  {num('round(avg(txn_cnt_m), 1)')} AS avg_txn_cnt, {num('round(avg(avg_ticket_m), 2)')} AS avg_ticket,
  {num('round(avg(persona_confidence_score), 3)')} AS avg_confidence
FROM scored GROUP BY primary_persona"""
FINAL["source_coverage"] = f"""
SELECT taxonomy_source, count(*) AS txn_count, {num(total('amt'))} AS total_spend,
  {num(f'round({total("amt")} / (SELECT {total("amt")} FROM taxed) * 100, 2)')} AS spend_pct
FROM taxed GROUP BY taxonomy_source"""
FINAL["feature_health"] = f"""
SELECT count(*) AS total_rows, count(DISTINCT cust) AS unique_customers, count(DISTINCT mon) AS months_covered,
  {num(f'round({mean("spend_amt_m")}, 2)')} AS avg_spend_m, {num('round(avg(txn_cnt_m), 1)')} AS avg_txn_cnt,
  {num('round(avg(merchant_entropy_m), 3)')} AS avg_merchant_entropy,
  {num('round(avg(online_share_m), 3)')} AS avg_online_share, {num('round(avg(wallet_share_m), 3)')} AS avg_wallet_share
FROM mart"""
FINAL["segment_rates"] = "SELECT " + ", ".join(
    f"{num(f'round(avg(ms_{n}) * 100, 2)')} AS ms_{n}" for n in f.OVERLAYS) + " FROM scored"
FINAL["score_by_persona"] = "SELECT primary_persona, " + ", ".join(
    f"{num(f'round(avg({c}), 3)')} AS {c}" for c in SCORES) + " FROM scored GROUP BY primary_persona"


# ---------------------------------------------------------------- broad variant
FINAL["normalize_basic"] = pick(
    "basic_named", **same("txn_key"), mcht_nm_norm="bnm", txn_desc_norm="bds", curr_desc_norm="bcur",
    **same("match_text"), merchant_tokens="bnm", merchant_key="mkey")
FINAL["source_sentinel_clean"] = pick("landed", **same(
    "txn_key", "mobius_l1", "mobius_l2", "mobius_l3", "b2k_l1", "b2k_l2", "b2k_l3"))
FINAL["rule_match_broad"] = pick("broad_tagged", **same(
    "txn_key", "matched_priority", "rule_l1", "rule_l2", "rule_l3", "matched_rule_set", "rule_match_count"),
    rule_conflict_flag="broad_conflict")
FINAL["channel_geo_tags_v1"] = pick("broad_tagged", **same("txn_key", "channel_tag", "geo_tag", "in_app_tag"))
FINAL["structural_flags_v1"] = pick("broad_tagged", **same(
    "txn_key", "wallet_flag", "processor_flag", "topup_flag", "marketplace_flag", "food_delivery_flag",
    "ride_hailing_flag", "premium_merchant_flag", "business_proxy_flag", "mall_ecosystem_flag"))
FINAL["taxonomy_reconcile_single_source"] = pick(
    "broad_taxed", **same("txn_key"), taxonomy_source_used="source", **same(
        "taxonomy_conflict_flag", "tax_l1", "tax_l2", "tax_l3", "taxonomy_confidence_tag", "taxonomy_match_level"))
FINAL["recurrence_last3"] = pick(
    "basic_last3", **same("txn_key"), prev_txn_dt_same_merchant=day("prev_dt"), days_since_prev_same_merchant="gap",
    amt_delta_prev_same_merchant=num("delta"), avg_interval_3txns=num("avg3"), std_interval_3txns=num("std3"),
    cv_interval=num("cv3"), merchant_novelty_tag="novelty", **same("recurrence_tag"),
    subscription_candidate_flag="candidate")
FINAL["recurrence_last3_cut"] = pick(
    "basic_last3", **same("txn_key"), avg_interval_3txns=num("avg3"), std_interval_3txns=num("std3"), **same("recurrence_tag"))
FINAL["recurrence_last3_events"] = pick(
    "ev_last3", **same("txn_key"), avg_interval_3txns=num("avg3"), std_interval_3txns=num("std3"), **same("recurrence_tag"))
FINAL["month_base_v1"] = months("broad_mart", """
txn_cnt_m spend_amt_m avg_ticket_m max_ticket_m active_days_m uniq_merchants_m uniq_tax_l1_m uniq_tax_l2_m
uniq_tax_l3_m recurring_txn_cnt_m recurring_merchant_cnt_m dominant_ecosystem""".split()
    + [f"{n}_spend_m" for n in b.SPENDS] + [f"{n}_spend_share_m" for n in b.SHARED]
).replace("dominant_ecosystem AS dominant_ecosystem",
          f"dominant_ecosystem, {num('dominant_ecosystem_spend_m')} AS dominant_ecosystem_spend_m")
FINAL["l1_pivot_v1"] = months("broad_mart", b.L1)
FINAL["merchant_intelligence_v1"] = pick(
    "broad_mart", **KEYS, avg_merchant_scale_txn_cnt_m=num("avg_merchant_scale_txn_cnt_m"),
    **same("max_merchant_scale_txn_cnt_m", "new_merchant_cnt_m"), **{n: num(n) for n in """
spend_at_mega_merchants_m spend_at_large_merchants_m spend_at_longtail_merchants_m merchant_entropy_m merchant_hhi_m
top_merchant_share_m top3_merchant_share_m ecosystem_entropy_m ecosystem_hhi_m""".split()})
FINAL["rolling_v1"] = months("broad_mart", """
spend_amt_3m txn_cnt_3m spend_amt_6m avg_ticket_3m merchant_entropy_3m_avg ecosystem_entropy_3m_avg
mom_spend_growth mom_txn_growth online_share_delta_m xborder_share_delta_m wallet_share_delta_m
premium_share_delta_m l1_migration_flag merchant_entropy_trend diversification_flag prev_txn_cnt_m2""")
FINAL["regime_v1"] = months("broad_mart", "spend_regime_flag wallet_dependence_flag feature_quality_flag")
FINAL["persona_v1"] = pick(
    "broad_personas", **KEYS, **{f"share_{x.lower()}": num(f"share_{x.lower()}") for x in b.L1},
    **same("primary_persona"), persona_confidence=num("persona_confidence"), **same("prev_persona", "persona_shift_flag"))
FINAL["overlays_v1"] = pick("broad_personas", **KEYS, **same(*[f"overlay_{n}" for n in b.OVERLAYS]))
FINAL["campaign_view_v1"] = pick(
    "broad_personas", **KEYS, **same("primary_persona"), persona_confidence=num("persona_confidence"), **same(
        "overlay_subscription_heavy", "overlay_wallet_dependent", "overlay_food_delivery_native",
        "overlay_cross_border_frequent", "overlay_healthcare_engaged", "overlay_premium_retail_oriented",
        "spend_regime_flag", "feature_quality_flag", "dominant_ecosystem"),
    **{n: num(n) for n in ("food_delivery_spend_share_m", "premium_spend_share_m", "xborder_spend_share_m")})
FINAL["clm_view"] = pick(
    "broad_personas", "WHERE feature_quality_flag = 'GOOD'", **KEYS, **same("primary_persona"), **{n: num(n) for n in """
persona_confidence spend_amt_m spend_amt_3m mom_spend_growth avg_ticket_m premium_spend_share_m xborder_spend_share_m
merchant_entropy_m ecosystem_entropy_m""".split()})
FINAL["risk_view"] = pick(
    "broad_personas", **KEYS, **same("primary_persona", "spend_regime_flag", "overlay_risk_monitor_flag",
                                     "l1_migration_flag", "diversification_flag"),
    **{n: num(n) for n in """topup_spend_share_m wallet_spend_share_m business_proxy_spend_share_m mom_spend_growth
merchant_entropy_trend""".split()})


def percent(condition: str) -> str:
    return f"round(avg(CASE WHEN {condition} THEN 1 ELSE 0 END) * 100, 4)"


FINAL["audit_v1"] = " UNION ALL ".join([
    tidy("PHASE1", "broad_taxed", {
        "unclassified_pct": percent("tax_l1 = 'OTHER_LONGTAIL'"), "rule_coverage_pct": percent("source = 'MERCHANT_RULE'"),
        "mobius_coverage_pct": percent("source = 'MOBIUS'"), "b2k_coverage_pct": percent("source = 'B2K'")},
        total_records="count(*)"),
    tidy("PHASE2", "broad_mart", {"low_volume_pct": percent("feature_quality_flag = 'LOW_VOLUME'")},
         customer_months="count(*)"),
    "SELECT 'PHASE3' AS phase, 'persona_count' AS metric, CAST(count(*) AS VARCHAR) AS metric_value FROM broad_personas"])

# ---------------------------------------------------------------- small variant
FINAL["simple_tags"] = pick(
    "plain_tagged", **same("txn_key"), merchant_norm="pnm", **same("channel_tag", "wallet_topup_flag", "txn_size_tier"))
FINAL["persona_simple"] = pick(
    "plain_months", **KEYS, **same("txn_cnt_m", "uniq_merchants_m", "wallet_txn_cnt", "primary_persona"),
    **{n: num(n) for n in "spend_amt_m avg_ticket_m online_spend_m merchant_entropy spend_prev_m spend_velocity".split()})

# ---------------------------------------------------------------- sinks and runs
FINAL["broad_run"] = FINAL["audit_v1"]
FINAL["simple_run"] = FINAL["persona_simple"]
FINAL["txn_row_ids"] = f"""
SELECT mcht_nm AS MCHT_NM, {day('mon')} AS txn_month, onln AS ONLN_FLAG, count(*) AS rows, count(*) AS row_ids,
  CAST(0 AS BIGINT) AS first_copy, count(*) - 1 AS last_copy FROM typed GROUP BY ALL"""
FINAL["sink_round_trip"] = f"""
SELECT {day('mon')} AS txn_month, count(*) AS txn_cnt, count(*) AS keys, {num(total('amt'))} AS spend, 'PHASE1' AS phase,
  'card' AS source, month(mon) % 2 = 0 AS untouched FROM typed GROUP BY mon"""

# ---------------------------------------------------------------- rough input
FINAL["rough_standardize"] = FINAL["txn_standardize"].replace("FROM typed", "FROM ro_typed")
FINAL["rough_rules"] = FINAL["rule_conflicts"].replace("FROM ruled", "FROM ro_ruled")
FINAL["rough_taxonomy"] = pick("ro_tagged", **same(
    "txn_key", "b2k_l1", "b2k_l2", "b2k_l3", "tax_l1", "tax_l2", "tax_l3", "taxonomy_source", "txn_size_tier", "time_pattern",
    "weekpart_tag", "payday_window_flag"))
FINAL["rough_history"] = FINAL["rough_history_cut"] = FINAL["recurrence_history"].replace("FROM enriched", "FROM ro_enriched")
FINAL["rough_months"] = months("ro_month_sums", """
txn_cnt_m spend_amt_m avg_ticket_m max_ticket_m min_ticket_m stddev_ticket_m active_days_m online_spend_m offline_spend_m
weekend_spend_m payday_window_spend_m new_merchant_cnt_m repeat_merchant_txn_cnt_m""").replace(
    num("active_days_m"), "active_days_m")
FINAL["rough_unclassified_top"] = FINAL["unclassified_top"].replace("FROM taxed", "FROM ro_taxed")
FINAL["rough_unclassified_count"] = FINAL["unclassified_top_count"].replace("FROM taxed", "FROM ro_taxed")

# ---------------------------------------------------------------- sources that lack something
FINAL["taxonomy_no_sources"] = """
SELECT txn_key, CASE WHEN rule_l1 IS NULL THEN 'UNCLASSIFIED' ELSE 'MERCHANT_RULE' END AS taxonomy_source,
  coalesce(rule_l1, 'UNCLASSIFIED') AS tax_l1, coalesce(rule_l2, 'UNCLASSIFIED') AS tax_l2, coalesce(rule_l3, 'UNCLASSIFIED') AS tax_l3,
  CASE WHEN rule_l1 IS NULL THEN 'LOW' ELSE 'HIGH' END AS taxonomy_confidence,
  CASE WHEN rule_l1 IS NULL THEN 'NONE' ELSE 'L3' END AS taxonomy_match_level, 'NO_SOURCE' AS taxonomy_conflict_flag
FROM ruled"""
PRESENT = {"CUST_NUM": "cust", "txn_date": day("dt"), "txn_month": day("mon"), "txn_amount": num("amt")}
FINAL["output_columns"] = pick(
    "ev_typed", **same("txn_key"), **{c: PRESENT.get(c, "CAST(NULL AS VARCHAR)") for c in fv.BROAD_OUTPUT_COLUMNS})
