"""SQL of the broad and the small variant."""

from __future__ import annotations

from spendlens import fixed_values as fv

from .enrichment import CTES, bit, clean_basic, listed, mean, quote, rx, tiers, total, units, values
from .features import commas, total_of

L1 = [*fv.ECOSYSTEMS, "OTHER_LONGTAIL"]
RULES = [(priority, l3, pattern, l1, l2, l3) for priority, l1, l2, l3, pattern in fv.BROAD_RULES]

CTES["basic_named"] = f"""
SELECT *, concat_ws(' | ', bnm, bds) AS match_text, sha256(concat_ws('||', bnm, bds)) AS mkey FROM (
  SELECT *, {clean_basic('mcht_nm')} AS bnm, {clean_basic('txn_desc')} AS bds, {clean_basic('curr_desc')} AS bcur
  FROM typed)"""
CTES["landed"] = """
SELECT *, CASE WHEN f1 IN ('#N/A', 'null', '') THEN NULL ELSE f1 END AS mobius_l1,
  CASE WHEN f2 IN ('#N/A', 'null', '') THEN NULL ELSE f2 END AS mobius_l2,
  CASE WHEN f3 IN ('#N/A', 'null', '') THEN NULL ELSE f3 END AS mobius_l3,
  CAST(NULL AS VARCHAR) AS b2k_l1, CAST(NULL AS VARCHAR) AS b2k_l2, CAST(NULL AS VARCHAR) AS b2k_l3
FROM (SELECT n.*,
  CASE p_size % 5 WHEN 0 THEN '#N/A' WHEN 1 THEN '' WHEN 2 THEN 'SHOPPING_RETAIL' WHEN 3 THEN 'EDUCATION' END AS f1,
  CASE p_size % 3 WHEN 0 THEN 'UNCLASSIFIED' WHEN 1 THEN 'FASHION' ELSE 'null' END AS f2,
  CASE p_size % 2 WHEN 0 THEN 'SPORTSWEAR' ELSE 'UNCLASSIFIED' END AS f3
  FROM basic_named n)"""
CTES["broad_rules"] = (
    "SELECT * FROM (" + values([(i, r[0], *r[3:]) for i, r in enumerate(RULES, 1)])
    + ") AS r(place, matched_priority, rule_l1, rule_l2, rule_l3)")
HITS = ", ".join(f"CASE WHEN {rx(r[2])} THEN {i} END" for i, r in enumerate(RULES, 1))
PATHS = ", ".join(f"CASE WHEN {rx(r[2])} THEN {quote('|'.join(r[3:]))} END" for r in RULES)
TAGS = {
    "wallet_flag": fv.BROAD_WALLET, "processor_flag": fv.BROAD_PROCESSOR, "names_topup": fv.BROAD_TOPUP,
    "marketplace_flag": fv.BROAD_MARKETPLACE, "food_delivery_flag": fv.BROAD_FOOD_DELIVERY,
    "ride_hailing_flag": fv.BROAD_RIDE_HAILING, "premium_merchant_flag": fv.BROAD_LUXURY_MALL,
    "business_proxy_flag": fv.BROAD_B2B,
    "mall_ecosystem_flag": "|".join([fv.BROAD_CENTRAL, fv.BROAD_THE_MALL, fv.BROAD_SIAM_EM, fv.BROAD_MEGA]),
}
CTES["broad_texts"] = f"""
SELECT match_text, list_filter([{HITS}], lambda x: x IS NOT NULL) AS hits,
  array_to_string(list_sort(list_filter([{PATHS}], lambda x: x IS NOT NULL)), ' ') AS matched_rule_set,
  {', '.join(f'{bit(rx(p))} AS {n}' for n, p in TAGS.items())}
FROM (SELECT DISTINCT match_text FROM basic_named)"""
VALID = "({0} IS NOT NULL AND {0} NOT IN ('#N/A', 'null', '', 'UNCLASSIFIED'))".format
CTES["broad_tagged"] = f"""
SELECT *, {bit("channel_tag = 'IN_APP'")} AS in_app_tag,
  CASE WHEN matched_priority IS NOT NULL THEN 'MERCHANT_RULE' WHEN {VALID('mobius_l1')} THEN 'MOBIUS'
       WHEN {VALID('b2k_l1')} THEN 'B2K' ELSE 'UNCLASSIFIED' END AS source
FROM (SELECT n.*, t.* EXCLUDE (match_text), r.*, len(hits) AS rule_match_count,
  CASE WHEN len(hits) > 1 THEN 'MULTIPLE_RULES_MATCHED' WHEN len(hits) = 1 THEN 'SINGLE_RULE_MATCHED'
       ELSE 'NO_RULE_MATCH' END AS broad_conflict,
  CASE WHEN food_delivery_flag = 1 OR ride_hailing_flag = 1 OR wallet_flag = 1 THEN 'IN_APP'
       WHEN onln IN ('Y', '1') THEN 'ONLINE' WHEN onln IN ('N', '0') THEN 'OFFLINE' ELSE 'UNKNOWN' END AS channel_tag,
  CASE WHEN regexp_matches(bcur, '\\b(thb|baht)\\b') THEN 'DOMESTIC' WHEN bcur = '' THEN 'UNKNOWN'
       ELSE 'CROSS_BORDER' END AS geo_tag,
  {bit('names_topup = 1 OR wallet_flag = 1')} AS topup_flag
  FROM landed n JOIN broad_texts t USING (match_text) LEFT JOIN broad_rules r ON r.place = t.hits[1])"""


def level(name: str, fallback: str) -> str:
    return (f"CASE source WHEN 'MERCHANT_RULE' THEN rule_{name} WHEN 'MOBIUS' THEN mobius_{name} "
            f"WHEN 'B2K' THEN b2k_{name} ELSE '{fallback}' END AS tax_{name}")


CTES["broad_taxed"] = f"""
SELECT *, CASE WHEN {VALID('mobius_l1')} AND {VALID('b2k_l1')} AND mobius_l1 <> b2k_l1 THEN 'MOBIUS_B2K_MISMATCH'
               ELSE 'NO_CONFLICT' END AS taxonomy_conflict_flag,
  CASE WHEN source = 'MERCHANT_RULE' THEN 'HIGH'
       WHEN source IN ('MOBIUS', 'B2K') AND tax_l3 <> 'UNCLASSIFIED' THEN 'MEDIUM'
       WHEN source IN ('MOBIUS', 'B2K') AND tax_l2 <> 'UNCLASSIFIED' THEN 'LOW' ELSE 'VERY_LOW' END AS taxonomy_confidence_tag,
  CASE WHEN tax_l3 <> 'UNCLASSIFIED' THEN 'L3' WHEN tax_l2 <> 'UNCLASSIFIED' THEN 'L2'
       WHEN tax_l1 <> 'OTHER_LONGTAIL' THEN 'L1' ELSE 'NONE' END AS taxonomy_match_level
FROM (SELECT *, {level('l1', 'OTHER_LONGTAIL')}, {level('l2', 'UNCLASSIFIED')}, {level('l3', 'UNCLASSIFIED')}
      FROM broad_tagged)"""


def last3_ctes(prefix: str, source: str) -> None:
    order = "PARTITION BY cust, mkey ORDER BY dt, ts, txn_key"
    frame = f"({order} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    CTES[f"{prefix}last3"] = f"""
SELECT *, {bit("recurrence_tag IN ('SUBSCRIPTION_LIKE', 'RECURRING')")} AS candidate
FROM (SELECT *, CASE WHEN prev_dt IS NULL THEN 'FIRST_TIME' ELSE 'REPEAT' END AS novelty,
  CASE WHEN prev_dt IS NULL THEN 'FIRST_TIME'
       WHEN gap BETWEEN 20 AND 45 AND coalesce(cv3, 999.0) < 0.35 AND coalesce(delta, 999.0) < 0.20 THEN 'SUBSCRIPTION_LIKE'
       WHEN gap BETWEEN 7 AND 60 AND coalesce(cv3, 999.0) < 0.60 THEN 'RECURRING'
       WHEN gap BETWEEN 1 AND 120 THEN 'IRREGULAR' ELSE 'EPISODIC' END AS recurrence_tag
  FROM (SELECT *, CASE WHEN avg3 > 0 THEN std3 / avg3 END AS cv3
    FROM (SELECT *, avg(gap) OVER {frame} AS avg3, stddev_samp(gap) OVER {frame} AS std3,
            CASE WHEN prev_amt <> 0 THEN abs(amt - prev_amt) / abs(prev_amt) END AS delta
      FROM (SELECT *, date_diff('day', prev_dt, dt) AS gap
        FROM (SELECT *, lag(dt) OVER ({order}) AS prev_dt, lag(amt) OVER ({order}) AS prev_amt FROM {source})))))"""


last3_ctes("basic_", "basic_named")
CTES["ev_basic"] = f"""
SELECT *, sha256(concat_ws('||', {clean_basic('mcht_nm')}, {clean_basic('txn_desc')})) AS mkey FROM ev_typed"""
last3_ctes("ev_", "ev_basic")
last3_ctes("broad_", "broad_taxed")

SPENDS = {
    "online": "channel_tag = 'ONLINE'", "offline": "channel_tag = 'OFFLINE'", "in_app": "channel_tag = 'IN_APP'",
    "domestic": "geo_tag = 'DOMESTIC'", "xborder": "geo_tag = 'CROSS_BORDER'", "wallet": "wallet_flag = 1",
    "topup": "topup_flag = 1", "processor": "processor_flag = 1", "food_delivery": "food_delivery_flag = 1",
    "ride_hailing": "ride_hailing_flag = 1", "premium": "premium_merchant_flag = 1",
    "business_proxy": "business_proxy_flag = 1", "mall": "mall_ecosystem_flag = 1", "recurring": "candidate = 1",
}
SHARED = "online offline in_app xborder wallet topup food_delivery premium business_proxy mall recurring".split()


def div(part: str, total: str) -> str:
    return f"CASE WHEN {total} IS NULL OR {total} = 0 THEN 0.0::DOUBLE ELSE ({part}) / {total} END"


CTES["broad_l1"] = f"SELECT cust, mon, tax_l1, {total('amt')} AS spend FROM broad_last3 GROUP BY ALL"
CTES["broad_best"] = """
SELECT cust, mon, tax_l1 AS dominant_ecosystem, spend AS dominant_ecosystem_spend_m FROM broad_l1
QUALIFY row_number() OVER (PARTITION BY cust, mon ORDER BY spend DESC, tax_l1) = 1"""
CTES["broad_base"] = "SELECT *,\n  " + commas(
    *[f"{div(f'{n}_spend_m', 'spend_amt_m')} AS {n}_spend_share_m" for n in SHARED]) + "\nFROM (SELECT cust, mon,\n  " + commas(
    "count(*) AS txn_cnt_m", f"{total('amt')} AS spend_amt_m", f"{mean('amt')} AS avg_ticket_m", "max(amt) AS max_ticket_m",
    "count(DISTINCT dt) AS active_days_m", "count(DISTINCT mkey) AS uniq_merchants_m",
    *[f"count(DISTINCT tax_{x}) AS uniq_tax_{x}_m" for x in ("l1", "l2", "l3")],
    *[f"{total_of(c)} AS {n}_spend_m" for n, c in SPENDS.items()],
    "CAST(sum(candidate) AS BIGINT) AS recurring_txn_cnt_m",
    "count(DISTINCT CASE WHEN candidate = 1 THEN mkey END) AS recurring_merchant_cnt_m",
    *[f"{total(f"CASE WHEN tax_l1 = '{x}' THEN amt END")} AS {x}" for x in L1],
) + " FROM broad_last3 GROUP BY cust, mon) JOIN broad_best USING (cust, mon)"
CTES["broad_size"] = "SELECT mkey, mon, count(*) AS size FROM broad_last3 GROUP BY ALL"
CTES["broad_scale"] = f"""
SELECT cust, mon, avg(size) AS avg_merchant_scale_txn_cnt_m, max(size) AS max_merchant_scale_txn_cnt_m,
  {total_of('size >= 150')} AS spend_at_mega_merchants_m,
  {total_of('size >= 60 AND size < 150')} AS spend_at_large_merchants_m,
  {total_of('size < 20')} AS spend_at_longtail_merchants_m
FROM broad_last3 JOIN broad_size USING (mkey, mon) GROUP BY cust, mon"""


def mix(name: str, rows: str, entity: str) -> str:
    return f"""
SELECT cust, mon, sum(CASE WHEN p > 0 THEN -p * log2(p) ELSE 0.0::DOUBLE END) AS {name}_entropy_m, 
  coalesce(CAST(sum(CAST({units('spend')} AS HUGEINT) * {units('spend')}) AS DOUBLE)
    / nullif(CAST(sum({units('spend')}) AS DOUBLE) * CAST(sum({units('spend')}) AS DOUBLE), 0), 0.0::DOUBLE) AS {name}_hhi_m,
  max(p) AS top_{name}_share_m, coalesce({total("CASE WHEN place <= 3 THEN spend END")} / nullif(any_value(total), 0), 0.0::DOUBLE) AS top3_{name}_share_m
FROM (SELECT *, row_number() OVER (PARTITION BY cust, mon ORDER BY p DESC, {entity}) AS place
  FROM (SELECT r.*, t.total, {div('spend', 'total')} AS p
        FROM {rows} r JOIN (SELECT cust, mon, {total("spend")} AS total FROM {rows} GROUP BY ALL) t USING (cust, mon)))
GROUP BY cust, mon"""


CTES["broad_merchant"] = f"SELECT cust, mon, mkey, {total('amt')} AS spend FROM broad_last3 GROUP BY ALL"
CTES["broad_mix"] = mix("merchant", "broad_merchant", "mkey")
CTES["broad_eco"] = mix("ecosystem", "broad_l1", "tax_l1")
CTES["broad_new"] = """
SELECT cust, mon, CAST(sum(CASE WHEN seen IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS new_merchant_cnt_m
FROM (SELECT cust, mon, lag(mon) OVER (PARTITION BY cust, mkey ORDER BY mon) AS seen
      FROM (SELECT DISTINCT cust, mon, mkey FROM broad_last3)) GROUP BY cust, mon"""
CTES["broad_months"] = """
SELECT b.*, s.* EXCLUDE (cust, mon), m.* EXCLUDE (cust, mon), e.ecosystem_entropy_m, e.ecosystem_hhi_m, n.new_merchant_cnt_m
FROM broad_base b JOIN broad_scale s USING (cust, mon) JOIN broad_mix m USING (cust, mon)
JOIN broad_eco e USING (cust, mon) JOIN broad_new n USING (cust, mon)"""
LAGS = {
    "prev_spend_amt_m": "spend_amt_m", "prev_txn_cnt_m": "txn_cnt_m", "prev_online_share_m": "online_spend_share_m",
    "prev_xborder_share_m": "xborder_spend_share_m", "prev_wallet_share_m": "wallet_spend_share_m",
    "prev_premium_share_m": "premium_spend_share_m", "prev_dominant_ecosystem": "dominant_ecosystem",
    "prev_merchant_entropy_m": "merchant_entropy_m",
}
CTES["broad_windowed"] = "SELECT *,\n  " + commas(
    f"{total('spend_amt_m', 'OVER w3')} AS spend_amt_3m", "CAST(sum(txn_cnt_m) OVER w3 AS BIGINT) AS txn_cnt_3m",
    f"{total('spend_amt_m', 'OVER w6')} AS spend_amt_6m", "avg(avg_ticket_m) OVER w3 AS avg_ticket_3m",
    "avg(merchant_entropy_m) OVER w3 AS merchant_entropy_3m_avg",
    "avg(ecosystem_entropy_m) OVER w3 AS ecosystem_entropy_3m_avg",
    *[f"lag({now}) OVER w AS {prev}" for prev, now in LAGS.items()], "lag(txn_cnt_m, 2) OVER w AS prev_txn_cnt_m2",
) + """ FROM broad_months WINDOW w AS (PARTITION BY cust ORDER BY mon),
  w3 AS (PARTITION BY cust ORDER BY mon ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
  w6 AS (PARTITION BY cust ORDER BY mon ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"""
CTES["broad_mart"] = f"""
SELECT *, CASE WHEN merchant_entropy_trend > 0.10::DOUBLE THEN 'DIVERSIFYING'
            WHEN merchant_entropy_trend < -0.10::DOUBLE THEN 'CONCENTRATING' ELSE 'STABLE' END AS diversification_flag
FROM (SELECT *,
  {div('spend_amt_m - prev_spend_amt_m', 'prev_spend_amt_m')} AS mom_spend_growth,
  {div('(txn_cnt_m - prev_txn_cnt_m)::DOUBLE', 'prev_txn_cnt_m')} AS mom_txn_growth,
  {commas(*[f"{p}_spend_share_m - coalesce(prev_{p}_share_m, 0) AS {p}_share_delta_m" for p in ('online', 'xborder', 'wallet', 'premium')])},
  {bit('prev_dominant_ecosystem IS NOT NULL AND dominant_ecosystem <> prev_dominant_ecosystem')} AS l1_migration_flag,
  merchant_entropy_m - coalesce(prev_merchant_entropy_m, 0) AS merchant_entropy_trend,
  CASE WHEN txn_cnt_m >= 3 THEN 'ACTIVE' WHEN txn_cnt_m > 0 AND coalesce(prev_txn_cnt_m, 0) = 0 THEN 'REACTIVATING'
       WHEN txn_cnt_m = 0 THEN 'DORMANT' ELSE 'LOW_VOLUME' END AS spend_regime_flag,
  CASE WHEN wallet_spend_share_m > 0.50::DOUBLE THEN 'HIGH_WALLET' WHEN wallet_spend_share_m > 0.20::DOUBLE
       THEN 'MODERATE_WALLET' ELSE 'LOW_WALLET' END AS wallet_dependence_flag,
  CASE WHEN txn_cnt_m < 3 THEN 'LOW_VOLUME' WHEN spend_amt_m <= 0 THEN 'ZERO_SPEND'
       WHEN uniq_merchants_m <= 1 THEN 'SINGLE_MERCHANT' ELSE 'GOOD' END AS feature_quality_flag
  FROM broad_windowed)"""
CTES["broad_shares"] = "SELECT *, " + commas(
    *[f"{div(f'coalesce({x}, 0)', 'spend_amt_m')} AS share_{x.lower()}" for x in L1],
) + " FROM broad_mart"
OVERLAYS = {
    "subscription_heavy": "recurring_merchant_cnt_m >= 3", "wallet_dependent": "wallet_spend_share_m > 0.30::DOUBLE",
    "food_delivery_native": "food_delivery_spend_share_m > 0.15::DOUBLE",
    "cross_border_frequent": "xborder_spend_share_m > 0.15::DOUBLE",
    "healthcare_engaged": "share_health_wellness > 0.15::DOUBLE",
    "premium_retail_oriented": "premium_spend_share_m > 0.20::DOUBLE",
    "convenience_dependent": "share_everyday_essentials > 0.50::DOUBLE",
    "business_spend_proxy": "business_proxy_spend_share_m > 0.20::DOUBLE",
    "risk_monitor_flag": "topup_spend_share_m > 0.40::DOUBLE OR l1_migration_flag = 1 OR mom_spend_growth < -0.50::DOUBLE",
}
CTES["broad_personas"] = f"""
SELECT *, CASE WHEN prev_persona IS NOT NULL AND prev_persona <> primary_persona THEN 1 ELSE 0 END AS persona_shift_flag,
  CASE primary_persona WHEN 'TRAVEL_CENTRIC' THEN greatest(share_travel_mobility, xborder_spend_share_m)
    WHEN 'AFFLUENT_LIFESTYLE' THEN greatest(premium_spend_share_m, avg_ticket_m / 10000.0::DOUBLE)
    WHEN 'DIGITAL_NATIVE' THEN greatest(online_spend_share_m + in_app_spend_share_m, wallet_spend_share_m)
    WHEN 'EVERYDAY_ANCHOR' THEN share_everyday_essentials
    WHEN 'LIFESTYLE_SOCIAL' THEN share_food_dining + share_entertainment_leisure
    WHEN 'EMERGING_MOBILE' THEN food_delivery_spend_share_m ELSE 0.5::DOUBLE END AS persona_confidence,
  {commas(*[f"{bit(c)} AS overlay_{n}" for n, c in OVERLAYS.items()])}
FROM (SELECT *, lag(primary_persona) OVER (PARTITION BY cust ORDER BY mon) AS prev_persona FROM (SELECT *,
  CASE WHEN share_travel_mobility > 0.30::DOUBLE OR xborder_spend_share_m > 0.20::DOUBLE THEN 'TRAVEL_CENTRIC'
       WHEN premium_spend_share_m > 0.25::DOUBLE AND avg_ticket_m > 3000 THEN 'AFFLUENT_LIFESTYLE'
       WHEN online_spend_share_m + in_app_spend_share_m > 0.60::DOUBLE AND wallet_spend_share_m > 0.15::DOUBLE THEN 'DIGITAL_NATIVE'
       WHEN share_everyday_essentials > 0.45::DOUBLE AND avg_ticket_m < 1500 THEN 'EVERYDAY_ANCHOR'
       WHEN share_food_dining + share_entertainment_leisure > 0.40::DOUBLE THEN 'LIFESTYLE_SOCIAL'
       WHEN food_delivery_spend_share_m + ride_hailing_spend_m
            / CASE WHEN spend_amt_m = 0 THEN 1.0::DOUBLE ELSE spend_amt_m END > 0.25::DOUBLE THEN 'EMERGING_MOBILE'
       WHEN business_proxy_spend_share_m > 0.30::DOUBLE THEN 'BUSINESS_PROXY'
       WHEN top_merchant_share_m > 0.50::DOUBLE AND merchant_entropy_m < 1.5::DOUBLE THEN 'CONCENTRATED_LOYALIST'
       WHEN merchant_entropy_m > 3.0::DOUBLE THEN 'DIVERSIFIED_EXPLORER'
       WHEN spend_regime_flag IN ('DORMANT', 'LOW_VOLUME') THEN 'DORMANT_LOW_ACTIVITY'
       ELSE 'EVERYDAY_ANCHOR' END AS primary_persona
  FROM broad_shares))"""

CTES["plain_tagged"] = f"""
SELECT *, {bit(rx(fv.SIMPLE_WALLET, 'pnm'))} AS wallet_topup_flag,
  CASE onln WHEN 'Y' THEN 'ONLINE' WHEN 'N' THEN 'OFFLINE' ELSE 'UNKNOWN' END AS channel_tag,
  {tiers('amt', fv.SIMPLE_SIZE_TIERS, fv.SIMPLE_SIZE_TIER_TOP)} AS txn_size_tier
FROM (SELECT *, lower(trim(regexp_replace(mcht_nm, '\\s+', ' ', 'g'))) AS pnm FROM typed)"""
CTES["plain_mix"] = f"""
SELECT cust, mon, sum(CASE WHEN p > 0 THEN -p * log2(p) ELSE 0 END) AS merchant_entropy
FROM (SELECT cust, mon, spend / sum(spend) OVER (PARTITION BY cust, mon) AS p
      FROM (SELECT cust, mon, pnm, {total('amt')} AS spend FROM plain_tagged GROUP BY ALL)) GROUP BY cust, mon"""
CTES["plain_months"] = f"""
SELECT *, spend_amt_m - spend_prev_m AS spend_velocity,
  CASE WHEN online_spend_m > 0.6::DOUBLE * spend_amt_m THEN 'DIGITAL_NATIVE'
       WHEN merchant_entropy < 1.2::DOUBLE THEN 'LOYAL_SPENDER'
       WHEN avg_ticket_m > 5000 THEN 'PREMIUM_AFFLUENT' ELSE 'EVERYDAY_ANCHOR' END AS primary_persona
FROM (SELECT *, lag(spend_amt_m) OVER (PARTITION BY cust ORDER BY mon) AS spend_prev_m FROM (
  SELECT cust, mon, count(*) AS txn_cnt_m, {total('amt')} AS spend_amt_m, {mean('amt')} AS avg_ticket_m,
    count(DISTINCT pnm) AS uniq_merchants_m, {total_of("channel_tag = 'ONLINE'")} AS online_spend_m,
    CAST(sum(wallet_topup_flag) AS BIGINT) AS wallet_txn_cnt
  FROM plain_tagged GROUP BY cust, mon) JOIN plain_mix USING (cust, mon))"""
