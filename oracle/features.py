"""SQL of phases 2 and 3, as common table expressions by name."""

from __future__ import annotations

from spendlens import fixed_values as fv

from .enrichment import CTES, bit, listed, mean, money, money_spread, spread, total, units

L1 = [*fv.ECOSYSTEMS, "UNCLASSIFIED"]
SPENDS = {
    "online": "channel_tag = 'ONLINE'", "offline": "channel_tag = 'OFFLINE'", "inapp": "channel_tag = 'IN_APP'",
    "domestic": "geo_tag = 'DOMESTIC'", "xborder": "geo_tag = 'CROSS_BORDER'",
    "topup": "is_topup = 1", "wallet": "is_wallet = 1", "processor": "is_processor_mediated = 1",
    "subscription": "candidate = 1", "weekend": "weekpart_tag = 'WEEKEND'", "weekday": "weekpart_tag = 'WEEKDAY'",
    "premium": "is_premium_merchant = 1", "mall": "is_mall_ecosystem = 1", "ride_hailing": "is_ride_hailing = 1",
    "grocery": "is_grocery = 1", "subscription_pattern": "is_subscription = 1", "risky": "is_risky_merchant = 1",
    "business_proxy": "is_business_proxy = 1", "food_delivery": "is_food_delivery = 1",
    "morning": "time_pattern = 'MORNING_ROUTINE'", "lunch": "time_pattern = 'LUNCH'",
    "evening": "time_pattern = 'EVENING_SOCIAL'", "late_night": "time_pattern = 'LATE_NIGHT'",
    "payday_window": "payday_window_flag = 1",
}
COUNTS = {
    "topup": "is_topup", "wallet": "is_wallet", "marketplace": "is_marketplace", "mall": "is_mall_ecosystem",
    "premium": "is_premium_merchant", "food_delivery": "is_food_delivery", "business_proxy": "is_business_proxy",
    "travel_booking": "is_travel_booking", "ride_hailing": "is_ride_hailing",
    "subscription_pattern": "is_subscription", "grocery": "is_grocery", "risky": "is_risky_merchant",
    "subscription": "candidate", "payday_window": "payday_window_flag",
}
SHARES = {p: p for p in (
    "online offline inapp xborder domestic topup wallet premium mall weekend subscription ride_hailing "
    "grocery food_delivery risky business_proxy late_night").split()} | {"payday": "payday_window"}


def total_of(condition: str, amount: str = "amt") -> str:
    return total(f"CASE WHEN {condition} THEN {amount} ELSE 0.0::DOUBLE END")


def share(part: str, total: str = "spend_amt_m") -> str:
    return f"CASE WHEN {total} > 0 THEN ({part}) / {total} ELSE 0.0::DOUBLE END"


def commas(*parts: str) -> str:
    return ",\n  ".join(parts)


def known(number: str) -> str:
    """0 where no amount is known."""
    return f"coalesce({number}, 0.0::DOUBLE)"


def base_sql(source: str) -> str:
    return "SELECT cust, mon,\n  " + commas(
        "count(*) AS txn_cnt_m", f"{known(total('amt'))} AS spend_amt_m", f"{known(mean('amt'))} AS avg_ticket_m",
        f"{known('max(amt)')} AS max_ticket_m", f"{known('min(amt)')} AS min_ticket_m", f"coalesce({money_spread('amt')}, 0.0::DOUBLE) AS stddev_ticket_m",
        "quantile_disc(amt, 0.5) AS median_ticket_m", "count(DISTINCT dt) AS active_days_m",
        "count(DISTINCT nm) AS uniq_merchants_m", "count(DISTINCT tax_l1) AS uniq_tax_l1_m",
        "count(DISTINCT tax_l2) AS uniq_tax_l2_m", "count(DISTINCT tax_l3) AS uniq_tax_l3_m",
        *[f"{known(total_of(c))} AS {n}_spend_m" for n, c in SPENDS.items()],
        *[f"CAST(sum({c}) AS BIGINT) AS {n}_txn_cnt_m" for n, c in COUNTS.items()],
        "CAST(sum(CASE WHEN novelty = 'FIRST_TIME' THEN 1 ELSE 0 END) AS BIGINT) AS new_merchant_cnt_m",
        "CAST(sum(CASE WHEN novelty = 'REPEAT' THEN 1 ELSE 0 END) AS BIGINT) AS repeat_merchant_txn_cnt_m",
    ) + f"\nFROM {source} GROUP BY cust, mon"


CTES["month_sums"] = base_sql("enriched")
CTES["ev_month_sums"] = base_sql("ev_enriched")
CTES["ro_month_sums"] = base_sql("ro_enriched")
CTES["month_rows"] = "SELECT *,\n  " + commas(
    *[f"{share(f'{part}_spend_m')} AS {name}_share_m" for name, part in SHARES.items()],
    f"greatest({money(units('spend_amt_m') + ' - ' + units('topup_spend_m'))}, 0.0::DOUBLE) AS consumption_spend_m",
    "CASE WHEN active_days_m > 0 THEN txn_cnt_m::DOUBLE / active_days_m ELSE 0 END AS txn_per_active_day_m",
    "CASE WHEN txn_cnt_m > 0 THEN repeat_merchant_txn_cnt_m::DOUBLE / txn_cnt_m ELSE 0 END AS merchant_repeat_ratio_m",
    "CASE WHEN uniq_merchants_m > 0 THEN new_merchant_cnt_m::DOUBLE / uniq_merchants_m ELSE 0 END AS merchant_novelty_rate_m",
) + " FROM month_sums"

# --- composition: spend per label first, then one column per label
CTES["l1_rows"] = f"SELECT cust, mon, tax_l1, {total('amt')} AS spend FROM enriched GROUP BY ALL"
CTES["l1_wide"] = "SELECT cust, mon,\n  " + commas(
    *[f"coalesce(sum(spend) FILTER (tax_l1 = '{x}'), 0.0::DOUBLE) AS l1_{x.lower()}_spend_m" for x in L1],
) + " FROM l1_rows GROUP BY cust, mon"
CTES["l1_places"] = f"""
SELECT *, row_number() OVER (PARTITION BY cust, mon ORDER BY spend DESC, tax_l1 DESC) AS place
FROM l1_rows WHERE tax_l1 IN {listed(fv.ECOSYSTEMS)} AND spend > 0"""
CTES["l1_top"] = """
SELECT cust, mon, max(CASE WHEN place = 1 THEN tax_l1 END) AS l1_first, max(CASE WHEN place = 2 THEN tax_l1 END) AS l1_second,
       max(CASE WHEN place = 1 THEN spend END) AS l1_first_spend
FROM l1_places GROUP BY cust, mon"""
BREADTH = " + ".join(bit(f"{share(f'l1_{x.lower()}_spend_m')} > 0.05::DOUBLE") for x in fv.ECOSYSTEMS)
CTES["l1_month"] = f"""
SELECT m.cust, m.mon, w.* EXCLUDE (cust, mon),
  coalesce(l1_first, 'UNCLASSIFIED') AS dominant_ecosystem, coalesce(l1_second, 'NONE') AS second_ecosystem,
  {share('coalesce(l1_first_spend, 0.0::DOUBLE)')} AS top_l1_share,
  {commas(*[f"{share(f'l1_{x.lower()}_spend_m')} AS l1_{x.lower()}_share_m" for x in fv.ECOSYSTEMS])},
  {BREADTH} AS category_breadth_m
FROM month_sums m JOIN l1_wide w USING (cust, mon) LEFT JOIN l1_top t USING (cust, mon)"""
CTES["l2_rows"] = f"SELECT cust, mon, tax_l2, {total('amt')} AS spend FROM enriched GROUP BY ALL"
CTES["l2_wide"] = "SELECT cust, mon,\n  " + commas(
    *[f"coalesce(sum(spend) FILTER (tax_l2 = '{x}'), 0.0::DOUBLE) AS l2_{x.lower()}_spend_m" for x in fv.KEY_L2],
) + " FROM l2_rows GROUP BY cust, mon"
CTES["l2_month"] = "SELECT m.cust, m.mon, w.* EXCLUDE (cust, mon),\n  " + commas(
    *[f"{share(f'l2_{x.lower()}_spend_m')} AS l2_{x.lower()}_share_m" for x in fv.KEY_L2],
) + " FROM month_sums m JOIN l2_wide w USING (cust, mon)"
CTES["platform_rows"] = f"""
SELECT cust, mon, platform_ecosystem, {total('amt')} AS spend, count(*) AS n
FROM enriched WHERE platform_ecosystem <> 'NONE' GROUP BY ALL"""
CTES["platform_best"] = """
SELECT cust, mon, platform_ecosystem AS best FROM platform_rows
QUALIFY row_number() OVER (PARTITION BY cust, mon ORDER BY spend DESC, platform_ecosystem DESC) = 1"""
CTES["platform_months"] = f"""
SELECT m.cust, m.mon, coalesce(p.n, 0) AS platform_count_m, coalesce(p.spend, 0.0::DOUBLE) AS platform_spend_m,
  coalesce(p.txns, 0) AS platform_txn_cnt_m, {share('coalesce(p.spend, 0.0::DOUBLE)')} AS platform_share_m,
  coalesce(b.best, 'NONE') AS dominant_platform
FROM month_sums m
LEFT JOIN (SELECT cust, mon, count(*) AS n, {total('spend')} AS spend, CAST(sum(n) AS BIGINT) AS txns
           FROM platform_rows GROUP BY cust, mon) p USING (cust, mon)
LEFT JOIN platform_best b USING (cust, mon)"""


def concentration(rows: str, name: str, entity: str, extra: str = "") -> str:
    return f"""
SELECT cust, mon, sum(CASE WHEN p > 0 THEN -p * log2(p) ELSE 0 END) AS {name}_entropy_m,
       CASE WHEN any_value(total) > 0 THEN CAST(sum(CAST({units('spend')} AS HUGEINT) * {units('spend')}) AS DOUBLE)
         / (CAST(sum({units('spend')}) AS DOUBLE) * CAST(sum({units('spend')}) AS DOUBLE)) ELSE 0 END AS {name}_hhi_m,
       count(*) AS {name}_cnt_m {extra}
FROM (SELECT *, CASE WHEN total > 0 THEN spend / total ELSE 0 END AS p,
             row_number() OVER (PARTITION BY cust, mon ORDER BY spend DESC, {entity}) AS place
      FROM (SELECT *, {total('spend', 'OVER (PARTITION BY cust, mon)')} AS total FROM {rows}))
GROUP BY cust, mon"""


CTES["merchant_rows"] = f"SELECT cust, mon, nm, {total('amt')} AS spend, count(*) AS visits FROM enriched GROUP BY ALL"
CTES["merchant_mix"] = concentration("merchant_rows", "merchant", "nm", """,
       max(CASE WHEN place = 1 THEN p END) AS top1_merchant_share_m,
       """ + total("CASE WHEN place <= 3 THEN spend END") + " AS top3_merchant_spend_m")
CTES["ecosystem_mix"] = concentration("l1_rows", "ecosystem", "tax_l1")
CTES["merchant_size"] = "SELECT nm, mon, count(*) AS txns, count(DISTINCT cust) AS custs FROM enriched GROUP BY ALL"
CTES["scale"] = f"""
SELECT cust, mon, avg(txns) AS avg_merchant_scale_m,
  {total_of('txns >= 150')} AS spend_at_mega_merchants_m,
  {total_of('txns >= 60 AND txns < 150')} AS spend_at_large_merchants_m,
  {total_of('txns < 20')} AS spend_at_longtail_merchants_m
FROM enriched JOIN merchant_size USING (nm, mon) GROUP BY cust, mon"""
CTES["loyalty"] = """
SELECT cust, mon, avg(visits) AS avg_visits_per_merchant_m, max(visits) AS max_visits_per_merchant_m,
       CAST(sum(CASE WHEN visits >= 3 THEN 1 ELSE 0 END) AS BIGINT) AS loyal_merchant_cnt_m
FROM merchant_rows GROUP BY cust, mon"""
CTES["visited"] = "SELECT DISTINCT cust, mon, nm FROM named"
CTES["retained"] = """
SELECT n.cust, n.mon, count(*) AS retained_merchant_cnt_m
FROM visited n JOIN visited p ON n.cust = p.cust AND n.nm = p.nm AND n.mon = CAST(p.mon + INTERVAL 1 MONTH AS DATE)
GROUP BY n.cust, n.mon"""
CTES["before"] = """
SELECT cust, CAST(mon + INTERVAL 1 MONTH AS DATE) AS mon, count(*) AS before_cnt FROM visited GROUP BY ALL"""
CTES["turnover"] = """
SELECT *,
  CASE WHEN uniq_merchants_m + before_cnt > 0
       THEN (new_merchant_cnt_m + dropped_merchant_cnt_m)::DOUBLE / (uniq_merchants_m + before_cnt) ELSE 0 END AS merchant_turnover_rate_m,
  CASE WHEN before_cnt > 0 THEN dropped_merchant_cnt_m::DOUBLE / before_cnt ELSE 0 END AS merchant_churn_rate_m,
  CASE WHEN before_cnt > 0 THEN retained_merchant_cnt_m::DOUBLE / before_cnt END AS merchant_retention_rate_m
FROM (SELECT cust, mon, uniq_merchants_m, new_merchant_cnt_m, coalesce(b.before_cnt, 0) AS before_cnt,
        coalesce(r.retained_merchant_cnt_m, 0) AS retained_merchant_cnt_m,
        greatest(coalesce(b.before_cnt, 0) - coalesce(r.retained_merchant_cnt_m, 0), 0) AS dropped_merchant_cnt_m
      FROM month_sums LEFT JOIN retained r USING (cust, mon) LEFT JOIN before b USING (cust, mon))"""
REGULAR = "recurrence_tag IN ('SUBSCRIPTION_LIKE', 'RECURRING')"
CTES["recurring"] = f"""
SELECT cust, mon,
  CAST(sum({bit("recurrence_tag = 'SUBSCRIPTION_LIKE'")}) AS BIGINT) AS subscription_merchant_cnt_m,
  CAST(sum({bit(REGULAR)}) AS BIGINT) AS recurring_merchant_cnt_m,
  CAST(sum({bit("recurrence_tag = 'EPISODIC'")}) AS BIGINT) AS episodic_merchant_cnt_m,
  CAST(sum({bit("recurrence_tag = 'IRREGULAR'")}) AS BIGINT) AS irregular_merchant_cnt_m,
  {total_of("recurrence_tag = 'SUBSCRIPTION_LIKE'", 'spend')} AS subscription_like_spend_m,
  {total_of(REGULAR, 'spend')} AS recurring_spend_m,
  avg(CASE WHEN {REGULAR} THEN interval_avg END) AS avg_recurring_interval_m,
  avg(CASE WHEN {REGULAR} THEN cv_avg END) AS avg_recurring_cv_m
FROM (SELECT cust, mon, nm, recurrence_tag, {total('amt')} AS spend, avg(avg_gap) AS interval_avg, avg(cv_interval) AS cv_avg
      FROM enriched GROUP BY ALL)
GROUP BY cust, mon"""
CTES["features"] = f"""
SELECT m.*, l.* EXCLUDE (cust, mon), l2.* EXCLUDE (cust, mon), p.* EXCLUDE (cust, mon),
  x.* EXCLUDE (cust, mon), e.ecosystem_entropy_m, e.ecosystem_hhi_m, s.* EXCLUDE (cust, mon), y.* EXCLUDE (cust, mon),
  {share('top3_merchant_spend_m')} AS top3_merchant_share_m,
  t.retained_merchant_cnt_m, t.dropped_merchant_cnt_m, t.merchant_turnover_rate_m, t.merchant_churn_rate_m,
  t.merchant_retention_rate_m, r.* EXCLUDE (cust, mon),
  {share('recurring_spend_m')} AS recurring_spend_share_m,
  {share('subscription_like_spend_m')} AS subscription_like_spend_share_m
FROM month_rows m JOIN l1_month l USING (cust, mon) JOIN l2_month l2 USING (cust, mon)
JOIN platform_months p USING (cust, mon) JOIN merchant_mix x USING (cust, mon) JOIN ecosystem_mix e USING (cust, mon)
JOIN scale s USING (cust, mon) JOIN loyalty y USING (cust, mon) JOIN turnover t USING (cust, mon)
JOIN recurring r USING (cust, mon)"""

# --- months in order
AVERAGED = ("online_share xborder_share wallet_share premium_share merchant_entropy grocery_share late_night_share "
            "weekend_share ride_hailing_share food_delivery_share").split()
LAGS = {
    "spend_amt_m": "spend_prev_m", "txn_cnt_m": "txn_cnt_prev_m", "avg_ticket_m": "avg_ticket_prev_m",
    "online_share_m": "online_share_prev_m", "xborder_share_m": "xborder_share_prev_m",
    "wallet_share_m": "wallet_share_prev_m", "premium_share_m": "premium_share_prev_m",
    "dominant_ecosystem": "dominant_ecosystem_prev_m", "merchant_entropy_m": "merchant_entropy_prev_m",
    "ecosystem_hhi_m": "ecosystem_hhi_prev_m", "merchant_hhi_m": "merchant_hhi_prev_m",
}
CTES["windowed"] = "SELECT *,\n  " + commas(
    *[f"{total('spend_amt_m', f'OVER w{n}')} AS spend_amt_{n}m" for n in (3, 6, 12)],
    *[f"CAST(sum(txn_cnt_m) OVER w{n} AS BIGINT) AS txn_cnt_{n}m" for n in (3, 6, 12)],
    *[f"avg({a}_m) OVER w3 AS {a}_3m" for a in AVERAGED],
    *[f"CASE WHEN {mean('spend_amt_m', f'OVER w{n}')} > 0 THEN {money_spread('spend_amt_m', f'OVER w{n}')}"
      f" / {mean('spend_amt_m', f'OVER w{n}')} END AS spend_stability_{n}m" for n in (6, 12)],
    "count(dominant_ecosystem) OVER w3 AS dominant_ecosystem_freq_3m",
    f"CASE WHEN {mean('spend_amt_m', 'OVER w3')} > 0 THEN spend_amt_m / {mean('spend_amt_m', 'OVER w3')} END AS spend_vs_3m_avg_ratio",
    *[f"lag({now}) OVER w AS {prev}" for now, prev in LAGS.items()],
) + """
FROM features
WINDOW w AS (PARTITION BY cust ORDER BY mon),
  w3 AS (PARTITION BY cust ORDER BY mon ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
  w6 AS (PARTITION BY cust ORDER BY mon ROWS BETWEEN 5 PRECEDING AND CURRENT ROW),
  w12 AS (PARTITION BY cust ORDER BY mon ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"""
CTES["changed"] = """
SELECT *, CASE WHEN entropy_trend_m > 0.2::DOUBLE THEN 'DIVERSIFYING' WHEN entropy_trend_m < -0.2::DOUBLE THEN 'CONCENTRATING'
            ELSE 'STABLE' END AS diversification_flag,
  lag(spend_velocity_m) OVER (PARTITION BY cust ORDER BY mon) AS spend_velocity_prev_m
FROM (SELECT *,
  CASE WHEN txn_cnt_3m > 0 THEN spend_amt_3m / txn_cnt_3m ELSE 0 END AS avg_ticket_3m,
  CASE WHEN txn_cnt_12m > 0 THEN spend_amt_12m / txn_cnt_12m ELSE 0 END AS avg_ticket_12m,
  spend_amt_m - coalesce(spend_prev_m, 0) AS spend_velocity_m,
  CASE WHEN spend_prev_m > 0 THEN (spend_amt_m - spend_prev_m) / spend_prev_m END AS spend_pct_change_m,
  txn_cnt_m - coalesce(txn_cnt_prev_m, 0) AS txn_cnt_velocity_m,
  avg_ticket_m - coalesce(avg_ticket_prev_m, 0) AS avg_ticket_change_m,
  online_share_m - coalesce(online_share_prev_m, 0) AS online_share_slope_m,
  xborder_share_m - coalesce(xborder_share_prev_m, 0) AS xborder_share_slope_m,
  wallet_share_m - coalesce(wallet_share_prev_m, 0) AS wallet_share_slope_m,
  premium_share_m - coalesce(premium_share_prev_m, 0) AS premium_share_slope_m,
  CASE WHEN dominant_ecosystem_prev_m IS NOT NULL AND dominant_ecosystem_prev_m <> dominant_ecosystem
       THEN 1 ELSE 0 END AS l1_migration_flag,
  merchant_entropy_m - coalesce(merchant_entropy_prev_m, 0) AS entropy_trend_m,
  ecosystem_hhi_m - coalesce(ecosystem_hhi_prev_m, 0) AS ecosystem_hhi_change_m,
  merchant_hhi_m - coalesce(merchant_hhi_prev_m, 0) AS merchant_hhi_change_m
  FROM windowed)"""


def graded(column: str, high: str, moderate: str) -> str:
    return f"CASE WHEN {column} > {high}::DOUBLE THEN 'HIGH' WHEN {column} > {moderate}::DOUBLE THEN 'MODERATE' ELSE 'LOW' END"


CTES["mart"] = f"""
SELECT *,
  spend_velocity_m - coalesce(spend_velocity_prev_m, 0) AS spend_acceleration_m,
  CASE WHEN wallet_share_m > 0.50::DOUBLE THEN 'HIGH_WALLET' WHEN wallet_share_m > 0.20::DOUBLE THEN 'MODERATE_WALLET'
       ELSE 'LOW_WALLET' END AS wallet_dependence_flag,
  {bit('topup_share_m > 0.30::DOUBLE')} AS topup_heavy_flag,
  CASE WHEN spend_amt_m > 0 AND processor_spend_m / spend_amt_m > 0.20::DOUBLE THEN 1 ELSE 0 END AS processor_mediated_flag,
  {graded('premium_share_m', '0.15', '0.05')} AS premium_retail_orientation,
  CASE WHEN avg_ticket_m > 10000 THEN 'HIGH_AFFLUENCE_PROXY' WHEN avg_ticket_m > 3000 THEN 'MID_AFFLUENCE_PROXY'
       ELSE 'STANDARD' END AS avg_ticket_affluence_proxy,
  CASE WHEN l1_travel_mobility_share_m > 0.15::DOUBLE THEN 'TRAVEL_ORIENTED' ELSE 'NON_TRAVEL' END AS travel_premium_proxy,
  {graded('l2_convenience_store_share_m', '0.20', '0.10')} AS convenience_dependence,
  {graded('l2_fuel_share_m', '0.15', '0.05')} AS fuel_dependence,
  CASE WHEN l1_b2b_professional_share_m > 0.20::DOUBLE OR business_proxy_txn_cnt_m > txn_cnt_m * 0.3::DOUBLE THEN 'LIKELY_BUSINESS'
       WHEN l1_b2b_professional_share_m > 0.10::DOUBLE THEN 'POSSIBLE_BUSINESS' ELSE 'RETAIL_CONSUMER' END AS business_proxy_flag,
  l1_financial_services_share_m AS financial_services_share_m,
  {bit('merchant_hhi_change_m > 0.15::DOUBLE AND merchant_hhi_m > 0.5::DOUBLE')} AS concentration_shock_flag,
  {bit('spend_pct_change_m < -0.50::DOUBLE')} AS spend_drop_flag,
  {bit('l1_migration_flag = 1 AND abs(coalesce(spend_pct_change_m, 0.0)) > 0.30::DOUBLE')} AS category_shock_flag,
  {bit('txn_cnt_m > 30 AND avg_ticket_m < 200')} AS high_freq_low_ticket_flag,
  {bit('topup_share_m > 0.40::DOUBLE AND topup_txn_cnt_m > 5')} AS topup_overdependence_flag,
  {bit("spend_regime = 'REACTIVATING' OR spend_stability_6m > 1.5::DOUBLE")} AS unstable_flag,
  CASE WHEN txn_cnt_m = 0 THEN 'ZERO_SPEND' WHEN txn_cnt_m < 3 THEN 'LOW_VOLUME'
       WHEN uniq_merchants_m <= 1 THEN 'SINGLE_MERCHANT' ELSE 'GOOD' END AS feature_quality_flag
FROM (SELECT *, CASE WHEN txn_cnt_m = 0 THEN 'DORMANT' WHEN coalesce(txn_cnt_prev_m, 0) = 0 THEN 'REACTIVATING'
                     WHEN txn_cnt_m < 3 THEN 'LOW_VOLUME' ELSE 'ACTIVE' END AS spend_regime FROM changed)"""

# --- personas
OVERLAYS = {
    "subscription_heavy": "subscription_merchant_cnt_m >= 2", "wallet_dependent": "wallet_share_3m > 0.25::DOUBLE",
    "food_delivery_native": "food_delivery_txn_cnt_m >= 3 OR l2_food_delivery_share_m > 0.10::DOUBLE",
    "cross_border_frequent": "xborder_share_3m > 0.10::DOUBLE", "weekend_spender": "weekend_share_m > 0.45::DOUBLE",
    "healthcare_engaged": "l2_hospital_clinic_share_m + l2_beauty_wellness_share_m > 0.10::DOUBLE",
    "premium_retail_oriented": "premium_share_3m > 0.08::DOUBLE",
    "convenience_dependent": "convenience_dependence = 'HIGH'",
    "installment_buyer_proxy": "avg_ticket_m > 5000 AND txn_cnt_m <= 5 AND max_ticket_m > 10000",
    "fuel_dependent": "fuel_dependence = 'HIGH'", "reactivating_user": "spend_regime = 'REACTIVATING'",
    "business_spend_proxy": "business_proxy_flag IN ('LIKELY_BUSINESS', 'POSSIBLE_BUSINESS')",
    "risk_monitor_flag": "concentration_shock_flag = 1 OR spend_drop_flag = 1 OR topup_overdependence_flag = 1 "
                         "OR high_freq_low_ticket_flag = 1 OR unstable_flag = 1",
    "grocery_anchor": "grocery_share_m >= 0.30::DOUBLE", "payday_spender": "payday_share_m >= 0.50::DOUBLE",
    "ride_hailing_regular": "ride_hailing_share_m >= 0.10::DOUBLE",
}
CTES["scored"] = f"""
SELECT *,
  least(1.0::DOUBLE, l1_travel_mobility_share_m * 2 + xborder_share_3m * 1.5::DOUBLE
        + CASE WHEN travel_booking_txn_cnt_m >= 2 THEN 0.3::DOUBLE ELSE 0 END) AS score_travel,
  least(1.0::DOUBLE, premium_share_3m * 3 + CASE WHEN avg_ticket_3m > 5000 THEN 0.3::DOUBLE ELSE 0 END
        + CASE WHEN avg_ticket_3m > 10000 THEN 0.2::DOUBLE ELSE 0 END) AS score_affluent,
  least(1.0::DOUBLE, online_share_3m * 1.2::DOUBLE + l1_digital_services_share_m * 1.5::DOUBLE) AS score_digital,
  least(1.0::DOUBLE, l1_food_dining_share_m * 1.5::DOUBLE + food_delivery_share_m * 2) AS score_food_social,
  least(1.0::DOUBLE, grocery_share_3m * 2 + l1_everyday_essentials_share_m * 1.5::DOUBLE) AS score_everyday,
  CASE WHEN business_proxy_flag = 'LIKELY_BUSINESS' THEN 1.0::DOUBLE
       ELSE least(0.5::DOUBLE, business_proxy_share_m * 3) END AS score_business_proxy,
  least(1.0::DOUBLE, wallet_share_3m * 2 + online_share_3m * 0.8::DOUBLE) AS score_mobile_wallet,
  least(1.0::DOUBLE, top1_merchant_share_m * 1.5::DOUBLE + merchant_hhi_m * 1.2::DOUBLE) AS score_concentration,
  CASE WHEN spend_regime = 'DORMANT' OR feature_quality_flag = 'ZERO_SPEND' THEN 'DORMANT_LOW_ACTIVITY'
       WHEN business_proxy_flag = 'LIKELY_BUSINESS' THEN 'BUSINESS_PROXY'
       WHEN l1_travel_mobility_share_m > 0.20::DOUBLE OR xborder_share_3m > 0.15::DOUBLE OR travel_booking_txn_cnt_m >= 2
            THEN 'TRAVEL_CENTRIC'
       WHEN premium_share_3m > 0.10::DOUBLE AND avg_ticket_3m > 5000 THEN 'AFFLUENT_LIFESTYLE'
       WHEN online_share_3m > 0.55::DOUBLE OR l1_digital_services_share_m > 0.25::DOUBLE THEN 'DIGITAL_NATIVE'
       WHEN l1_food_dining_share_m > 0.25::DOUBLE
            OR l2_restaurants_share_m + l2_food_delivery_share_m + l2_coffee_cafe_share_m > 0.25::DOUBLE THEN 'LIFESTYLE_SOCIAL'
       WHEN top1_merchant_share_m > 0.50::DOUBLE OR merchant_hhi_m > 0.35::DOUBLE THEN 'CONCENTRATED_LOYALIST'
       WHEN wallet_share_3m > 0.20::DOUBLE AND online_share_3m > 0.30::DOUBLE THEN 'EMERGING_MOBILE'
       WHEN category_breadth_m >= 5 AND merchant_entropy_3m > 2.5::DOUBLE THEN 'DIVERSIFIED_EXPLORER'
       ELSE 'EVERYDAY_ANCHOR' END AS primary_persona,
  {commas(*[f"{bit(c)} AS ms_{n}" for n, c in OVERLAYS.items()])},
  CASE feature_quality_flag WHEN 'GOOD' THEN 'HIGH' WHEN 'LOW_VOLUME' THEN 'MEDIUM' ELSE 'LOW' END AS persona_confidence,
  CASE feature_quality_flag WHEN 'GOOD' THEN 1.0::DOUBLE WHEN 'LOW_VOLUME' THEN 0.5::DOUBLE ELSE 0.2::DOUBLE END
    AS persona_confidence_score
FROM mart"""
CTES["shifted"] = """
SELECT *, CASE WHEN primary_persona_prev_m IS NOT NULL AND primary_persona_prev_m <> primary_persona THEN 1 ELSE 0 END
  AS persona_shift_flag
FROM (SELECT *, lag(primary_persona) OVER (PARTITION BY cust ORDER BY mon) AS primary_persona_prev_m FROM scored)"""
CTES["tenured"] = """
SELECT *, row_number() OVER (PARTITION BY cust, island ORDER BY mon) AS persona_tenure_months
FROM (SELECT *, sum(CASE WHEN primary_persona_prev_m IS NULL THEN 1 ELSE persona_shift_flag END)
        OVER (PARTITION BY cust ORDER BY mon) AS island FROM shifted)"""
CAMPAIGN = " ".join(f"WHEN '{p}' THEN '{u}'" for p, u in fv.CAMPAIGN_USE_CASES.items())
CTES["personas"] = f"""
SELECT *,
  CASE primary_persona {CAMPAIGN} ELSE '{fv.CAMPAIGN_DEFAULT}' END AS campaign_use_case,
  CASE WHEN spend_velocity_m > 0 AND avg_ticket_m > 3000 AND persona_confidence = 'HIGH' THEN 'line_increase_candidate'
       WHEN recurring_spend_share_m > 0.30::DOUBLE AND spend_regime = 'ACTIVE' THEN 'stable_recurring_spend|line_confidence'
       WHEN primary_persona IN ('AFFLUENT_LIFESTYLE', 'TRAVEL_CENTRIC') AND premium_share_3m > 0.10::DOUBLE
            THEN 'premium_migration_candidate'
       WHEN primary_persona = 'DIVERSIFIED_EXPLORER' AND category_breadth_m >= 5
            THEN 'diversified_healthy_spend|affluent_migration'
       ELSE 'standard_review' END AS clm_use_case,
  CASE WHEN xborder_share_3m > 0.15::DOUBLE THEN 'cross_border_pricing_relevant'
       WHEN primary_persona = 'TRAVEL_CENTRIC' THEN 'travel_card_pricing'
       WHEN ms_subscription_heavy = 1 THEN 'subscription_card_features'
       WHEN ms_wallet_dependent = 1 THEN 'wallet_integration_pricing'
       WHEN ms_premium_retail_oriented = 1 THEN 'premium_product_pricing' ELSE 'standard_pricing' END AS pricing_use_case,
  CASE WHEN ms_risk_monitor_flag = 1 THEN concat_ws('|',
       CASE WHEN concentration_shock_flag = 1 THEN 'concentration_shock' END,
       CASE WHEN spend_drop_flag = 1 THEN 'spend_decline' END,
       CASE WHEN topup_overdependence_flag = 1 THEN 'topup_overdependence' END,
       CASE WHEN high_freq_low_ticket_flag = 1 THEN 'high_freq_low_ticket' END,
       CASE WHEN unstable_flag = 1 THEN 'unstable_behavior' END) ELSE 'no_risk_signal' END AS risk_use_case
FROM tenured"""
