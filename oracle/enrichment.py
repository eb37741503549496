"""SQL of phase 1, as common table expressions by name."""

from __future__ import annotations

from spendlens import fixed_values as fv
from spendlens.sources import retail


def quote(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def values(rows: list[tuple]) -> str:
    cells = lambda row: ", ".join(str(v) if isinstance(v, int) else quote(v) for v in row)
    return "VALUES " + ", ".join(f"({cells(row)})" for row in rows)


def listed(items: list[str]) -> str:
    return "(" + ", ".join(quote(i) for i in items) + ")"


# RE2 has no look-ahead; these tests are equivalent to the patterns with one.
WITHOUT = {
    "grab(?!food|\\s?food)": ("grab\\s?food", "grab"),
    "shopee(?!pay|\\s?pay)": ("shopee\\s?pay", "shopee"),
    "big\\s?c(?!inema)": ("big\\s?cinema", "big\\s?c"),
    "the\\s?mall(?!\\s?group)": ("the\\s?mall\\s?group", "the\\s?mall"),
}


def rx(pattern: str, text: str = "match_text") -> str:
    """A boolean regex test, with look-ahead patterns rewritten."""
    if pattern in WITHOUT:
        removed, kept = WITHOUT[pattern]
        return f"regexp_matches(regexp_replace({text}, {quote(removed)}, '#', 'g'), {quote(kept)})"
    if pattern == "thai\\s?airway|thai\\s?air(?!asia)":
        return (f"(regexp_matches({text}, 'thai\\s?airway') OR "
                f"regexp_matches(regexp_replace({text}, 'thai\\s?airasia', '#', 'g'), 'thai\\s?air'))")
    if pattern.startswith("clinic(?!"):
        return (f"(regexp_matches({text}, 'clinic') AND NOT regexp_matches("
                f"regexp_extract({text}, '.*clinic(.*)', 1), 'beauty|cosmetic|skin|derma'))")
    return f"regexp_matches({text}, {quote(pattern)})"


def any_rx(patterns: list[str], text: str = "match_text") -> str:
    plain = [p for p in patterns if p not in WITHOUT]
    tests = [rx(p, text) for p in patterns if p in WITHOUT] + [rx("|".join(plain), text)]
    return "(" + " OR ".join(tests) + ")"


def bit(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def tiers(column: str, bounds, top: str) -> str:
    whens = " ".join(f"WHEN {column} < {bound} THEN '{name}'" for name, bound in bounds)
    return f"CASE WHEN {column} IS NULL THEN NULL {whens} ELSE '{top}' END"


# Money as in the library: whole ten-thousandths, summed exactly and divided last.
def units(amount: str) -> str:
    return f"CAST(round(({amount}) * 10000.0::DOUBLE) AS BIGINT)"


def money(total: str) -> str:
    return f"(CAST({total} AS DOUBLE) / 10000.0::DOUBLE)"


def total(amount: str, over: str = "") -> str:
    return money(f"sum({units(amount)}) {over}")


def mean(amount: str, over: str = "") -> str:
    return f"({total(amount, over)} / nullif(count({amount}) {over}, 0))"


def spread(value: str, over: str = "") -> str:
    """Sample standard deviation of whole numbers from exact sums."""
    n, s1 = f"count({value}) {over}", f"sum(CAST({value} AS HUGEINT)) {over}"
    s2 = f"sum(CAST({value} AS HUGEINT) * CAST({value} AS HUGEINT)) {over}"
    return (f"(CASE WHEN {n} > 1 THEN sqrt(CAST(CAST({n} AS HUGEINT) * {s2} - ({s1}) * ({s1}) AS DOUBLE)"
            f" / (CAST({n} AS DOUBLE) * (CAST({n} AS DOUBLE) - 1))) END)")


def money_spread(amount: str, over: str = "") -> str:
    return f"({spread(units(amount), over)} / 10000.0::DOUBLE)"


def clean(column: str) -> str:
    sql = f"lower(trim(coalesce({column}, '')))"
    for pattern, replacement in fv.CLEANUP_STEPS:
        sql = f"regexp_replace({sql}, {quote(pattern)}, {quote(replacement)}, 'g')"
    return f"trim({sql})"


def clean_basic(column: str) -> str:
    sql = f"lower(coalesce({column}, ''))"
    for pattern, replacement in fv.BASIC_CLEANUP_STEPS:
        sql = f"regexp_replace({sql}, {quote(pattern)}, {quote(replacement)}, 'g')"
    return f"trim({sql})"


CTES: dict[str, str] = {}

CTES["names"] = f"SELECT * FROM ({values(list(enumerate(retail.DESCRIPTORS)))}) AS d(idx, mcht_nm)"
CTES["card"] = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS txn_ref,
       o_custkey AS cust, d.mcht_nm,
       CASE WHEN j.idx BETWEEN 10 AND 13 THEN 199.0::DOUBLE + j.idx
            WHEN l_partkey % 25 = 0 THEN l_extendedprice * 0.6::DOUBLE
            ELSE l_extendedprice * 0.04::DOUBLE END AS amt,
       TIMESTAMP '2024-01-01 00:00:00'
         + to_days(CAST(floor(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 7.0) AS INTEGER))
         + to_hours(CAST(l_partkey % 24 AS INTEGER)) AS ts,
       CASE WHEN l_linenumber % 4 <> 0 THEN p_name END AS txn_desc,
       CASE l_returnflag WHEN 'N' THEN 'THB' WHEN 'R' THEN 'USD' END AS curr_desc,
       CASE l_linenumber WHEN 2 THEN '764' WHEN 3 THEN '' END AS curr_cd,
       CASE l_linenumber % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS onln,
       p_type AS mcht_catg, CAST(NULL AS VARCHAR) AS mcht_sub, p_brand AS sic, p_size, 0 AS copy
FROM (SELECT *, (CASE WHEN l_partkey % 10 < 5 THEN o_custkey * 7
                      WHEN l_partkey % 10 < 8 THEN o_custkey * 3 + 1
                      ELSE o_custkey + l_partkey * 13 END) % 50 AS idx
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) j
JOIN part ON l_partkey = p_partkey
JOIN names d ON d.idx = j.idx"""
CTES["event_card"] = """
SELECT CAST(event_id AS VARCHAR) AS txn_ref, user_id AS cust, d.mcht_nm, value * 20.0::DOUBLE AS amt,
       CAST(ts AS TIMESTAMP) AS ts, CAST(NULL AS VARCHAR) AS txn_desc, CAST(NULL AS VARCHAR) AS curr_desc,
       CAST(NULL AS VARCHAR) AS curr_cd,
       CASE WHEN event_type IN ('click', 'purchase') THEN 'Y' WHEN event_type = 'view' THEN 'N' END AS onln,
       CAST(NULL AS VARCHAR) AS mcht_catg, CAST(NULL AS VARCHAR) AS mcht_sub, CAST(NULL AS VARCHAR) AS sic, 0 AS copy
FROM events JOIN names d ON d.idx = CAST(json_extract_string(props, '$.k') AS BIGINT) % 50"""


CTES["rough_names"] = f"SELECT * FROM ({values(list(enumerate(retail.rough_names())))}) AS d(idx, mcht_nm)"
CTES["rough_cents"] = f"""
SELECT *, (l_orderkey * 7 + l_linenumber * 31 + l_partkey) % {len(retail.rough_names())} AS idx,
       CAST(round(l_extendedprice * 4) AS BIGINT) AS cents,
       DATE '2024-01-01' + CAST(floor(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 7.0) AS INTEGER) AS day
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""
CTES["rough_text"] = """
SELECT *, (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS plain FROM rough_cents"""
CTES["rough_card"] = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS txn_ref,
       CASE WHEN l_orderkey % 11 <> 0 THEN o_custkey % 200 END AS cust, d.mcht_nm,
       TRY_CAST(CASE WHEN l_partkey % 29 = 0 THEN 'n/a' WHEN l_partkey % 13 = 0 THEN NULL
                     WHEN l_returnflag = 'R' THEN '-' || plain ELSE plain END AS DOUBLE) AS amt,
       CASE WHEN l_partkey % 17 <> 0 AND l_partkey % 19 <> 0 THEN day + to_hours(CAST(l_partkey % 24 AS INTEGER)) END AS ts,
       CAST(NULL AS VARCHAR) AS txn_desc, CASE l_returnflag WHEN 'N' THEN 'THB' WHEN 'R' THEN 'USD' END AS curr_desc,
       CAST(NULL AS VARCHAR) AS curr_cd, CASE l_linenumber % 3 WHEN 0 THEN 'Y' WHEN 1 THEN '0' END AS onln,
       p_type AS mcht_catg, CASE l_partkey % 3 WHEN 0 THEN 'SUB1' WHEN 1 THEN '' END AS mcht_sub, p_brand AS sic, again AS copy
FROM rough_text t JOIN rough_names d ON d.idx = t.idx
JOIN (SELECT 0 AS again UNION ALL SELECT 1) ON again = 0 OR l_partkey % 23 = 0"""


def named_ctes(prefix: str, source: str) -> None:
    """Typed and normalised rows of a source."""
    CTES[f"{prefix}typed"] = f"""
SELECT * EXCLUDE (amt), {money(units('amt'))} AS amt, sha256(txn_ref) AS txn_key, CAST(ts AS DATE) AS dt,
  CAST(date_trunc('month', ts) AS DATE) AS mon
FROM {source}"""
    CTES[f"{prefix}named"] = f"""
SELECT *, concat_ws(' | ', nm, ds) AS match_text FROM (
  SELECT *, {clean('mcht_nm')} AS nm, {clean('txn_desc')} AS ds FROM {prefix}typed)"""


named_ctes("", "card")
named_ctes("ev_", "event_card")
named_ctes("ro_", "rough_card")

RULES = fv.MERCHANT_RULES
TEXT_BITS = {
    "is_topup": fv.TOPUP, "is_wallet": fv.WALLET, "is_processor_mediated": fv.PROCESSOR,
    "is_food_delivery": fv.FOOD_DELIVERY, "is_ride_hailing": fv.RIDE_HAILING,
    "is_subscription": fv.SUBSCRIPTION, "is_grocery": fv.GROCERY, "is_risky_merchant": fv.RISKY,
    "is_mall_pattern": fv.MALL, "in_app": fv.IN_APP, "premium_brand": fv.PREMIUM_BRAND,
}
CTES["rules"] = (
    "SELECT * FROM (" + values([(r[0], r[1], r[3], r[4], r[5]) for r in RULES])
    + ") AS r(priority, rule_name, rule_l1, rule_l2, rule_l3)")
CTES["hierarchy"] = f"SELECT * FROM ({values(fv.HIERARCHY)}) AS h(ref_l1, ref_l2, ref_l3)"


def rule_ctes(prefix: str) -> None:
    hits = ", ".join(f"CASE WHEN {rx(r[2])} THEN {r[0]} END" for r in RULES)
    platform = " ".join(f"WHEN {rx(p)} THEN '{name}'" for name, p in fv.PLATFORMS)
    bits = ", ".join(f"{bit(any_rx(p))} AS {name}" for name, p in TEXT_BITS.items())
    CTES[f"{prefix}texts"] = f"""
SELECT match_text, list_filter([{hits}], lambda x: x IS NOT NULL) AS hits, {bits},
       CASE {platform} ELSE 'NONE' END AS platform_ecosystem
FROM (SELECT DISTINCT match_text FROM {prefix}named)"""
    CTES[f"{prefix}ruled"] = f"""
SELECT n.*, t.* EXCLUDE (match_text), len(hits) AS rule_match_cnt, r.*,
       CASE WHEN len(hits) > 1 THEN 'MULTIPLE_RULES' WHEN len(hits) = 1 THEN 'SINGLE_RULE'
            ELSE 'NO_RULE' END AS rule_conflict_flag
FROM {prefix}named n JOIN {prefix}texts t USING (match_text) LEFT JOIN rules r ON r.priority = t.hits[1]"""


rule_ctes("")
rule_ctes("ev_")
rule_ctes("ro_")

CTES["b2k"] = f"SELECT * FROM ({values(retail.B2K_ROWS)}) AS b(catg, sub, b2k_l1, b2k_l2, b2k_l3)"
CTES["mobius"] = f"SELECT * FROM ({values(retail.MOBIUS_ROWS)}) AS m(msic, mcc, mobius_l1, mobius_l2, mobius_l3)"
def taxed_ctes(prefix: str) -> None:
    CTES[f"{prefix}sourced"] = f"""
SELECT t.*, b2k_l1, b2k_l2, b2k_l3, mobius_l1, mobius_l2, mobius_l3
FROM {prefix}ruled t
LEFT JOIN b2k ON t.mcht_catg = b2k.catg AND coalesce(t.mcht_sub, '') = coalesce(b2k.sub, '')
LEFT JOIN mobius ON coalesce(t.sic, '') = coalesce(mobius.msic, '')"""
    CTES[f"{prefix}taxed"] = f"""
SELECT *,
  CASE WHEN taxonomy_source = 'MERCHANT_RULE' THEN 'HIGH'
       WHEN taxonomy_source IN ('MOBIUS', 'B2K') THEN 'MEDIUM' ELSE 'LOW' END AS taxonomy_confidence,
  CASE WHEN tax_l3 <> 'UNCLASSIFIED' THEN 'L3' WHEN tax_l2 <> 'UNCLASSIFIED' THEN 'L2'
       WHEN tax_l1 <> 'UNCLASSIFIED' THEN 'L1' ELSE 'NONE' END AS taxonomy_match_level,
  CASE WHEN mobius_l1 IS NOT NULL AND b2k_l1 IS NOT NULL AND mobius_l1 <> b2k_l1 THEN 'MOBIUS_B2K_DISAGREE'
       WHEN mobius_l1 IS NOT NULL OR b2k_l1 IS NOT NULL THEN 'SINGLE_SOURCE'
       ELSE 'NO_SOURCE' END AS taxonomy_conflict_flag
FROM (SELECT *,
  coalesce(rule_l1, mobius_l1, b2k_l1, 'UNCLASSIFIED') AS tax_l1,
  coalesce(rule_l2, mobius_l2, b2k_l2, 'UNCLASSIFIED') AS tax_l2,
  coalesce(rule_l3, mobius_l3, b2k_l3, 'UNCLASSIFIED') AS tax_l3,
  CASE WHEN rule_l1 IS NOT NULL THEN 'MERCHANT_RULE' WHEN mobius_l1 IS NOT NULL THEN 'MOBIUS'
       WHEN b2k_l1 IS NOT NULL THEN 'B2K' ELSE 'UNCLASSIFIED' END AS taxonomy_source
  FROM {prefix}sourced)"""
    hours = " ".join(f"WHEN hour(ts) >= {a} AND hour(ts) < {b} THEN '{name}'" for name, a, b in fv.HOUR_PATTERNS)
    CTES[f"{prefix}tagged"] = f"""
SELECT *,
  CASE WHEN onln IN ('Y', '1') THEN 'ONLINE' WHEN onln IN ('N', '0') THEN 'OFFLINE'
       WHEN in_app = 1 THEN 'IN_APP' ELSE 'UNKNOWN' END AS channel_tag,
  CASE WHEN regexp_matches(coalesce(curr_cd, curr_desc, ''), {quote(fv.DOMESTIC_CURRENCY)}) THEN 'DOMESTIC'
       WHEN coalesce(curr_cd, curr_desc, '') <> '' THEN 'CROSS_BORDER' ELSE 'UNKNOWN' END AS geo_tag,
  {bit("tax_l2 = 'MARKETPLACE_ECOM'")} AS is_marketplace,
  {bit("tax_l2 = 'MALLS_DEPARTMENT'")} AS is_mall_ecosystem,
  {bit(f"premium_brand = 1 OR tax_l3 IN {listed(fv.PREMIUM_L3)}")} AS is_premium_merchant,
  {bit("tax_l1 = 'B2B_PROFESSIONAL' OR tax_l2 = 'WHOLESALE' OR tax_l3 = 'OFFICE_SUPPLY'")} AS is_business_proxy,
  {bit(f"tax_l2 IN {listed(fv.TRAVEL_BOOKING_L2)}")} AS is_travel_booking,
  {tiers('amt', fv.SIZE_TIERS, fv.SIZE_TIER_TOP)} AS txn_size_tier,
  hour(ts) AS hour_of_day,
  {bit("NOT (hour(ts) = 0 AND minute(ts) = 0 AND second(ts) = 0)")} AS has_real_timestamp,
  CASE WHEN ts IS NULL OR (hour(ts) = 0 AND minute(ts) = 0 AND second(ts) = 0) THEN 'UNKNOWN_TIME' {hours}
       ELSE 'LATE_NIGHT' END AS time_pattern,
  dayofweek(dt) + 1 AS txn_dow,
  CASE WHEN dayofweek(dt) IN (0, 6) THEN 'WEEKEND' ELSE 'WEEKDAY' END AS weekpart_tag,
  day(dt) AS txn_dom,
  {bit("day(dt) BETWEEN 25 AND 31 OR day(dt) BETWEEN 1 AND 5")} AS payday_window_flag,
  {bit(f"is_topup = 1 AND amt > {fv.LARGE_TOPUP}")} AS is_risk_adjacent
FROM {prefix}taxed"""


taxed_ctes("")
taxed_ctes("ev_")
taxed_ctes("ro_")

HISTORY = "PARTITION BY cust, nm ORDER BY dt NULLS FIRST, ts NULLS FIRST, txn_key, copy"
RUNNING = f"({HISTORY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def history_ctes(prefix: str, source: str) -> None:
    CTES[f"{prefix}lagged"] = f"""
SELECT *, lag(dt) OVER ({HISTORY}) AS prev_dt, lag(amt) OVER ({HISTORY}) AS prev_amt FROM {source}"""
    CTES[f"{prefix}spaced"] = f"""
SELECT *, date_diff('day', prev_dt, dt) AS gap,
  CASE WHEN prev_amt > 0 THEN abs(amt - prev_amt) / prev_amt END AS amt_delta_pct
FROM {prefix}lagged"""
    CTES[f"{prefix}history"] = f"""
SELECT *,
  CASE WHEN avg_gap > 0 THEN coalesce(std_gap, 0.0) / avg_gap END AS cv_interval,
  CASE WHEN avg_amt > 0 THEN coalesce(std_amt, 0.0) / avg_amt END AS amt_cv
FROM (SELECT *, count(*) OVER {RUNNING} AS visits, avg(gap) OVER {RUNNING} AS avg_gap,
        {spread('gap', f'OVER {RUNNING}')} AS std_gap, {mean('amt', f'OVER {RUNNING}')} AS avg_amt,
        {money_spread('amt', f'OVER {RUNNING}')} AS std_amt
      FROM {prefix}spaced)"""
    CTES[f"{prefix}enriched"] = f"""
SELECT *, CASE WHEN recurrence_tag IN ('SUBSCRIPTION_LIKE', 'RECURRING') THEN 1 ELSE 0 END AS candidate
FROM (SELECT *,
  CASE WHEN prev_dt IS NULL THEN 'FIRST_TIME' ELSE 'REPEAT' END AS novelty,
  CASE WHEN prev_dt IS NULL THEN 'FIRST_TIME'
       WHEN visits >= 3 AND coalesce(cv_interval, 1.0) < 0.25 AND coalesce(amt_cv, 1.0) < 0.15
            AND avg_gap BETWEEN 15 AND 45 THEN 'SUBSCRIPTION_LIKE'
       WHEN visits >= 2 AND coalesce(cv_interval, 1.0) < 0.40 AND avg_gap BETWEEN 10 AND 60 THEN 'RECURRING'
       WHEN visits >= 2 AND gap BETWEEN 1 AND 90 THEN 'EPISODIC' ELSE 'IRREGULAR' END AS recurrence_tag
  FROM {prefix}history)"""


history_ctes("", "tagged")
history_ctes("ev_", "ev_tagged")
history_ctes("ro_", "ro_tagged")
