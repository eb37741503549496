"""The broad variant: 32 coarse rules, single-source taxonomy, monthly personas.

Same three phases as the main pipeline with other definitions. Rules that share a
priority are settled by list order, and no transaction is lost or repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import (
    clean_text_basic, flag, label_by, matching, mean_of, money_when, safe_div, squared, sum_money,
    tier_by, units)
from ..sources import complete_columns, materialize, standardize
from .history import add_history_part, held_as, history_cuts, large_owners, move_by_history, move_by_month, store_rows
from .monthly import MONTH, PLAIN_MONTH, add_plain_months, join_months, label_mix, per_month, restore_months
from .recurrence import LAST3, add_last3, add_last3_tags
from .merchant import match_text
from .rules import classify_texts, distinct_texts, join_profiles, settle, store_profiles
from .trends import months, rows

LEVELS = ["l1", "l2", "l3"]
L1 = [*fv.ECOSYSTEMS, fv.OTHER_LONGTAIL]
# Rules as the main pipeline has them; the name of a rule is its L3.
RULES = [(priority, l3, pattern, l1, l2, l3) for priority, l1, l2, l3, pattern in fv.BROAD_RULES]


# ---------------------------------------------------------------- transactions

def standardize_lenient(df: DataFrame, key_columns: list[str] | None = None) -> DataFrame:
    """Typed transactions where a missing column gets a default instead of an
    error: today's date, amount 0.0, and blank text."""
    defaults = {
        "TXN_DT": F.current_date().cast("timestamp"), "TXN_AMT": F.lit(0.0), "MCHT_NM": F.lit(""),
        "TXN_DESC": F.lit(""), "CURR_DESC": F.lit(""), "ONLN_FLAG": F.lit(""),
        "CUST_NUM": F.lit(None).cast("string"),
    }
    missing = {name: value for name, value in defaults.items() if name not in df.columns}
    return standardize(df.withColumns(missing) if missing else df, key_columns)


def add_text_basic(df: DataFrame) -> DataFrame:
    """Lightly cleaned texts; the merchant key covers name and description."""
    return add_basic_keys(df, clean_text_basic(F.col("MCHT_NM")), clean_text_basic(F.col("TXN_DESC")))


def add_basic_keys(df: DataFrame, name: Column, description: Column) -> DataFrame:
    """The same from a name and a description that are cleaned already."""
    cleaned = df.withColumns({
        "mcht_nm_norm": name,
        "txn_desc_norm": description,
        "curr_desc_norm": clean_text_basic(F.col("CURR_DESC")),
    })
    return cleaned.withColumns({
        "match_text": match_text(F.col("mcht_nm_norm"), F.col("txn_desc_norm")),
        "merchant_tokens": F.split("mcht_nm_norm", " "),
        "merchant_key": _merchant_key("mcht_nm_norm", "txn_desc_norm"),
    })


def _merchant_key(name: str, description: str) -> Column:
    return F.sha2(F.concat_ws("||", name, description), 256)


def add_source_taxonomy(df: DataFrame) -> DataFrame:
    """The landed taxonomy without its placeholder texts. It counts as mobius if the
    industry column exists, else as b2k."""
    landed = [f"taxonomy_{level}_final" for level in LEVELS]
    source = "mobius" if "SIC_CD_DESC" in df.columns else "b2k"
    if landed[0] in df.columns:
        df = complete_columns(df, landed).withColumns({
            f"{source}_{level}": F.when(~F.col(name).isin(fv.SOURCE_SENTINELS), F.col(name))
            for level, name in zip(LEVELS, landed)
        })
    return complete_columns(df, [f"{s}_{level}" for s in ("mobius", "b2k") for level in LEVELS])


TEXT_TAGS = {
    "wallet_flag": fv.BROAD_WALLET,
    "processor_flag": fv.BROAD_PROCESSOR,
    "names_topup": fv.BROAD_TOPUP,
    "marketplace_flag": fv.BROAD_MARKETPLACE,
    "food_delivery_flag": fv.BROAD_FOOD_DELIVERY,
    "ride_hailing_flag": fv.BROAD_RIDE_HAILING,
    "premium_merchant_flag": fv.BROAD_LUXURY_MALL,
    "business_proxy_flag": fv.BROAD_B2B,
}
MALL_PATTERNS = [fv.BROAD_CENTRAL, fv.BROAD_THE_MALL, fv.BROAD_SIAM_EM, fv.BROAD_MEGA]


def text_tags(texts: DataFrame) -> DataFrame:
    """Rule result and pattern tags of each text."""
    named = [*TEXT_TAGS.items(), *[("mall_ecosystem_flag", pattern) for pattern in MALL_PATTERNS]]
    details = {rule[1]: "|".join(rule[3:]) for rule in RULES}
    paths = F.create_map(*[F.lit(text) for pair in details.items() for text in pair])
    profile = settle(
        classify_texts(texts, RULES), _tags=matching("match_text", named)
    ).withColumns({
        **{name: flag(F.array_contains("_tags", name)) for name in [*TEXT_TAGS, "mall_ecosystem_flag"]},
        "matched_rule_set": F.array_sort(F.transform("rule_hits", lambda name: F.try_element_at(paths, name))),
    }).withColumnsRenamed({"priority": "matched_priority", "rule_match_cnt": "rule_match_count"})
    return profile.drop("_tags", "rule_hits", "matched_rule_name")


def add_rules_and_tags(df: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """Rule result and pattern tags, evaluated once per distinct text; with ``profiles`` by
    the number that rows hold, as in ``add_text_profile``."""
    tagged = join_profiles(df, profiles) if profiles is not None else df.join(text_tags(distinct_texts(df)), "match_text")
    wallet, app = F.col("wallet_flag") == 1, (F.col("food_delivery_flag") + F.col("ride_hailing_flag")) > 0
    currency = F.col("curr_desc_norm")
    tagged = tagged.withColumns({
        "rule_conflict_flag": label_by([
            ("MULTIPLE_RULES_MATCHED", F.col("rule_match_count") > 1),
            ("SINGLE_RULE_MATCHED", F.col("rule_match_count") == 1)], "NO_RULE_MATCH"),
        "channel_tag": label_by([
            ("IN_APP", app | wallet),
            ("ONLINE", F.col("ONLN_FLAG").isin("Y", "1")),
            ("OFFLINE", F.col("ONLN_FLAG").isin("N", "0"))], "UNKNOWN"),
        "geo_tag": label_by([
            ("DOMESTIC", currency.rlike(r"\b(thb|baht)\b")), ("UNKNOWN", currency == "")], "CROSS_BORDER"),
        "topup_flag": flag(wallet | (F.col("names_topup") == 1)),
    }).drop("names_topup")
    return tagged.withColumn("in_app_tag", flag(F.col("channel_tag") == "IN_APP"))


def reconcile_single_source(df: DataFrame) -> DataFrame:
    """All levels come from the one best source: rule, then mobius, then b2k."""
    def valid(name: str) -> Column:
        return F.col(name).isNotNull() & ~F.col(name).isin([*fv.SOURCE_SENTINELS, fv.UNCLASSIFIED])

    chosen = df.withColumn("taxonomy_source_used", label_by([
        ("MERCHANT_RULE", F.col("matched_priority").isNotNull()),
        ("MOBIUS", valid("mobius_l1")), ("B2K", valid("b2k_l1"))], fv.UNCLASSIFIED))
    source = F.col("taxonomy_source_used")
    fallback = {"l1": fv.OTHER_LONGTAIL, "l2": fv.UNCLASSIFIED, "l3": fv.UNCLASSIFIED}
    leveled = chosen.withColumns({
        f"tax_{level}": F.when(source == "MERCHANT_RULE", F.col(f"rule_{level}"))
        .when(source == "MOBIUS", F.col(f"mobius_{level}"))
        .when(source == "B2K", F.col(f"b2k_{level}"))
        .otherwise(F.lit(fallback[level]))
        for level in LEVELS
    })
    from_source = source.isin("MOBIUS", "B2K")
    deep = {level: F.col(f"tax_{level}") != fallback[level] for level in LEVELS}
    return leveled.withColumns({
        "taxonomy_conflict_flag": label_by([(
            "MOBIUS_B2K_MISMATCH",
            valid("mobius_l1") & valid("b2k_l1") & (F.col("mobius_l1") != F.col("b2k_l1")))], "NO_CONFLICT"),
        "taxonomy_confidence_tag": label_by([
            ("HIGH", source == "MERCHANT_RULE"), ("MEDIUM", from_source & deep["l3"]),
            ("LOW", from_source & deep["l2"])], "VERY_LOW"),
        "taxonomy_match_level": label_by([(level.upper(), deep[level]) for level in reversed(LEVELS)], "NONE"),
    })


def enrich_broad(source: DataFrame, key_columns: list[str] | None = None, by_month: bool = False) -> DataFrame:
    """Phase 1 of the broad variant. The source is read once: its rows are stored with their
    cleaned texts. Histories come first, while rows are narrow. ``by_month`` lays the rows
    out for a table of months, again while they are narrow."""
    held = ["mcht_nm_norm", "txn_desc_norm", *([] if key_columns else ["txn_key"])]

    def derive(rows: DataFrame) -> DataFrame:
        typed = standardize_lenient(rows, key_columns or source.columns)
        if not key_columns:
            typed = typed.withColumn("txn_key", F.col(held_as("txn_key")))
        return add_basic_keys(typed, F.col(held_as("mcht_nm_norm")), F.col(held_as("txn_desc_norm")))

    stored = store_rows(add_text_basic(standardize_lenient(source, key_columns)), source.columns, held)
    named = derive(stored)
    numbers, profiles = store_profiles(text_tags(distinct_texts(named)))
    numbered = stored.withColumn("match_text", match_text(*[F.col(held_as(c)) for c in held[:2]])).join(numbers, "match_text")
    cuts = history_cuts(named, lambda rows: rows)
    moved = move_by_history(
        add_history_part(derive(numbered), cuts, large_owners(named)), source.columns, [*held, "profile_id"],
        _merchant_key(held_as("mcht_nm_norm"), held_as("txn_desc_norm")), derive, by_owner=cuts.isEmpty())
    visits = add_last3(moved)
    if by_month:
        visits = move_by_month(visits, source.columns, [*held, "profile_id", *LAST3], derive)
    txns = add_source_taxonomy(add_last3_tags(visits))
    tagged = reconcile_single_source(add_rules_and_tags(txns, profiles))
    sized = tagged.withColumn("txn_size_tier", tier_by(F.col("txn_amount"), fv.SIZE_TIERS, fv.SIZE_TIER_TOP))
    return complete_columns(sized, fv.BROAD_OUTPUT_COLUMNS)


# ---------------------------------------------------------------- customer-months

# Spend columns by name: the tag and its value whose transactions they add up.
SPENDS = {
    "online_spend_m": ("channel_tag", "ONLINE"),
    "offline_spend_m": ("channel_tag", "OFFLINE"),
    "in_app_spend_m": ("channel_tag", "IN_APP"),
    "domestic_spend_m": ("geo_tag", "DOMESTIC"),
    "xborder_spend_m": ("geo_tag", "CROSS_BORDER"),
    "wallet_spend_m": ("wallet_flag", 1),
    "topup_spend_m": ("topup_flag", 1),
    "processor_spend_m": ("processor_flag", 1),
    "food_delivery_spend_m": ("food_delivery_flag", 1),
    "ride_hailing_spend_m": ("ride_hailing_flag", 1),
    "premium_spend_m": ("premium_merchant_flag", 1),
    "business_proxy_spend_m": ("business_proxy_flag", 1),
    "mall_spend_m": ("mall_ecosystem_flag", 1),
    "recurring_spend_m": ("subscription_candidate_flag", 1),
}
SHARED = ["online", "offline", "in_app", "xborder", "wallet", "topup", "food_delivery", "premium",
          "business_proxy", "mall", "recurring"]


def merchant_rows(txns: DataFrame) -> DataFrame:
    """A row per customer, month and merchant. The key is the first 128 bits of the digest,
    a quarter of its hexadecimal text, since most shuffles of the mart carry it."""
    candidate = F.max("subscription_candidate_flag")
    return txns.groupBy(*MONTH, F.unhex(F.left("merchant_key", F.lit(32))).alias("merchant_key")).agg(
        sum_money("txn_amount").alias("spend"), F.count("*").alias("visits"), candidate.alias("is_recurring"))


def _plain(name: str) -> Column:
    """A column whose name is a label and may hold any sign."""
    return F.col(f"`{name}`")


def month_base(txns: DataFrame, merchants: DataFrame) -> DataFrame:
    """Base aggregate, ecosystem spend (NULL where there is none; other labels in
    ``l1_remainder_spend_m``), the dominant ecosystem of any label, concentration over
    labels, and eleven shares."""
    amount, l1 = F.col("txn_amount"), F.col("tax_l1")
    totals = per_month(
        txns,
        F.count("*").alias("txn_cnt_m"),
        sum_money(amount).alias("spend_amt_m"),
        mean_of(sum_money(amount), F.count(amount)).alias("avg_ticket_m"),
        F.max(amount).alias("max_ticket_m"),
        F.bit_count(F.expr("bit_or(shiftleft(1L, dayofmonth(txn_date)))")).alias("active_days_m"),
        *[money_when(F.col(tag) == value).alias(name) for name, (tag, value) in SPENDS.items()],
        F.sum("subscription_candidate_flag").alias("recurring_txn_cnt_m"),
        *[sum_money(F.when(l1 == label, amount)).alias(label) for label in L1],
        sum_money(F.when(~F.coalesce(l1.isin(L1), F.lit(False)), amount)).alias("l1_remainder_spend_m"),
    )
    visited = per_month(
        merchants, F.count("*").alias("uniq_merchants_m"), F.sum("is_recurring").alias("recurring_merchant_cnt_m"))
    base = join_months(totals, visited)
    return join_months(base, label_mix(txns, [top_label(), *ecosystem_concentration()])).withColumns({
        "dominant_ecosystem": F.col("top.tax_l1"),
        "dominant_ecosystem_spend_m": -F.col("top.minus"),
        **{f"{part}_spend_share_m": safe_div(F.col(f"{part}_spend_m"), F.col("spend_amt_m")) for part in SHARED},
    }).drop("top")


def _signed(of, total: Column, spend: Column) -> Column:
    """``of`` the spends where the month's total is positive, of the negated ones where it
    is negative: a share is positive if spend and total have one sign."""
    return F.when(total > 0, of(spend, total)).when(total < 0, of(-spend, -total)).otherwise(F.lit(0.0))


def _entropy_of(spend: Column, total: Column) -> Column:
    """Sum of -p*log2(p) over the positive shares p, from sums of one pass."""
    positive = sum_money(F.when(spend > 0, spend).otherwise(0.0))
    logged = F.sum(F.when(spend > 0, spend * F.log2(spend)).otherwise(0.0))
    return (F.log2(total) * positive - logged) / total


def mix(name: str) -> list[Column]:
    """Entropy, concentration and largest share of the ``spend`` of a month's rows."""
    spend, total = F.col("spend"), sum_money("spend")
    squares = F.sum(squared(units("spend"))).cast("double")
    whole = F.sum(units("spend")).cast("double")
    return [
        _signed(_entropy_of, total, spend).alias(f"{name}_entropy_m"),
        F.coalesce(squares / F.nullif(whole * whole, F.lit(0.0)), F.lit(0.0)).alias(f"{name}_hhi_m"),
        _signed(lambda part, all_of_it: F.max(part) / all_of_it, total, spend).alias(f"top_{name}_share_m"),
    ]


def _first_three(order: Column) -> Column:
    """Whether a spend is among the first three of its month, whoever of equal ones comes first."""
    return F.row_number().over(Window.partitionBy(*PLAIN_MONTH).orderBy(order)) <= 3


def merchant_intelligence(merchants: DataFrame, bounds: dict[str, int]) -> DataFrame:
    """Scale, entropy, top shares and first-seen merchants of a customer-month. Its rows, one
    for each merchant, move to their month once, for the largest spends and the sums alike:
    they are half as wide as partial sums, which have little to combine."""
    sizes = merchants.groupBy("merchant_key", "txn_month").agg(
        F.sum("visits").alias("size"), sum_money("spend").alias("merchant_total_spend_m"),
        F.count("*").alias("merchant_cust_cnt_m"))
    # Stored first, so that customers' rows stay where they are while there are few merchants.
    sized = join_months(merchants, materialize(sizes, "broad_sizes"), ["merchant_key", "txn_month"])
    moved = add_plain_months(sized).select(*PLAIN_MONTH, "spend", "visits", "size").repartition(*PLAIN_MONTH)
    ranked = moved.withColumns({
        "_most": _first_three(F.desc_nulls_last("spend")), "_least": _first_three(F.asc_nulls_last("spend"))})
    spend, size = F.col("spend"), F.col("size")

    def spend_at(condition: Column) -> Column:
        return sum_money(F.when(condition, spend).otherwise(0.0))

    # The largest shares are those of the largest spends, or of the smallest where a month
    # of refunds has a negative total.
    total = sum_money("spend")
    top3 = F.when(total > 0, sum_money(F.when(F.col("_most"), spend))).when(
        total < 0, sum_money(F.when(F.col("_least"), spend)))
    months_of = restore_months(ranked.groupBy(*PLAIN_MONTH).agg(
        (F.sum(size * F.col("visits")) / F.sum("visits")).alias("avg_merchant_scale_txn_cnt_m"),
        F.max(size).alias("max_merchant_scale_txn_cnt_m"),
        spend_at(size >= bounds["mega"]).alias("spend_at_mega_merchants_m"),
        spend_at((size >= bounds["large"]) & (size < bounds["mega"])).alias("spend_at_large_merchants_m"),
        spend_at(size < bounds["longtail"]).alias("spend_at_longtail_merchants_m"),
        *mix("merchant"),
        F.coalesce(top3 / F.nullif(total, F.lit(0.0)), F.lit(0.0)).alias("top3_merchant_share_m"),
    ))
    first = merchants.groupBy("CUST_NUM", "merchant_key").agg(F.min("txn_month").alias("txn_month"))
    new = per_month(first, F.count("*").alias("new_merchant_cnt_m"))
    return join_months(months_of, new).fillna(0, subset=["new_merchant_cnt_m"])


def ecosystem_concentration() -> list[Column]:
    """Entropy and concentration of a month, over the spends of its labels."""
    return mix("ecosystem")[:2]


def top_label() -> Column:
    """The label with the largest spend of a month, then by name."""
    spend, l1 = F.col("spend"), F.col("tax_l1")
    return F.min(F.when(l1.isNotNull() & spend.isNotNull(), F.struct((-spend).alias("minus"), l1))).alias("top")


def add_rolling(df: DataFrame) -> DataFrame:
    """Three- and six-month sums and averages, and changes to the month before."""
    previous = {
        "prev_spend_amt_m": "spend_amt_m", "prev_txn_cnt_m": "txn_cnt_m",
        "prev_online_share_m": "online_spend_share_m", "prev_xborder_share_m": "xborder_spend_share_m",
        "prev_wallet_share_m": "wallet_spend_share_m", "prev_premium_share_m": "premium_spend_share_m",
        "prev_dominant_ecosystem": "dominant_ecosystem", "prev_merchant_entropy_m": "merchant_entropy_m",
    }
    rolled = df.withColumns({
        "spend_amt_3m": sum_money("spend_amt_m", rows(3)),
        "txn_cnt_3m": F.sum("txn_cnt_m").over(rows(3)),
        "spend_amt_6m": sum_money("spend_amt_m", rows(6)),
        "avg_ticket_3m": F.avg("avg_ticket_m").over(rows(3)),
        "merchant_entropy_3m_avg": F.avg("merchant_entropy_m").over(rows(3)),
        "ecosystem_entropy_3m_avg": F.avg("ecosystem_entropy_m").over(rows(3)),
        **{name: F.lag(source).over(months()) for name, source in previous.items()},
        "prev_txn_cnt_m2": F.lag("txn_cnt_m", 2).over(months()),
    })

    def growth(now: str, before: str) -> Column:
        return safe_div(F.col(now) - F.col(before), F.col(before))

    def delta(part: str) -> Column:
        return F.col(f"{part}_spend_share_m") - F.coalesce(f"prev_{part}_share_m", F.lit(0.0))

    trend = F.col("merchant_entropy_trend")
    return rolled.withColumns({
        "mom_spend_growth": growth("spend_amt_m", "prev_spend_amt_m"),
        "mom_txn_growth": growth("txn_cnt_m", "prev_txn_cnt_m"),
        **{f"{part}_share_delta_m": delta(part) for part in ("online", "xborder", "wallet", "premium")},
        "l1_migration_flag": flag(F.col("dominant_ecosystem") != F.col("prev_dominant_ecosystem")),
        "merchant_entropy_trend":
            F.col("merchant_entropy_m") - F.coalesce("prev_merchant_entropy_m", F.lit(0.0)),
    }).withColumn(
        "diversification_flag",
        label_by([("DIVERSIFYING", trend > 0.10), ("CONCENTRATING", trend < -0.10)], "STABLE"))


def add_regime(df: DataFrame) -> DataFrame:
    count, wallet = F.col("txn_cnt_m"), F.col("wallet_spend_share_m")
    return df.withColumns({
        "spend_regime_flag": label_by([
            ("ACTIVE", count >= 3),
            ("REACTIVATING", (count > 0) & (F.coalesce("prev_txn_cnt_m", F.lit(0)) == 0)),
            ("DORMANT", count == 0)], "LOW_VOLUME"),
        "wallet_dependence_flag": label_by(
            [("HIGH_WALLET", wallet > 0.50), ("MODERATE_WALLET", wallet > 0.20)], "LOW_WALLET"),
        "feature_quality_flag": label_by([
            ("LOW_VOLUME", count < 3), ("ZERO_SPEND", F.col("spend_amt_m") <= 0),
            ("SINGLE_MERCHANT", F.col("uniq_merchants_m") <= 1)], "GOOD"),
    })


def broad_mart(txns: DataFrame, merchants: DataFrame, bounds: dict[str, int]) -> DataFrame:
    """Phase 2 of the broad variant."""
    months_of = join_months(month_base(txns, merchants), merchant_intelligence(merchants, bounds))
    return add_regime(add_rolling(months_of.drop(*PLAIN_MONTH)))


# ---------------------------------------------------------------- personas and views

def add_l1_shares(mart: DataFrame) -> DataFrame:
    """Share of each ecosystem, 0.0 where nothing was spent on it."""
    spent = {label: F.coalesce(_plain(label), F.lit(0.0)) if label in mart.columns else F.lit(0.0) for label in L1}
    return mart.withColumns({
        f"share_{label.lower()}": safe_div(spend, F.col("spend_amt_m")) for label, spend in spent.items()})


def add_personas(mart: DataFrame) -> DataFrame:
    """Monthly persona, its driving share as confidence, overlays and shift."""
    df = add_l1_shares(mart)
    c = F.col
    online = c("online_spend_share_m") + c("in_app_spend_share_m")
    social = c("share_food_dining") + c("share_entertainment_leisure")
    rides = c("ride_hailing_spend_m") / F.when(c("spend_amt_m") == 0, F.lit(1.0)).otherwise(c("spend_amt_m"))
    df = df.withColumn("primary_persona", label_by([
        ("TRAVEL_CENTRIC", (c("share_travel_mobility") > 0.30) | (c("xborder_spend_share_m") > 0.20)),
        ("AFFLUENT_LIFESTYLE", (c("premium_spend_share_m") > 0.25) & (c("avg_ticket_m") > 3000)),
        ("DIGITAL_NATIVE", (online > 0.60) & (c("wallet_spend_share_m") > 0.15)),
        ("EVERYDAY_ANCHOR", (c("share_everyday_essentials") > 0.45) & (c("avg_ticket_m") < 1500)),
        ("LIFESTYLE_SOCIAL", social > 0.40),
        ("EMERGING_MOBILE", c("food_delivery_spend_share_m") + rides > 0.25),
        ("BUSINESS_PROXY", c("business_proxy_spend_share_m") > 0.30),
        ("CONCENTRATED_LOYALIST", (c("top_merchant_share_m") > 0.50) & (c("merchant_entropy_m") < 1.5)),
        ("DIVERSIFIED_EXPLORER", c("merchant_entropy_m") > 3.0),
        ("DORMANT_LOW_ACTIVITY", c("spend_regime_flag").isin("DORMANT", "LOW_VOLUME")),
    ], "EVERYDAY_ANCHOR"))
    drivers = {
        "TRAVEL_CENTRIC": F.greatest("share_travel_mobility", "xborder_spend_share_m"),
        "AFFLUENT_LIFESTYLE": F.greatest(c("premium_spend_share_m"), c("avg_ticket_m") / 10000.0),
        "DIGITAL_NATIVE": F.greatest(online, c("wallet_spend_share_m")),
        "EVERYDAY_ANCHOR": c("share_everyday_essentials"),
        "LIFESTYLE_SOCIAL": social,
        "EMERGING_MOBILE": c("food_delivery_spend_share_m"),
    }
    confidence = F.lit(0.50)
    for persona, driver in drivers.items():
        confidence = F.when(c("primary_persona") == persona, driver).otherwise(confidence)
    overlays = {
        "subscription_heavy": c("recurring_merchant_cnt_m") >= 3,
        "wallet_dependent": c("wallet_spend_share_m") > 0.30,
        "food_delivery_native": c("food_delivery_spend_share_m") > 0.15,
        "cross_border_frequent": c("xborder_spend_share_m") > 0.15,
        "healthcare_engaged": c("share_health_wellness") > 0.15,
        "premium_retail_oriented": c("premium_spend_share_m") > 0.20,
        "convenience_dependent": c("share_everyday_essentials") > 0.50,
        "business_spend_proxy": c("business_proxy_spend_share_m") > 0.20,
        "risk_monitor_flag":
            (c("topup_spend_share_m") > 0.40) | (c("l1_migration_flag") == 1) | (c("mom_spend_growth") < -0.50),
    }
    return df.withColumns({
        "persona_confidence": confidence,
        **{f"overlay_{name}": flag(condition) for name, condition in overlays.items()},
        "prev_persona": F.lag("primary_persona").over(months()),
    }).withColumn("persona_shift_flag", flag(c("prev_persona") != c("primary_persona")))


# Columns of the three views
VIEWS = {
    "campaign": """CUST_NUM txn_month primary_persona persona_confidence overlay_subscription_heavy
        overlay_wallet_dependent overlay_food_delivery_native overlay_cross_border_frequent
        overlay_healthcare_engaged overlay_premium_retail_oriented spend_regime_flag feature_quality_flag
        dominant_ecosystem food_delivery_spend_share_m premium_spend_share_m xborder_spend_share_m""",
    "clm": """CUST_NUM txn_month primary_persona persona_confidence spend_amt_m spend_amt_3m
        mom_spend_growth avg_ticket_m premium_spend_share_m xborder_spend_share_m merchant_entropy_m
        ecosystem_entropy_m""",
    "risk": """CUST_NUM txn_month primary_persona spend_regime_flag overlay_risk_monitor_flag
        topup_spend_share_m wallet_spend_share_m business_proxy_spend_share_m l1_migration_flag
        mom_spend_growth merchant_entropy_trend diversification_flag""",
}


def views(df: DataFrame) -> dict[str, DataFrame]:
    """The campaign, credit-line and risk views; credit lines need good quality."""
    selected = {name: columns.split() for name, columns in VIEWS.items()}
    return {
        "campaign": df.select(*selected["campaign"]),
        "clm": df.where(F.col("feature_quality_flag") == "GOOD").select(*selected["clm"]),
        "risk": df.select(*selected["risk"]),
    }


def _percent(condition: Column) -> Column:
    return F.round(F.avg(flag(condition)) * 100, 4)


def phase1_metrics(txns: DataFrame) -> DataFrame:
    source = F.col("taxonomy_source_used")
    return txns.agg(
        F.count("*").alias("total_records"),
        _percent(F.col("tax_l1") == fv.OTHER_LONGTAIL).alias("unclassified_pct"),
        _percent(source == "MERCHANT_RULE").alias("rule_coverage_pct"),
        _percent(source == "MOBIUS").alias("mobius_coverage_pct"),
        _percent(source == "B2K").alias("b2k_coverage_pct"),
    )


def phase2_metrics(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count("*").alias("customer_months"),
        _percent(F.col("feature_quality_flag") == "LOW_VOLUME").alias("low_volume_pct"))


def phase3_metrics(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("persona_count"))
