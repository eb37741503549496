"""Scores, exclusive personas, overlay flags, tenure and use cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import flag, flags_by, labels_by
from .trends import months


def known(name: str) -> Column:
    """A number, or 0 where it is missing."""
    return F.coalesce(F.col(name), F.lit(0.0))


def _score(name: str) -> Column:
    parts = [known(column) * weight for column, weight in fv.SCORE_WEIGHTS[name]]
    parts += [F.when(F.expr(condition), F.lit(points)).otherwise(F.lit(0.0))
              for condition, points in fv.SCORE_POINTS.get(name, [])]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    value = F.least(F.lit(fv.SCORE_MOST.get(name, 1.0)), total)
    return F.when(F.expr(fv.SCORE_SURE[name]), F.lit(1.0)).otherwise(value) if name in fv.SCORE_SURE else value


def add_scores(df: DataFrame) -> DataFrame:
    """Eight dimension scores between 0 and 1."""
    return df.withColumns({name: _score(name) for name in fv.SCORE_WEIGHTS})


def add_persona(df: DataFrame) -> DataFrame:
    """One persona per customer-month; the first that applies."""
    return df.withColumns(labels_by({"primary_persona": (fv.PERSONAS, fv.PERSONA_REST)}))


def add_overlays(df: DataFrame) -> DataFrame:
    """Sixteen overlay flags that do not exclude each other."""
    return df.withColumns(flags_by({f"ms_{name}": condition for name, condition in fv.OVERLAYS.items()}))


def add_confidence(df: DataFrame) -> DataFrame:
    scores = F.create_map(*[F.lit(value) for pair in fv.CONFIDENCE_SCORES.items() for value in pair])
    return df.withColumns(labels_by(fv.CONFIDENCE_LABELS)).withColumn(
        "persona_confidence_score", F.try_element_at(scores, F.col("persona_confidence")))


def add_persona_shift(df: DataFrame) -> DataFrame:
    previous = F.lag("primary_persona").over(months())
    return df.withColumn("primary_persona_prev_m", previous).withColumn(
        "persona_shift_flag", flag(F.col("primary_persona_prev_m") != F.col("primary_persona")))


def add_tenure(df: DataFrame) -> DataFrame:
    """Months in a row with the same persona: the distance to the last row where
    the persona changed."""
    place = F.row_number().over(months())
    changed = F.col("primary_persona_prev_m").isNull() | (F.col("persona_shift_flag") == 1)
    so_far = months().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("_place", place).withColumn(
        "persona_tenure_months",
        F.col("_place") - F.max(F.when(changed, F.col("_place"))).over(so_far) + 1).drop("_place")


def add_use_cases(df: DataFrame) -> DataFrame:
    """Campaign, credit-line, pricing and risk use of a customer-month."""
    persona = F.col("primary_persona")
    campaigns = F.create_map(*[F.lit(text) for pair in fv.CAMPAIGN_USE_CASES.items() for text in pair])
    reasons = {
        "concentration_shock": "concentration_shock_flag",
        "spend_decline": "spend_drop_flag",
        "topup_overdependence": "topup_overdependence_flag",
        "high_freq_low_ticket": "high_freq_low_ticket_flag",
        "unstable_behavior": "unstable_flag",
    }
    active = F.concat_ws("|", *[F.when(F.col(column) == 1, F.lit(name)) for name, column in reasons.items()])
    return df.withColumns({
        "campaign_use_case": F.coalesce(F.try_element_at(campaigns, persona), F.lit(fv.CAMPAIGN_DEFAULT)),
        **labels_by(fv.USE_CASE_LABELS),
        "risk_use_case": F.when(F.col("ms_risk_monitor_flag") == 1, active).otherwise(F.lit("no_risk_signal")),
    })


# Columns of the campaign-ready view
CAMPAIGN_VIEW = """
CUST_NUM txn_month
primary_persona persona_confidence persona_confidence_score persona_shift_flag persona_tenure_months
campaign_use_case clm_use_case pricing_use_case risk_use_case
spend_amt_m consumption_spend_m txn_cnt_m avg_ticket_m max_ticket_m txn_per_active_day_m
online_share_m xborder_share_m wallet_share_m premium_share_m
merchant_entropy_m merchant_hhi_m top3_merchant_share_m
merchant_repeat_ratio_m merchant_novelty_rate_m merchant_churn_rate_m merchant_retention_rate_m
spend_velocity_m spend_acceleration_m
dominant_ecosystem second_ecosystem category_breadth_m
dominant_platform platform_count_m platform_share_m
l1_migration_flag diversification_flag spend_regime feature_quality_flag
spend_amt_3m avg_ticket_3m online_share_3m spend_vs_3m_avg_ratio
spend_amt_12m txn_cnt_12m spend_stability_12m
grocery_share_3m late_night_share_3m weekend_share_3m
score_travel score_affluent score_digital score_food_social score_everyday score_business_proxy
score_mobile_wallet score_concentration
ms_subscription_heavy ms_wallet_dependent ms_food_delivery_native ms_cross_border_frequent
ms_weekend_spender ms_healthcare_engaged ms_premium_retail_oriented ms_convenience_dependent
ms_installment_buyer_proxy ms_fuel_dependent ms_reactivating_user ms_business_spend_proxy
ms_risk_monitor_flag ms_grocery_anchor ms_payday_spender ms_ride_hailing_regular
concentration_shock_flag spend_drop_flag topup_overdependence_flag wallet_dependence_flag
business_proxy_flag
""".split()


def campaign_view(df: DataFrame) -> DataFrame:
    return df.select(*CAMPAIGN_VIEW)
