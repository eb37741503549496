"""Phases 2 and 3: the customer-month mart and the personas."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import merchants as m
from ..operators import monthly as mm
from ..operators import personas as p
from ..operators import trends as t


def month_base(txns: DataFrame, labels: mm.Labels, merchants: DataFrame) -> DataFrame:
    """Totals, medians, distinct categories, merchant features, shares and ratios of
    a customer-month. NULL customers and months join like any other."""
    base = mm.month_totals(txns, labels)
    for part in (mm.month_medians(txns), mm.label_mix(txns), merchants):
        base = mm.join_months(base, part)
    return mm.add_derived(mm.add_shares(base.withColumnRenamed("merchant_cnt_m", "uniq_merchants_m")))


def feature_mart(
    txns: DataFrame, merchant_table: DataFrame, labels: mm.Labels, bounds: dict[str, int] | None = None,
    base: str = "spend_amt_m",
) -> DataFrame:
    """The mart from enriched transactions and the stored merchant table."""
    sized = m.add_merchant_sizes(merchant_table)
    df = month_base(txns, labels, m.merchant_features(sized, bounds))
    df = mm.join_months(df, m.top_merchants(merchant_table)).drop(*mm.PLAIN_MONTH)
    df = df.withColumn("merchant_cnt_m", df["uniq_merchants_m"])
    df = mm.add_platforms(mm.add_key_l2_shares(mm.add_ecosystems(df, base), base))
    df = m.add_recurring_shares(m.add_top_shares(df))
    df = t.add_wallet_flags(m.add_turnover(df))
    return t.add_quality(t.add_risk_flags(t.add_regime(t.add_trends(t.add_rolling(df)))))


def personas(mart: DataFrame) -> DataFrame:
    """Phase 3 columns on top of the mart."""
    for step in (p.add_scores, p.add_persona, p.add_overlays, p.add_confidence,
                 p.add_persona_shift, p.add_tenure, p.add_use_cases):
        mart = step(mart)
    return mart
