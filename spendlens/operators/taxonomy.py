"""Source taxonomies and their reconciliation with the rule result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import label_by
from ..sources import attach_dimension, complete_columns

LEVELS = ["l1", "l2", "l3"]


def add_b2k(df: DataFrame, ref: DataFrame) -> DataFrame:
    """Category source: equal category and equal (or both blank) sub-category.
    A NULL category never matches."""
    if "MCHT_CATG" not in df.columns:
        return complete_columns(df, [f"b2k_{level}" for level in LEVELS])
    ref = ref.select(
        F.col("MCHT_CATG").alias("_catg"),
        F.coalesce("MCHT_SUB_CATG", F.lit("")).alias("_sub"),
        *[f"b2k_{level}" for level in LEVELS])
    same = (df["MCHT_CATG"] == F.col("_catg")) & (F.coalesce(df["MCHT_SUB_CATG"], F.lit("")) == F.col("_sub"))
    return attach_dimension(df, ref, ["_catg", "_sub"], same).drop("_catg", "_sub")


def add_mobius(df: DataFrame, ref: DataFrame) -> DataFrame:
    """Industry source: equal description, where NULL counts as blank."""
    if not {"SIC_CD_DESC", "MCC_CD"} <= set(df.columns):
        return complete_columns(df, [f"mobius_{level}" for level in LEVELS])
    ref = ref.select(
        F.coalesce("SIC_CD_DESC", F.lit("")).alias("_sic"), *[f"mobius_{level}" for level in LEVELS])
    same = F.coalesce(df["SIC_CD_DESC"], F.lit("")) == F.col("_sic")
    return attach_dimension(df, ref, ["_sic"], same).drop("_sic")


def reconcile(df: DataFrame) -> DataFrame:
    """Final taxonomy per level (rule, then mobius, then b2k), with its source,
    confidence, depth, and whether the two sources disagree."""
    unclassified = F.lit(fv.UNCLASSIFIED)
    final = df.withColumns({
        f"tax_{level}": F.coalesce(f"rule_{level}", f"mobius_{level}", f"b2k_{level}", unclassified)
        for level in LEVELS
    })
    rule, mobius, b2k = (F.col(f"{source}_l1") for source in ("rule", "mobius", "b2k"))
    final = final.withColumns({
        "taxonomy_source": label_by([
            ("MERCHANT_RULE", rule.isNotNull()), ("MOBIUS", mobius.isNotNull()), ("B2K", b2k.isNotNull()),
        ], fv.UNCLASSIFIED),
        "taxonomy_match_level": label_by(
            [(level.upper(), F.col(f"tax_{level}") != unclassified) for level in reversed(LEVELS)], "NONE"),
        "taxonomy_conflict_flag": label_by([
            ("MOBIUS_B2K_DISAGREE", mobius != b2k),
            ("SINGLE_SOURCE", mobius.isNotNull() | b2k.isNotNull()),
        ], "NO_SOURCE"),
    })
    return final.withColumn("taxonomy_confidence", label_by([
        ("HIGH", F.col("taxonomy_source") == "MERCHANT_RULE"),
        ("MEDIUM", F.col("taxonomy_source").isin("MOBIUS", "B2K")),
    ], "LOW"))


def coverage(df: DataFrame) -> DataFrame:
    """Transactions by source, confidence and match level."""
    return df.groupBy("taxonomy_source", "taxonomy_confidence", "taxonomy_match_level").count()
