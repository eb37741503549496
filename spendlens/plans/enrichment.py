"""Phase 1: enriched transactions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import SLICE_ROWS, add_history_part, held_as, history_cuts, large_owners, move_by_history, store_rows
from ..operators.merchant import add_match_keys, add_merchant_text, add_merchant_tokens, match_text, merchant_key
from ..operators.recurrence import add_recurrence
from ..operators.rules import add_text_profile, distinct_texts, store_profiles, text_profile
from ..operators.tags import add_tags
from ..operators.taxonomy import add_b2k, add_mobius, reconcile
from ..sources import dimension, standardize

B2K_DDL = "MCHT_CATG string, MCHT_SUB_CATG string, b2k_l1 string, b2k_l2 string, b2k_l3 string"
MOBIUS_DDL = "SIC_CD_DESC string, MCC_CD string, mobius_l1 string, mobius_l2 string, mobius_l3 string"


@dataclass
class References:
    """The two source taxonomies; without tables they are empty frames."""

    b2k: DataFrame
    mobius: DataFrame

    @classmethod
    def empty(cls, spark: SparkSession) -> "References":
        return cls(dimension(spark, [], B2K_DDL), dimension(spark, [], MOBIUS_DDL))


def classify(
    named: DataFrame, refs: References, rules: list[tuple] | None = None, profiles: DataFrame | None = None,
) -> DataFrame:
    """Rules and source taxonomies of transactions with merchant text, reconciled."""
    sourced = add_mobius(add_b2k(named, refs.b2k), refs.mobius)
    return reconcile(add_text_profile(sourced, rules, profiles))


def enrich(
    source: DataFrame,
    refs: References,
    rules: list[tuple] | None = None,
    key_columns: list[str] | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Everything phase 1 knows about a transaction.

    The source is read once: its rows are stored with their cleaned texts. They shuffle
    twice: once to find the profile of their text, unless texts are few, and once for the
    history windows (the join of the carried state shares that exchange). Rows are narrow at
    both points: columns that need no other row come last, and a profile moves as its number.
    """
    held = ["mcht_nm_norm", "txn_desc_norm", *([] if key_columns else ["txn_key"])]

    def derive(rows: DataFrame) -> DataFrame:
        typed = standardize(rows, key_columns or source.columns)
        if not key_columns:
            typed = typed.withColumn("txn_key", F.col(held_as("txn_key")))
        return add_match_keys(typed, F.col(held_as("mcht_nm_norm")), F.col(held_as("txn_desc_norm")))

    stored = store_rows(add_merchant_text(standardize(source, key_columns)), source.columns, held)
    named = derive(stored)
    numbers, profiles = store_profiles(text_profile(distinct_texts(named), rules))
    numbered = stored.withColumn("match_text", match_text(*[F.col(held_as(c)) for c in held[:2]])).join(numbers, "match_text")
    cuts = history_cuts(named, lambda rows: rows, slice_rows)
    sliced = add_history_part(derive(numbered), cuts, large_owners(named, slice_rows))
    # The join of carried state needs all three keys.
    moved = move_by_history(
        sliced, source.columns, [*held, "profile_id"], merchant_key(F.col(held_as("mcht_nm_norm"))), derive,
        by_owner=cuts.isEmpty())
    return add_merchant_tokens(add_tags(classify(add_recurrence(moved), refs, rules, profiles)))
