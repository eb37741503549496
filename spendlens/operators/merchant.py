"""Merchant text: normalised names, match text, keys and tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_text


def add_merchant_text(df: DataFrame) -> DataFrame:
    """Normalised merchant and description text with the derived keys."""
    return add_match_keys(df, clean_text(F.col("MCHT_NM")), clean_text(F.col("TXN_DESC")))


def add_match_keys(df: DataFrame, name: Column, description: Column) -> DataFrame:
    """The same from texts that are normalised already."""
    named = df.withColumns({"mcht_nm_raw": F.col("MCHT_NM"), "mcht_nm_norm": name, "txn_desc_norm": description})
    return named.withColumns({
        "match_text": match_text(F.col("mcht_nm_norm"), F.col("txn_desc_norm")),
        "merchant_key": merchant_key(F.col("mcht_nm_norm")),
    })


def match_text(name: Column, description: Column) -> Column:
    return F.concat_ws(" | ", name, description)


def merchant_key(name: Column) -> Column:
    return F.sha2(name, 256)


def add_merchant_tokens(df: DataFrame) -> DataFrame:
    """Words of the normalised name, how many, and the first one."""
    return df.withColumn("merchant_tokens", F.split("mcht_nm_norm", r"\s+")).withColumns({
        "merchant_token_cnt": F.size("merchant_tokens"),
        "merchant_brand_root": F.get("merchant_tokens", F.lit(0)),
    })
