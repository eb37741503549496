"""The corpus pipeline: five operators, each on what its predecessor kept.

Every stage takes the session, the documents so far and the folder of the tables,
and returns documents with their columns; the last returns token ids. ``run`` writes
each stage as Parquet below the folder of ``spark.checkpoint.dir`` and reads it again.

A document is known by its id, or by its text if it has none. Null texts count as empty; empty
texts are no near duplicates of each other, and texts of any length are processed whole. Repeated
rows are one document from the near-dedup stage on. Columns that documents do not have are
dropped at the start, whatever their names; no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm.byte_bpe import encode_decode
from spendlens.llm.common import table
from spendlens.llm.minhash import near_duplicates
from spendlens.llm.mixing import mix
from spendlens.llm.quality_classifier import classify
from spendlens.llm.secrets import scan
from spendlens.sources.store import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns of documents with ``key``: the id, or for want of one a digest of the text."""
    return docs.select(*COLUMNS).withColumn("key", F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")))


def _chosen(keyed: DataFrame, chosen: DataFrame) -> DataFrame:
    """Documents whose key was chosen. Only keys come from the operator, so texts move at most once."""
    return keyed.join(chosen.select(F.col("doc_id").alias("key")).distinct(), "key", "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for good ones."""
    keyed = _keyed(docs)
    scored = classify(keyed.drop("doc_id").withColumnRenamed("key", "doc_id"), table(spark, sf_dir, "labels"))
    return _chosen(keyed, scored.where(F.col("predicted") == 1)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, 0.8 alike in shingles of five words (the four
    of op5 bind that query only). Rows of one key are one document as well: of each text that it
    has, the row with the least language, source and length is kept."""
    keyed = _keyed(docs)
    found = near_duplicates(keyed.drop("doc_id").withColumnRenamed("key", "doc_id"), words=5)
    kept = _chosen(keyed, found.where("kept")).withColumn("same", F.xxhash64("text"))
    row = F.struct("lang", "source", "n_chars", "doc_id", "text")
    return kept.groupBy("key", "same").agg(F.min(row).alias("row")).select("row.*").select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked by their kind."""
    found = scan(docs.select(*COLUMNS), keep=["lang", "source", "n_chars"])
    text = F.coalesce("masked", "text")
    return found.select(
        "doc_id", text.alias("text"), "lang", "source",
        F.when(F.col("masked").isNull(), F.col("n_chars")).otherwise(F.length("masked").cast("long")).alias("n_chars"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen for the token budgets of their domain, language and source, each once at most."""
    return mix(docs.select(*COLUMNS), max_epochs=1)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with a check that they decode to its text."""
    return encode_decode(docs, ["n_tokens", "ids", "round_trip"])


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_dedup),
    ("secret scans", secrets),
    ("mixing sources", mixing),
    ("byte-level bpe", encoding),
]

#: No SQL: a trained classifier and a tokenizer are among the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
