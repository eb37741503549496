"""Token counts with a digest cache.

Counts are stored by the digest of the normalised content and the digest of the
tokenizer file. A run joins its documents to the stored counts, encodes each
distinct text without a count once, appends the new counts, and reads the result
from the cache. Texts that occur many times collapse before they shuffle, so a
group of copies of any size is one row per task; the join back moves ids and
digests only, and Spark splits a hot digest there.

Normalisation is the tokenizer's own: byte_bpe_50k.json has none, so the digest
is taken of the whole text. Null texts are empty. Repeated rows get a row each;
an empty table gives no rows; other columns are not looked at. A digest that two jobs
have stored at the same time counts once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import scratch_path
from .common import table, text_of

CACHE_SCHEMA = "digest binary, version string, n_tokens long"
TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
TEXTS_AT_ONCE = 64


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _counter(path: str, version: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(path).encode_batch_fast
        for batch in batches:
            counts: list[int] = []
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                texts = batch.column("text").slice(start, TEXTS_AT_ONCE).to_pylist()
                counts += [len(e) for e in encode(texts, add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())],
                ["digest", "version", "n_tokens"])
    return count


def _stored(spark: SparkSession, cache_path: str, version: str) -> DataFrame | None:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache_path)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(hadoop_path):
        return None
    counts = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    # Two runs at a time may have stored a digest twice.
    return counts.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache_path: str, tokenizer_path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of every text: id, ``n_bytes``, ``n_tokens``, ``over_limit``."""
    spark = docs.sparkSession
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    version = tokenizer_version(path)
    texts = docs.select(F.col(id_col), text_of(text_col).alias("text")).withColumn(
        "digest", F.unhex(F.sha2("text", 256)))
    known = _stored(spark, cache_path, version)
    missing = texts if known is None else texts.join(known, "digest", "left_anti")
    misses = missing.groupBy("digest").agg(F.first("text").alias("text"))
    misses.mapInArrow(_counter(path, version), CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    counts = _stored(spark, cache_path, version)
    return texts.select(id_col, "digest", F.octet_length("text").cast("long").alias("n_bytes")).join(
        counts, "digest").select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, through a cache that starts empty."""
    return count_tokens(table(spark, sf_dir, "documents"), scratch_path(spark, "token-counts"))
