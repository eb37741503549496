"""Line dedup: lines that many documents share stay in one of them only.

Lines are exploded with their positions, and the key of a line (stripped at both
ends, A-Z in lower case) is hashed. Distinct documents are counted per hash; of a
hash at or over the threshold every document but the one with the largest id loses
its lines. What is dropped goes back to its document as positions, and the rest is
reassembled by position.

1. The key is two 64-bit hashes with different seeds, so keys are told apart by 128
   bits and lines never shuffle as text.
2. Documents per key are counted in two steps, first by key and document with partial
   sums in each task, so a line of all documents is one row per task in the end.
3. The keys over the threshold are written. Lines meet them in a join of two tables
   that are dealt out for it alone, so Spark broadcasts them if they are few and splits
   a hot key if not. Positions are grouped per text.
4. Only a projection over the text's own lines follows: positions without the dropped
   ones (a hash set, so long texts cost what they have lines) pick the lines.

Everything is built-in expressions; texts shuffle once, for the join with positions.

Null texts are empty, and an empty text is one empty line. Rows with one id are one
document: they count once and keep or lose a line together. A row without an id
counts for no line and is left whole. Equal rows get a row each; an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import materialize
from .common import table, text_of

BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_CHARS = 20
LEAST_DOCS = 3


def key_of(bare: Column) -> Column:
    """The stripped line with A-Z in lower case."""
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def _lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """(id, same, pos, high, low) of each line that is long enough."""
    # The digest is taken below the generator, once a text.
    whole = docs.where(F.col("id").isNotNull()).withColumn("same", F.xxhash64("text"))
    placed = whole.select("id", "same", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    stripped = placed.select("id", "same", "pos", F.btrim("line", F.lit(BLANKS)).alias("bare"))
    keyed = stripped.where(F.char_length("bare") >= least_chars).withColumn("key", key_of(F.col("bare")))
    return keyed.select(
        "id", "same", "pos", F.xxhash64("key").alias("high"), F.xxhash64(F.lit("low"), F.col("key")).alias("low"))


def dedup_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``n_lines`` before, ``n_dropped`` and the ``kept`` text of every row."""
    docs = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    lines = _lines(docs, least_chars)
    shared = materialize(lines.groupBy("high", "low").agg(
        F.count_distinct("id").alias("n_docs"), F.max("id").alias("latest")).where(F.col("n_docs") >= least_docs), "shared")
    drops = lines.join(shared, ["high", "low"]).where(F.col("id") < F.col("latest")).groupBy("id", "same").agg(
        F.collect_set("pos").alias("dropped"))
    # The generator keeps the split from being repeated for each position.
    whole = docs.withColumn("same", F.xxhash64("text")).join(drops, ["id", "same"], "left").select(
        "id", "text", "dropped", F.explode(F.array(F.split("text", "\n", -1))).alias("lines"))
    n_lines, places = F.size("lines"), F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.transform(F.array_except(places, F.col("dropped")), lambda i: F.get("lines", i))
    return whole.select(
        F.col("id").alias(id_col), n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("kept"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and dropped lines of every document, and the digest of what is kept."""
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = """
WITH placed AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM placed
), shared AS (
  SELECT key, max(doc_id) AS latest FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.pos, k.line, s.latest IS NOT NULL AND k.doc_id < s.latest AS dropped
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
