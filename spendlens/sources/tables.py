"""Reading the transaction table, typing it, and writing phase outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import typed_money
from .store import CLEANUP, setting


def read_transactions(spark: SparkSession, name: str, fmt: str | None = None) -> DataFrame:
    """A catalog table, or with a format the files at a path."""
    return spark.read.format(fmt).load(name) if fmt else spark.table(name)


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {', '.join(missing)}")
    return df


def complete_columns(df: DataFrame, names: list[str], dtype: str = "string") -> DataFrame:
    """Add every listed column that is absent as a typed NULL."""
    absent = [n for n in names if n not in df.columns]
    return df.select("*", *[F.lit(None).cast(dtype).alias(n) for n in absent])


def standardize(df: DataFrame, key_columns: list[str] | None = None) -> DataFrame:
    """Check the required columns, complete the optional ones and add typed
    date, timestamp, month and amount columns. Values that do not parse become
    NULL instead of failing the job. Amounts are rounded to four decimals, and all
    later sums are sums of whole ten-thousandths, so they are exact in any order.

    ``txn_key`` is a SHA-256 over the key columns (by default over all source
    columns). Equal rows get equal keys on every run and layout, which is all
    the ordered windows need from it.
    """
    require_columns(df, fv.REQUIRED_COLUMNS)
    key_columns = key_columns or df.columns
    key_text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_columns])
    typed = complete_columns(df, fv.OPTIONAL_COLUMNS).withColumns({
        "txn_key": F.sha2(key_text, 256),
        "txn_ts": F.col("TXN_DT").try_cast("timestamp"),
        "txn_amount": typed_money(F.col("TXN_AMT").try_cast("double")),
    })
    return typed.withColumns({
        "txn_date": F.col("txn_ts").cast("date"),
        "txn_month": F.trunc(F.col("txn_ts").cast("date"), "month"),
    })


def stamp(df: DataFrame, phase: str, source: str | None = None) -> DataFrame:
    """Lineage columns of a phase output."""
    columns = {"_processed_dtm": F.current_timestamp(), "_phase": F.lit(phase)}
    if source is not None:
        columns["_src_table"] = F.lit(source)
    return df.withColumns(columns)


def write_table(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    partition_by: str | list[str] | None = "txn_month",
    mode: str = "overwrite",
    replace_touched: bool = False,
    buckets: tuple[str, int] | None = None,
    laid_out: bool = False,
) -> DataFrame:
    """Write to a path (if the target holds a slash) or a table; read it back.

    With ``replace_touched`` only the partitions that the rows are in are replaced, so a
    run over some months can be repeated and leaves the files of all others alone.

    ``buckets`` (a column and a number; tables only) lays the rows out by that column, a
    file per bucket and partition. Windows and aggregates by the column then read the table
    without a shuffle.

    Reading back cuts the lineage, so audits and later phases scan the stored
    columns they need instead of recomputing the phase. Rows are rebalanced by the
    partition column, unless they are ``laid_out`` so already: small months go to one file,
    large ones are split by size. Parquet is packed by zstd, since digests only yield to an
    entropy code, and what is left of the shuffles is deleted.
    """
    partition_by = [partition_by] if isinstance(partition_by, str) else partition_by
    if buckets:
        rows = df.repartition(buckets[1], buckets[0])
    else:
        rows = df.hint("rebalance", *partition_by) if partition_by and not laid_out else df
    spark = df.sparkSession
    if replace_touched and "/" not in target and spark.catalog.tableExists(target):
        with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"), setting(spark, CLEANUP, "true"):
            rows.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
        return spark.table(target)
    writer = rows.write.mode(mode).format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    if replace_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets[1], buckets[0]).sortBy(buckets[0])
    with setting(spark, CLEANUP, "true"):
        if "/" in target:
            writer.save(target)
            return spark.read.format(fmt).schema(df.schema).load(target)
        writer.saveAsTable(target)
    return spark.table(target)


AUDIT_COLUMNS = "phase STRING, processed_dtm TIMESTAMP, metric STRING, metric_value STRING"


def ensure_audit_table(spark: SparkSession, table: str, fmt: str = "parquet") -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({AUDIT_COLUMNS}) USING {fmt}")


def append_audit(metrics: DataFrame, target: str, fmt: str = "parquet", run_id: str | None = None) -> None:
    """Append tidy audit rows to a table or path. With a ``run_id`` the rows go to the
    partition of run and phase and replace those of an earlier try of the same run."""
    rows = metrics.select(
        F.col("phase"), F.current_timestamp().alias("processed_dtm"),
        F.col("metric"), F.col("metric_value"),
    )
    if run_id is not None:
        named = rows.select("metric", "metric_value", "processed_dtm", F.lit(run_id).alias("run_id"), "phase")
        write_table(named, target, fmt, ["run_id", "phase"], replace_touched=True)
        return
    if "/" in target:
        rows.write.mode("append").format(fmt).save(target)
    else:
        ensure_audit_table(rows.sparkSession, target, fmt)
        rows.write.mode("append").format(fmt).insertInto(target)
