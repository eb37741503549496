"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles methods above 8 KB; wide steps run faster without them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("spendlens")
    settings = {**SETTINGS, "spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": "16g"}
    for key, value in {**settings, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
