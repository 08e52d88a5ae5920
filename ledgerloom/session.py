"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Skewed joins are split at run time from the real shuffle sizes, also where
# splitting costs one more shuffle: a hot key then never pins a single task.
# The number of shuffle partitions is left to the cluster and to AQE.
# The JVM never compiles methods above 8000 bytes of bytecode, so where a fused
# stage would need one, its operators run one by one, each compiled.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# At most so many bytes of a shuffle, or of files, are put together for one task. They are compressed: rows in
# sorts and hash tables take more than ten times as much, so Spark's own 64 and 128 MB come to a gigabyte a task.
MOST_BYTES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 * 1024 * 1024,
    "spark.sql.files.maxPartitionBytes": 32 * 1024 * 1024,
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings every job and query of this package expects.

    A session that gives a task less than ``MOST_BYTES`` keeps its own values.
    """
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    size_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name, most in MOST_BYTES.items():
        spark.conf.set(name, str(min(size_of(spark.conf.get(name)), most)))
    return spark


def local_session(cpus: int = 8, app_name: str = "ledgerloom") -> SparkSession:
    """A single-process session for tests and the local bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
