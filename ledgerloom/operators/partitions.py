"""Looking at partitions and plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_count(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


def rows_per_partition(df: DataFrame) -> DataFrame:
    """Row count per non-empty partition, to see how even they are."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count("*").alias("row_count")
    )


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Even out into ``partitions`` parts, by a full shuffle."""
    return df.repartition(partitions)


def merge_down(df: DataFrame, partitions: int) -> DataFrame:
    """Merge into at most ``partitions`` parts, without a full shuffle."""
    return df.coalesce(partitions)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints, as a string."""
    import contextlib
    import io

    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain(mode=mode)
    return printed.getvalue()
