"""Parquet in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_and_read(df: DataFrame, path: str, codec: str = "snappy") -> DataFrame:
    """Write a table and return it as read back from storage.

    What follows starts from files, so a lost executor costs a re-read and not
    the work that made the table.
    """
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
