"""Basic sales job: check the columns, add the line amount, write the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.quality import require_columns
from ledgerloom.sources.csv import read_csv, write_csv

REQUIRED = ("quantity", "unit_price")


def add_line_amount(df: DataFrame, name: str = "total_amount") -> DataFrame:
    """Quantity times unit price; null if either is missing."""
    require_columns(df, REQUIRED)
    return df.withColumn(name, F.col("quantity") * F.col("unit_price"))


def run(spark: SparkSession, source: str, target: str) -> None:
    raw = read_csv(spark, source)
    require_columns(raw, REQUIRED)
    # A quantity may be written 2 or 2.0; a text that is no number fails the run.
    typed = raw.withColumns({c: F.col(c).cast("double") for c in REQUIRED})
    amounts = add_line_amount(typed)
    quantity = F.col("quantity")
    whole = quantity == F.floor(quantity)
    written = F.when(whole, quantity.cast("bigint").cast("string")).otherwise(quantity.cast("string"))
    write_csv(amounts.withColumn("quantity", written), target)
