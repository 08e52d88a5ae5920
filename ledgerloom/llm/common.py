"""Helpers shared by the operators: words, remainders, written tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.scratch import written

__all__ = ["SETTINGS", "WORD", "configure", "let", "lower_words", "once", "remainder", "table", "written"]

WORD = r"[^\x20\x09-\x0D]+"


# Rows that a task hands to Python at once; with long texts that bounds its memory.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def lower_words(text: str | None) -> list[bytes]:
    """The words as UTF-8, A-Z lower-cased; ``bytes.split`` parts at the same six characters as ``WORD``."""
    return text.encode().lower().split() if text else []


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(df: DataFrame, columns: dict[str, Column], *kept: str) -> DataFrame:
    """Add columns that no later expression or filter can repeat."""
    fields = [c.alias(n) for n, c in columns.items()]
    return df.select(*kept, F.inline(F.array(F.struct(*fields))))


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the value as text, modulo ``divisor``; null for null."""
    return F.crc32(F.col(column).cast("string")) % divisor


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
