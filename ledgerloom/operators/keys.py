"""Key counts: repeated keys, keys that occur once, exact copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("row_count"))
    return counted.filter("row_count > 1")


def singleton_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by exactly one row."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("row_count"))
    return counted.filter("row_count = 1").drop("row_count")


def rows_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: ``candidate_rows`` and some row's other columns.

    The other columns mean something only where ``candidate_rows`` is 1; there
    they are the one row. Partial aggregation reduces a hot key on every task
    before the shuffle, which a window or a self-join would not.
    """
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(
        F.count("*").alias("candidate_rows"), *[F.first(c).alias(c) for c in others]
    )


def singleton_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not repeated; every row of a repeated key is left out."""
    kept = rows_per_key(df, keys).filter("candidate_rows = 1")
    return kept.select(*df.columns)


def drop_exact_copies(df: DataFrame) -> DataFrame:
    """One row of each set of rows that agree in every column."""
    return df.dropDuplicates()


def row_marks(df: DataFrame) -> dict[str, Column]:
    """128 bits that stand for a row, as two columns, and a hash of another kind to check them by.

    Spark's hashes pass over nulls, so where they are is hashed too.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    return {
        "_mark_a": F.xxhash64(nulls, *columns),
        "_mark_b": F.xxhash64(F.lit("second"), *columns, nulls),
        "_mark_check": F.hash(nulls, *columns),
    }


def drop_marked_copies(df: DataFrame, copies: str | None = None) -> DataFrame:
    """One row of each set of rows that were equal when ``row_marks`` were added.

    The other columns may have been made narrower since; only they and the marks are shuffled. Rows that share
    their marks without having been equal raise an error. ``copies`` names a column for the number of rows in the set.
    """
    marks = ["_mark_a", "_mark_b"]
    columns = [f"`{c}`" for c in df.columns if c not in (*marks, "_mark_check")]
    counted = [F.count("*").alias(copies)] if copies else []
    kept = df.groupBy(*marks, *columns).agg(F.min("_mark_check").alias("_low"), F.max("_mark_check").alias("_high"), *counted)
    clash = F.raise_error(F.lit("two different rows have the same marks")).cast("boolean")
    same = kept.filter(F.when(F.col("_low") == F.col("_high"), True).otherwise(clash))
    return same.select(*columns, *([copies] if copies else []))


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise ``ValueError`` if a key is repeated, naming one such key."""
    found = duplicate_keys(df, keys).take(1)
    if found:
        named = ", ".join(f"{k}={found[0][k]}" for k in keys)
        raise ValueError(f"repeated key in {what}: {named} ({found[0]['row_count']} rows)")
