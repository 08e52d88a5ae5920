"""Version histories: the current version of a key, and keys without a clear one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.keys import rows_per_key


def latest_version(
    df: DataFrame, key: Sequence[str], version: str, ties: Sequence[str]
) -> DataFrame:
    """The newest row of each key; ``ties`` decides among equally new rows.

    Pass ``()`` only where a key cannot hold a version twice.

    Spark keeps only the best row per key on every task before the shuffle, so
    a hot key sends a handful of rows.
    """
    newest = Window.partitionBy(*key).orderBy(
        F.col(version).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in ties]
    )
    numbered = df.withColumn("_position", F.row_number().over(newest))
    return numbered.filter("_position = 1").drop("_position")


def resolve_versions(df: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """One row per key: its newest version and how many rows claim it.

    ``candidate_rows`` is 1 for a clear current row, whose columns are then
    given; with more candidates the other columns mean nothing. Copies of a
    (key, version) are counted by partial aggregation first, however many.
    """
    per_version = rows_per_key(df, [*key, version])
    return latest_version(per_version, key, version, ())


def current_rows(resolved: DataFrame) -> DataFrame:
    """Keys with a single newest row, as rows of the history."""
    return resolved.filter("candidate_rows = 1").drop("candidate_rows")


def ambiguous_keys(resolved: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys whose newest version is claimed by several rows."""
    return resolved.filter("candidate_rows > 1").select(*key, "candidate_rows")


def _at_version(df: DataFrame, chosen: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """Rows of ``df`` at the versions in ``chosen``; null versions match too."""
    right = chosen.select(*[F.col(c).alias(f"_{c}") for c in (*key, version)])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*key, version)]
    return df.join(right, on=same, how="left_semi")


def latest_candidates(df: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """All rows at the newest version of their key, ties included."""
    newest = df.groupBy(*key).agg(F.max(version).alias(version))
    return _at_version(df, newest, key, version)


def ambiguous_rows(
    df: DataFrame, resolved: DataFrame, key: Sequence[str], version: str
) -> DataFrame:
    """The rows that compete for the newest version of an ambiguous key."""
    return _at_version(df, resolved.filter("candidate_rows > 1"), key, version)
