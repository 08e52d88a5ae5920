"""Applying a batch of changes to a core table: newer wins, and rerunnable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.keys import require_unique
from ledgerloom.operators.versions import latest_version

INSERT, UPDATE, IGNORE = "insert", "update", "ignore"


def classify_changes(
    core: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    version: str,
    ties: Sequence[str],
    dedup: bool = True,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The rows of a batch with the ``action`` each one calls for.

    A key the core lacks is inserted, a strictly newer version updates, and an
    equal or older one is ignored. Only the version decides, never a business
    date, so a late order is still inserted. With ``dedup=False`` a repeated
    key in the batch is an error; otherwise its newest row stands for it.

    The core is first reduced to the keys of the batch, by key columns only, and
    those in ``carry``, which the result has as ``core_<column>``.
    """
    if dedup:
        batch = latest_version(batch, key, version, ties)
    else:
        require_unique(batch, key, "batch")
    carried = {c: f"core_{c}" for c in carry}
    known = core.select(
        *key,
        F.col(version).alias("_core_version"),
        F.lit(True).alias("_in_core"),
        *[F.col(c).alias(name) for c, name in carried.items()],
    )
    touched = known.join(batch.select(*key), on=list(key), how="left_semi")
    action = (
        F.when(F.col("_in_core").isNull(), F.lit(INSERT))
        .when(F.col(version) > F.col("_core_version"), F.lit(UPDATE))
        .otherwise(F.lit(IGNORE))
    )
    joined = batch.join(touched, on=list(key), how="left")
    return joined.withColumn("action", action).select(*batch.columns, "action", *carried.values())


def effective_changes(classified: DataFrame) -> DataFrame:
    """The rows to write: inserts and updates."""
    return classified.filter(F.col("action").isin(INSERT, UPDATE))


def change_report(classified: DataFrame) -> DataFrame:
    """Row count per action."""
    return classified.groupBy("action").agg(F.count("*").alias("row_count"))


def _side_by_side(core: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """``_old`` and ``_new`` row of every key; the keys stay columns, as the core's buckets go by them."""
    old = core.select(*key, F.struct(*core.columns).alias("_old"))
    new = changes.select(*key, F.struct(*core.columns).alias("_new"))
    return old.join(new, on=list(key), how="full")


def apply_changes(core: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """The core with changed keys replaced and new keys added.

    One full join on the key: a core that lies in buckets of it stays where it is, and so does what is
    written back. Keys are unique on both sides.
    """
    both = _side_by_side(core, changes, key)
    return both.select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")


def upsert(
    core: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    version: str,
    ties: Sequence[str],
    dedup: bool = True,
) -> DataFrame:
    """The core after a batch: newer wins, and among equals the core row stays.

    The core has unique keys. The newest row of each key of the batch meets it in one full join, so a core that is
    in buckets of the key, or was just grouped by it, is not shuffled again. Applying a batch again changes
    nothing. Where only some parts of a core hold keys of the batch, ``classify_changes`` and ``apply_changes``
    on those parts read less.
    """
    if dedup:
        batch = latest_version(batch, key, version, ties)
    else:
        require_unique(batch, key, "batch")
    both = _side_by_side(core, batch, key)
    newer = (F.col(f"_new.{version}") > F.col(f"_old.{version}")) | F.col(f"_old.{version}").isNull()
    take = F.col("_old").isNull() | (F.col("_new").isNotNull() & F.col(f"_new.{version}").isNotNull() & newer)
    return both.select(F.when(take, F.col("_new")).otherwise(F.col("_old")).alias("_row")).select("_row.*")


def append_batch(core: DataFrame, batch: DataFrame) -> DataFrame:
    """Core plus the columns of the batch it knows."""
    return core.unionByName(batch.select(*core.columns))


def update_by_key(
    core: DataFrame, corrections: DataFrame, key: Sequence[str], column: str
) -> DataFrame:
    """Set ``column`` to the value of a correction where the key has one."""
    require_unique(corrections, key, "corrections")
    new = corrections.select(*key, F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    joined = core.join(new, on=list(key), how="left")
    value = F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))
    return joined.withColumn(column, value).select(*core.columns)


def delete_by_key(core: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """The core without the rows of the given keys."""
    return core.join(keys.select(*key), on=list(key), how="left_anti").select(*core.columns)


def look_up(core: DataFrame, wanted: dict[str, object]) -> DataFrame:
    """The rows of one key; the conditions reach the Parquet scan."""
    for column, value in wanted.items():
        core = core.filter(F.col(column) == F.lit(value))
    return core
