"""Joins with a checked cardinality, orphans, fan-out, and enrichment status.

No side is broadcast by hint: Spark broadcasts a side whose measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges beyond it, where
AQE splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.keys import require_unique


def join_many_to_one(
    left: DataFrame, right: DataFrame, on: Sequence[str], what: str = "lookup table"
) -> DataFrame:
    """Left join that refuses a right side with repeated keys.

    The keys are counted before the join, by a job of its own that reads no
    other column, so the check runs whatever is read of the result. A null key
    has no partner and may repeat. Rows are never multiplied.
    """
    require_unique(right.dropna(subset=list(on)), on, what)
    return left.join(right, on=list(on), how="left")


def orphans(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a partner in ``right``."""
    return left.join(right.select(*on), on=list(on), how="left_anti").select(*left.columns)


def with_partner(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` with a partner in ``right``; never more rows than ``left``."""
    return left.join(right.select(*on), on=list(on), how="left_semi").select(*left.columns)


def fanout_report(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """What a left join would do to the row count, without running it.

    One row: ``rows_before``, ``rows_after`` and ``repeated_keys`` of the right
    side. Both sides are counted per key first, so the join has one row per key
    and no pairs are produced.
    """
    l = left.groupBy(*on).agg(F.count("*").alias("_left"))
    r = right.dropna(subset=list(on)).groupBy(*on).agg(F.count("*").alias("_right"))
    per_key = l.join(r, on=list(on), how="full")
    return per_key.agg(
        F.coalesce(F.sum("_left"), F.lit(0)).alias("rows_before"),
        F.coalesce(
            F.sum(F.col("_left") * F.coalesce("_right", F.lit(1))), F.lit(0)
        ).alias("rows_after"),
        F.count_if(F.col("_right") > 1).alias("repeated_keys"),
    )


def enrich_with_status(
    lines: DataFrame, catalogue: DataFrame, on: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """Add catalogue attributes and ``enrichment_status`` to every line.

    ``catalogue`` has one row per key and a ``candidate_rows`` count. A key with
    several candidates gives CATALOG_DUPLICATE and no attributes. A match is
    told from that count, so a matched row with a null name is still ENRICHED.
    """
    single = F.col("candidate_rows") == 1
    right = catalogue.select(
        *on, "candidate_rows", *[F.when(single, F.col(c)).alias(c) for c in attributes]
    )
    status = (
        F.when(F.col("candidate_rows") > 1, F.lit("CATALOG_DUPLICATE"))
        .when(F.col("candidate_rows").isNull(), F.lit("CATALOG_MISSING"))
        .otherwise(F.lit("ENRICHED"))
    )
    joined = lines.join(right, on=list(on), how="left")
    return joined.withColumn("enrichment_status", status).select(
        *lines.columns, *attributes, "enrichment_status"
    )
