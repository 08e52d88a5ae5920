"""Order lines against a versioned catalogue: check, resolve, enrich, summarize."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.dates import iso_date, iso_timestamp
from ledgerloom.operators.joins import enrich_with_status
from ledgerloom.operators.keys import require_unique
from ledgerloom.operators.quality import (
    ReconciliationError,
    compare_totals,
    error_codes,
    first_failure,
    order_time_rules,
    reconcile_split,
    require_split_reconciled,
    require_totals_equal,
    split_on_errors,
)
from ledgerloom.operators.versions import resolve_versions
from ledgerloom.sources.snapshots import Snapshots

LINE_KEY = ["order_id", "line_id"]
CATALOGUE_KEY = ["market", "product_id"]
ATTRIBUTES = ["product_name", "category"]
_TIMES = ("order_date_raw", "order_date", "updated_at_raw", "updated_at")


def parse_times(lines: DataFrame) -> DataFrame:
    return lines.withColumns(
        {
            "order_date": iso_date(F.col("order_date_raw")),
            "updated_at": iso_timestamp(F.col("updated_at_raw")),
        }
    )


def with_status(lines: DataFrame) -> DataFrame:
    """Add the parsed times and the first thing wrong with them."""
    rules = order_time_rules(*_TIMES, single=True)
    return parse_times(lines).withColumn("validation_status", first_failure(rules))


def with_errors(lines: DataFrame) -> DataFrame:
    """Add the parsed times and everything wrong with them."""
    return parse_times(lines).withColumn("validation_errors", error_codes(order_time_rules(*_TIMES)))


def resolve_catalogue(history: DataFrame) -> DataFrame:
    """One row per (market, product): newest version and its candidates."""
    parsed = history.withColumn("updated_at", iso_timestamp(F.col("updated_at_raw")))
    return resolve_versions(parsed, CATALOGUE_KEY, "updated_at")


def classify(valid: DataFrame, resolved: DataFrame) -> DataFrame:
    return enrich_with_status(valid, resolved, CATALOGUE_KEY, ATTRIBUTES)


def market_summary(valid: DataFrame, resolved: DataFrame) -> DataFrame:
    """Lines, amount and quantity per market and enrichment status.

    Lines are totalled per catalogue key before the join: the status depends on
    that key alone, so a hot product reaches the join as a single row.
    """
    per_key = valid.groupBy(*CATALOGUE_KEY).agg(
        F.count("*").alias("_rows"),
        F.sum("line_amount").alias("_amount"),
        F.sum("quantity").alias("_quantity"),
    )
    return (
        enrich_with_status(per_key, resolved, CATALOGUE_KEY, [])
        .groupBy("market", "enrichment_status")
        .agg(
            F.sum("_rows").alias("row_count"),
            F.sum("_amount").alias("total_amount"),
            F.sum("_quantity").alias("total_quantity"),
        )
    )


def market_summary_schema(amount: str = "bigint") -> T.StructType:
    """Columns of a written summary; sums of amounts are of this type."""
    return T.StructType.fromDDL(
        "market string, enrichment_status string, row_count bigint, "
        f"total_amount {amount}, total_quantity bigint"
    )


def compare_summary(valid: DataFrame, summary: DataFrame) -> DataFrame:
    """Totals of the valid lines beside totals of the summary."""
    c = F.col
    return compare_totals(
        valid,
        {"rows": F.lit(1), "amount": c("line_amount"), "quantity": c("quantity")},
        summary,
        {"rows": c("row_count"), "amount": c("total_amount"), "quantity": c("total_quantity")},
    )


def missing_lines(valid: DataFrame, classified: DataFrame) -> DataFrame:
    """Valid lines that enrichment lost."""
    return valid.join(classified.select(*LINE_KEY), on=LINE_KEY, how="left_anti").select(
        *valid.columns
    )


@dataclass(frozen=True)
class OrderQuality:
    checked: DataFrame
    valid: DataFrame
    quarantine: DataFrame
    catalogue: DataFrame
    classified: DataFrame
    summary: DataFrame


def order_quality(lines: DataFrame, history: DataFrame) -> OrderQuality:
    """All results of the job; nothing runs until one of them is used."""
    checked = with_errors(lines)
    valid, quarantine = split_on_errors(checked, "validation_errors")
    catalogue = resolve_catalogue(history)
    return OrderQuality(
        checked,
        valid,
        quarantine,
        catalogue,
        classify(valid, catalogue),
        market_summary(valid, catalogue),
    )


def check(result: OrderQuality) -> dict:
    """Raise if rows or amounts got lost or multiplied; returns the totals."""
    is_valid = F.size("validation_errors") == 0
    totals = require_split_reconciled(
        reconcile_split(result.checked, is_valid, ["line_amount"])
    )
    require_totals_equal(compare_summary(result.valid, result.summary))
    require_unique(result.classified, LINE_KEY, "classified lines")
    lost = missing_lines(result.valid, result.classified)
    if not lost.isEmpty():
        raise ReconciliationError("enrichment lost valid lines")
    return totals


def run(store: Snapshots, lines: DataFrame, history: DataFrame) -> dict:
    """Write all results once, check what was written, then publish them together.

    Each result is made from written tables, so the sources are read once. A failed
    check raises and leaves what was published before. Returns the checked totals.
    """
    base = store.version
    folders, tables = {}, {}

    def write(name: str, df: DataFrame) -> DataFrame:
        folders[name], tables[name] = store.write(name, df)
        return tables[name]

    checked = write("checked_lines", with_errors(lines))
    valid, quarantine = split_on_errors(checked, "validation_errors")
    valid, quarantine = write("valid_lines", valid), write("quarantined_lines", quarantine)
    catalogue = write("catalogue", resolve_catalogue(history))
    classified = write("classified_lines", classify(valid, catalogue))
    summary = write("market_summary", market_summary(valid, catalogue))
    totals = check(OrderQuality(checked, valid, quarantine, catalogue, classified, summary))
    if (valid.count(), quarantine.count()) != (totals["valid_rows"], totals["quarantine_rows"]):
        raise ReconciliationError("written valid or quarantined lines differ from the checked ones")
    store.publish(folders, base)
    return totals
