"""Incremental load of order lines: stage, check, upsert, publish, log the run."""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.incremental import (
    IGNORE,
    INSERT,
    UPDATE,
    apply_changes,
    change_report,
    classify_changes,
    effective_changes,
)
from ledgerloom.operators.joins import with_partner
from ledgerloom.operators.keys import require_unique
from ledgerloom.operators.quality import RuleViolation, require_columns, require_no_violations
from ledgerloom.sources.contracts import ORDER_LINES, TableContract
from ledgerloom.sources.csv import read_csv
from ledgerloom.sources.part_checks import standing_violations, write_checks
from ledgerloom.sources.part_index import parts_of_keys, write_index
from ledgerloom.sources.run_log import RunLog
from ledgerloom.sources.snapshots import Snapshots

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadResult:
    run_id: str
    staged_rows: int
    inserted_rows: int
    updated_rows: int
    ignored_rows: int

    @property
    def affected_rows(self) -> int:
        return self.inserted_rows + self.updated_rows


def core_orders(
    store: Snapshots, contract: TableContract = ORDER_LINES, parts: Collection[str] | None = None
) -> DataFrame:
    """The core, or some months of it, in buckets of its key."""
    return store.read_bucketed("core", contract.schema, contract.key, contract.buckets, parts)


def core_near(store: Snapshots, batch: DataFrame, contract: TableContract = ORDER_LINES) -> DataFrame:
    """The months of the core that may hold a key of the batch, by their index; no other month is read."""
    parts = parts_of_keys(store, "core", contract.schema, batch, contract.key)
    return core_orders(store, contract, parts)


def check_core(store: Snapshots, contract: TableContract = ORDER_LINES) -> None:
    """The standing checks: keys unique, required columns filled, values in range.

    They are added up from what the loads have stored of each month; the core is not read.
    """
    kept = standing_violations(store, "core", contract)
    if kept is None:  # a month was not written by a load
        contract.require_table(core_orders(store, contract))
    else:
        require_no_violations(kept, contract.name)


def _month(date: str = "order_date") -> Column:
    return F.date_format(date, "yyyy-MM")


def _write_core(store: Snapshots, changes: DataFrame, contract: TableContract) -> dict:
    """Write the months of the core that the changes touch; folders to publish.

    These are the months of the new rows, and those of the rows they replace,
    since a newer version may carry another date; ``core_order_date`` is the old one.
    """
    months = changes.select(_month().alias("month")).union(changes.select(_month("core_order_date")))
    touched = [r["month"] for r in months.dropna().distinct().collect()]
    core = core_orders(store, contract, touched)
    held = bool(touched) and not set(touched).isdisjoint(n.removeprefix("core/") for n in store.parts("core"))
    # Joined with buckets, the rows come in tasks by bucket.
    rows = apply_changes(core, changes, contract.key) if held else changes.select(*contract.columns)
    written = store.write_parts("core", rows, _month(), contract.key, contract.buckets, clustered=held)
    layers = ("core", "core_index", "core_checks", "core_shared")
    gone = {f"{layer}/{month}": None for month in touched for layer in layers}
    if not written:
        return gone
    fresh = store.spark.read.schema(contract.schema).parquet(*[f"{store.root}/{f}" for f in written.values()])
    index = write_index(store, "core", fresh, _month(), contract.key)

    def after(layer: str, made: dict) -> dict:
        return {**{n: f for n, f in store.parts(layer).items() if n not in gone}, **made}

    checks = write_checks(store, "core", contract, fresh, _month(), after("core", written), after("core_index", index))
    return {**gone, **written, **index, **checks}


def load_initial(store: Snapshots, raw: DataFrame, contract: TableContract = ORDER_LINES) -> int:
    """Append a whole batch to the core; a rule or a known key rejects it."""
    base = store.version
    batch = contract.require_batch(contract.typed(raw))
    require_unique(batch, contract.key, "initial batch")
    known = with_partner(core_near(store, batch, contract), batch, contract.key).count()
    if known:
        raise RuleViolation(contract.name, {"key_unique": known})
    changes = batch.withColumns(
        {"action": F.lit(INSERT), "core_order_date": F.lit(None).cast("date")}
    )
    return store.publish(_write_core(store, changes, contract), base)


def load_batch(
    store: Snapshots,
    log: RunLog,
    read: Callable[[], DataFrame],
    contract: TableContract = ORDER_LINES,
    version: str = "updated_at",
    dedup: bool = True,
) -> LoadResult:
    """Load the batch that ``read`` returns as one run.

    Staging and core become current together. On any failure the run is logged as
    FAILED, nothing is published and the error goes on, also when it cannot be
    logged; loading the same batch again then starts from scratch. A writer that
    was overtaken by another one fails like this too. If only the success entry
    cannot be written the data stays published, the run stays RUNNING in the log,
    and that error goes on.
    """
    run_id = log.start()
    try:
        base = store.version
        result, folders = _stage_and_merge(store, read(), contract, version, dedup, run_id)
        store.publish(folders, base)
    except Exception as error:
        try:
            log.fail(run_id, str(error))
        except Exception:
            logger.exception("the failed run could not be logged")
        raise
    try:
        log.succeed(run_id, result.staged_rows, result.affected_rows)
    except Exception:
        logger.exception("data was published, but the run log could not be updated")
        raise
    return result


def _stage_and_merge(store, raw, contract, version, dedup, run_id):
    require_columns(raw, contract.columns)
    # Staged with the raw text beside the typed values: the batch is read once.
    staging, staged = store.write("staging", contract.typed(raw))
    batch = contract.require_batch(staged)
    # Equal versions of a key in one batch are told apart by their other columns.
    ties = [c for c in contract.columns if c not in (*contract.key, version)]
    core = core_near(store, batch, contract)
    classified = classify_changes(
        core, batch, contract.key, version, ties, dedup, carry=["order_date"]
    )
    # Written, since the counts, the months and the new core are made from it.
    _, classified = store.write("changes", classified)
    counts = {r["action"]: r["row_count"] for r in change_report(classified).collect()}
    folders = _write_core(store, effective_changes(classified), contract)
    result = LoadResult(
        run_id,
        staged.count(),
        counts.get(INSERT, 0),
        counts.get(UPDATE, 0),
        counts.get(IGNORE, 0),
    )
    return result, {"staging": staging, **folders}


def run(store: Snapshots, log: RunLog, path: str) -> LoadResult:
    return load_batch(store, log, lambda: read_csv(store.spark, path, on_empty="warn"))
