"""Batch files as they arrive: every new file in a folder becomes one load run.

Spark's file stream remembers in its checkpoint which files it has handed out.
A batch that is handed out again after a failure changes nothing, since an
upsert of the same rows is ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.plans.incremental_orders import load_batch
from ledgerloom.sources.contracts import ORDER_LINES, TableContract
from ledgerloom.sources.csv import na_to_null
from ledgerloom.sources.run_log import RunLog
from ledgerloom.sources.snapshots import Snapshots


def take_in(
    store: Snapshots,
    log: RunLog,
    folder: str,
    checkpoint: str,
    contract: TableContract = ORDER_LINES,
    files_per_run: int = 1,
) -> None:
    """Load all files of ``folder`` not loaded yet, oldest first, then return.

    ``files_per_run`` files make up one run; with more than one, their rows are one
    batch, in which the newest version of a key stands for it.
    A file that breaks a rule stops the intake with its error; it is logged as
    a failed run and handed out again next time.
    """
    text = T.StructType([T.StructField(c, T.StringType()) for c in contract.columns])
    files = (
        store.spark.readStream.schema(text)
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_run)
        .csv(folder)
    )

    def load(batch: DataFrame, _: int) -> None:
        load_batch(store, log, lambda: na_to_null(batch), contract)

    writer = files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
