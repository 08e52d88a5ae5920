"""The run log: an append-only table of run events, and the state of each run."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.versions import latest_version
from ledgerloom.sources.contracts import TableContract

RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"

_EVENTS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("event_number", T.IntegerType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("finished_at", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("staged_rows", T.LongType()),
        T.StructField("affected_rows", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)

# What the events promise; a run is closed by its second event.
RUN_EVENTS = TableContract(
    name="run log",
    schema=_EVENTS,
    key=("run_id", "event_number"),
    required=("run_id", "event_number", "started_at", "status"),
    checks={
        "status_known": f"status IN ('{RUNNING}', '{SUCCESS}', '{FAILED}')",
        "finished_if_closed": f"(status = '{RUNNING}') = (finished_at IS NULL)",
        "rows_not_negative": "staged_rows >= 0 AND affected_rows >= 0",
    },
    max_lengths={"status": 20},
)


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def run_state(
    events: DataFrame,
    key: str = "run_id",
    version: str = "event_number",
    ties: Sequence[str] = ("finished_at", "status"),
) -> DataFrame:
    """The newest event of each run, which is the run's current state."""
    return latest_version(events, [key], version, ties)


class RunLog:
    """Events are only ever appended, apart from the data they report on.

    A run's start is in its first event, so any log object can close a run.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _append(self, *event) -> None:
        frame = self.spark.createDataFrame([event], _EVENTS).coalesce(1)
        frame.write.mode("append").parquet(self.path)

    def _close(self, run_id: str, status: str, staged=None, affected=None, error=None) -> None:
        first = self.events().filter((F.col("run_id") == run_id) & (F.col("event_number") == 1)).first()
        if first is None:
            raise ValueError(f"run {run_id} was never started")
        self._append(run_id, 2, first["started_at"], _now(), status, staged, affected, error)

    def start(self) -> str:
        run_id = str(uuid4())
        self._append(run_id, 1, _now(), None, RUNNING, None, None, None)
        return run_id

    def succeed(self, run_id: str, staged_rows: int, affected_rows: int) -> None:
        self._close(run_id, SUCCESS, staged_rows, affected_rows)

    def fail(self, run_id: str, error_message: str) -> None:
        self._close(run_id, FAILED, error=error_message)

    def compact(self) -> None:
        """Rewrite the events as few files, for a time without open runs' writers.

        The old files go only after the new ones are in place; should that be cut
        short, events are there twice, which no state depends on.
        """
        old = self.events().inputFiles()
        self.events().distinct().coalesce(1).write.mode("append").parquet(self.path)
        jvm = self.spark._jvm
        for file in old:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, False)

    def events(self) -> DataFrame:
        try:
            return self.spark.read.schema(_EVENTS).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _EVENTS)

    def check(self) -> None:
        """Raise if an event breaks the contract of the log."""
        RUN_EVENTS.require_table(self.events())

    def state(self) -> DataFrame:
        return run_state(self.events()).drop("event_number")
