"""The run ledger: one event per status change, the latest event is the state."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.merge import latest_per_key
from feedloom.operators.reconcile import errors_per_run
from feedloom.sources.files import delete, has_children, list_files

# Fixed values ---------------------------------------------------------------
STARTED, RUNNING, SUCCESS, FAILED = "STARTED", "RUNNING", "SUCCESS", "FAILED"
UNFINISHED = (STARTED, RUNNING)
SOURCE_LENGTH = 1000
UNKNOWN_RUN = "No ingestion_execution row found for this run"
ENDED_WITH = "Ingestion ended with status "
REJECTED = " record(s) were rejected"
# ----------------------------------------------------------------------------

SCHEMA = (
    "execution_id string, source_file string, status string, expected_record_count bigint, "
    "actual_loaded_record_count bigint, started_at timestamp, completed_at timestamp, failure_reason string, "
    "sequence bigint"
)


def current_runs(events: DataFrame) -> DataFrame:
    """State of every run: how it first ended, else its latest event.

    An end stands: events that come later, whatever their clock says, do not
    change it.
    """
    ended = ~F.col("status").isin(*UNFINISHED)
    earliest_end = F.when(ended, -F.col("sequence")).otherwise(F.col("sequence"))
    return latest_per_key(events, "execution_id", [ended.cast("int"), earliest_end])


def fail_unfinished(current: DataFrame, requests: DataFrame) -> DataFrame:
    """Events that turn unfinished runs FAILED; finished ones are left alone.

    ``requests`` holds ``execution_id``, ``failure_reason``, ``completed_at`` and ``sequence``.
    """
    kept = ["execution_id", "source_file", "expected_record_count", "actual_loaded_record_count", "started_at"]
    open_runs = current.where(F.col("status").isin(*UNFINISHED)).select(*kept)
    changed = open_runs.join(requests, "execution_id").withColumn("status", F.lit(FAILED))
    return changed.select(*[c for c in current.columns])


def run_status(events: DataFrame, errors: DataFrame) -> DataFrame:
    """Every run's state with its number of rejected records."""
    return errors_per_run(current_runs(events), errors)


def run_gate(status: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """What follows from a run's end: ``verdict`` PASS, WARN or FAIL, and why.

    Requested runs the ledger does not know fail.
    """
    if requested is not None:
        status = requested.join(status, "execution_id", "left")
    count = F.coalesce(F.col("error_count"), F.lit(0))
    known = F.col("status").isNotNull()
    done = known & (F.col("status") == SUCCESS)
    reason = (
        F.when(~known, F.lit(UNKNOWN_RUN))
        .when(~done, F.concat(F.lit(ENDED_WITH), F.col("status"), F.lit(": "),
                              F.coalesce("failure_reason", F.lit("None"))))
        .when(count > 0, F.concat(count.cast("string"), F.lit(REJECTED)))
    )
    return status.select(
        "execution_id",
        F.when(~done, F.lit("FAIL")).when(count > 0, F.lit("WARN")).otherwise(F.lit("PASS")).alias("verdict"),
        reason.alias("reason"),
        F.when(done, F.col("expected_record_count")).alias("expected"),
        F.when(done, F.col("actual_loaded_record_count")).alias("loaded"),
        F.when(done, count).alias("error_records"),
    )


#: Files of a ledger above which the end of a run compacts it.
FILES = 64


class Ledger:
    """The ledger as a folder of appended events; old ones are compacted into one event a run."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def events(self) -> DataFrame:
        if not has_children(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def current(self) -> DataFrame:
        return current_runs(self.events())

    def save(
        self,
        execution_id: str,
        source_file: str,
        status: str | Sequence[str],
        started_at: datetime,
        expected: int | None = None,
        actual: int | None = None,
        reason: str | None = None,
    ) -> None:
        """Append the run's new state, or several in turn at once.

        Refuses what the ledger's table does: an unknown status, a source of
        more than 1000 characters.
        """
        states = [status] if isinstance(status, str) else list(status)
        if unknown := set(states) - {STARTED, RUNNING, SUCCESS, FAILED}:
            raise ValueError(f"unknown status: {', '.join(sorted(unknown))}")
        if len(source_file) > SOURCE_LENGTH:
            raise ValueError(f"source_file must not exceed {SOURCE_LENGTH} characters")
        now, at = datetime.now(timezone.utc), time.time_ns()
        rows = [
            (execution_id, source_file, state, expected, actual, started_at, None if state in UNFINISHED else now, reason, at + i)
            for i, state in enumerate(states)
        ]
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

        if set(states) - set(UNFINISHED):
            self.compact(above=FILES)

    def compact(self, above: int = 1) -> None:
        """Put the events of all files into one event a run, where there are more than ``above`` files.

        Only files that are there at the beginning are read, and deleted once
        the compacted events are written; events appended meanwhile stay. An
        event that is read twice, because this stops in between or two compact
        at once, changes no run's state.
        """
        files = [row["path"] for row in list_files(self.spark, f"{self.path}/part-*").collect()]
        if len(files) <= above:
            return
        states = current_runs(self.spark.read.schema(SCHEMA).parquet(*files))
        states.hint("rebalance").write.mode("append").parquet(self.path)
        for file in files:
            delete(self.spark, file)

    def fail_if_unfinished(self, execution_id: str, reason: str) -> None:
        """FAILED, unless the run already ended."""
        request = self.spark.createDataFrame(
            [(execution_id, reason, datetime.now(timezone.utc), time.time_ns())],
            "execution_id string, failure_reason string, completed_at timestamp, sequence bigint",
        )
        known = self.events().where(F.col("execution_id") == execution_id)
        fail_unfinished(current_runs(known), request).coalesce(1).write.mode("append").parquet(self.path)
