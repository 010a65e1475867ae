"""The feed load as one job: read, check, protect, merge, report, reconcile, record."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.protect import check_key
from feedloom.functions.records import mismatch_text, redacted_record
from feedloom.functions.text import UUID_PATTERN
from feedloom.operators import route
from feedloom.operators.ledger import FAILED, RUNNING, STARTED, SUCCESS, Ledger, run_status
from feedloom.operators.merge import TargetTable
from feedloom.operators.prepare import add_metadata, encrypt_sensitive, fill_missing, target_columns
from feedloom.operators.reconcile import compare_counts, counters
from feedloom.schema import BOOLEAN, DATE, LONG, Feed
from feedloom.session import configure, new_path
from feedloom.sources.control import expected_count
from feedloom.sources.files import delete, has_children, plain_path, source_problem
from feedloom.sources.reader import file_type, read_feed

RUN_PREFIX = "ingestion_"
ERROR_SCHEMA = (
    "id string, source_file string, record_number bigint, error_type string, error_message string, "
    "raw_record string, created_at timestamp, execution_id string"
)
FILE_SCHEMA = (
    "source_file string, expected bigint, actual bigint, matched boolean, parse_errors bigint, validation_errors bigint, "
    "load_errors bigint, problem string, execution_id string"
)


class RecordCountMismatch(RuntimeError):
    """The loaded rows are not as many as the control file says. They stay loaded."""


@dataclass(frozen=True)
class Warehouse:
    """Where a feed's tables live."""

    root: str

    @property
    def table(self) -> str:
        return f"{self.root}/target"

    @property
    def errors(self) -> str:
        return f"{self.root}/errors"

    @property
    def files(self) -> str:
        return f"{self.root}/files"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"

    def report(self, execution_id: str) -> str:
        return f"{self.root}/reports/execution-{execution_id}"


def new_execution_id() -> str:
    return str(uuid.uuid4())


def run_name(execution_id: str) -> str:
    """Name a scheduler shows for the run."""
    return RUN_PREFIX + execution_id


def target_schema(feed: Feed) -> str:
    """Columns of the target table."""
    columns = []
    for f in feed.fields:
        if f.sensitive:
            columns.append(f"{f.name}_encrypted string")
        else:
            kind = {DATE: "date", BOOLEAN: "boolean", LONG: "bigint"}.get(f.kind, "string")
            columns.append(f"{f.name} {kind}")
    return ", ".join(
        columns + ["ingestion_timestamp timestamp", "execution_id string", "source_creation_time timestamp"]
    )


def outcomes(
    records: DataFrame, feed: Feed, execution_id: str, key: str, observation: Observation | None = None, numbered: bool = False
) -> DataFrame:
    """Every record's fate in one narrow pass: its stored form, or why it failed.

    No shuffle: rules, constraints, filling and encryption are all row-local.
    ``observation`` receives the run's counters when the rows are written.
    """
    passed = "error_type IS NULL"
    checked = route.validate(records, feed)
    ready = route.check_constraints(fill_missing(checked, feed, only_if=passed), feed)
    ready = ready.withColumn("raw_record", F.expr(f"if({passed}, NULL, {redacted_record(feed)})"))
    sealed = encrypt_sensitive(add_metadata(ready, execution_id), feed, key, only_if=passed, numbered=numbered)
    sealed = sealed if observation is None else sealed.observe(observation, *counters())
    return sealed.selectExpr(
        *target_columns(feed),
        "ingestion_timestamp",
        "execution_id",
        "source_creation_time",
        "record_number",
        "source_file",
        "error_type",
        "error_message",
        "raw_record",
    )


def root_message(error: BaseException) -> str:
    """Message of the innermost cause."""
    while error.__cause__ is not None:
        error = error.__cause__
    return str(error).split("\n", 1)[0] or type(error).__name__


def ingest(
    spark: SparkSession,
    feed: Feed,
    source: str,
    kind: str,
    control_file: str,
    warehouse: Warehouse,
    key: str,
    execution_id: str | None = None,
    single_report: bool = False,
    multi_line: bool | None = None,
    on_broken: str = "fail",
    manifest: DataFrame | None = None,
    numbered: bool = False,
) -> dict[str, int | str]:
    """Load a feed; returns the run's counters.

    ``manifest`` (``source_file``, ``expected``) sets a count for each file, by
    its full path; every file's counts are stored in the run's table of files
    (``files``), and a file that differs, is not named or is not there fails the
    run like the control file does. ``numbered`` encrypts in the form that is
    safe for any number of records.

    The control file and the source are checked first; a run that they stop is
    stored as FAILED. Good rows are merged into the target, bad ones reported,
    and the loaded count is compared with the control file. A mismatch stores FAILED, then
    raises; what was loaded stays.
    """
    check_key(key)
    configure(spark)
    run = execution_id or new_execution_id()
    if not re.match(UUID_PATTERN.replace(r"\z", r"\Z"), run):
        raise ValueError(f"execution id is not a UUID: {run}")
    started = datetime.now(timezone.utc)
    ledger = Ledger(spark, warehouse.runs)
    try:
        wanted = file_type(kind)
        expected = expected_count(spark, control_file)
        problem = source_problem(spark, source, wanted)
        if problem is not None:
            raise ValueError(problem)
    except Exception as error:
        ledger.save(run, source, FAILED, started, reason=root_message(error))
        raise
    ledger.save(run, source, (STARTED, RUNNING), started, expected)
    staged = new_path(spark, "outcomes")
    try:
        seen = Observation()
        records = read_feed(spark, source, feed, wanted, multi_line=multi_line, on_broken=on_broken)
        fates = outcomes(records, feed, run, key, seen, numbered)
        fates.write.parquet(staged)
        done, numbers = spark.read.schema(fates.schema).parquet(staged), seen.get

        failures = route.failure_rows(done, feed)
        route.write_error_table(failures, warehouse.errors, run)
        route.write_error_report(failures, feed.key, warehouse.report(run), single_report)

        table = TargetTable(spark, warehouse.table, target_schema(feed), feed.key)
        table.merge(route.good(done), ["source_file", "record_number"])

        actual = numbers["records_loaded"]
        reason = None if actual == expected else mismatch_text(expected, actual)
        if manifest is not None:
            reason = _file_counts(done, manifest, warehouse, run) or reason
        if reason is not None:
            ledger.save(run, source, FAILED, started, expected, actual, reason)
            raise RecordCountMismatch(reason)
        ledger.save(run, source, SUCCESS, started, expected, actual)
    except Exception as error:
        ledger.fail_if_unfinished(run, root_message(error))
        raise
    finally:
        delete(spark, staged)
    return {"execution_id": run, "expected": expected, **numbers}


def _file_counts(done: DataFrame, manifest: DataFrame, warehouse: Warehouse, run: str) -> str | None:
    """Store the counts of every file of the run; what is wrong with the first one that differs.

    The counts come from two columns of the staged records; the feed isn't read again.
    """
    by_file = done.groupBy(plain_path(F.col("source_file")).alias("source_file")).agg(*counters())
    named = manifest.select(plain_path(F.col("source_file")).alias("source_file"), F.col("expected").cast("bigint").alias("expected"))
    named = named.groupBy("source_file").agg(F.sum("expected").alias("expected"))
    joined = named.join(by_file, "source_file", "full").withColumn("actual", F.coalesce("records_loaded", F.lit(0)))
    checked = compare_counts(joined.fillna(0, [c for c in by_file.columns if c != "source_file"]))
    checked = checked.withColumn("matched", F.coalesce("matched", F.lit(False)))
    problem = F.when(F.col("expected").isNull(), F.lit("not named in the manifest")).otherwise(F.col("failure_message"))
    checked = checked.select(
        "source_file", "expected", "actual", "matched", "parse_errors", "validation_errors", "load_errors",
        F.when(~F.col("matched"), problem).alias("problem"), F.lit(run).alias("execution_id"),
    )
    writer = checked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("execution_id").parquet(warehouse.files)
    first = files(done.sparkSession, warehouse).where((F.col("execution_id") == run) & ~F.col("matched")).orderBy("source_file").first()
    return None if first is None else f"{first['source_file']}: {first['problem']}"


def files(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """The table of files: expected and loaded records and rejects of every file of the runs that had a manifest."""
    if not has_children(spark, warehouse.files):
        return spark.createDataFrame([], FILE_SCHEMA)
    return spark.read.schema(FILE_SCHEMA).parquet(warehouse.files)


def errors(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """The error table."""
    if not has_children(spark, warehouse.errors):
        return spark.createDataFrame([], ERROR_SCHEMA)
    return spark.read.schema(ERROR_SCHEMA).parquet(warehouse.errors)


def status(spark: SparkSession, warehouse: Warehouse, execution_id: str | None = None) -> DataFrame:
    """State of one run or of all."""
    events, failures = Ledger(spark, warehouse.runs).events(), errors(spark, warehouse)
    if execution_id is not None:
        events = events.where(F.col("execution_id") == execution_id)
        failures = failures.where(F.col("execution_id") == execution_id)
    return run_status(events, failures)
