"""Sorting records into good and failed ones, and reporting the failed."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from feedloom.functions.records import error_line, redacted_record
from feedloom.functions.rules import error_text, first_error
from feedloom.functions.text import name
from feedloom.schema import Feed
from feedloom.session import configure
from feedloom.sources.files import delete

# Fixed values ---------------------------------------------------------------
PARSE_ERROR = "PARSE_ERROR"
VALIDATION_ERROR = "VALIDATION_ERROR"
LOAD_ERROR = "LOAD_ERROR"
# ----------------------------------------------------------------------------


def validate(df: DataFrame, feed: Feed, observation: Observation | None = None) -> DataFrame:
    """Add ``error_type`` and ``error_message``: the parse error, or all broken rules; NULL if valid.

    The outcome is observed on the way: ``observation`` receives ``records``,
    ``parse_errors`` and ``validation_errors``. The observation also keeps a
    later filter on the outcome above the rules. Pushed below, Catalyst would
    put a copy of every rule into the filter and evaluate all rules twice.
    """
    configure(df.sparkSession)
    if "parse_error" not in df.columns:
        df = df.withColumn("parse_error", F.lit(None).cast("string"))
    # The joined text is a column of its own so that the rules run once per row.
    checked = df.withColumn("__broken", F.expr(error_text(feed.rules)))
    checked = checked.withColumns(
        {
            "error_message": F.expr("CASE WHEN parse_error IS NOT NULL THEN parse_error WHEN __broken <> '' THEN __broken END"),
            "error_type": F.expr(
                f"CASE WHEN parse_error IS NOT NULL THEN '{PARSE_ERROR}' WHEN __broken <> '' THEN '{VALIDATION_ERROR}' END"
            ),
        }
    ).drop("parse_error", "__broken")
    return checked.observe(
        observation or f"validate-{uuid.uuid4().hex}",
        F.count("*").alias("records"),
        F.count_if(F.expr(f"error_type <=> '{PARSE_ERROR}'")).alias("parse_errors"),
        F.count_if(F.expr(f"error_type <=> '{VALIDATION_ERROR}'")).alias("validation_errors"),
    )


def check_constraints(df: DataFrame, feed: Feed) -> DataFrame:
    """Mark the still good rows that the target table would refuse."""
    refused = F.expr(f"if(error_type IS NULL, {first_error(feed.constraints)}, NULL)")
    return (
        df.withColumn("__refused", refused)
        .withColumns(
            {
                "error_type": F.expr(f"if(__refused IS NULL, error_type, '{LOAD_ERROR}')"),
                "error_message": F.coalesce("__refused", "error_message"),
            }
        )
        .drop("__refused")
    )


def good(df: DataFrame) -> DataFrame:
    return df.where(F.col("error_type").isNull())


def failed(df: DataFrame) -> DataFrame:
    return df.where(F.col("error_type").isNotNull())


def failure_rows(df: DataFrame, feed: Feed, execution_id: str | None = None) -> DataFrame:
    """One failure row per failed record, its values redacted; a parse error has no record."""
    if execution_id is not None:
        df = df.withColumn("execution_id", F.lit(execution_id))
    if "raw_record" not in df.columns:
        df = df.withColumn("raw_record", F.expr(redacted_record(feed)))
    return failed(df).selectExpr(
        "record_number",
        "source_file",
        "execution_id",
        "error_type",
        "error_message",
        f"if(error_type = '{PARSE_ERROR}', NULL, {name(feed.key)}) AS {name(feed.key)}",
        f"if(error_type = '{PARSE_ERROR}', NULL, raw_record) AS raw_record",
    )


def combine(*failures: DataFrame) -> DataFrame:
    """All failures as one bag, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), failures)


def report_lines(failures: DataFrame, key: str) -> DataFrame:
    """The text report: one line per failure."""
    return failures.selectExpr(f"{error_line(key)} AS line")


def write_error_table(failures: DataFrame, path: str, execution_id: str | None = None) -> None:
    """Write the failures to the error table, one partition per run; a run that is written again replaces its rows.

    An id follows from the run, the file, the record and the error, so a
    repeated run leaves the same rows. A run of ``execution_id`` without
    failures loses the rows it had.
    """
    if execution_id is not None and failures.isEmpty():
        delete(failures.sparkSession, f"{path}/execution_id={execution_id}")
        return
    digest = F.md5(F.to_json(F.struct("execution_id", "source_file", "record_number", "error_type", "error_message")))
    failures.select(
        F.regexp_replace(digest, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5").alias("id"),
        "execution_id",
        "source_file",
        "record_number",
        "error_type",
        "error_message",
        "raw_record",
        F.current_timestamp().alias("created_at"),
    ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("execution_id").parquet(path)


def write_error_report(failures: DataFrame, key: str, path: str, single_file: bool = False) -> None:
    """Write the text report, in parts or, if the caller wants one file, by one task."""
    lines = report_lines(failures, key)
    if single_file:
        lines = lines.coalesce(1)
    lines.write.mode("overwrite").text(path)
