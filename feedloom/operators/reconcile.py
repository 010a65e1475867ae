"""Counting: loaded rows against control files, and what happened per stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.records import mismatch_message
from feedloom.operators.route import LOAD_ERROR, PARSE_ERROR, VALIDATION_ERROR

NO_RECORDS = "Input file contains no records"


def loaded_count(loaded: DataFrame) -> DataFrame:
    """One row with the number of loaded rows, repeated keys included; 0 for none."""
    return loaded.agg(F.count("*").alias("actual"))


def compare_counts(counts: DataFrame) -> DataFrame:
    """Add ``matched``, ``status`` and ``failure_message`` to rows of ``expected`` and ``actual``."""
    return counts.selectExpr(
        "*",
        "expected = actual AS matched",
        "if(expected = actual, 'SUCCESS', 'FAILED') AS status",
        f"if(expected = actual, NULL, {mismatch_message('expected', 'actual')}) AS failure_message",
    )


def check_count(loaded: DataFrame, expected: int) -> DataFrame:
    """One run against its control count."""
    return compare_counts(
        loaded_count(loaded).select(F.lit(expected).cast("bigint").alias("expected"), "actual")
    )


def check_count_per(loaded: DataFrame, manifest: DataFrame, by: str) -> DataFrame:
    """Every file (or run) of a manifest ``(by, expected)``; one without loaded rows counts 0."""
    counts = loaded.groupBy(by).agg(F.count("*").alias("actual"))
    joined = manifest.join(counts, by, "left").select(
        by, F.col("expected").cast("bigint").alias("expected"), F.coalesce("actual", F.lit(0)).alias("actual")
    )
    return compare_counts(joined)


def counters() -> list[Column]:
    """Records parsed, refused at each stage and loaded, of rows with their ``error_type``."""
    kind = F.col("error_type")

    def number(condition: Column) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False)))

    return [
        number(kind.isNull() | (kind != PARSE_ERROR)).alias("records_parsed"),
        number(kind == PARSE_ERROR).alias("parse_errors"),
        number(kind == VALIDATION_ERROR).alias("validation_errors"),
        number(kind.isNull()).alias("records_loaded"),
        number(kind == LOAD_ERROR).alias("load_errors"),
    ]


def stage_counters(outcomes: DataFrame, by: str = "execution_id") -> DataFrame:
    """The counters of many runs from their written outcomes."""
    return outcomes.groupBy(by).agg(*counters())


def errors_per_run(runs: DataFrame, errors: DataFrame) -> DataFrame:
    """Runs with their number of rejected records."""
    counts = errors.groupBy("execution_id").agg(F.count("*").alias("error_count"))
    return runs.join(counts, "execution_id", "left").withColumn(
        "error_count", F.coalesce("error_count", F.lit(0).cast("bigint"))
    )


def require_records(df: DataFrame) -> int:
    """Number of records; an input without any is an error."""
    n = df.count()
    if n == 0:
        raise ValueError(NO_RECORDS)
    return n
