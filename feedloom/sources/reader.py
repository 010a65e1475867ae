"""Reading a described feed in either format."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.convert import convert_csv, convert_json
from feedloom.schema import EXTENSIONS, Feed
from feedloom.sources.csv_feed import read_csv
from feedloom.sources.json_feed import read_json

# Fixed values ---------------------------------------------------------------
TYPE_REQUIRED = "fileType is required"
UNSUPPORTED_TYPE = "Unsupported fileType '{}'. Supported values: CSV, JSON"
# ----------------------------------------------------------------------------


def file_type(name: str | None) -> str:
    """``CSV`` or ``JSON`` from a name in any case."""
    wanted = (name or "").strip().upper()
    if not wanted:
        raise ValueError(TYPE_REQUIRED)
    if wanted not in EXTENSIONS:
        raise ValueError(UNSUPPORTED_TYPE.format(name))
    return wanted


def read_feed(
    spark: SparkSession,
    paths: str | Sequence[str],
    feed: Feed,
    kind: str,
    read_at: datetime | None = None,
    multi_line: bool | None = None,
    on_broken: str = "fail",
) -> DataFrame:
    """All records of the feed's files, typed.

    Result: ``record_number``, ``source_file``, ``source_creation_time`` (one
    instant for the run's files), ``parse_error`` and the feed's columns.
    """
    at = F.lit(read_at or datetime.now(timezone.utc)).cast("timestamp")
    if file_type(kind) == "CSV":
        raw = read_csv(spark, paths, feed.csv_columns, multi_line).withColumn("source_creation_time", at)
        return convert_csv(raw, feed)
    raw = read_json(spark, paths, feed.fields, on_broken).withColumn("source_creation_time", at)
    return convert_json(raw, feed)
