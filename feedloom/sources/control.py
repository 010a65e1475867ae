"""Control files: the record count a feed is expected to have."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.text import is_blank, quoted, to_long, trimmed
from feedloom.sources.files import is_file, plain_path
from feedloom.sources.lines import as_paths

# Fixed values ---------------------------------------------------------------
RECORD_COUNT = "record_count"
BLANK = "Control file location must not be blank"
UNREADABLE = "Control file does not exist or cannot be read"
MISSING = f"Control file is missing required property: {RECORD_COUNT}"
NOT_WHOLE = f"{RECORD_COUNT} must be a whole number but was: "
NEGATIVE = f"{RECORD_COUNT} must not be negative: "
# ----------------------------------------------------------------------------

#: ``name=value``, ``name: value`` or ``name value`` on a line of its own; comment lines start otherwise.
_PROPERTY = r"(?m)^[ \t\f]*" + RECORD_COUNT + r"(?:[ \t\f]*[=:][ \t\f]*|[ \t\f]+)([^\r\n]*)"


def with_count(df: DataFrame, content: str) -> DataFrame:
    """Add ``expected`` and ``problem`` of the control text in SQL ``content``; the last mention counts."""
    found = f"regexp_extract_all({content}, {quoted(_PROPERTY)}, 1)"
    df = df.withColumn("__value", F.expr(f"get({found}, size({found}) - 1)"))
    df = df.withColumn("__number", F.expr(to_long(trimmed("__value"))))
    problem = (
        f"CASE WHEN {content} IS NULL THEN '{UNREADABLE}' WHEN {is_blank('__value')} THEN '{MISSING}'"
        f" WHEN __number IS NULL THEN concat('{NOT_WHOLE}', __value)"
        f" WHEN __number < 0 THEN concat('{NEGATIVE}', __number) END"
    )
    df = df.withColumn("problem", F.expr(problem))
    return df.withColumn("expected", F.expr("if(problem IS NULL, __number, NULL)")).drop("__value", "__number")


def read_control_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All control files at once: ``control_file``, ``expected`` and ``problem``."""
    read = spark.read.text(as_paths(paths), wholetext=True)
    read = read.select(plain_path(F.col("_metadata.file_path")).alias("control_file"), "value")
    return with_count(read, "value").select("control_file", "expected", "problem")


def expected_count(spark: SparkSession, path: str | None) -> int:
    """The count of one control file, or an error that says what is wrong with it."""
    if path is None or not path.strip():
        raise ValueError(BLANK)
    if not is_file(spark, path):
        raise ValueError(f"{UNREADABLE}: {path}")
    row = read_control_files(spark, path).first()
    if row is None:  # an empty file
        raise ValueError(MISSING)
    if row["problem"] is not None:
        raise ValueError(row["problem"])
    return row["expected"]
