"""Rewriting a feed into files of equal size."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.operators.reconcile import NO_RECORDS, require_records
from feedloom.session import stage
from feedloom.sources.csv_feed import header_names, open_csv, scanned
from feedloom.sources.json_feed import RAW, read_json_elements
from feedloom.sources.lines import FILE, if_small
from feedloom.sources.reader import file_type


def file_count(records: int, per_file: int) -> int:
    """Files needed for ``records`` at ``per_file`` each: at least one."""
    if per_file <= 0:
        raise ValueError("records per file must be greater than zero")
    return max(1, math.ceil(records / per_file))


#: Tasks that write files at most; each writes a run of whole files.
PARTITIONS = 4096
_NUMBER = "__number"


def numbered_writer(df: DataFrame, records: int, per_file: int, number: str = _NUMBER) -> tuple[DataFrameWriter, int]:
    """A writer of rows as files of exactly ``per_file`` records in order of ``number`` (1, 2, 3...), the last one smaller.

    A record's file follows from its number. Each task gets a run of files, from
    the first record of one to the last of another, sorts its records and begins
    a new file every ``per_file`` of them. The names of the files ascend with
    the records. Returns the writer and the number of files.
    """
    files = file_count(records, per_file)
    tasks = min(files, PARTITIONS)
    task = F.expr(f"cast((({number} - 1) DIV {per_file}) * {tasks} DIV {files} AS int)")
    ordered = df.repartitionById(tasks, task).sortWithinPartitions(number).drop(number)
    return ordered.write.mode("overwrite").option("maxRecordsPerFile", per_file), files


def _over_files(df: DataFrame, sizes: DataFrame) -> DataFrame:
    """Number the records of all files, in order of the files' names, by their numbers within their files.

    ``sizes`` (file, records) has a row for each file.
    """
    earlier = F.sum("records").over(Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.select(FILE, F.coalesce(earlier, F.lit(0)).alias("__before"))
    joined = df.join(if_small(before), FILE)
    return joined.withColumn(_NUMBER, F.col("__before") + F.col("record_number")).drop("__before", "record_number", FILE)


def write_csv_parts(df: DataFrame, path: str, files: int) -> None:
    """Replace ``path`` by some ``files`` CSV files, each with a header; cells stay as they are, padded ones too."""
    _csv(df.repartition(files).write.mode("overwrite"), path)


def _csv(writer: DataFrameWriter, path: str) -> None:
    writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def split_feed(spark: SparkSession, source: str, kind: str, out: str, per_file: int = 10_000) -> int:
    """Rewrite a CSV or JSON feed as files of ``per_file`` records, the last one smaller; returns their number.

    The records stay in the feed's order: files by name, and records as they
    are in them. CSV keeps every column as text. JSON becomes one object per
    line, its text unchanged, whatever layout it had. A feed without records is
    an error, and so is a CSV row that does not fit its header.
    """
    if file_type(kind) == "JSON":
        broken = F.when(F.col(RAW).isNull(), F.raise_error(F.concat(F.lit("not valid JSON: "), F.col(FILE))))
        # A line break outside a string is only white space, and there is none inside one.
        line = F.coalesce(F.translate(RAW, "\r\n", "  "), broken.cast("string"))
        lines = stage(read_json_elements(spark, source).select(FILE, "record_number", line.alias("value")), "elements")
        sizes = stage(lines.groupBy(FILE).agg(F.count("*").alias("records")), "file-sizes")
        records = require_records(lines)
        writer, files = numbered_writer(_over_files(lines, sizes), records, per_file)
        writer.text(out)
        return files
    scan = open_csv(spark, source)
    if scan.records == 0:
        raise ValueError(NO_RECORDS)
    columns = header_names(scan)
    rows = scanned(scan, columns, clean=False)
    message = F.concat(F.lit("record "), F.col("record_number").cast("string"), F.lit(": "), F.col("parse_error"))
    fits = F.when(F.col("parse_error").isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    sizes = scan.index.groupBy(FILE).agg((F.sum("n") - 1).alias("records"))
    rows = rows.where(fits).select(FILE, "record_number", *[F.col(f"`{c}`") for c in columns])
    writer, files = numbered_writer(_over_files(rows, sizes), scan.records, per_file)
    _csv(writer, out)
    return files
