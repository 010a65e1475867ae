"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feedloom.session import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact(df: DataFrame, *columns: str) -> DataFrame:
    """Only these columns, so that further ones cannot clash with the operator's own names."""
    return df.select(*(df[name] for name in columns))


class Scratch:
    """Tables in the shared folder that one job writes, reads again and may drop.

    Writing cuts the lineage: a lost executor repeats its own tasks only.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch_path = path
        return back

    def write_parts(self, df: DataFrame, name: str, column: str, values: list[int]) -> list[DataFrame]:
        """Write once, and return a table for each value of a column, without the column; each can be dropped alone."""
        path = new_path(self.spark, name)
        df.write.partitionBy(column).option("compression", "zstd").parquet(path)
        kind = StructType([field for field in df.schema if field.name != column])
        tables = []
        for value in values:
            back = self.spark.createDataFrame([], kind)
            part = f"{path}/{column}={value}"
            if exists(self.spark, part):
                back = self.spark.read.schema(kind).parquet(part)
            back._scratch_path = part
            tables.append(back)
        return tables

    def drop(self, df: DataFrame) -> None:
        """Delete a table written here, once nothing reads it any more."""
        delete(self.spark, df._scratch_path)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def ship(spark: SparkSession) -> None:
    """Let the executors import this package wherever they run; once a session."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    archive = f"{package.name}-{context.applicationId}.zip"
    if archive not in context._python_includes:
        path = Path(tempfile.mkdtemp()) / archive  # the driver's own copy, which Spark sends to the executors
        with zipfile.ZipFile(path, "w") as out:
            for source in package.rglob("*.py"):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(path))


def in_python(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with a function of this package.

    Texts that are not valid UTF-8 reach it repaired, a replacement character for each part that is not.
    """
    ship(df.sparkSession)
    named = [(field, F.col("`" + field.name.replace("`", "``") + "`")) for field in df.schema]
    valid = [F.make_valid_utf8(column).alias(field.name) if field.dataType == StringType() else column for field, column in named]
    return df.select(*valid).mapInArrow(function, schema)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand Python at most so many rows at once, for tables of large rows that are written inside."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, usual)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], list[pa.Array]], fields: list[StructField]
) -> DataFrame:
    """The columns that ``function`` makes of each Arrow batch of ``df``; one row out for each row in."""
    names = [field.name for field in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(function(batch), names)

    return in_python(df, run, StructType(fields))


def salted(column: str | Column, seed: str) -> Column:
    """A keyed 60-bit hash of a column, the same in Spark and in other SQL engines; NULL is an empty text."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
