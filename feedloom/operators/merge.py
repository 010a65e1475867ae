"""Merging rows into a target table by key."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from feedloom.sources.files import child_names


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last row of every key; a row without a key is an error.

    ``row_number() = 1`` lets Spark keep one row per key in every map task
    before the shuffle, so a key with very many rows costs no more than others.
    """
    keys = [key] if isinstance(key, str) else list(key)
    newest_first = [F.desc(o) if isinstance(o, str) else o.desc() for o in order]
    missing = F.raise_error(F.lit(f"a key is missing: {', '.join(keys)}"))
    known = [F.coalesce(F.col(k), missing.cast(df.schema[k].dataType)) for k in keys]
    rank = F.row_number().over(Window.partitionBy(*known).orderBy(*newest_first))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def upsert(base: DataFrame, incoming: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``base`` with the latest row of every incoming key in place of its own.

    Only the distinct keys meet the base: repeated keys are reduced before the
    shuffle, and a small set of keys is broadcast by size, which leaves the base
    unshuffled.
    """
    keys = [key] if isinstance(key, str) else list(key)
    newest = latest_per_key(incoming, keys, order).select(*base.columns)
    kept = base.join(incoming.select(*keys).distinct(), keys, "left_anti").select(*base.columns)
    return kept.unionByName(newest)


_PART = re.compile(r"part_of_(\d+)=\d+")


class TargetTable:
    """A Parquet folder partitioned by a hash of its key; a merge overwrites the partitions that have incoming keys.

    Spark's dynamic partition overwrite does the writing: partitions without
    incoming keys are not touched, a failed job leaves all as they were, and a
    merge that is repeated changes nothing more. The number of partitions is
    part of their column's name, so it stays as the first write had it. Writers
    take turns: of two merges at once the later one may undo the other where
    they share a partition; with a table format, use ``MERGE INTO``.

    A key's partition follows from the key, so a look-up reads one partition,
    and in it only row groups whose Bloom filter may have the key.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType, key: str, parts: int = 32) -> None:
        self.spark, self.path, self.key, self._new_parts = spark, path.rstrip("/"), key, parts
        self.schema = spark.createDataFrame([], schema).schema

    def _parts(self) -> tuple[int, bool]:
        """Number of partitions, and whether there are any yet."""
        found = (_PART.fullmatch(name) for name in child_names(self.spark, self.path))
        number = next((int(match[1]) for match in found if match), None)
        return (self._new_parts, False) if number is None else (number, True)

    def _rows(self) -> tuple[DataFrame, str, int]:
        """The rows with the column of their partition."""
        parts, exists = self._parts()
        column = f"part_of_{parts}"
        kind = StructType([*self.schema, StructField(column, IntegerType())])
        reader = self.spark.read.schema(kind)
        return (reader.parquet(self.path) if exists else self.spark.createDataFrame([], kind)), column, parts

    def _part(self, key: Column, parts: int) -> Column:
        return F.pmod(F.xxhash64(key.cast(self.schema[self.key].dataType)), F.lit(parts)).cast("int")

    def read(self) -> DataFrame:
        """All rows; none before the first write."""
        rows, column, _ = self._rows()
        return rows.drop(column)

    def find(self, value) -> DataFrame:
        """The row of one key; no row when it is unknown. Reads the key's partition only."""
        rows, column, parts = self._rows()
        # The partition is computed here, since Spark prunes by values and not by hashes of values.
        part = self.spark.range(1).select(self._part(F.lit(value), parts)).first()[0]
        return rows.where((F.col(column) == part) & (F.col(self.key) == F.lit(value))).drop(column)

    def find_all(self, keys: DataFrame) -> DataFrame:
        """The rows of many keys; reads the keys' partitions only."""
        rows, column, parts = self._rows()
        wanted = keys.select(self.key).withColumn(column, self._part(F.col(self.key), parts))
        touched = [row[0] for row in wanted.select(column).distinct().collect()]  # at most ``parts``
        return rows.where(F.col(column).isin(touched)).join(wanted, [column, self.key], "left_semi").drop(column)

    def _write(self, df: DataFrame, column: str, parts: int, overwrite: str) -> None:
        rows = df.select(*self.schema.names).withColumn(column, self._part(F.col(self.key), parts)).hint("rebalance", column)
        writer = rows.write.mode("overwrite").partitionBy(column).option("partitionOverwriteMode", overwrite)
        writer.option(f"parquet.bloom.filter.enabled#{self.key}", "true").parquet(self.path)

    def publish(self, df: DataFrame) -> None:
        """Replace all rows."""
        _, column, parts = self._rows()
        self._write(df, column, parts, "static")

    def merge(self, incoming: DataFrame, order: Sequence[str | Column]) -> None:
        """Upsert."""
        rows, column, parts = self._rows()
        touched = [row[0] for row in incoming.select(self._part(F.col(self.key), parts)).distinct().collect()]  # at most ``parts``
        base = rows.where(F.col(column).isin(touched)).drop(column)
        self._write(upsert(base, incoming, self.key, order), column, parts, "dynamic")
