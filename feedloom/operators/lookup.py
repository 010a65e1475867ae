"""Reading stored rows back, with sensitive fields in clear."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.protect import decrypt_if_present
from feedloom.functions.records import json_list
from feedloom.functions.text import name, quoted
from feedloom.schema import LIST, LONG, STRUCT, Feed


def find(table: DataFrame, key: str, value: str) -> DataFrame:
    """The row of one key in any table; the filter reaches the Parquet scan. ``TargetTable.find`` reads one partition."""
    return table.where(F.col(key) == F.lit(value))


def find_all(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of many keys in any table. ``TargetTable.find_all`` reads their partitions."""
    return table.join(keys.select(key), key, "left_semi")


def decrypted_view(table: DataFrame, feed: Feed, encryption_key: str, strict: bool = True) -> DataFrame:
    """Stored rows as records again: fields in clear, lists and structs restored."""
    restored = {}
    for f in feed.fields:
        if f.kind == STRUCT:
            schema = quoted(", ".join(f"{name(c)} string" for c in f.children))
            restored[f"__{f.name}"] = F.expr(f"from_json({name(f.name)}, {schema})")
    table = table.withColumns(restored)
    columns = []
    for f in feed.fields:
        if f.sensitive:
            plain = decrypt_if_present(name(f"{f.name}_encrypted"), encryption_key, strict)
            columns.append((plain.try_cast("bigint") if f.kind == LONG else plain).alias(f.name))
        elif f.kind == LIST:
            columns.append(F.expr(json_list(name(f.name))).alias(f.name))
        elif f.kind == STRUCT:
            value = F.col(f"__{f.name}")
            for child in f.sensitive_children:
                value = value.withField(child, decrypt_if_present(f"__{f.name}.{name(child)}", encryption_key, strict))
            columns.append(F.when(F.col(f.name).isNotNull(), value).alias(f.name))
        else:
            columns.append(F.col(f.name))
    rest = [c for c in ("ingestion_timestamp", "execution_id", "source_creation_time") if c in table.columns]
    return table.select(*columns, *rest)
