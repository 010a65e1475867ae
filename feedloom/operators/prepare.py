"""From valid records to rows of the target table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.protect import encrypt_columns, encrypt_numbered
from feedloom.functions.records import value_json
from feedloom.functions.text import fill_text, name, quoted
from feedloom.schema import DATE, LIST, STRING, STRUCT, Feed


def fill_missing(df: DataFrame, feed: Feed, only_if: str = "true") -> DataFrame:
    """Missing texts become one space, a missing list an empty one, a missing struct one of spaces.

    Numbers, booleans and dates stay as they are, and so do rows not satisfying ``only_if``.
    """
    values = {}
    for f in feed.fields:
        c = name(f.name)
        if f.kind == STRING:
            value = fill_text(c)
        elif f.kind == LIST:
            value = f"coalesce({c}, cast(array() AS array<string>))"
        elif f.kind == STRUCT:
            members = ", ".join(f"{quoted(child)}, {fill_text(f'{c}.{name(child)}')}" for child in f.children)
            value = f"named_struct({members})"
        else:
            continue
        values[f.name] = F.expr(value if only_if == "true" else f"if({only_if}, {value}, {c})")
    return df.withColumns(values)


def add_metadata(df: DataFrame, execution_id: str) -> DataFrame:
    """Lineage of the run: its id and the time of loading."""
    return df.withColumns({"execution_id": F.lit(execution_id), "ingestion_timestamp": F.current_timestamp()})


def encrypt_sensitive(df: DataFrame, feed: Feed, key: str, only_if: str = "true", numbered: bool = False) -> DataFrame:
    """Replace sensitive fields by ``<field>_encrypted``; nested ones stay in place, encrypted.

    Rows not satisfying ``only_if`` get NULLs instead of encrypted values. With
    ``numbered`` the values have the form for any number of records.
    """
    targets: dict[str, str] = {}
    for f in feed.fields:
        if f.sensitive:
            targets[f"{f.name}_encrypted"] = f"if({only_if}, {name(f.name)}, NULL)"
        for child in f.sensitive_children:
            targets[f"__{f.name}_{child}"] = f"if({only_if}, {name(f.name)}.{name(child)}, NULL)"
    df = (encrypt_numbered if numbered else encrypt_columns)(df, targets, key)
    nested = {}
    for f in feed.fields:
        if f.sensitive_children:
            members = ", ".join(
                f"{quoted(c)}, " + (f"__{f.name}_{c}" if c in f.sensitive_children else f"{name(f.name)}.{name(c)}")
                for c in f.children
            )
            nested[f.name] = F.expr(f"if({name(f.name)} IS NULL, NULL, named_struct({members}))")
    hidden = [t for t in targets if t.startswith("__")]
    return df.withColumns(nested).drop(*hidden, *[f.name for f in feed.fields if f.sensitive])


def target_columns(feed: Feed) -> list[str]:
    """The stored form of every field, in order: dates as dates, lists and structs as JSON text."""
    out = []
    for f in feed.fields:
        c = name(f.name)
        if f.sensitive:
            out.append(name(f"{f.name}_encrypted"))
        elif f.kind == DATE:
            out.append(f"try_to_date({c}, 'yyyy-MM-dd') AS {c}")
        elif f.kind in (LIST, STRUCT):
            out.append(f"{value_json(c)} AS {c}")
        else:
            out.append(c)
    return out
