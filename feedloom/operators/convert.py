"""From text to typed columns, with at most one parse error per record."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedloom.functions import text as T
from feedloom.schema import BOOLEAN, LIST, LONG, STRUCT, Feed, Field
from feedloom.sources.json_feed import RAW


def convert_csv(df: DataFrame, feed: Feed) -> DataFrame:
    """Flat text cells to the feed's columns; the first value that cannot be converted is the parse error."""
    errors = ["parse_error"]
    values: dict[str, str] = {}
    for f in feed.fields:
        c = T.name(f.name)
        if f.kind == STRUCT:
            members = ", ".join(f"{T.quoted(child)}, {T.name(f'{f.name}_{child}')}" for child in f.children)
            values[f.name] = f"named_struct({members})"
        elif f.kind in (LONG, BOOLEAN):
            value, wanted = (
                (T.to_long(c), T.WHOLE_NUMBER) if f.kind == LONG else (T.to_boolean(c), T.TRUE_OR_FALSE)
            )
            values[f.name] = value
            errors.append(f"CASE WHEN {c} IS NOT NULL AND {value} IS NULL THEN {T.quoted(f'{f.name} {wanted}')} END")
        elif f.kind == LIST:
            values[f.name] = T.to_list(c, feed.list_separator)
        else:
            values[f.name] = c
    return _with_values(df, feed, values, errors)


def _maybe_nested(text: str) -> str:
    """Text that may have been an object or an array instead of a plain value."""
    return f"left({text}, 1) IN ('{{', '[')"


def _kind_at(path: str) -> str:
    """JSON type of a member of the raw record."""
    return f"schema_of_variant(try_variant_get(try_parse_json({RAW}), {T.quoted(path)}, 'variant'))"


def _is_nested(kind: str) -> str:
    return f"coalesce(left({kind}, 5) IN ('OBJEC', 'ARRAY'), false)"


def _wrong_type(f: Field) -> str:
    """Whether a list or struct member is there but was not read as one."""
    return f"(__text IS NOT NULL AND __text.{T.name(f.name)} IS NOT NULL AND {T.name(f.name)} IS NULL)"


def _json_field(f: Field) -> tuple[str, str]:
    """Value and error of one member.

    A text that looks like an object or a list may really be a string with that
    look; only then is the record parsed again for the member's JSON type.
    """
    c, path = T.name(f.name), f"$.{f.name}"
    error = T.quoted(f"invalid value for field '{f.name}'")
    if f.kind in (LONG, BOOLEAN):
        text = f"nullif({T.trimmed(c)}, '')"
        value = T.to_long(text) if f.kind == LONG else T.to_boolean(text)
        return value, f"CASE WHEN {text} IS NOT NULL AND {value} IS NULL THEN {error} END"
    if f.kind == LIST:
        typed = f"try_variant_get(try_parse_json({RAW}), {T.quoted(path)}, 'array<variant>')"
        place = f"array_position(transform({typed}, v -> {_is_nested('schema_of_variant(v)')}), true) - 1"
        message = T.quoted(f"invalid value for field '{f.name}.[%d]'")
        return c, (
            f"CASE WHEN {_wrong_type(f)} OR exists({c}, i -> i IS NULL) THEN {error}"
            f" WHEN exists({c}, i -> {_maybe_nested('i')}) AND {place} >= 0 THEN format_string({message}, {place}) END"
        )
    if f.kind == STRUCT:
        members = [
            f" WHEN {_maybe_nested(f'{c}.{T.name(child)}')} AND {_is_nested(_kind_at(f'{path}.{child}'))}"
            f" THEN {T.quoted(f"invalid value for field '{f.name}.{child}'")}"
            for child in f.children
        ]
        return c, f"CASE WHEN {_wrong_type(f)} THEN {error}{''.join(members)} END"
    return c, f"CASE WHEN {_maybe_nested(c)} AND {_is_nested(_kind_at(path))} THEN {error} END"


def convert_json(df: DataFrame, feed: Feed) -> DataFrame:
    """Members (see ``read_json``) to the feed's columns; one wrongly typed member rejects only its record."""
    errors = ["parse_error"]
    values: dict[str, str] = {}
    for f in feed.fields:
        values[f.name], error = _json_field(f)
        errors.append(error)
    return _with_values(df, feed, values, errors)


def _with_values(df: DataFrame, feed: Feed, values: dict[str, str], errors: list[str]) -> DataFrame:
    carried = [c for c in ("record_number", "source_file", "source_creation_time") if c in df.columns]
    typed = df.selectExpr(
        *carried,
        f"coalesce({', '.join(errors)}) AS parse_error",
        *[f"{values[n]} AS {T.name(n)}" for n in feed.names],
    )
    # A record that cannot be parsed has no values at all.
    return typed.selectExpr(
        *carried, "parse_error", *[f"if(parse_error IS NULL, {T.name(n)}, NULL) AS {T.name(n)}" for n in feed.names]
    )
