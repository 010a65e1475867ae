"""Whole records as text: JSON, redacted JSON, report lines and messages (Spark SQL text)."""

from __future__ import annotations

from feedloom.functions.protect import redacted
from feedloom.functions.text import name, quoted
from feedloom.schema import STRUCT, Feed

# Fixed values ---------------------------------------------------------------
MISMATCH = ("Record count mismatch: control file expected ", " record(s) but ", " record(s) were loaded")
# ----------------------------------------------------------------------------


def value_json(c: str) -> str:
    """A struct or array as JSON text, NULL members included; NULL stays NULL."""
    return f"to_json({c}, map('ignoreNullFields', 'false'))"


def as_json(members: dict[str, str]) -> str:
    """Named values as one JSON object, NULL members included."""
    return value_json("named_struct(" + ", ".join(f"{quoted(n)}, {c}" for n, c in members.items()) + ")")


def redacted_record(feed: Feed) -> str:
    """The record as JSON with its sensitive values hidden."""
    members = {}
    for f in feed.fields:
        c = name(f.name)
        if f.sensitive:
            c = redacted(c)
        elif f.kind == STRUCT and f.sensitive_children:
            inner = [
                f"{quoted(child)}, "
                + (redacted(f"{c}.{name(child)}") if child in f.sensitive_children else f"{c}.{name(child)}")
                for child in f.children
            ]
            c = f"if({c} IS NULL, NULL, named_struct({', '.join(inner)}))"
        members[f.name] = c
    return as_json(members)


def one_line(c: str) -> str:
    """Text that cannot break a report line: ``|``, CR and LF become spaces."""
    return f"translate(coalesce(cast({c} AS string), ''), '|\\r\\n', '   ')"


def error_line(key: str) -> str:
    """One line of the error report, from the columns of a failure row with key column ``key``."""
    columns = ["record_number", "error_type", "error_message", key, "source_file", "execution_id"]
    parts = [f"'{'|' if i else ''}{c}=', {one_line(name(c))}" for i, c in enumerate(columns)]
    return f"concat({', '.join(parts)})"


def mismatch_message(expected: str, actual: str) -> str:
    """Why a run failed its count check (SQL text)."""
    return "concat(" + ", ".join([quoted(MISMATCH[0]), expected, quoted(MISMATCH[1]), actual, quoted(MISMATCH[2])]) + ")"


def mismatch_text(expected: int, actual: int) -> str:
    """The same for known numbers."""
    return f"{MISMATCH[0]}{expected}{MISMATCH[1]}{actual}{MISMATCH[2]}"


def json_text(c: str, path: str) -> str:
    """One member of a JSON text column, as text."""
    return f"get_json_object({c}, {quoted(path)})"


def json_value(c: str, path: str, ddl: str) -> str:
    """One member of a JSON text column as the given type; NULL where it does not fit."""
    return f"try_variant_get(try_parse_json({c}), {quoted(path)}, {quoted(ddl)})"


def json_list(c: str) -> str:
    """A JSON text column as a list of texts; NULL gives an empty list."""
    return f"coalesce(from_json({c}, 'array<string>'), cast(array() AS array<string>))"
