"""Text clean-up and text-to-value expressions.

All of them take and return Spark SQL text, to be used through ``expr`` or
``selectExpr``: one call per output column, everything built in and JVM-side.
"""

from __future__ import annotations

# Fixed values ---------------------------------------------------------------
MISSING_TEXT = " "  # what a missing text value is stored as
WHOLE_NUMBER = "must be a whole number"
TRUE_OR_FALSE = "must be true or false"
UUID_PATTERN = r"\A[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\z"
# ----------------------------------------------------------------------------

# The characters stripped from the ends of a cell: everything up to the space.
_CONTROL_AND_SPACE = "'" + "".join(f"\\u{code:04x}" for code in range(0x21)) + "'"


def quoted(text: str) -> str:
    """A SQL text literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A column name as SQL."""
    return "`" + column.replace("`", "``") + "`"


def trimmed(c: str) -> str:
    """Strip control characters and spaces from both ends (no regex)."""
    return f"trim(BOTH {_CONTROL_AND_SPACE} FROM {c})"


def is_blank(c: str) -> str:
    """NULL, empty or only white space. Never NULL itself.

    A first character in the printable ASCII range settles almost every value
    without running the regular expression.
    """
    return f"({c} IS NULL OR (NOT ({c} >= '!' AND {c} < '\\u007f') AND {c} RLIKE r'\\A\\p{{javaWhitespace}}*\\z'))"


def cell(c: str, has_control: str = "true") -> str:
    """A CSV cell: trimmed, and NULL when there is nothing in it.

    ``has_control`` says whether the line has any control character; without
    one, spaces are all there is to strip, which is much cheaper.
    """
    return f"if({is_blank(c)}, NULL, if({has_control}, {trimmed(c)}, trim({c})))"


def has_control(c: str) -> str:
    """Whether a text has a control character."""
    return f"{c} RLIKE r'[\\x00-\\x1f]'"


def utf16_length(c: str) -> str:
    """Length in UTF-16 units, as a bigint; pure ASCII text is not re-encoded."""
    return (
        f"CASE WHEN octet_length({c}) = length({c}) THEN cast(length({c}) AS bigint)"
        f" ELSE cast(octet_length(encode({c}, 'UTF-16BE')) DIV 2 AS bigint) END"
    )


def to_long(c: str) -> str:
    """Whole number or NULL: digits with an optional sign, within 64 bits."""
    return f"if({c} RLIKE r'\\A[+-]?[0-9]+\\z', try_cast({c} AS bigint), NULL)"


def to_boolean(c: str) -> str:
    """``true`` or ``false`` in any case; anything else is NULL."""
    return f"CASE lower({c}) WHEN 'true' THEN true WHEN 'false' THEN false END"


def to_list(c: str, separator: str = ";") -> str:
    """``a; ;b`` to ``[a, b]``; NULL to an empty list."""
    parts = f"transform(split({c}, {quoted(chr(92) + 'Q' + separator + chr(92) + 'E')}), p -> {trimmed('p')})"
    return f"coalesce(filter({parts}, p -> p <> ''), cast(array() AS array<string>))"


def fill_text(c: str) -> str:
    """A missing text (NULL or empty, but not white space) becomes one space."""
    return f"if({c} IS NULL OR {c} = '', {quoted(MISSING_TEXT)}, {c})"


def is_uuid(c: str) -> str:
    return f"coalesce({c} RLIKE r'{UUID_PATTERN}', false)"


def part_count(records: str, per_file: str) -> str:
    """Number of files of ``per_file`` records: at least one."""
    return f"greatest(1L, cast(ceil({records} / {per_file}) AS bigint))"
