"""Validation rules as data, applied to any table.

A rule turns into one SQL expression: its message when the row breaks it, else
NULL. ``error_text`` puts the messages of all rules side by side, in rule order.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from feedloom.functions.text import is_blank, name, quoted, utf16_length

# Fixed values ---------------------------------------------------------------
ERROR_SEPARATOR = "; "
EMAIL_PATTERN = r"[A-Za-z0-9+_.-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
CURRENCY_PATTERN = r"[A-Z]{3}"
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Base of all rules; ``field`` is the column it looks at."""

    field: str

    def error(self) -> str:
        raise NotImplementedError

    @property
    def _c(self) -> str:
        return name(self.field)


def _when(condition: str, message: str) -> str:
    return f"CASE WHEN {condition} THEN {quoted(message)} END"


@dataclass(frozen=True)
class Length(Rule):
    """Text of ``low`` to ``high`` UTF-16 units; a blank one is only reported when required."""

    low: int = 0
    high: int = 0
    required: bool = True

    def error(self) -> str:
        size = utf16_length(self._c)
        span = f"exactly {self.high}" if self.low == self.high else f"between {self.low} and {self.high}"
        wanted = quoted(f"{self.field} must be {span} characters (found ")
        missing = quoted(f"{self.field} is required") if self.required else "NULL"
        return (
            f"CASE WHEN {is_blank(self._c)} THEN {missing}"
            f" WHEN {size} NOT BETWEEN {self.low} AND {self.high} THEN concat({wanted}, {size}, ')') END"
        )


@dataclass(frozen=True)
class Required(Rule):
    """Text that must not be blank."""

    def error(self) -> str:
        return _when(is_blank(self._c), f"{self.field} is required")


@dataclass(frozen=True)
class Matches(Rule):
    """Text that must match a pattern as a whole, when there is any."""

    pattern: str = ""
    message: str = ""

    def error(self) -> str:
        whole = quoted(rf"\A(?:{self.pattern})\z")
        return _when(f"NOT {is_blank(self._c)} AND NOT {self._c} RLIKE {whole}", self.message)


@dataclass(frozen=True)
class RealDate(Rule):
    """Text that must be an existing day written ``yyyy-MM-dd``, when there is any."""

    def error(self) -> str:
        broken = f"(length({self._c}) <> 10 OR try_to_date({self._c}, 'yyyy-MM-dd') IS NULL)"
        return _when(
            f"NOT {is_blank(self._c)} AND {broken}", f"{self.field} must be a real date in yyyy-MM-dd format"
        )


@dataclass(frozen=True)
class NotNegative(Rule):
    def error(self) -> str:
        return _when(f"{self._c} < 0", f"{self.field} must not be negative")


@dataclass(frozen=True)
class Present(Rule):
    """A value of any type that must not be NULL."""

    hint: str = ""

    def error(self) -> str:
        return _when(f"{self._c} IS NULL", f"{self.field} is required{self.hint}")


@dataclass(frozen=True)
class JoinedLength(Rule):
    """A list whose members, joined, must not exceed ``high`` UTF-16 units."""

    high: int = 0
    separator: str = ";"

    def error(self) -> str:
        size = utf16_length(f"array_join({self._c}, {quoted(self.separator)})")
        return _when(f"{size} > {self.high}", f"{self.field} must not exceed {self.high} characters in total")


# Constraints of a target table, checked just before the write.


@dataclass(frozen=True)
class NotNull(Rule):
    def error(self) -> str:
        return _when(f"{self._c} IS NULL", f'null value in column "{self.field}" violates not-null constraint')


@dataclass(frozen=True)
class MaxLength(Rule):
    """Declared width of a text column, in characters."""

    high: int = 0

    def error(self) -> str:
        message = f'value too long for column "{self.field}" of type character varying({self.high})'
        return _when(f"length({self._c}) > {self.high}", message)


@dataclass(frozen=True)
class OneOf(Rule):
    values: tuple[str, ...] = ()

    def error(self) -> str:
        allowed = ", ".join(quoted(v) for v in self.values)
        return _when(f"{self._c} NOT IN ({allowed})", f'value of column "{self.field}" violates check constraint')


@dataclass(frozen=True)
class NoNul(Rule):
    """Text a warehouse column cannot hold: it contains the zero character."""

    def error(self) -> str:
        return _when(f"contains({self._c}, '\\u0000')", f'invalid byte sequence in column "{self.field}": 0x00')


def errors_of(rules: Iterable[Rule]) -> str:
    """All messages of a row, in rule order (an empty array when it is valid)."""
    return "array_compact(array(" + ", ".join(rule.error() for rule in rules) + "))"


def error_text(rules: Iterable[Rule]) -> str:
    """All messages joined by ``"; "``, empty when the row is valid."""
    return f"concat_ws({', '.join([quoted(ERROR_SEPARATOR), *[rule.error() for rule in rules]])})"


def first_error(rules: Iterable[Rule]) -> str:
    """The first message only, as a database reports a rejected row."""
    errors = [rule.error() for rule in rules]
    return f"coalesce({', '.join(errors)})" if errors else "cast(NULL AS string)"


def is_row_level(sqlstate: str) -> str:
    """True for SQL states that blame the row (class 22 or 23), not the database."""
    return f"coalesce(left({sqlstate}, 2) IN ('22', '23'), false)"
