"""How a feed is described: its fields, rules, target constraints and key."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values ---------------------------------------------------------------
EXTENSIONS = {"CSV": ".csv", "JSON": ".json"}
# ----------------------------------------------------------------------------

STRING = "string"
LONG = "long"
BOOLEAN = "boolean"
DATE = "date"
LIST = "list"
STRUCT = "struct"


@dataclass(frozen=True)
class Field:
    """One field of a feed.

    ``children`` are the text members of a STRUCT; in a CSV feed they are the
    columns ``<name>_<child>``. ``sensitive`` fields (or the members named in
    ``sensitive_children``) are stored encrypted and shown redacted.
    A DATE field is text in flight and a date at rest.
    """

    name: str
    kind: str = STRING
    children: tuple[str, ...] = ()
    sensitive: bool = False
    sensitive_children: tuple[str, ...] = ()

    @property
    def ddl(self) -> str:
        """Type in flight, after conversion."""
        if self.kind == LONG:
            return "bigint"
        if self.kind == BOOLEAN:
            return "boolean"
        if self.kind == LIST:
            return "array<string>"
        if self.kind == STRUCT:
            return "struct<" + ",".join(f"{c}:string" for c in self.children) + ">"
        return "string"


@dataclass(frozen=True)
class Feed:
    """A feed: fields in order, the key, validation rules, target constraints."""

    name: str
    key: str
    fields: tuple[Field, ...]
    rules: tuple = ()
    constraints: tuple = ()
    list_separator: str = ";"
    _by_name: dict = field(default_factory=dict, compare=False, repr=False)

    def __post_init__(self) -> None:
        self._by_name.update({f.name: f for f in self.fields})

    def field(self, name: str) -> Field:
        return self._by_name[name]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def csv_columns(self) -> list[str]:
        """The flat columns of the CSV form."""
        out: list[str] = []
        for f in self.fields:
            out += [f"{f.name}_{c}" for c in f.children] if f.kind == STRUCT else [f.name]
        return out
