"""The declared model: plain records that the operators read."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Generated:
    """GENERATED ALWAYS / BY DEFAULT: an expression or an identity."""

    type: str = "ALWAYS"
    expression: str = ""
    as_identity: bool = False
    on_null: bool = False
    start: int = 1
    increment: int = 1


@dataclass(frozen=True)
class Column:
    """A declared column. ``type`` is a Spark SQL type text, such as ``decimal(12,2)``."""

    name: str
    type: str
    nullable: bool = True
    length: int | None = None
    length_semantics: str = "CHAR"
    default: str | None = None
    default_on_null: bool = False
    generated: Generated | None = None
    rules: dict[str, Any] = field(default_factory=dict)
    comment: str = ""


@dataclass(frozen=True)
class Key:
    """PRIMARY KEY or UNIQUE over one or more columns."""

    name: str
    columns: tuple[str, ...]
    primary: bool = False
    validate: bool = True
    rely: bool = False
    deferrable: bool = False


@dataclass(frozen=True)
class Check:
    name: str
    expression: str
    validate: bool = True


@dataclass(frozen=True)
class ForeignKey:
    name: str
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    on_delete: str = ""
    active: bool = True
    validate: bool = True
    cardinality: tuple[int, int | None] = (0, None)


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...] = ()
    keys: tuple[Key, ...] = ()
    checks: tuple[Check, ...] = ()


@dataclass(frozen=True)
class Model:
    tables: tuple[Table, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()

    def table(self, name: str) -> Table:
        return next(t for t in self.tables if t.name == name)


@dataclass(frozen=True)
class Sequence:
    """START, INCREMENT, bounds and CYCLE of a sequence; unset bounds follow the direction."""

    start: int | None = None
    increment: int = 1
    min_value: int | None = None
    max_value: int | None = None
    cycle: bool = False


@dataclass(frozen=True)
class Tags:
    """Rights of a table or column inside a document; ``check`` is CHECK, NOCHECK or empty."""

    insert: bool = False
    update: bool = False
    delete: bool = False
    check: str = ""
    etag: bool = False


@dataclass(frozen=True)
class DocField:
    """A column of the node's table; ``key`` is the explicit code, ``name`` the property name."""

    column: str
    name: str = ""
    key: str = ""
    tags: Tags | None = None
    flex: bool = False

    @property
    def label(self) -> str:
        return self.key or self.name or self.column


@dataclass(frozen=True)
class DocNode:
    """A table inside a document: the root, an ``object`` or an ``array`` below it.

    ``on`` pairs (parent column, own column). ``key`` is the row key used when
    documents are written back, ``order`` sorts the entries of an array.
    """

    table: str
    fields: tuple[DocField, ...]
    name: str = ""
    kind: str = "root"
    on: tuple[tuple[str, str], ...] = ()
    where: str = ""
    order: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    unnest: bool = False
    tags: Tags = Tags()
    children: tuple["DocNode", ...] = ()


@dataclass(frozen=True)
class Step:
    """One step of an evolution plan: add, drop, rename or type; ``column`` may be a path."""

    action: str
    column: str
    to: Any = None
    active: bool = True
