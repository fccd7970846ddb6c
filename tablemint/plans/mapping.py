"""Mappings as data: how one table becomes one kind of entity."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

GRAINS = ("row", "group")
CASTS = (None, "number", "string", "boolean", "datetime")
CONDITIONS = (None, "unanimous", "single")
IDENTITY_PATH = "identifier[0].identifierValue"


class MappingError(ValueError):
    """A mapping that cannot be compiled, with every problem found."""


@dataclass(frozen=True)
class Lookup:
    """Resolve a value through another table: first row whose ``on`` equals it."""

    table: str
    on: str
    select: str


@dataclass(frozen=True)
class Source:
    """Where one property's value comes from.

    ``when='unanimous'`` withholds the value unless the rows agree; ``when='single'`` unless the
    split cell has exactly one member.  What is withheld becomes a note.
    """

    column: str | None = None
    cast: str | None = None
    const: Any = None
    split: str | None = None
    when: str | None = None
    lookup: Lookup | None = None


@dataclass(frozen=True)
class Text:
    """One column carried as an ``{author, title, text}`` entry."""

    title: str
    column: str
    author: str | None = None


@dataclass(frozen=True)
class Rest:
    """Carry every column no property consumes, under its own name."""

    domain: str
    namespace: str | None = None
    schema: str | None = None
    exclude: tuple[str, ...] = ()
    include: tuple[str, ...] | None = None


@dataclass(frozen=True)
class FromTable:
    """Edge rows read from another table, matched to the entity's key."""

    table: str
    on: str


@dataclass(frozen=True)
class Edge:
    to: str
    via: str
    source: FromTable | None = None
    split: str | None = None
    inverse: bool = False
    external: bool = False
    edge_key: str | None = None


@dataclass(frozen=True)
class Mapping:
    entity_type: str
    table: str
    key: str | None = None
    grain: str = "row"
    skip_empty_key: bool = False
    properties: dict[str, Source | str] = field(default_factory=dict)
    texts: dict[str, tuple[Text, ...]] = field(default_factory=dict)
    custom: Rest | None = None
    edges: tuple[Edge, ...] = ()

    def sources(self) -> dict[str, Source]:
        """Properties with the shorthand spelled out."""
        return {
            path: Source(column=s) if isinstance(s, str) else s for path, s in self.properties.items()
        }

    def identity(self) -> str:
        """The key column, or the column mapped to the first identifier's value."""
        if self.key:
            return self.key
        source = self.sources().get(IDENTITY_PATH)
        if source and source.column:
            return source.column
        raise MappingError(f"{self.entity_type} names neither a key nor an identifier column")

    def consumed(self) -> set[str]:
        """Columns already carried by a property or a text.

        A column that feeds a lookup is a join key, so its own value is still worth carrying.
        """
        used = {s.column for s in self.sources().values() if s.column and not s.lookup}
        return used | {t.column for entries in self.texts.values() for t in entries}

    def rest_columns(self, columns: list[str]) -> list[str]:
        if not self.custom:
            return []
        skip = self.consumed() | set(self.custom.exclude)
        allowed = self.custom.include
        return [c for c in columns if c not in skip and (allowed is None or c in allowed)]


def check_mappings(mappings: list[Mapping], columns: dict[str, list[str]], edge_rules: dict | None = None) -> None:
    """Raise with all problems at once, before any data is read.

    ``columns`` are the columns of each table.  ``edge_rules`` maps ``(from, to)`` to the allowed
    ``(edge_key, inverse_key)``.
    """
    problems: list[str] = []
    for m in mappings:
        name = f"{m.entity_type} from {m.table}"
        if m.table not in columns:
            problems.append(f"{name}: table is not present")
            continue
        have = set(columns[m.table])
        if m.grain not in GRAINS:
            problems.append(f"{name}: grain {m.grain!r}")
        wanted = {m.identity()} | m.consumed() | {s.column for s in m.sources().values() if s.column}
        problems += [f"{name}: no column {c}" for c in sorted(wanted - have)]
        for path, s in m.sources().items():
            if s.cast not in CASTS:
                problems.append(f"{name}: {path} casts to {s.cast!r}")
            if s.when not in CONDITIONS:
                problems.append(f"{name}: {path} holds when {s.when!r}")
            if s.column is None and s.const is None:
                problems.append(f"{name}: {path} has neither a column nor a constant")
        for e in m.edges:
            rows = columns.get(e.source.table if e.source else m.table, [])
            if e.via not in rows:
                problems.append(f"{name}: edge to {e.to} reads no column {e.via}")
            if edge_rules is not None and (m.entity_type, e.to) not in edge_rules:
                problems.append(f"{name}: edgeNotAllowed {m.entity_type} to {e.to}")
    if problems:
        raise MappingError("; ".join(problems))


def mappings_for(
    built_in: dict[str, list[Mapping]], supplied: dict[str, list[Mapping]], datasets: list[str]
) -> tuple[list[Mapping], list[tuple[str, str, str]]]:
    """Per dataset the supplied mapping, else the built-in one, with a note for each override."""
    chosen: list[Mapping] = []
    notes = []
    for dataset in datasets:
        template = supplied.get(dataset)
        if template:
            chosen += [replace(m, table=dataset) for m in template]
            notes.append(
                ("mappingFromTemplate", dataset, f"built with a supplied mapping of {len(template)} entity type(s)")
            )
        else:
            chosen += built_in[dataset]
    return chosen, notes
