"""Compile mappings to DataFrame plans.

A mapping becomes one aggregation per entity type.  Facts that an entity may have many of, which
are texts, customData entries and edges, stay rows of their own: an entity with a third of all
rows behind it is then spread over tasks like any other rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import cached_property, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cast_as, entity_id, is_present, present, split_list
from ..operators.edges import edge_targets, keyed_edges, resolved, unresolved, with_edge_ids, with_inverse
from ..operators.notes import note_rows
from ..operators.quality import report_rows
from ..operators.order import ORDER, data_columns, first_match, order_of
from ..session import stage
from .mapping import Lookup, Mapping, MappingError, Source, check_mappings

TEXT_PATH = re.compile(r"^(\w+)\[\d+\]\.(author|title|text)$")
TEXT_FIELDS = ("author", "title", "text")
EdgeRules = dict[tuple[str, str], tuple[str, str]]
#: The key of a table's rows; a name of its own leaves ``key`` to the tables' columns.
KEY = "_entity_key"


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _union(frames: Iterable[DataFrame | None]) -> DataFrame | None:
    found = [f for f in frames if f is not None]
    return reduce(DataFrame.unionByName, found) if found else None


def keyed_rows(mapping: Mapping, table: DataFrame) -> DataFrame:
    """The mapping's rows with their key as text in ``KEY``; rows without one are skipped or fail the run."""
    column = mapping.identity()
    value = _quoted(column)
    if mapping.skip_empty_key:
        return table.filter(is_present(value)).withColumn(KEY, value.cast("string"))
    failed = F.raise_error(F.lit(f'Row has no value for key column "{column}"'))
    return table.withColumn(KEY, F.when(is_present(value), value.cast("string")).otherwise(failed))


def _as_key() -> Column:
    """The rows' key under the name it has in results."""
    return F.col(KEY).alias("key")


def _row_columns(table: DataFrame) -> list[str]:
    return [c for c in data_columns(table) if c != KEY]


def _order(mapping: Mapping, rows: DataFrame) -> Column:
    """The recorded source order, else the tuple of the columns this mapping reads.

    Without a recorded order any fixed order will do; this one carries no column through the
    shuffle that the mapping does not need anyway.
    """
    if ORDER in rows.columns:
        return F.col(ORDER)
    read = {s.column for s in mapping.sources().values() if s.column}
    read |= {t.column for texts in mapping.texts.values() for t in texts}
    return order_of(rows.select(*[_quoted(c) for c in sorted(read | {mapping.identity()})]))


# --- properties -----------------------------------------------------------------------


def _text_groups(mapping: Mapping) -> dict[str, dict[str, Source]]:
    """Property paths that spell an indexed text entry, by property and entry."""
    groups: dict[str, dict[str, Source]] = {}
    for path, source in mapping.sources().items():
        match = TEXT_PATH.match(path)
        if match:
            groups.setdefault(path.rsplit(".", 1)[0], {})[match.group(2)] = source
    return groups


def _scalar_sources(mapping: Mapping) -> dict[str, Source]:
    return {p: s for p, s in mapping.sources().items() if not TEXT_PATH.match(p)}


def _raw(source: Source) -> Column:
    """The cell before splitting, lookup and cast, for one row."""
    return F.lit(source.const) if source.const is not None else present(_quoted(source.column))


def _split(source: Source, value: Column) -> Column:
    """A split cell's one member or its joined members; withheld when it must be single."""
    if not source.split:
        return value
    members = split_list(value, source.split)
    if source.when == "single":
        return F.when(F.size(members) == 1, F.element_at(members, 1))
    return F.array_join(members, ", ")


def lookup_side(table: DataFrame, lookup: Lookup) -> DataFrame:
    """``(_on, _found)`` with one row per key, the first in source order.

    The key is made text before the grouping, so the grouping already partitions the table the
    way the join needs it.
    """
    order = [F.col(ORDER)] if ORDER in table.columns else []
    side = table.select(
        _quoted(lookup.on).cast("string").alias("_on"), _quoted(lookup.select).alias("_found"), *order
    )
    return first_match(side, ["_on"])


def _finish(df: DataFrame, sources: dict[str, Source], tables: dict[str, DataFrame]) -> DataFrame:
    """Splitting, lookups and casts on resolved cells.

    A lookup table is reduced to its first row per key, so the join can neither multiply rows
    nor be multiplied by a hot key; Spark picks the strategy from the sizes it measures.
    """
    for path, s in sources.items():
        if s.const is not None:
            continue
        value = _split(s, _quoted(path))
        if s.lookup:
            side = lookup_side(tables[s.lookup.table], s.lookup)
            df = df.withColumn("_value", value.cast("string")).join(side, F.col("_value") == F.col("_on"), "left")
            df = df.withColumn(path, F.col("_found")).drop("_value", "_on", "_found")
            value = _quoted(path)
        df = df.withColumn(path, cast_as(value, s.cast) if s.cast else value)
    return df


def _group_entities(mapping: Mapping, rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """One entity per key, its rows resolved together in one aggregation."""
    sources = _scalar_sources(mapping)
    order = _order(mapping, rows)
    aggregates = [F.lit(True).alias("_group")]
    for path, s in sources.items():
        if s.const is not None:
            aggregates.append(F.first(F.lit(s.const)).alias(path))
            continue
        value = _raw(s)
        if s.when == "unanimous":
            agreed = F.when(F.min(value) == F.max(value), F.max(value))
            aggregates.append(agreed.alias(path))
        elif s.column == mapping.identity():
            aggregates.append(F.min(value).alias(path))
        else:
            aggregates.append(F.min_by(value, F.when(value.isNotNull(), order)).alias(path))
    grouped = rows.groupBy(_as_key()).agg(*aggregates).drop("_group")
    return _finish(grouped, sources, tables)


def _row_entities(mapping: Mapping, rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """One entity per row; rows of one key fold, the first present value of each property wins.

    Splits and casts happen per row, before the fold, as each row is an entity of its own.
    """
    sources = _scalar_sources(mapping)
    order = _order(mapping, rows)
    cells = rows.select(_as_key(), order.alias(ORDER), *[_raw(s).alias(p) for p, s in sources.items()])
    finished = _finish(cells, sources, tables)
    # Rows of one key agree on what only reads the key, so that needs no order.
    by_key = {p for p, s in sources.items() if s.const is not None or (s.column == mapping.identity() and not s.lookup)}
    folds = [
        F.min(_quoted(p)).alias(p)
        if p in by_key
        else F.min_by(present(_quoted(p)), F.when(is_present(_quoted(p)), F.col(ORDER))).alias(p)
        for p in sources
    ]
    return finished.groupBy("key").agg(*folds) if folds else finished.select("key").distinct()


def _entities(mapping: Mapping, rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    return (_group_entities if mapping.grain == "group" else _row_entities)(mapping, rows, tables)


# --- texts and customData ---------------------------------------------------------------


def _texts(mapping: Mapping, rows: DataFrame) -> DataFrame | None:
    """``(entity_type, key, path, author, title, text)``, empty texts dropped, equal ones once.

    At group grain texts come from the group's first row, so that row is picked first.
    """
    entries = []
    for path, texts in mapping.texts.items():
        for t in texts:
            entries.append((path, F.lit(t.author).cast("string"), F.lit(t.title).cast("string"), t.column))
    declared = {t.column for texts in mapping.texts.values() for t in texts}
    groups = _text_groups(mapping)
    for fields in groups.values():
        declared |= {s.column for s in fields.values() if s.column}
    if not entries and not groups:
        return None
    if mapping.grain == "group":
        order = _order(mapping, rows)
        row = F.struct(*[_quoted(c) for c in sorted(declared)])
        rows = rows.groupBy(KEY).agg(F.min_by(row, order).alias("_r")).select(KEY, "_r.*")

    structs = [
        F.when(
            is_present(f"`{column}`"),
            F.struct(
                F.lit(path).alias("path"), author.alias("author"), title.alias("title"),
                _quoted(column).cast("string").alias("text"),
            ),
        )
        for path, author, title, column in entries
    ]
    for entry, fields in groups.items():
        def cell(name: str) -> Column:
            s = fields.get(name)
            if s is None:
                return F.lit(None).cast("string")
            value = _split(s, _raw(s))
            return (cast_as(value, s.cast) if s.cast else value).cast("string")

        filled = reduce(or_, [cell(n).isNotNull() for n in fields])
        structs.append(
            F.when(
                filled,
                F.struct(F.lit(entry.split("[")[0]).alias("path"), *[cell(n).alias(n) for n in TEXT_FIELDS]),
            )
        )
    found = rows.select(_as_key(), F.inline(F.array_compact(F.array(*structs))))
    return found.distinct().select(F.lit(mapping.entity_type).alias("entity_type"), "key", "path", *TEXT_FIELDS)


def _entry_values(columns: list[str], value) -> Column:
    entries = [
        F.when(value(c).isNotNull(), F.struct(F.lit(c).alias("name"), value(c).alias("value"))) for c in columns
    ]
    return F.array_compact(F.array(*entries))


def _open_columns(mapping: Mapping, table: DataFrame) -> list[str]:
    """Map columns the mapping carries; only a row by itself says what an open column holds."""
    carried = mapping.rest_columns(_row_columns(table))
    maps = [c for c in carried if isinstance(table.schema[c].dataType, T.MapType)]
    if maps and mapping.grain == "group":
        raise MappingError(f"{mapping.entity_type}: open columns {maps} can only be carried at row grain")
    return maps


def _open_entries(mapping: Mapping, column: str) -> Column:
    """Entries of a map column, each of them held to the mapping's allow and deny lists."""
    skip = list(mapping.consumed() | set(mapping.custom.exclude))
    allowed = mapping.custom.include

    def kept(e: Column) -> Column:
        keep = is_present(e["value"])
        keep = keep & ~e["key"].isin(*skip) if skip else keep
        return keep & e["key"].isin(*allowed) if allowed is not None else keep

    entries = F.array_sort(F.filter(F.map_entries(_quoted(column)), kept))
    return F.transform(
        F.coalesce(entries, F.array().cast("array<struct<key:string,value:string>>")),
        lambda e: F.struct(e["key"].alias("name"), e["value"].cast("string").alias("value")),
    )


def _agreed(rows: DataFrame, column: str) -> Column:
    """Aggregate: the value of a column that every row has and all rows agree on, else null."""
    value = present(_quoted(column))
    if not isinstance(rows.schema[column].dataType, T.AtomicType):
        value = value.cast("string")
    return F.when((F.count(value) == F.count("*")) & (F.min(value) == F.max(value)), F.max(value))


def _custom(mapping: Mapping, rows: DataFrame) -> DataFrame | None:
    """``(entity_type, key, domain, namespace, schema, value)``, one entry per agreeing set.

    At group grain a column is carried only when it is present on every row and equal on all of
    them.  At row grain each distinct row gives an entry, as array members are kept by value.
    """
    maps = _open_columns(mapping, rows)
    columns = [c for c in mapping.rest_columns(_row_columns(rows)) if c not in maps]
    if not columns and not maps:
        return None
    text = lambda c: present(_quoted(c)).cast("string")
    if mapping.grain == "group":
        # Columns are compared in their own types: without text among them this is a hash aggregate.
        agreed = [_agreed(rows, c).alias(f"_{i}") for i, c in enumerate(columns)]
        grouped = rows.groupBy(KEY).agg(*agreed)
        value = lambda c: F.col(f"_{columns.index(c)}").cast("string")
        entries = grouped.select(_as_key(), _entry_values(columns, value).alias("_v"))
        filled = F.size("_v") > 0
    else:
        lists = [_entry_values(columns, text)] if columns else []
        lists += [_open_entries(mapping, c) for c in maps]
        # The size is an aggregate of its own: a filter on the entries themselves would be pushed below
        # the grouping and down to the source, and every cell be worked out for it many times over.
        entries = rows.select(_as_key(), F.concat(*lists).alias("_v")).groupBy("key", "_v").agg(F.max(F.size("_v")).alias("_n"))
        filled = F.col("_n") > 0
    c = mapping.custom
    return entries.filter(filled).select(
        F.lit(mapping.entity_type).alias("entity_type"), "key",
        F.lit(c.domain).alias("domain"), F.lit(c.namespace).cast("string").alias("namespace"),
        F.lit(c.schema).cast("string").alias("schema"), F.map_from_entries("_v").alias("value"),
    )


# --- notes ------------------------------------------------------------------------------


def _withheld_unanimous(mapping: Mapping, rows: DataFrame) -> DataFrame | None:
    """Exact value and row counts of the groups a unanimous property was withheld from.

    Rows are counted per key, property and value first, so the second step sees one row per
    distinct value however hot its key is, and no distinct set is ever held in memory.
    """
    unanimous = {p: s for p, s in _scalar_sources(mapping).items() if s.when == "unanimous" and s.const is None}
    if not unanimous or mapping.grain != "group":
        return None
    cells = F.array(
        *[
            F.struct(F.lit(p).alias("path"), F.lit(s.column).alias("column"), _raw(s).cast("string").alias("value"))
            for p, s in unanimous.items()
        ]
    )
    counted = rows.select(_as_key(), F.inline(cells)).groupBy("key", "path", "column", "value").agg(F.count("*").alias("n"))
    withheld = (
        counted.groupBy("key", "path", "column")
        .agg(F.count("value").alias("values"), F.sum("n").alias("rows"))
        .filter(F.col("values") > 1)
    )
    detail = F.concat(
        "path", F.lit(" left out: rows disagree, "), F.col("rows").cast("string"), F.lit(" of them give "),
        F.col("values").cast("string"), F.lit(' for "'), "column", F.lit('"'),
    )
    return note_rows(withheld, "propertyWithheld", F.concat(F.lit(f"{mapping.entity_type} "), "key"), detail)


def _withheld_single(mapping: Mapping, rows: DataFrame) -> DataFrame | None:
    """Split cells that had to hold one value and do not."""
    single = {
        p: s for p, s in _scalar_sources(mapping).items() if s.when == "single" and s.split and s.const is None
    }
    if not single:
        return None
    if mapping.grain == "group":
        order = _order(mapping, rows)
        firsts = [
            F.min_by(_raw(s), F.when(_raw(s).isNotNull(), order)).alias(p) for p, s in single.items()
        ]
        rows = rows.groupBy(_as_key()).agg(*firsts)
    else:
        rows = rows.select(_as_key(), *[_raw(s).alias(p) for p, s in single.items()])
    cells = F.array(
        *[
            F.struct(
                F.lit(p).alias("path"), F.lit(s.column).alias("column"), split_list(_quoted(p), s.split).alias("members")
            )
            for p, s in single.items()
        ]
    )
    bad = rows.select("key", F.inline(cells)).filter(F.col("members").isNotNull() & (F.size("members") != 1))
    detail = F.concat(
        "path", F.lit(' left out: one member wanted, "'), "column", F.lit('" lists '), F.size("members").cast("string"),
        F.lit(" ["), F.array_join("members", ", "), F.lit("]"),
    )
    return note_rows(bad, "propertyWithheld", F.concat(F.lit(f"{mapping.entity_type} "), "key"), detail)


# --- folding and edges --------------------------------------------------------------------


def fold_entities(held: DataFrame, added: DataFrame) -> DataFrame:
    """A second mapping of a type fills the gaps of the first and adds what it did not have.

    Both sides are grouped on the key already, so the join needs no further shuffle.
    """
    shared = [c for c in added.columns if c in held.columns and c != "key"]
    new = [c for c in added.columns if c not in held.columns]
    right = added.select("key", *[_quoted(c).alias(f"_added_{i}") for i, c in enumerate(added.columns) if c != "key"])
    index = {c: f"_added_{i}" for i, c in enumerate(added.columns)}
    merged = held.join(right, "key", "full_outer")
    kept = [
        F.coalesce(present(_quoted(c)), F.col(index[c])).alias(c) if c in shared else _quoted(c)
        for c in held.columns
        if c != "key"
    ]
    return merged.select("key", *kept, *[F.col(index[c]).alias(c) for c in new])


def _edge_pairs(mapping: Mapping, edge, rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    if edge.source is None:
        return edge_targets(rows, KEY, edge.via, edge.split)
    own = rows.select(F.col(KEY).alias("from_key")).distinct()
    pairs = edge_targets(tables[edge.source.table], f"`{edge.source.on}`", edge.via, edge.split)
    return pairs.join(own, "from_key", "left_semi")


class Built:
    """The canonical result of a build; each frame is planned when it is first asked for.

    ``entities[type]`` has ``key``, ``entity_id`` and one column per property path; ``texts``,
    ``custom``, ``edges`` and ``identifiers`` are shared long tables; ``notes`` says what was
    withheld and ``unresolved`` which edge targets were not built.  Frames that the mappings give
    no reason for are None.
    """

    def __init__(self, tables: dict[str, DataFrame], mappings: list[Mapping], namespace: str, scope: str, edge_rules: EdgeRules | None):
        self._tables = tables
        self.namespace = namespace
        self._scope = scope
        self._edge_rules = edge_rules
        self._rows = [(m, keyed_rows(m, tables[m.table])) for m in mappings]

    @cached_property
    def _folded(self) -> dict[str, DataFrame]:
        """Entities by type, the mappings of one type folded in order."""
        folded: dict[str, DataFrame] = {}
        for m, rows in self._rows:
            found = _entities(m, rows, self._tables)
            held = folded.get(m.entity_type)
            folded[m.entity_type] = found if held is None else fold_entities(held, found)
        return folded

    @cached_property
    def _keys(self) -> dict[str, DataFrame]:
        """The keys of each type; all that an edge or an identifier needs of an entity."""
        keys: dict[str, list[DataFrame]] = {}
        for m, rows in self._rows:
            keys.setdefault(m.entity_type, []).append(rows.select(_as_key()))
        return {t: reduce(DataFrame.unionByName, frames).distinct() for t, frames in keys.items()}

    @cached_property
    def entities(self) -> dict[str, DataFrame]:
        return {
            t: df.select(
                "key", entity_id(t, "key", self.namespace).alias("entity_id"),
                *[_quoted(c) for c in df.columns if c != "key"],
            )
            for t, df in self._folded.items()
        }

    @cached_property
    def identifiers(self) -> DataFrame:
        return _union(
            df.select(
                F.lit(t).alias("entity_type"), entity_id(t, "key", self.namespace).alias("entity_id"),
                F.lit(0).alias("ordinal"), F.lit(self._scope).alias("scope"),
                entity_id(t, "key", self.namespace).alias("value"),
            )
            for t, df in self._keys.items()
        )

    @cached_property
    def texts(self) -> DataFrame | None:
        found = [t for t in (_texts(m, rows) for m, rows in self._rows) if t is not None]
        # Two mappings of one type may state the same text.
        return _union(found).distinct() if len(found) > 1 else _union(found)

    @cached_property
    def custom(self) -> DataFrame | None:
        return _union(_custom(m, rows) for m, rows in self._rows)

    @cached_property
    def notes(self) -> DataFrame | None:
        return _union(f(m, rows) for m, rows in self._rows for f in (_withheld_unanimous, _withheld_single))

    def _declared_edges(self):
        """``(mapping, edge, pairs, predicates)`` of every edge that may be built."""
        for m, rows in self._rows:
            for e in m.edges:
                rule = (self._edge_rules or {}).get((m.entity_type, e.to))
                if self._edge_rules is not None and rule is None:
                    continue
                if not e.external and e.to not in self._keys:
                    continue
                yield m, e, _edge_pairs(m, e, rows, self._tables), rule or ("has", "for")

    @cached_property
    def _edges(self) -> DataFrame | None:
        """Edges without ids, which are worked out from the keys where they are read."""
        frames = []
        for m, e, pairs, (forward, backward) in self._declared_edges():
            found = pairs if e.external else resolved(pairs, self._keys[e.to])
            rows = keyed_edges(found, m.entity_type, e.to, e.edge_key or forward, e.external)
            frames.append(with_inverse(rows, backward) if e.inverse and not e.external else rows)
        return _union(frames)

    @cached_property
    def edges(self) -> DataFrame | None:
        return None if self._edges is None else with_edge_ids(self._edges, self.namespace)

    @cached_property
    def unresolved(self) -> DataFrame | None:
        return _union(
            unresolved(pairs, self._keys[e.to]).select(
                F.lit(m.entity_type).alias("from_type"), "from_key", F.lit(e.to).alias("to_type"), "to_key"
            )
            for m, e, pairs, _ in self._declared_edges()
            if not e.external
        )

    def stored(self, *frames: str) -> Built:
        """The same build with frames written once to the shared folder: those named, or all.

        For what reads a build many times.  Sealing reads ``keys`` and ``edges`` for each figure and
        every entity once; writing a bundle reads everything twice.
        """
        wanted = frames or ("keys", "edges", "entities", "texts", "custom")
        held = object.__new__(Built)
        held.__dict__.update(self.__dict__)
        if "keys" in wanted:
            held.__dict__["_keys"] = {t: stage(df, f"keys-{t}") for t, df in self._keys.items()}
            # What was planned from the sources is planned anew from the stored keys.
            for name in ("identifiers", "_edges", "edges", "unresolved"):
                held.__dict__.pop(name, None)
        if "entities" in wanted:
            held.__dict__["entities"] = {t: stage(df, f"entities-{t}") for t, df in self.entities.items()}
        if "edges" in wanted and held._edges is not None:
            held.__dict__["_edges"] = stage(held._edges, "edges")
            held.__dict__.pop("edges", None)
        for name in ("texts", "custom"):
            frame = getattr(held, name) if name in wanted else None
            if frame is not None:
                held.__dict__[name] = stage(frame, name)
        return held

    @property
    def types(self) -> list[str]:
        return list(self._keys)

    def counts(self) -> DataFrame:
        """``report`` rows: entities per type."""
        return report_rows(self.identifiers.filter("ordinal = 0"), "entities", "entity_type")


def build_entities(
    tables: dict[str, DataFrame],
    mappings: list[Mapping],
    namespace: str,
    scope: str = "local",
    edge_rules: EdgeRules | None = None,
) -> Built:
    """Check the mappings and plan their entities and the edges between them.

    Mapping order decides only which mapping owns a property that two of them state.  An edge not
    in ``edge_rules``, when those are given, is not allowed and is not built.
    """
    check_mappings(mappings, {n: t.columns for n, t in tables.items()})
    for m in mappings:
        if m.custom and m.grain == "group":
            _open_columns(m, tables[m.table])
    return Built(tables, mappings, namespace, scope, edge_rules)
