"""Nested values of any depth: paths into them, a canonical form, and rules on what stands at a path.

A record is a VARIANT, made from columns or from JSON text.  Paths are compiled into one expression per
record, so rewriting and checking are narrow: nothing is exploded and grouped again.

A path names members with dots and every element of an array with ``[]``; ``*`` is any member.  A tuple
of steps says the same where a name holds a dot or a bracket: ``("customData", "[]", "value", "a.b")``.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Path = str | tuple[str, ...]

ELEMENT = "[]"
ANY = "*"


def path_steps(path: Path) -> tuple[str, ...]:
    """``customData[].value.day`` as its steps."""
    if not isinstance(path, str):
        return tuple(path)
    steps: list[str] = []
    for part in path.split("."):
        name, brackets = re.fullmatch(r"(.*?)((?:\[\])*)", part).groups()
        if (not name and (steps == [] or not brackets)) or "[" in name or "]" in name:
            raise ValueError(f"not a path: {path!r}")
        steps += [name] if name else []
        steps += [ELEMENT] * (len(brackets) // 2)
    return tuple(steps)


def record_of(columns: list[str]) -> Column:
    """Columns as one VARIANT record; null fields of columns and structs are absent from it."""
    return F.parse_json(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])))


def is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType))


def _members(value: Column) -> Column:
    """An object's members as a map in name order, null for anything else."""
    return value.try_cast("map<string,variant>")


def _elements(value: Column) -> Column:
    return value.try_cast("array<variant>")


def _quoted(text: Column) -> Column:
    """A string as JSON spells it."""
    return F.btrim(F.to_json(F.array(text)), F.lit("[]"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# --- canonical form -------------------------------------------------------------------


def _dropping(paths: list[tuple[str, ...]]) -> dict:
    """Paths as a tree of steps; None marks what goes."""
    tree: dict = {}
    for path in paths:
        node = tree
        for step in path[:-1]:
            node = node.setdefault(step, {})
            if node is None:
                break
        if node is not None:
            node[path[-1]] = None
    return tree


def _under(tree: dict, name: str) -> dict | None:
    """What is dropped below a member: the paths that name it together with those for any member."""
    if ANY not in tree or name == ANY:
        return tree[name]
    own, other = tree.get(name, {}), tree[ANY]
    if own is None or other is None:
        return None
    return {step: _under_both(own, other, step) for step in sorted({*own, *other})}


def _under_both(a: dict, b: dict, step: str) -> dict | None:
    if step not in a or step not in b:
        return a.get(step, {}) if step in a else b[step]
    if a[step] is None or b[step] is None:
        return None
    return {s: _under_both(a[step], b[step], s) for s in sorted({*a[step], *b[step]})}


def canonical_text(value: Column, drop: list[Path] | tuple[Path, ...] = ()) -> Column:
    """A VARIANT as JSON with members in name order at every depth, less what stands at ``drop``.

    The order of members and the spelling of integers and decimals (1.50 and 1.5) make no difference;
    the order of array elements does.  What a dropped member leaves empty stays, as an empty object.
    """
    return _text(value, _dropping([path_steps(p) for p in drop]))


def _text(value: Column, tree: dict) -> Column:
    names = [n for n in tree if n not in (ELEMENT, ANY)]
    forms = []
    if names or ANY in tree:
        dropped = [n for n in names if _under(tree, n) is None]

        def kept(key: Column) -> Column:
            if ANY in tree and tree[ANY] is None:
                return F.lit(False)
            return ~key.isin(*dropped) if dropped else F.lit(True)

        def member(entry: Column) -> Column:
            key, inner = entry["key"], entry["value"]
            text = _text(inner, tree.get(ANY) or {})
            for name in names:
                below = _under(tree, name)
                if below:
                    text = F.when(key == name, _text(inner, below)).otherwise(text)
            return F.concat(_quoted(key), F.lit(":"), text)

        entries = F.filter(F.map_entries(_members(value)), lambda e: kept(e["key"]))
        forms.append(F.concat(F.lit("{"), F.array_join(F.transform(entries, member), ","), F.lit("}")))
    if ELEMENT in tree:
        below = tree[ELEMENT]
        listed = F.transform(_elements(value), lambda e: _text(e, below or {}))
        forms.append(
            F.when(_elements(value).isNotNull(), F.lit("[]"))
            if below is None
            else F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]"))
        )
    return F.coalesce(*forms, F.to_json(value)) if forms else F.to_json(value)


def without_paths(value: Column, kind: T.DataType, drop: dict) -> tuple[Column, T.DataType] | None:
    """A column less what stands at a tree of paths, before it becomes a record.

    None where only the record tells what a path meets: inside of a VARIANT, under keys that are no text
    and among fields whose names differ in case only.
    """
    if not drop or isinstance(kind, T.AtomicType | T.NullType) and not isinstance(kind, T.VariantType):
        return value, kind
    if isinstance(kind, T.ArrayType):
        if ELEMENT not in drop:
            return value, kind
        if drop[ELEMENT] is None:
            return F.when(value.isNotNull(), F.array().cast("array<string>")), T.ArrayType(T.StringType())
        inner = without_paths(F.lit(None), kind.elementType, drop[ELEMENT])
        if inner is None:
            return None
        return F.transform(value, lambda e: without_paths(e, kind.elementType, drop[ELEMENT])[0]), T.ArrayType(inner[1])
    if isinstance(kind, T.StructType):
        if len({f.name.lower() for f in kind.fields}) < len(kind.fields):
            return None
        fields = []
        for f in kind.fields:
            below = _below(drop, f.name)
            if below is None:
                continue
            inner = without_paths(value[f.name], f.dataType, below)
            if inner is None:
                return None
            fields.append((f.name, *inner))
        if not fields:
            nothing = T.MapType(T.StringType(), T.StringType())
            return F.when(value.isNotNull(), F.create_map().cast(nothing)), nothing
        left = F.when(value.isNotNull(), F.struct(*[c.alias(name) for name, c, _ in fields]))
        return left, T.StructType([T.StructField(name, t) for name, _, t in fields])
    if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        names = [n for n in drop if n not in (ELEMENT, ANY)]
        if ANY in drop and drop[ANY] is None:
            return F.when(value.isNotNull(), F.create_map().cast(kind)), kind
        gone = [n for n in names if _below(drop, n) is None]
        kept = F.map_filter(value, lambda k, v: ~k.isin(*gone)) if gone else value
        below = {n: _below(drop, n) for n in names if n not in gone}
        if not below and not drop.get(ANY):
            return kept, kind
        if any(without_paths(F.lit(None), kind.valueType, d) is None for d in (*below.values(), drop.get(ANY) or {})):
            return None
        forms = {n: without_paths(F.lit(None), kind.valueType, d)[1] for n, d in (*below.items(), (ANY, drop.get(ANY) or {}))}
        # Values under different names must keep one type, which they do unless some lose fields.
        if len({t.json() for t in forms.values()}) > 1:
            return None

        def trimmed(k: Column, v: Column) -> Column:
            chosen = without_paths(v, kind.valueType, drop.get(ANY) or {})[0]
            for name, d in below.items():
                chosen = F.when(k == name, without_paths(v, kind.valueType, d)[0]).otherwise(chosen)
            return chosen

        return F.transform_values(kept, trimmed), T.MapType(kind.keyType, forms[ANY])
    return None


def _below(tree: dict, name: str) -> dict | None:
    """What is dropped below a member of this name; None when the member itself is."""
    return _under(tree, name) if name in tree else tree.get(ANY, {})


def records_without(df: DataFrame, columns: list[str], drop: list[Path]) -> Column | None:
    """``record_of`` the columns less what stands at ``drop``, where the columns' types tell; else None."""
    tree, left = _dropping([path_steps(p) for p in drop]), []
    for c in columns:
        below = _below(tree, c)
        if below is None:
            continue
        inner = without_paths(F.col(f"`{c}`"), df.schema[c].dataType, below)
        if inner is None:
            return None
        left.append(inner[0].alias(c))
    return F.parse_json(F.to_json(F.struct(*left))) if left else None


# --- rules ----------------------------------------------------------------------------


KINDS = ("string", "number", "boolean", "object", "array")


@dataclass(frozen=True)
class PathRule:
    """What a record must hold at a path.

    ``required`` asks for a value wherever the parent stands; ``kind`` is one of ``KINDS``; ``allowed``
    and ``pattern`` hold for the text of present values; ``only`` are the members an object may have,
    ``least`` the number of elements an array must have.
    """

    path: Path
    required: bool = False
    kind: str | None = None
    allowed: tuple[str, ...] | None = None
    pattern: str | None = None
    only: tuple[str, ...] | None = None
    least: int = 0

    def __post_init__(self):
        if self.kind is not None and self.kind not in KINDS:
            raise ValueError(f"kind {self.kind!r} is none of {', '.join(KINDS)}")


class _Node:
    """Rules of one step of the paths, and the steps below it."""

    def __init__(self):
        self.rules: list[PathRule] = []
        self.below: dict[str, _Node] = {}

    def at(self, steps: tuple[str, ...]) -> _Node:
        node = self
        for step in steps:
            node = node.below.setdefault(step, _Node())
        return node


def _fault(wrong: Column, path: Column, error: str | Column) -> Column:
    """An array of one failure, or an empty one."""
    message = F.lit(error) if isinstance(error, str) else error
    found = F.struct(path.alias("path"), message.alias("error"))
    return F.when(wrong, F.array(found)).otherwise(F.array().cast("array<struct<path:string,error:string>>"))


def _is_null(value: Column) -> Column:
    """Absent, or a JSON null."""
    return value.isNull() | F.coalesce(F.is_variant_null(value), F.lit(False))


def _kind_of(value: Column) -> Column:
    """The kind of a value; members and elements are not copied to find it."""
    return (
        F.when(value.try_cast(T.StructType()).isNotNull(), "object")
        .when(value.try_cast(T.ArrayType(T.StructType())).isNotNull(), "array")
        .otherwise(
            _bound(
                F.schema_of_variant(value),
                lambda s: F.when(s == "STRING", "string").when(s == "BOOLEAN", "boolean").otherwise("number"),
            )
        )
    )


def _own_faults(rule: PathRule, value: Column, members: Column, elements: Column, path: Column) -> list[Column]:
    there, text = ~_is_null(value), F.coalesce(value.try_cast("string"), F.to_json(value))
    found = []
    if rule.required:
        found.append(_fault(_is_null(value) | F.coalesce(text == "", F.lit(False)), path, "a value is required"))
    if rule.kind is not None:
        found.append(
            _bound(
                F.when(there, _kind_of(value)),
                lambda kind: _fault(
                    kind != rule.kind, path, F.concat(F.lit(f"{rule.kind} expected, "), kind, F.lit(" found"))
                ),
            )
        )
    if rule.allowed is not None:
        found.append(_fault(there & ~text.isin(*rule.allowed), path, "not among the allowed values"))
    if rule.pattern is not None:
        found.append(_fault(there & ~text.rlike(rule.pattern), path, "not in the expected form"))
    if rule.least:
        found.append(_fault(F.size(elements) < rule.least, path, f"at least {rule.least} expected"))
    if rule.only is not None:
        extra = F.map_keys(members)
        extra = F.filter(extra, lambda k: ~k.isin(*rule.only)) if rule.only else extra
        listed = F.transform(extra, lambda k: F.struct(_child(path, k).alias("path"), F.lit("not expected here").alias("error")))
        found.append(F.coalesce(listed, F.array().cast("array<struct<path:string,error:string>>")))
    return found


def _child(path: Column, name: Column) -> Column:
    return F.concat(path, F.lit("/"), name)


def _members_type(node: _Node) -> T.DataType | None:
    """What an object is taken apart as: the members that rules name, or all where they read every name."""
    names = [n for n in node.below if n != ELEMENT]
    alike = len({n.lower() for n in names}) < len(names)
    if names == [ANY]:
        return T.MapType(T.StringType(), _type_of(node.below[ANY]))
    if ANY in names or alike or any(r.only is not None for r in node.rules):
        return T.MapType(T.StringType(), T.VariantType())
    return T.StructType([T.StructField(n, _type_of(node.below[n])) for n in names]) if names else None


def _elements_type(node: _Node) -> T.DataType | None:
    if ELEMENT in node.below:
        return T.ArrayType(_type_of(node.below[ELEMENT]))
    return T.ArrayType(T.StructType()) if any(r.least for r in node.rules) else None


def _type_of(node: _Node) -> T.DataType:
    """What a value is cast to: its parts where rules read nothing else, which copies no more than those."""
    own = any(r.required or r.kind or r.allowed is not None or r.pattern is not None or r.least for r in node.rules)
    members, elements = _members_type(node), _elements_type(node)
    return T.VariantType() if own or (members is None) == (elements is None) else members or elements


def _faults(node: _Node, value: Column, path: Column, kind: T.DataType) -> Column:
    """Failures of a value of a type and of what is below it; its parts are taken out once."""
    if not isinstance(kind, T.VariantType):
        return _all_faults(node, value, value, value, path)
    parts = {"m": _members_type(node), "e": _elements_type(node)}
    taken = [value.try_cast(t).alias(name) for name, t in parts.items() if t is not None]
    if not taken:
        return _all_faults(node, value, F.lit(None), F.lit(None), path)
    part = lambda t, name: t[name] if parts[name] is not None else F.lit(None)
    return _bound(F.struct(*taken), lambda t: _all_faults(node, value, part(t, "m"), part(t, "e"), path))


def _all_faults(node: _Node, value: Column, members: Column, elements: Column, path: Column) -> Column:
    found = [fault for rule in node.rules for fault in _own_faults(rule, value, members, elements, path)]
    empty = F.array().cast("array<struct<path:string,error:string>>")
    of_members = _members_type(node)
    for name, below in node.below.items():
        if name == ELEMENT:
            kind = _type_of(below)
            inner = F.transform(elements, lambda e, i: _faults(below, e, _child(path, i.cast("string")), kind))
            found.append(F.coalesce(F.flatten(inner), empty))
        elif name == ANY:
            entries = F.map_entries(members)
            inner = F.transform(entries, lambda e: _faults(below, e["value"], _child(path, e["key"]), of_members.valueType))
            found.append(F.coalesce(F.flatten(inner), empty))
        else:
            kind = of_members[name].dataType if isinstance(of_members, T.StructType) else of_members.valueType
            inner = _bound(members[name], lambda v: _faults(below, v, _child(path, F.lit(name)), kind))
            found.append(F.when(members.isNotNull(), inner).otherwise(empty))
    return (F.flatten(F.array(*found)) if len(found) > 1 else found[0]) if found else empty


def record_faults(value: Column, rules: list[PathRule]) -> Column:
    """All failures of a VARIANT record as an array of ``(path, error)``."""
    root = _Node()
    for rule in rules:
        root.at(path_steps(rule.path) if rule.path else ()).rules.append(rule)
    return _faults(root, value, F.lit(""), T.VariantType())


def validate_records(
    records: DataFrame, rules: dict[str, list[PathRule]], entity_type: str, identifier: str, record: str
) -> DataFrame:
    """Failures as ``(entity_type, identifier, path, error)``, one row each, in one narrow pass.

    ``record`` is a column of JSON text or VARIANT.  Text that is no JSON is a failure of its own; a type
    without rules is not checked.
    """
    kind = records.schema[record].dataType
    value = F.col(record) if isinstance(kind, T.VariantType) else F.try_parse_json(F.col(record))
    found = F.lit(None).cast("array<struct<path:string,error:string>>")
    for name, own in rules.items():
        found = F.when(F.col("entity_type") == name, record_faults(F.col("_record"), own)).otherwise(found)
    unread = _fault(F.col("_record").isNull(), F.lit(""), "not readable as JSON")
    read = records.select(
        F.col(entity_type).alias("entity_type"), F.col(identifier).cast("string").alias("identifier"), value.alias("_record")
    )
    failures = F.when(F.col("_record").isNull(), unread).otherwise(found)
    return read.select("entity_type", "identifier", F.inline(failures))
