"""Property paths to nested structs."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP = re.compile(r"^(\w+)(?:\[(\d+)\])?$")


def _insert(tree: dict, steps: list[str], column: str) -> None:
    match = STEP.match(steps[0])
    if not match:
        raise ValueError(f"unreadable path step {steps[0]!r}")
    name, index = match.group(1), match.group(2)
    key = (name, int(index)) if index is not None else (name, None)
    if len(steps) == 1:
        tree[key] = column
    else:
        _insert(tree.setdefault(key, {}), steps[1:], column)


def _column(node) -> Column:
    return F.col(f"`{node}`") if isinstance(node, str) else _all_or_nothing(node)


def _all_or_nothing(tree: dict) -> Column:
    """A struct of the tree's fields; null when all of them are, so empty objects vanish."""
    fields = nested_fields(tree)
    filled = reduce(or_, [value.isNotNull() for value, _ in fields])
    return F.when(filled, F.struct(*[value.alias(name) for value, name in fields]))


def nested_fields(tree: dict) -> list[tuple[Column, str]]:
    names = list(dict.fromkeys(name for name, _ in tree))
    fields = []
    for name in names:
        indexed = sorted(i for n, i in tree if n == name and i is not None)
        if indexed:
            members = F.array_compact(F.array(*[_column(tree[(name, i)]) for i in indexed]))
            fields.append((F.when(F.size(members) > 0, members), name))
        else:
            fields.append((_column(tree[(name, None)]), name))
    return fields


def nest(paths: list[str]) -> list[Column]:
    """Columns that nest flat path-named columns: ``a.b`` and ``a[0].b``.

    The paths are known at plan time, so this is a projection.
    """
    tree: dict = {}
    for path in paths:
        _insert(tree, path.split("."), path)
    return [value.alias(name) for value, name in nested_fields(tree)]
