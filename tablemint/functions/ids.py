"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def _part(value: Column) -> Column:
    """A seed part with its length in front, so no two part lists spell the same seed."""
    return F.concat(F.length(value).cast("string"), F.lit(":"), value)


def entity_id(entity_type: Column | str, key: Column | str, namespace: str) -> Column:
    """Hash of namespace, type and key.  A ``str`` type is the type's name."""
    kind = F.lit(entity_type) if isinstance(entity_type, str) else entity_type
    key = _col(key).cast("string")
    return F.sha2(F.concat_ws("|", _part(F.lit(namespace)), _part(kind), _part(key)), 256)


def id_combined(scope: Column | str, value: Column | str) -> Column:
    """``scope/value``, the display and lookup form of an identifier."""
    return F.concat_ws("/", _col(scope), _col(value))


def project_identifier(project: str, prefix: str) -> str:
    """The whole identifier of a project; compared by equality, never as a substring."""
    return f"{prefix}{project}"


def child_path(parent: Column | str, name: Column | str, folder: bool) -> Column:
    """Path of a child; a folder's ends with a slash so its children append to it."""
    parts = [_col(parent), F.coalesce(_col(name), F.lit(""))]
    return F.concat(*parts, F.lit("/")) if folder else F.concat(*parts)
