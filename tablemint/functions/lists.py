"""Delimited cells and arrays."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, trimmed

# The fields a member object is named by, in order of preference.
NAMING_FIELDS = ("display_name", "name", "email", "id")


def split_members(value: Column | str, delimiter: str) -> Column:
    """Members of a delimited cell, trimmed, without blanks, in the order written."""
    parts = F.split(_col(value).cast("string"), re.escape(delimiter))
    return F.filter(F.transform(parts, trimmed), lambda part: part != "")


def split_list(value: Column | str, delimiter: str) -> Column:
    """Members of a delimited cell as a sorted set, so two orders of one set are equal."""
    return F.array_sort(F.array_distinct(split_members(value, delimiter)))


def join_list(members: Column | str) -> Column:
    """Present members joined with ``'; '``; an empty list is null."""
    kept = F.filter(_col(members), lambda part: part.isNotNull() & (part != ""))
    return F.nullif(F.array_join(kept, "; "), F.lit(""))


def named_members(members: Column | str, fields: tuple[str, ...] = NAMING_FIELDS) -> Column:
    """Objects of an array joined with ``'; '`` by the first naming field each one has."""
    return F.array_join(
        F.transform(_col(members), lambda m: F.coalesce(*[m[f] for f in fields])), "; "
    )
