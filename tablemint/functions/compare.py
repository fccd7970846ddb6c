"""Comparison forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, is_present


def compare_value(value: Column | str, normalize: Callable[[Column], Column] | None) -> Column:
    """Blank is null; otherwise the field's own normal form, as text."""
    value = _col(value)
    text = value.cast("string")
    return F.when(is_present(value), normalize(text) if normalize else text)
