"""Diagnostics: every finding is a ``(kind, where, detail)`` row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NOTE_SCHEMA = "kind string, where string, detail string"


def _text(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value.cast("string")


def note_rows(df: DataFrame, kind: Column | str, where: Column | str, detail: Column | str) -> DataFrame:
    """One note per row of ``df``.  A ``str`` is literal text; pass a Column to read data."""
    return df.select(
        _text(kind).alias("kind"), _text(where).alias("where"), _text(detail).alias("detail")
    )


def no_notes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], NOTE_SCHEMA)


def all_notes(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
