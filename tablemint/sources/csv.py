"""Delimited deliveries: no typing, blanks null, malformed rows kept and reported."""

from __future__ import annotations

import csv
from functools import reduce
from operator import or_
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean_text
from ..operators.order import ORDER
from ..session import stage

CORRUPT = "_malformed"
# A well-formed cell loses its enclosing quotes.  One that still has them, with more quotes
# inside, was written without escaping the inner ones.
UNESCAPED = r'(?s)^".*".*"'


#: File headers that are sent to all tasks to tell header lines from rows; more are joined by a shuffle.
BROADCAST_HEADERS = 100_000


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their file and place."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
    )


def _headers(lines: DataFrame) -> DataFrame:
    """``(file, at, header, odd)``: a file's first line that is not blank, and whether any line has an odd
    number of quotes, as one has that ends inside a quoted cell."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    first = F.min(F.when((F.col("block") == 0) & (F.trim("value") != ""), F.struct("at", "value")))
    found = lines.groupBy("file").agg(first.alias("first"), F.bool_or(quotes % 2 == 1).alias("odd"))
    return found.filter("first is not null").select("file", "first.at", F.col("first.value").alias("header"), "odd")


def _names(header: str) -> list[str]:
    return next(csv.reader([header.lstrip("\ufeff").rstrip("\r")]))


def csv_rows(
    spark: SparkSession, path: str | list[str], columns: list[str] | None = None, multiline: bool | None = None
) -> DataFrame:
    """Rows keyed by header name, all text, with ``_malformed`` set on rows that do not parse.

    A malformed row stays in the data with what could be read of it: a row with too few or too many
    cells, or with quotes inside a quoted cell that are not escaped.  Each file is read by its own header,
    so columns may come in another order or be missing in some files.

    Files are read line by line and split, unless some line has an odd number of quotes: cells then hold
    line breaks, and such deliveries are read one file per task.  ``multiline`` says which without looking.
    """
    lines = _lines(spark, path)
    heads = stage(_headers(lines), "csv-headers")
    # One row per layout; the files that have it stay in Spark.
    layouts = [tuple(r) for r in heads.groupBy("header").agg(F.bool_or("odd"), F.count("*")).orderBy("header").collect()]
    if multiline is None:
        multiline = any(odd for _, odd, _ in layouts)
    if multiline:
        return _multiline_rows(spark, path, columns, heads, [header for header, _, _ in layouts])
    if not layouts:
        return _parsed_lines(lines.filter("false"), columns or [])
    marked = heads.select(F.col("file").alias("_file"), F.col("at").alias("_at"))
    if sum(n for _, _, n in layouts) <= BROADCAST_HEADERS:
        marked = F.broadcast(marked)
    rows = lines.filter(F.trim("value") != "")
    rows = rows.join(marked, (F.col("file") == F.col("_file")) & (F.col("at") == F.col("_at")), "left")
    # A header line has no value, so that no condition on cells that Spark takes first meets its names.
    rows = rows.withColumn("value", F.when(F.col("_at").isNull(), F.col("value"))).filter("_at is null").drop("_file", "_at")
    if columns is not None or len(layouts) == 1:
        return _parsed_lines(rows, columns or _names(layouts[0][0]))
    by_file = heads.select(F.col("file").alias("_file"), F.col("header").alias("_header"))
    named = rows.join(by_file, F.col("file") == F.col("_file"))
    parts = [_parsed_lines(named.filter(F.col("_header") == header), _names(header)) for header, _, _ in layouts]
    return _together(parts)


def _together(parts: list[DataFrame]) -> DataFrame:
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    last = [CORRUPT, "file_path", ORDER]
    return rows.select(*[f"`{c}`" for c in rows.columns if c not in last], *last)


def _schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])


def _parsed_lines(lines: DataFrame, names: list[str]) -> DataFrame:
    """Rows of lines that are whole records.  The line itself says whether it is well formed."""
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    cells = F.from_csv("value", F.lit(_schema(names).toDDL()), options)
    # Less escaped quotes and quoted cells, a quote that begins a cell has no end, and commas count cells.
    quoted = F.regexp_replace(F.replace("value", F.lit('""'), F.lit("")), '(^|,)"[^"]*"(?=,|$)', "$1")
    bare = F.when(F.contains("value", F.lit('"')), quoted).otherwise(F.col("value"))
    commas = F.octet_length("_bare") - F.octet_length(F.replace("_bare", F.lit(","), F.lit("")))
    wrong = (commas + 1 != len(names)) | (F.contains("_bare", F.lit('"')) & F.col("_bare").rlike('(^|,)"'))
    # Both are columns first, as they are used more than once.
    return lines.withColumns({"_cells": cells, "_bare": bare}).select(
        *[clean_text(F.col("_cells")[c]).alias(c) for c in names],
        F.when(wrong, F.col("value")).alias(CORRUPT),
        F.col("file").alias("file_path"),
        F.struct("file", "block", F.col("at").alias("row")).alias(ORDER),
    )


def _multiline_rows(
    spark: SparkSession, path: str | list[str], columns: list[str] | None, heads: DataFrame, layouts: list[str]
) -> DataFrame:
    """Rows of files with line breaks inside cells, each file read whole by one task."""
    if columns is None and len(layouts) > 1:
        # A reader has one schema, so it is given the files of each layout.
        files = heads.select("header", "file").orderBy("file").collect()
        parts = [_read_whole(spark, [unquote(r["file"]) for r in files if r["header"] == h], _names(h)) for h in layouts]
        return _together(parts)
    return _read_whole(spark, path, columns or _names(layouts[0]))


def _read_whole(spark: SparkSession, path: str | list[str], names: list[str]) -> DataFrame:
    rows = (
        spark.read.option("header", "true")
        .option("escape", '"')
        .option("multiLine", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(_schema(names))
        .csv(path)
    )
    cells = [F.col(f"`{c}`") for c in names]
    unescaped = reduce(or_, [F.coalesce(c.rlike(UNESCAPED), F.lit(False)) for c in cells])
    malformed = F.coalesce(F.col(CORRUPT), F.when(unescaped, F.concat_ws(",", *cells)))
    return rows.select(
        *[clean_text(f"`{c}`").alias(c) for c in names],
        malformed.alias(CORRUPT),
        F.col("_metadata.file_path").alias("file_path"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(ORDER),
    )


def malformed_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(CORRUPT).isNotNull())
