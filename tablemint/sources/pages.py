"""Landed API pages and bundles of JSON arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_pages(spark: SparkSession, path: str | list[str], item: T.DataType | str, multiline: bool = False) -> DataFrame:
    """Landed pages as ``(data, has_more, next, file_path)``.

    ``item`` is the type of one entity.  A page is ``{data, pagination:{hasMore}}`` or
    ``{data, links:{next}}``; what a page lacks is null.
    """
    kind = item if isinstance(item, str) else item.simpleString()
    schema = f"data array<{kind}>, pagination struct<hasMore:boolean>, links struct<next:string>"
    pages = spark.read.schema(schema).option("multiLine", str(multiline).lower()).json(path)
    return pages.select(
        "data",
        F.coalesce("pagination.hasMore", F.lit(False)).alias("has_more"),
        F.col("links.next").alias("next"),
        F.col("_metadata.file_path").alias("file_path"),
    )


def page_items(pages: DataFrame) -> DataFrame:
    """All entities of all pages; one narrow explode."""
    kept = [c for c in pages.columns if c != "data"]
    return pages.select(*kept, F.explode("data").alias("item")).select(*kept, "item.*")


def unwrap_envelope(df: DataFrame, data: str, body: str) -> DataFrame:
    """A resource answered inside ``data`` or bare."""
    return df.withColumn("resource", F.coalesce(F.col(data), F.col(body)))


def json_bundle(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """A bundle of JSON arrays, one file per entity type."""
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """A bundle written as one JSON object per line, which large files can be split at."""
    return spark.read.schema(schema).json(path)
