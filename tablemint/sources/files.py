"""File manifests, opening signatures and the delivery layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ext_name, trimmed
from ..functions.text import _col
from ..operators.notes import note_rows
from ..operators.rules import first_rule

# Media type per file extension.
MEDIA_TYPES = {
    ".pdf": "application/pdf",
    ".xml": "application/xml",
    ".csv": "text/csv",
    ".txt": "text/plain",
}


def media_type(extension: Column | str) -> Column:
    return first_rule((_col(extension) == e, F.lit(m)) for e, m in MEDIA_TYPES.items())


def describe_files(files: DataFrame) -> DataFrame:
    """Add name, extension and media type to ``files(path, length)``."""
    return (
        files.withColumn("file_name", F.element_at(F.split("path", "/"), -1))
        .withColumn("file_extension", ext_name("file_name"))
        .withColumn("media_type", media_type("file_extension"))
    )


def file_manifest(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every file below a path.  File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return describe_files(files.select("path", F.col("length").alias("file_size")))


def empty_directories(directories: DataFrame, manifest: DataFrame) -> DataFrame:
    """Notes for listed ``directories(path)`` that hold no file."""
    holding = manifest.select(F.regexp_replace("path", "/[^/]*$", "").alias("path")).distinct()
    return note_rows(
        directories.join(holding, "path", "left_anti"), "emptyDirectory",
        F.element_at(F.split("path", "/"), -1), "delivered empty; nothing to record",
    )


def opening_signature(df: DataFrame, content: str) -> DataFrame:
    """Add ``head``, ``first_line`` and ``xml_root`` of a text or binary content column.

    The whole content is looked at, so a marker after a long comment is found.
    """
    head = F.make_valid_utf8(F.col(content).cast("binary").cast("string"))
    # Trimmed, the opening starts with its first line that is not blank.
    first_line = trimmed(F.substring_index(trimmed("head"), "\n", 1))
    body = F.regexp_replace("head", r"<\?xml[^?]*\?>", "")
    return (
        df.withColumn("head", head)
        .withColumn("first_line", F.coalesce(first_line, F.lit("")))
        .withColumn("xml_root", F.nullif(F.regexp_extract(body, r"<([A-Za-z_][\w.-]*)[\s>]", 1), F.lit("")))
    )


def file_signatures(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Opening signatures of every text file below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    signed = opening_signature(files, "content").drop("content", "modificationTime")
    return describe_files(signed.withColumnRenamed("length", "file_size"))


def wrong_documents(manifest: DataFrame, headers: DataFrame, root: str) -> DataFrame:
    """Notes for files in which the expected root element was not found."""
    found = headers.select(F.col("file_path").alias("path")).distinct()
    return note_rows(
        manifest.join(found, "path", "left_anti"), "wrongDocument", F.col("path"), f"not a {root} document"
    )


def day_path(root: str, production: str, source: str, day: str | int) -> str:
    """One day of one source, laid out so that Spark prunes by production, source and day."""
    return f"{root.rstrip('/')}/production={production}/source={source}/day={day}"


def read_days(spark: SparkSession, root: str, file_format: str = "parquet", **options: str) -> DataFrame:
    """All days below a root; ``production``, ``source`` and ``day`` are partition columns."""
    return spark.read.format(file_format).options(**options).load(root)
