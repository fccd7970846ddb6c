"""Table sets as CSV, one folder per table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.order import data_columns


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location, jvm


#: Folder beside the tables that names those a run has written; readers of tables skip it.
MANIFEST = "_tables"


def written_tables(spark: SparkSession, out: str) -> set[str]:
    """Names of the tables that the last run wrote to ``out``."""
    files, location, _ = _file_system(spark, f"{out}/{MANIFEST}")
    if not files.exists(location):
        return set()
    return {r.value for r in spark.read.text(f"{out}/{MANIFEST}").collect()}


def prune_stale(spark: SparkSession, out: str, keep: set[str]) -> list[str]:
    """Delete the tables that an earlier run recorded and this run does not have; returns their names.

    Folders that no run recorded are not touched.
    """
    stale = sorted(written_tables(spark, out) - keep)
    for name in stale:
        files, location, _ = _file_system(spark, f"{out}/{name}")
        files.delete(location, True)
    return stale


def write_table_set(tables: dict[str, DataFrame], out: str) -> list[str]:
    """Write every table with a header row and prune the tables no longer produced.

    Each table is finished in a folder of its own before it takes the place of the last one.
    """
    for name, df in tables.items():
        pending = staging_path(f"{out}/{name}")
        df.select(*[f"`{c}`" for c in data_columns(df)]).write.option("header", "true").option("escape", '"').csv(pending)
        publish(df.sparkSession, pending, f"{out}/{name}")
    if tables:
        spark = next(iter(tables.values())).sparkSession
        prune_stale(spark, out, set(tables))
        names = spark.createDataFrame([(name,) for name in sorted(tables)], "value string")
        names.coalesce(1).write.mode("overwrite").text(f"{out}/{MANIFEST}")
    return [f"{out}/{name}" for name in tables]


def write_json(df: DataFrame, path: str) -> str:
    """Nested rows as JSON lines; null fields are left out."""
    df.write.mode("overwrite").json(path)
    return path


def _beside(out: str, suffix: str) -> str:
    """A hidden name in the folder that holds ``out``."""
    parent, slash, name = out.rstrip("/").rpartition("/")
    return f"{parent}{slash}.{name}.{suffix}"


def staging_path(out: str) -> str:
    """A hidden folder beside ``out`` that no other run uses."""
    return _beside(out, uuid.uuid4().hex)


def publish(spark: SparkSession, staged: str, out: str) -> None:
    """Put a finished staging folder in the place of the previous output.

    The previous output is moved aside, and deleted only when the new one stands.  It is moved back
    when that fails, or by the next call when this one died in between.
    """
    files, source, jvm = _file_system(spark, staged)
    target = jvm.org.apache.hadoop.fs.Path(out)
    aside = jvm.org.apache.hadoop.fs.Path(_beside(out, "previous"))
    if files.exists(aside):
        if files.exists(target):
            files.delete(aside, True)
        else:
            files.rename(aside, target)
    if not files.exists(source):
        raise FileNotFoundError(staged)
    if files.exists(target) and not files.rename(target, aside):
        raise OSError(f"could not move {out} aside")
    published = False
    try:
        published = files.rename(source, target)
    finally:
        if not published and files.exists(aside):
            files.rename(aside, target)
    if not published:
        raise OSError(f"could not publish {staged} as {out}")
    files.delete(aside, True)
