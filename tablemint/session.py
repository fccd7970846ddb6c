"""Session helpers: shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Settings the plans here profit from, for a session's builder.  The method limit is the size above
# which the JVM leaves a generated method uncompiled; wide projections then run faster unfused.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A local session may have none; it then gets a fresh temporary folder.  On a cluster a
    machine-local folder would lose data with its machine, so an unset value is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tablemint-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared folder and continue from the stored copy."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """What runs inside is split where Spark would generate methods too long for the JVM to compile.

    Such a method is interpreted for every row of a wide table.  A lower limit of the session is kept.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    limit, given = RECOMMENDED[key], spark.conf.get(key)
    if int(given) <= int(limit):
        yield
        return
    spark.conf.set(key, limit)
    try:
        yield
    finally:
        spark.conf.set(key, given)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it from there.

    For a frame that several plans read: the source is parsed once, later plans read only the
    columns they need, and the stored table outlives any executor.
    """
    path = scratch_path(df.sparkSession, name)
    with compiled_methods(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
