"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(key: str, modulus: int) -> Column:
    """Fold number of a row: CRC-32 of its key as text; 0 for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % modulus, F.lit(0))


def words(text: str | None) -> list[bytes]:
    """Words as UTF-8, split at the six ASCII white-space characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased; other letters stay."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Hand Python few rows at once: texts are long, and a worker holds a batch in several forms."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, picked by a hash of the key.

    The hash thins all rows before the exact cut, so tasks send what is taken, however many they are.
    """
    total = df.count()
    order = F.xxhash64(F.col(key), F.lit("sample"))
    if total > rows:
        df = df.filter(F.pmod(order, F.lit(total)) < rows)
    return df.orderBy(order, key).limit(rows)


#: What a document carries besides the columns that an operator reads.
CARRIED = "carried"


def set_apart(docs: DataFrame, *read: str) -> DataFrame:
    """``docs`` with the columns an operator reads, and all others in one struct, where no name of theirs
    can meet one of the operator's own."""
    others = [c for c in docs.columns if c not in read]
    fields = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)]
    return docs.select(*read, F.struct(*fields, F.lit(True).alias("there")).alias(CARRIED))


def put_back(df: DataFrame, columns: list[str], *read: str, keep: dict[str, Column] | None = None) -> DataFrame:
    """The columns of the documents again, in their order, after ``set_apart``; then those of ``keep``, which
    take the place of columns of their names."""
    others = [c for c in columns if c not in read]
    own = [F.col(f"`{c}`") if c in read else F.col(CARRIED)[f"_{others.index(c)}"].alias(c) for c in columns]
    taken = {name.lower() for name in keep or {}}
    kept = [value.alias(name) for name, value in (keep or {}).items()]
    return df.select(*[value for c, value in zip(columns, own) if c.lower() not in taken], *kept)
