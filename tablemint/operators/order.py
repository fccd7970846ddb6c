"""First and last in source order.

Spark keeps no source order, so an order is a column: ``_ord`` where a reader recorded one,
else the tuple of all columns.  Picking a row is an aggregate rather than a window, because an
aggregate combines on the map side: a key holding a third of all rows still costs one row per
task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import present

ORDER = "_ord"


def with_order(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Record the source order of ``df`` as the tuple of ``columns``."""
    return df.withColumn(ORDER, F.struct(*columns))


def order_of(df: DataFrame) -> Column:
    """The recorded order, or all columns as a total order."""
    if ORDER in df.columns:
        return F.col(ORDER)
    return F.struct(*[_orderable(df, c) for c in sorted(df.columns)])


def _orderable(df: DataFrame, name: str) -> Column:
    """The column itself; a map, which has no order, as its sorted entries."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.MapType):
        return F.array_sort(F.map_entries(column)).alias(name)
    return column


def dense_order(df: DataFrame) -> DataFrame:
    """The recorded order of a reader as one number, 0 for the first row: short to carry through a shuffle.

    ``df`` has the order of a reader: file, block, and a row number that grows within the block.  Blocks
    are summed up in order of file and place, which is one row per input split; a row's number is what
    stands before its block plus its place there.  Rows that were filtered away leave gaps, so a row keeps
    its number whatever is filtered.  The order is read twice: store a frame first that is dear to read
    (``session.stage``), also because a reader must then cut its files only once.
    """
    place = lambda name: F.col(f"{ORDER}.{name}")
    blocks = df.groupBy(place("file").alias("_file"), place("block").alias("_block")).agg(
        F.min(place("row")).alias("_first"), (F.max(place("row")) - F.min(place("row")) + 1).alias("_rows")
    )
    # One row per input split goes to one task here.
    before = F.sum("_rows").over(W.orderBy("_file", "_block").rowsBetween(W.unboundedPreceding, -1))
    starts = blocks.select("_file", "_block", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    same = (place("file") == F.col("_file")) & (place("block") == F.col("_block"))
    return df.join(starts, same).withColumn(ORDER, place("row") + F.col("_shift")).select(*df.columns)


def data_columns(df: DataFrame) -> list[str]:
    """Columns of the table itself, without the recorded order."""
    return [c for c in df.columns if c != ORDER]


def first_present(value: str | Column, order: Column) -> Column:
    """Aggregate: the first present value in source order."""
    value = present(value)
    return F.min_by(value, F.when(value.isNotNull(), order))


def _pick(df: DataFrame, keys: list[str], chooser) -> DataFrame:
    rest = [c for c in data_columns(df) if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    picked = df.groupBy(*keys).agg(chooser(row, order_of(df)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def last_wins(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the last in source order."""
    return _pick(df, keys, F.max_by)


def first_match(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the first in source order."""
    return _pick(df, keys, F.min_by)


def head_of_stack(stacks: DataFrame, children: DataFrame) -> DataFrame:
    """The file each version stack contributes, or null for an empty one.

    ``stacks(id, head_version?)`` may carry its head inline; otherwise the first child of type
    ``file`` is taken, ``children(parent_id, id, type, position)`` being newest first.
    """
    newest = (
        children.filter(F.col("type") == "file")
        .groupBy(F.col("parent_id").alias("id"))
        .agg(F.min_by("id", "position").alias("_newest"))
    )
    inline = F.col("head_version") if "head_version" in stacks.columns else F.lit(None)
    return stacks.join(newest, "id", "left").withColumn(
        "head_id", F.coalesce(inline.cast("string"), F.col("_newest").cast("string"))
    ).drop("_newest")


def top_sample(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows of a report; a top-n, never a full sort."""
    return df.orderBy(*order).limit(n)


def by_name(df: DataFrame, column: str) -> DataFrame:
    """Rows in the locale order of a name."""
    return df.orderBy(F.collate(F.col(column), "UNICODE"), F.col(column))


def by_day(df: DataFrame, column: str) -> DataFrame:
    """Rows in numeric order of a day label; labels that are no number come last."""
    return df.orderBy(F.col(column).try_cast("int").asc_nulls_last(), F.col(column))
