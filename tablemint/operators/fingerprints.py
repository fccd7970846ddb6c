"""Comparing two runs by fingerprints of their rows, and reading rows only where those differ.

The rows of a run are dealt to buckets by a hash of the row.  A bucket's fingerprint is a count and two
sums of independent 64-bit row hashes, so it does not depend on row order, counts repeated rows, and adds
up: the fingerprint of a day's rows plus that of the next is that of both.  Buckets add up to groups of
buckets and those to the run, so two runs are compared from the top down.  A stored fingerprint stands
for its run; equal runs are told equal without reading any row of either again.

Two different row sets of a bucket pass as equal with a probability of about 2 to the power of -120.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of a run, and buckets to a group; a comparison broadcasts at most so many bucket numbers.
BUCKETS = 4_096
GROUP = 64

_SUM = "decimal(38,0)"


def _hash(columns: list[str], salt: str) -> Column:
    """A row hash that tells null from absent values: nulls are marked beside the values."""
    quoted = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(F.lit(salt), *[c for q in quoted for c in (q, q.isNull())])


def row_bucket(columns: list[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(_hash(columns, "bucket"), F.lit(buckets)).cast("int")


def fingerprint(df: DataFrame, buckets: int = BUCKETS, columns: list[str] | None = None) -> DataFrame:
    """``(bucket, n, a, b)`` of the rows of ``df``; buckets without rows are absent.

    One aggregate with a map-side step: a task sends at most one row a bucket, whatever the input.
    Columns are taken in name order, so their order in ``df`` makes no difference.
    """
    names = sorted(columns or df.columns)
    return df.groupBy(row_bucket(names, buckets).alias("bucket")).agg(
        F.count("*").alias("n"),
        F.sum(_hash(names, "a").cast(_SUM)).alias("a"),
        F.sum(_hash(names, "b").cast(_SUM)).alias("b"),
    )


def added(*prints: DataFrame) -> DataFrame:
    """The fingerprint of all rows together: days, files or partitions add up."""
    both = prints[0]
    for other in prints[1:]:
        both = both.unionByName(other)
    return both.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("a").cast(_SUM).alias("a"), F.sum("b").cast(_SUM).alias("b"))


def _differing(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose figures differ, by the difference of sums; a key that one side lacks has zeros there."""
    signed = first.select(*keys, "n", "a", "b").union(second.select(*keys, -F.col("n"), -F.col("a"), -F.col("b")))
    summed = signed.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "a", "b")])
    return summed.filter("n <> 0 or a <> 0 or b <> 0").select(*keys)


def differing_buckets(first: DataFrame, second: DataFrame, group: int = GROUP) -> DataFrame:
    """Bucket numbers in which two fingerprints differ, found from groups of buckets down."""
    grouped = lambda p: p.withColumn("group", F.floor(F.col("bucket") / group))
    one, two = grouped(first), grouped(second)
    groups = _differing(one, two, ["group"])
    inside = lambda p: p.join(groups, "group", "left_semi")
    return _differing(inside(one), inside(two), ["bucket"])


def level_differences(first: DataFrame, second: DataFrame, group: int = GROUP) -> DataFrame:
    """``(level, differing)``: how many runs, groups and buckets differ, from the top down."""
    grouped = lambda p: p.withColumn("run", F.lit(0)).withColumn("group", F.floor(F.col("bucket") / group))
    one, two = grouped(first), grouped(second)
    levels = [
        _differing(one, two, [key]).agg(F.count("*").alias("differing")).select(F.lit(key).alias("level"), "differing")
        for key in ("run", "group", "bucket")
    ]
    return levels[0].union(levels[1]).union(levels[2])


def rows_of_buckets(df: DataFrame, wanted: DataFrame, buckets: int = BUCKETS, columns: list[str] | None = None) -> DataFrame:
    """The rows of ``df`` in the wanted buckets; at most ``buckets`` numbers are broadcast."""
    names = sorted(columns or df.columns)
    numbered = df.withColumn("_bucket", row_bucket(names, buckets))
    return numbered.join(F.broadcast(wanted.select(F.col("bucket").alias("_bucket"))), "_bucket", "left_semi").select(*df.columns)
