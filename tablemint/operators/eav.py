"""Name/value metadata.

A record carries its metadata as an array of pairs, so turning pairs into columns is a
projection of one row.  Only metadata that is already a long table needs a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import is_present
from ..functions.text import _col
from .notes import note_rows
from .order import order_of


def named_pairs(pairs: Column | str, name: str = "name") -> Column:
    """Pairs that have a name; the others cannot become a column."""
    return F.filter(_col(pairs), lambda p: is_present(p[name]))


def pair_value(pairs: Column | str, wanted: str, name: str = "name", value: str = "value") -> Column:
    """The value under one name; the last duplicate wins."""
    return F.try_element_at(F.filter(_col(pairs), lambda p: p[name] == wanted), F.lit(-1))[value]


def pairs_to_map(pairs: Column | str, name: str = "name", value: str = "value") -> Column:
    """All pairs of a record as a map under their verbatim names; the last duplicate wins."""
    kept = named_pairs(pairs, name)
    names = F.array_distinct(F.transform(kept, lambda p: p[name]))
    values = F.transform(
        names, lambda n: F.element_at(F.filter(kept, lambda p: p[name] == n), -1)[value]
    )
    return F.map_from_arrays(names, values)


def metadata_columns(df: DataFrame, pairs: str, declared: list[str], rest: str = "metadata_rest") -> DataFrame:
    """Declared names as columns, everything else kept in a map."""
    everything = pairs_to_map(pairs)
    others = F.map_filter(everything, lambda k, v: ~k.isin(*declared)) if declared else everything
    return df.select(
        "*", *[pair_value(pairs, n).alias(n) for n in declared], others.alias(rest)
    )


def long_to_columns(df: DataFrame, key: str, declared: list[str], order: Column | None = None) -> DataFrame:
    """A long ``(key, name, value)`` table with the declared names as columns.

    The names are known, so this is one aggregation that combines on the map side.  The last
    value of a name wins.
    """
    order = order if order is not None else order_of(df)
    wanted = df.filter(F.col("name").isin(*declared))
    return wanted.groupBy(key).agg(
        *[
            F.max_by(
                F.when(F.col("name") == n, F.col("value")), F.when(F.col("name") == n, order)
            ).alias(n)
            for n in declared
        ]
    )


def without_structural_names(metadata: Column | str, structural: list[str]) -> Column:
    """The map without the names that would shadow a structural column."""
    return F.map_filter(_col(metadata), lambda k, v: ~k.isin(*structural))


def shadowed_names(df: DataFrame, metadata: str, structural: list[str]) -> DataFrame:
    """How many records carry each shadowing name."""
    names = F.filter(F.map_keys(metadata), lambda k: k.isin(*structural))
    return (
        df.select(F.explode(names).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    )


def shadowed_notes(df: DataFrame, metadata: str, structural: list[str]) -> DataFrame:
    return note_rows(
        shadowed_names(df, metadata, structural),
        "metadataNameCollision",
        F.col("name"),
        F.concat(
            "n", F.lit(' file(s) carry a metadata field named "'), "name",
            F.lit('", which is also a structural column; the structural value was kept'),
        ),
    )


def frequent_names(names: DataFrame, share: float) -> DataFrame:
    """``(name, n)`` of the names on at least ``share`` of the rows of ``names(name)``, with exact counts.

    Names may be free text, so their number has no bound.  A frequent-items sketch finds candidates in
    memory bounded by ``share`` alone: with 16 / share counters its error is below a quarter of the wanted
    count, so no frequent name is missed.  Only candidates, at most 4 / share of them, are then counted.
    """
    if not 0 < share <= 1:
        raise ValueError("share is above 0 and at most 1")
    counters, most = max(16, math.ceil(16 / share)), max(4, math.ceil(4 / share))
    total = names.agg(F.count("*")).first()[0]
    if not total:
        return names.groupBy("name").agg(F.count("*").alias("n"))
    sketch = names.filter(is_present("name")).agg(F.expr(f"approx_top_k(name, {most}, {counters})").alias("top"))
    candidates = [r["name"] for r in sketch.select(F.explode("top.item").alias("name")).collect()]
    counted = names.filter(F.col("name").isin(*candidates)).groupBy("name").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= math.ceil(share * total))


def open_columns(
    df: DataFrame, pairs: str, share: float, structural: list[str] = (), rest: str = "metadata_rest"
) -> tuple[DataFrame, list[str]]:
    """Pairs with names that at least ``share`` of the records carry as columns, all others kept in a map.

    The names are found in the data; those that shadow a structural column stay in the map, too.  Returns
    the frame and the names, the most frequent first.
    """
    listed = F.array_distinct(F.transform(named_pairs(pairs), lambda p: p["name"]))
    # A record without metadata counts as one that lacks every name.
    names = df.select(F.explode_outer(listed).alias("name"))
    records = df.count()
    rows = names.count()
    found = frequent_names(names, min(1.0, max(share * records / rows, 1e-6))).collect() if rows else []
    taken = {c.lower() for c in [*df.columns, *structural, rest]}
    frequent = [r for r in found if r["n"] >= math.ceil(share * records) and r["name"].lower() not in taken]
    chosen = []
    for r in sorted(frequent, key=lambda r: (-r["n"], r["name"])):
        # Spark takes columns that differ in case only for one, so the more frequent spelling is the column.
        if r["name"].lower() not in {c.lower() for c in chosen}:
            chosen.append(r["name"])
    return metadata_columns(df, pairs, chosen, rest), chosen


#: Size of a distinct-count sketch: 2**14 registers, about 16 KB, and a relative error of about 0.8 %.
SKETCH_BITS = 14


def inventory_sketches(long: DataFrame, by: list[str], bits: int = SKETCH_BITS) -> DataFrame:
    """One row per field and value of ``by`` (a day, a source): counts, origin and a sketch of its values.

    Stored per day, they give the inventory of any set of days without reading the metadata again.
    """
    present_pairs = long.filter(is_present("name") & is_present("value"))
    return present_pairs.groupBy(*by, "name").agg(
        F.count("*").alias("populated"),
        F.bool_or("mutable").alias("mutable"),
        F.hll_sketch_agg(F.col("value").cast("string"), F.lit(bits)).alias("values"),
    )


def merged_inventory(sketches: DataFrame) -> DataFrame:
    """The inventory of all rows of ``inventory_sketches``; distinct counts are estimates."""
    return sketches.groupBy("name").agg(
        F.sum("populated").alias("populated"),
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("distinct_values"),
        F.when(F.bool_or("mutable"), "entered").otherwise("derived").alias("origin"),
    )


def field_inventory(long: DataFrame, examples: int = 3, approximate: bool = False) -> DataFrame:
    """One row per field of ``(name, value, mutable)``: populated and distinct counts, examples.

    Rows are counted per field and value first; a field on every record then weighs as many
    rows as it has distinct values.  The examples are a per-field top-n, which Spark limits
    before the shuffle, so no set of values is collected.  ``approximate`` estimates the distinct counts
    from sketches instead, one row a field and task in the shuffle, and gives no examples.
    """
    if approximate:
        return merged_inventory(inventory_sketches(long, []))
    values = (
        long.filter(is_present("name") & is_present("value"))
        .groupBy("name", "value")
        .agg(F.count("*").alias("n"), F.bool_or("mutable").alias("mutable"))
    )
    fields = values.groupBy("name").agg(
        F.sum("n").alias("populated"),
        F.count("*").alias("distinct_values"),
        F.when(F.bool_or("mutable"), "entered").otherwise("derived").alias("origin"),
    )
    rank = F.row_number().over(W.partitionBy("name").orderBy("value"))
    top = values.select("name", "value", rank.alias("_r")).filter(F.col("_r") <= examples)
    shown = top.groupBy("name").agg(
        *[F.max(F.when(F.col("_r") == i, F.col("value"))).alias(f"example_{i}") for i in range(1, examples + 1)]
    )
    return fields.join(shown, "name", "left")


def unclassified_media(df: DataFrame, media_type: str, matched: str) -> DataFrame:
    """Media types that no rule knew, with counts."""
    return (
        df.filter(~F.col(matched))
        .groupBy(F.coalesce(F.col(media_type), F.lit("(none)")).alias("media_type"))
        .agg(F.count("*").alias("n"))
    )

