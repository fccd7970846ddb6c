"""Edges as rows: resolution, inverse, external targets and integrity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import entity_id, present, split_list
from .notes import note_rows

EDGE_COLUMNS = [
    "from_type", "from_key", "from_id", "edge_key", "to_type", "to_key", "to_id", "external", "inverse",
]


def edge_targets(rows: DataFrame, key: Column | str, via: str, split: str | None = None) -> DataFrame:
    """Distinct ``(from_key, to_key)`` pairs named by a column, one per member of a split cell."""
    key = F.col(key) if isinstance(key, str) else key
    value = present(f"`{via}`").cast("string")
    if split:
        pairs = rows.select(key.cast("string").alias("from_key"), F.explode(split_list(value, split)).alias("to_key"))
    else:
        pairs = rows.select(key.cast("string").alias("from_key"), value.alias("to_key")).filter("to_key is not null")
    return pairs.distinct()


def edge_rows(
    pairs: DataFrame, from_type: str, to_type: str, namespace: str,
    edge_key: str = "has", external: bool = False,
) -> DataFrame:
    """Complete edge rows from key pairs.  Both ids are computed from keys; neither is joined."""
    return with_edge_ids(keyed_edges(pairs, from_type, to_type, edge_key, external), namespace)


def keyed_edges(pairs: DataFrame, from_type: str, to_type: str, edge_key: str = "has", external: bool = False) -> DataFrame:
    """Edge rows without their ids, which are long and say no more than the keys."""
    return pairs.select(
        F.lit(from_type).alias("from_type"),
        "from_key",
        F.lit(edge_key).alias("edge_key"),
        F.lit(to_type).alias("to_type"),
        "to_key",
        F.lit(external).alias("external"),
        F.lit(False).alias("inverse"),
    )


def with_edge_ids(edges: DataFrame, namespace: str) -> DataFrame:
    """Complete edge rows from those without ids."""
    ids = {f"{end}_id": entity_id(F.col(f"{end}_type"), f"{end}_key", namespace) for end in ("from", "to")}
    return edges.withColumns(ids).select(*EDGE_COLUMNS)


def resolved(pairs: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs whose target was built; ``targets(key)`` is unique, so no pair multiplies."""
    return pairs.join(targets.select(F.col("key").alias("to_key")), "to_key", "left_semi").select("from_key", "to_key")


def unresolved(pairs: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs whose target was not built."""
    return pairs.join(targets.select(F.col("key").alias("to_key")), "to_key", "left_anti").select("from_key", "to_key")


def with_inverse(edges: DataFrame, edge_key: str = "for") -> DataFrame:
    """Each edge and its mirror row, from one reading of the edges; external targets have no mirror.

    Edges may come without ids, and are then given without.
    """
    mirror = {
        "from_type": F.col("to_type"), "from_key": F.col("to_key"), "from_id": F.col("to_id"), "edge_key": F.lit(edge_key),
        "to_type": F.col("from_type"), "to_key": F.col("from_key"), "to_id": F.col("from_id"),
        "external": F.lit(False), "inverse": F.lit(True),
    }
    columns = [c for c in EDGE_COLUMNS if c in edges.columns]
    row = F.struct(*[F.col(c) for c in columns])
    mirrored = F.struct(*[mirror[c].alias(c) for c in columns])
    both = F.when(F.col("external"), F.array(row)).otherwise(F.array(row, mirrored))
    return edges.select(F.inline(both))


def unknown_targets(edges: DataFrame, identifiers: DataFrame, built_types: list[str]) -> DataFrame:
    """Edges whose target id no entity carries; ``dangling`` where its type was built.

    ``edges(from_id, to_type, to_id, ...)``, ``identifiers(entity_id)``.  A type that was not built
    here is a reference to a later pass, not an error.
    """
    known = identifiers.select(F.col("entity_id").alias("to_id")).distinct()
    return edges.join(known, "to_id", "left_anti").withColumn("dangling", F.col("to_type").isin(*built_types))


def dangling_edges(edges: DataFrame, identifiers: DataFrame, built_types: list[str]) -> DataFrame:
    return unknown_targets(edges, identifiers, built_types).filter("dangling").select("from_id", "to_type", "to_id")


def external_counts(edges: DataFrame, identifiers: DataFrame, built_types: list[str]) -> DataFrame:
    return (
        unknown_targets(edges, identifiers, built_types)
        .filter(~F.col("dangling"))
        .groupBy("to_type")
        .agg(F.count("*").alias("n"))
    )


# --- nested edges ---------------------------------------------------------------------


def explode_edges(entities: DataFrame, edges: str = "edges") -> DataFrame:
    """Nested ``predicate -> type -> [reference]`` JSON as rows.

    ``edges`` is JSON text.  One row per reference; a node that is no list of references gives one
    row with ``malformed`` set to what was found instead, and nothing fails.
    """
    parsed = F.try_variant_get(F.try_parse_json(F.col(edges)), "$", "map<string,variant>")
    by_type = entities.select("*", F.explode(parsed).alias("edge_key", "_types"))
    by_node = by_type.select(
        *entities.columns, "edge_key",
        F.explode(F.try_variant_get("_types", "$", "map<string,variant>")).alias("to_type", "_node"),
    )
    kind = F.schema_of_variant("_node")
    is_list = F.startswith(kind, F.lit("ARRAY"))
    found = (
        F.when(is_list, F.lit(None))
        .when(F.col("_node").isNull() | (kind == "VOID"), "null")
        .when(F.startswith(kind, F.lit("OBJECT")), "object")
        .when(kind.isin("BIGINT", "DOUBLE") | F.startswith(kind, F.lit("DECIMAL")), "number")
        .otherwise(F.lower(kind))
    )
    nodes = by_node.withColumn("malformed", found)
    references = F.when(is_list, F.try_variant_get("_node", "$", "array<variant>"))
    refs = nodes.select(
        *entities.columns, "edge_key", "to_type", "malformed", F.explode_outer(references).alias("_ref")
    )
    # An empty list is well-formed and has no reference.
    kept = refs.filter(F.col("malformed").isNotNull() | F.col("_ref").isNotNull())
    path = "$.identifier[0]"
    return kept.select(
        *[c for c in entities.columns if c != edges], "edge_key", "to_type", "malformed",
        F.try_variant_get("_ref", f"{path}.identifierScope", "string").alias("to_scope"),
        F.try_variant_get("_ref", f"{path}.identifierValue", "string").alias("to_value"),
    )


def malformed_notes(exploded: DataFrame, identifier: str) -> DataFrame:
    return note_rows(
        exploded.filter("malformed is not null"), "malformedEdge", F.col(identifier),
        F.concat(F.col("to_type"), F.lit(": expected an array of references, found "), F.col("malformed")),
    )
