"""Entities that arrive ready-made: scoping, version upgrade, customData domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_present
from .notes import note_rows

PREDICATES = ("has", "for")


def in_project(project_id: str) -> Column:
    """Does an entity of ``(entity_type, identifier, season)`` belong to the project?

    Only creative works can belong to another project.  A work belongs when one of its own
    identifiers, or one its season reference carries, equals the project's whole identifier.
    """
    named = lambda ids: F.coalesce(
        F.exists(ids, lambda i: i["identifierValue"] == project_id), F.lit(False)
    )
    seasons = F.flatten(F.transform("season", lambda s: s["identifier"]))
    return (
        (F.coalesce(F.col("entity_type"), F.lit("")) != "CreativeWork") | named(F.col("identifier")) | named(seasons)
    )


def scope_to_project(entities: DataFrame, project_id: str) -> DataFrame:
    return entities.filter(in_project(project_id))


def out_of_project(entities: DataFrame, project_id: str) -> DataFrame:
    """One row: how many entities the scope drops."""
    return entities.agg(F.count_if(~in_project(project_id)).alias("dropped"))


def _plain_object(kind: Column) -> Column:
    return F.startswith(kind, F.lit("OBJECT"))


def name_domains(custom: DataFrame) -> DataFrame:
    """Lift the keys of a domain map to domains.

    ``custom(..., domain, value)`` with ``value`` as JSON text.  An entry without a domain whose
    every value is an object becomes one entry per key; any other entry is left as it is.  The
    ``changed`` column says which.
    """
    variant = F.try_parse_json("value")
    members = F.try_variant_get(variant, "$", "map<string,variant>")
    others = [c for c in custom.columns if c not in ("domain", "value")]
    typed = custom.withColumn("_members", F.when(_plain_object(F.schema_of_variant(variant)), members))
    lifted = (
        ~is_present("domain")
        & (F.size("_members") > 0)
        & F.forall(F.map_values("_members"), lambda v: _plain_object(F.schema_of_variant(v)))
    )
    entry = F.when(
        F.coalesce(lifted, F.lit(False)),
        F.transform(
            F.map_entries("_members"),
            lambda e: F.struct(e["key"].alias("domain"), F.to_json(e["value"]).alias("value"), F.lit(True).alias("changed")),
        ),
    ).otherwise(F.array(F.struct(F.col("domain"), F.col("value"), F.lit(False).alias("changed"))))
    return typed.select(*others, F.explode(entry).alias("_e")).select(*others, "_e.*")


def upgrade_context(contexts: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Bring context entities to the target version: ``(entities, edges)``.

    ``contexts(entity_id, schema_version, context_type, properties, has, for_, custom_data)``:
    ``properties`` and ``custom_data`` are JSON text, ``has`` and ``for_`` JSON maps of target type
    to references.  Properties move under their sub-type, the predicates become edge rows, and
    customData becomes a list with no domain.  An entity already at the target version is passed
    through, so a second run adds nothing.
    """
    old = F.coalesce(F.col("schema_version") != target, F.lit(True))
    nested = F.concat(F.lit('{"'), "context_type", F.lit('":'), "properties", F.lit("}"))
    wrapped = F.concat(F.lit('[{"domain":null,"value":'), "custom_data", F.lit("}]"))
    entities = contexts.select(
        "entity_id",
        F.lit(target).alias("schema_version"),
        F.when(old & is_present("properties"), nested).otherwise(F.col("properties")).alias("properties"),
        F.when(old & is_present("custom_data"), wrapped).otherwise(F.col("custom_data")).alias("custom_data"),
    )
    reference = "map<string,array<struct<identifier:array<struct<identifierScope:string,identifierValue:string>>>>>"
    hoisted = F.array(
        *[
            F.struct(F.lit(p).alias("edge_key"), F.from_json(F.col("for_" if p == "for" else p), reference).alias("targets"))
            for p in PREDICATES
        ]
    )
    edges = (
        contexts.filter(old)
        .select("entity_id", F.inline(hoisted))
        .select("entity_id", "edge_key", F.explode("targets").alias("to_type", "_refs"))
        .select("entity_id", "edge_key", "to_type", F.explode("_refs").alias("_ref"))
        .select("entity_id", "edge_key", "to_type", F.try_element_at(F.col("_ref.identifier"), F.lit(1))["identifierValue"].alias("to_value"))
    )
    return entities, edges


def append_source_identifier(
    identifiers: DataFrame, entities: DataFrame, entity_type: str, scope: str, value: str
) -> DataFrame:
    """Give one entity type a second identifier: the source's own name for the thing."""
    second = entities.filter(is_present(value)).select(
        F.lit(entity_type).alias("entity_type"), "entity_id", F.lit(1).alias("ordinal"),
        F.lit(scope).alias("scope"), F.col(value).cast("string").alias("value"),
    )
    return identifiers.unionByName(second)


def missing_source_identifier(entities: DataFrame, value: str) -> DataFrame:
    """One row: entities that did not get a second identifier."""
    return entities.agg(F.count_if(~is_present(value)).alias("missing"))


def version_notes(versions: DataFrame, target: str) -> DataFrame:
    return note_rows(
        versions.filter("migrated"), "migrated", F.col("version"),
        F.concat(F.col("n"), F.lit(f" entities delivered as {target}")),
    )


def scope_notes(dropped: DataFrame, where: str) -> DataFrame:
    """The note of what a scope dropped, if it dropped anything."""
    return note_rows(
        dropped.filter("dropped > 0"), "outOfProject", where,
        F.concat(F.lit("discarded "), "dropped", F.lit(" creative work(s) belonging to other productions")),
    )


def domain_notes(named: DataFrame, identifier: str, where: str) -> DataFrame:
    """The note of how many entities had their customData domains named by ``name_domains``."""
    counted = named.filter("changed").agg(F.count_distinct(F.col(identifier)).alias("n")).filter("n > 0")
    return note_rows(
        counted, "customDataDomains", where,
        F.concat(F.lit("named the customData domain on "), "n", F.lit(" entities from the source's own key")),
    )


def identifier_notes(missing: DataFrame, where: str, scope: str) -> DataFrame:
    """The note of entities that got no second identifier."""
    return note_rows(
        missing.filter("missing > 0"), "sourceIdentifierMissing", where,
        F.concat("missing", F.lit(f" entities did not receive a {scope} identifier")),
    )
