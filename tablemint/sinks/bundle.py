"""Entity bundles: written whole or not at all."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import entity_id
from ..operators.quality import EntityRule
from ..plans.build import Built
from ..plans.bundle import Seal, require_valid, seal_bundle
from ..plans.nest import nest
from ..session import stage
from .tables import publish, staging_path
from .versions import new_version, publish_version

#: What a bundle holds: one record per entity, and beside them what an entity may have many of.
PARTS = ("entities", "edges", "texts", "customData", "identifiers")
NO_SUB = "named_struct('edge_key', cast(null as string), 'to_type', cast(null as string))"


def _reference(scope: Column, value: Column) -> Column:
    return F.struct(scope.alias("identifierScope"), value.alias("identifierValue"))


def _facts(built: Built, scope: str, extra_identifiers: DataFrame | None) -> DataFrame:
    """All there is to say about every entity, as ``(entity_type, key, slot, sub, json)`` rows.

    The empty slot holds an entity's own properties, so every entity has at least one row.
    """
    frames = []
    for entity_type, df in built.entities.items():
        paths = [c for c in df.columns if c not in ("key", "entity_id")]
        body = F.regexp_replace(F.to_json(F.struct(*nest(paths))), r"^\{|\}$", "") if paths else F.lit("")
        frames.append(
            df.select(
                F.lit(entity_type).alias("entity_type"), "key", F.lit("").alias("slot"), F.expr(NO_SUB).alias("sub"),
                body.alias("json"),
            )
        )
    if built.edges is not None:
        reference = F.to_json(F.struct(F.array(_reference(F.lit(scope), F.col("to_id"))).alias("identifier")))
        frames.append(
            built.edges.select(
                F.col("from_type").alias("entity_type"), F.col("from_key").alias("key"), F.lit("edges").alias("slot"),
                F.struct("edge_key", "to_type").alias("sub"), reference.alias("json"),
            )
        )
    if built.texts is not None:
        frames.append(
            built.texts.select(
                "entity_type", "key", F.col("path").alias("slot"), F.expr(NO_SUB).alias("sub"),
                F.to_json(F.struct("author", "title", "text")).alias("json"),
            )
        )
    if built.custom is not None:
        frames.append(
            built.custom.select(
                "entity_type", "key", F.lit("customData").alias("slot"), F.expr(NO_SUB).alias("sub"),
                F.to_json(F.struct("domain", "namespace", "schema", "value")).alias("json"),
            )
        )
    if extra_identifiers is not None:
        frames.append(
            extra_identifiers.select(
                "entity_type", "key", F.lit("identifier").alias("slot"), F.expr(NO_SUB).alias("sub"),
                F.to_json(_reference(F.col("scope"), F.col("value"))).alias("json"),
            )
        )
    return reduce(DataFrame.unionByName, frames)


def bundle_parts(
    built: Built, schema_version: str, scope: str = "local", extra_identifiers: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The folders of a bundle, the same at every size: no row grows with what an entity has.

    ``entities(entityType, key, record)``: one JSON record per entity with its identifier and its
    own properties.  The others name the entity by ``entityType`` and ``key``: ``edges(edgeKey, toType,
    toKey, toId, external, inverse)``, ``texts(path, author, title, text)``, ``customData(domain,
    namespace, schema, value)``, ``identifiers(identifierScope, identifierValue)``.
    """
    records = []
    for entity_type, df in built.entities.items():
        paths = [c for c in df.columns if c not in ("key", "entity_id")]
        head = [
            F.lit(entity_type).alias("entityType"), F.lit(schema_version).alias("schemaVersion"),
            F.array(_reference(F.lit(scope), F.col("entity_id"))).alias("identifier"),
        ]
        record = F.to_json(F.struct(*head, *(nest(paths) if paths else [])))
        records.append(df.select(F.lit(entity_type).alias("entityType"), "key", record.alias("record")))
    of_entity = [F.col("entity_type").alias("entityType"), F.col("key")]
    own = reduce(DataFrame.unionByName, [
        df.select(
            F.lit(t).alias("entityType"), "key", F.lit(scope).alias("identifierScope"), F.col("entity_id").alias("identifierValue")
        )
        for t, df in built.entities.items()
    ])
    parts = {"entities": reduce(DataFrame.unionByName, records), "identifiers": own}
    if extra_identifiers is not None:
        more = extra_identifiers.select(
            *of_entity, F.col("scope").alias("identifierScope"), F.col("value").alias("identifierValue")
        )
        parts["identifiers"] = own.unionByName(more)
    if built.edges is not None:
        parts["edges"] = built.edges.select(
            F.col("from_type").alias("entityType"), F.col("from_key").alias("key"), F.col("edge_key").alias("edgeKey"),
            F.col("to_type").alias("toType"), F.col("to_key").alias("toKey"), F.col("to_id").alias("toId"),
            "external", "inverse",
        )
    if built.texts is not None:
        parts["texts"] = built.texts.select(*of_entity, "path", "author", "title", "text")
    if built.custom is not None:
        parts["customData"] = built.custom.select(*of_entity, "domain", "namespace", "schema", "value")
    return parts


def nested_records(
    built: Built, schema_version: str, per_record: int, scope: str = "local",
    extra_identifiers: DataFrame | None = None, staged: bool = False,
) -> DataFrame:
    """A nested view for readers that ask for one: JSON as ``(entityType, record)``.

    The reader says how many facts a record of its may hold (texts, customData entries and references
    together); an entity with more has several records of the same identifier, which fold by the
    ordinary rule that arrays unite by value.  No list grows with the data, and none is cut.  What
    ``write_bundle`` writes does not depend on it.

    ``extra_identifiers(entity_type, key, scope, value)`` follow an entity's own identifier.
    ``staged`` stores the facts once, as sizing and assembling them both read them.
    """
    facts = _facts(built, scope, extra_identifiers)
    facts = stage(facts, "facts") if staged else facts
    entity = ["entity_type", "key"]
    record = [*entity, "_chunk"]
    sizes = facts.groupBy(*entity).agg(F.ceil(F.count("*") / per_record).cast("int").alias("_chunks"))
    # Sizes are one narrow row per entity, so hashing them spares a sort of all facts.
    # Equal facts hash to one chunk, where collecting a set drops the repeats.
    spread = (
        facts.join(sizes.hint("shuffle_hash"), entity)
        .withColumn("_chunk", F.pmod(F.xxhash64("json", "sub"), F.col("_chunks")).cast("int"))
        .repartition(*record)
    )

    def named(name: Column, body: Column) -> Column:
        return F.concat(F.lit('"'), name, F.lit('":'), body)

    def joined(members: Column) -> Column:
        return F.array_join(F.array_sort(members), ",")

    # A record's facts are few by the reader's own figure, so one grouping holds them; predicates, types
    # and slots come from the mappings, so the lists that are looked through below are short.
    fact = F.struct("slot", F.col("sub.edge_key").alias("edge_key"), F.col("sub.to_type").alias("to_type"), "json")
    collected = spread.groupBy(*record).agg(F.collect_set(fact).alias("_facts"))

    def each(facts: Column, name: str, use: Callable[[Column, Column], Column]) -> Column:
        """``use`` of every value under a name, with the facts that have it."""
        values = F.array_distinct(F.transform(facts, lambda f: f[name]))
        return F.transform(values, lambda v: use(v, F.filter(facts, lambda f: f[name].eqNullSafe(v))))

    def of_type(to_type: Column, facts: Column) -> Column:
        members = joined(F.transform(facts, lambda f: f["json"]))
        return F.when(to_type.isNotNull(), named(to_type, F.concat(F.lit("["), members, F.lit("]")))).otherwise(members)

    def of_edge(edge_key: Column, facts: Column) -> Column:
        members = joined(each(facts, "to_type", of_type))
        return F.when(edge_key.isNotNull(), named(edge_key, F.concat(F.lit("{"), members, F.lit("}")))).otherwise(members)

    def of_slot(slot: Column, facts: Column) -> Column:
        return F.struct(slot.alias("slot"), joined(each(facts, "edge_key", of_edge)).alias("members"))

    def part(s: Column) -> Column:
        return (
            F.when(s["slot"] == "", F.nullif(s["members"], F.lit("")))
            .when(s["slot"] == "edges", named(s["slot"], F.concat(F.lit("{"), s["members"], F.lit("}"))))
            .when(s["slot"] != "identifier", named(s["slot"], F.concat(F.lit("["), s["members"], F.lit("]"))))
        )

    slots = collected.select(*record, each(F.col("_facts"), "slot", of_slot).alias("_slots"))
    others = F.filter("_slots", lambda s: s["slot"] == "identifier")
    records = slots.select(
        *record, joined(F.transform("_slots", part)).alias("_parts"), F.get(others, F.lit(0))["members"].alias("_others")
    )
    own = F.to_json(_reference(F.lit(scope), entity_id(F.col("entity_type"), "key", built.namespace)))
    text = F.concat(
        F.lit('{"entityType":"'), "entity_type", F.lit(f'","schemaVersion":"{schema_version}","identifier":['), own,
        F.coalesce(F.concat(F.lit(","), "_others"), F.lit("")), F.lit("]"),
        F.when(F.col("_parts") != "", F.concat(F.lit(","), "_parts")).otherwise(""), F.lit("}"),
    )
    return records.select(F.col("entity_type").alias("entityType"), text.alias("record"))


def write_bundle(
    built: Built, rules: dict[str, list[EntityRule]], out: str, schema_version: str, scope: str = "local",
    extra_identifiers: DataFrame | None = None, versioned: bool = False,
) -> Seal:
    """Validate, stage and publish a bundle: one folder of JSON lines per part of ``PARTS``.

    Everything is built once: validation, figures and the bundle are taken from the stored frames.
    Nothing is written to ``out`` unless every entity is valid, and readers never see a half-written
    bundle; parts that the mappings give no reason for are absent.

    A plain output takes the place of the last one by renames, so readers may find nothing between two
    of them, and an object store, which copies instead of renaming, does so for longer.  A ``versioned``
    one is a folder that ``current_version(out)`` finds: no moment is without a whole bundle.
    """
    built = built.stored()
    seal = seal_bundle(built, rules)
    require_valid(seal, built)
    spark = built.identifiers.sparkSession
    pending = new_version(out) if versioned else staging_path(out)
    for part, df in bundle_parts(built, schema_version, scope, extra_identifiers).items():
        target = f"{pending}/{part}"
        if part == "entities":
            df.drop("key").write.partitionBy("entityType").text(target)
        else:
            df.write.partitionBy("entityType").json(target)
    if versioned:
        publish_version(spark, out, pending)
    else:
        publish(spark, pending, out)
    return seal
