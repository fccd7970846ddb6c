"""Whole reports and catalogues, on deliveries that Spark derives from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import source_versions
from ..operators.tree import walk_tree
from ..operators.upgrade import version_notes
from ..plans.build import build_entities
from ..plans.catalogue import catalogue_mappings, file_notes, file_rows
from ..plans.delivery import (
    HEADER_TAGS,
    PRIMARY_ROOT,
    WITNESS_A_ROOT,
    WITNESS_A_ROW,
    fidelity_report,
    read_delivery,
    read_witness_a,
    read_witness_b,
    with_delivery_day,
    with_take_key,
)
from ..session import stage
from ..sources.files import day_path, empty_directories, file_manifest, wrong_documents
from ..sources.pages import json_bundle
from .deliveries import _COMPARED, _delivery, _folder, _lines, _perturbed, _perturbed_takes, _spread, _write_xml
from .entities import NAMESPACE
from .registry import Tables, query


@query(
    "fidelity_report",
    f"""with {_COMPARED}, w as (select * from keyed where o % 20 <> 19),
    d as (select count(*) as c from picked group by coalesce(slate, wild), camera, n, o % 4 having count(*) > 1),
    a as (
        select 'shotDescription mismatch' as name, count(*) as value from w where o % 8 = 3
        union all select 'take mismatch', count(*) from w where o % 4 = 0
        union all select 'selectType one_sided', count(*) from w where o % 3 = 1
        union all select 'comment one_sided', count(*) from w where o % 6 > 1
        union all select unnest(['shootDay one_sided', 'lensHeight one_sided', 'distance one_sided']), count(*) from w
        union all select 'recordedTime one_sided', count(*) from w where o % 5 <> 0),
    b as (
        select 'take mismatch' as name, count(*) as value from w where o % 4 = 0
        union all select 'comment one_sided', count(*) from w where o % 6 > 1
        union all select unnest(['cameraRoll one_sided', 'lensHeight one_sided', 'distance one_sided', 'recordingFPS one_sided', 'shotDescription one_sided']), count(*) from w),
    report as (
        select 'rows' as section, 'primary' as name, count(*) as value from picked
        union all select 'rows', unnest(['witness a', 'witness b']), count(*) from picked where o % 20 <> 19
        union all select unnest(['keys a', 'keys b']), 'matched', count(*) from w
        union all select unnest(['keys a', 'keys b']), 'only_left', count(*) from keyed where o % 20 = 19
        union all select unnest(['keys a', 'keys b']), 'only_right', 0
        union all select 'keys a', 'mismatches', sum(value) from a where name like '%mismatch'
        union all select 'keys a', 'one_sided', sum(value) from a where name like '%one_sided'
        union all select 'keys b', 'mismatches', sum(value) from b where name like '%mismatch'
        union all select 'keys b', 'one_sided', sum(value) from b where name like '%one_sided'
        union all select unnest(['verdict a', 'verdict b']), 'DIFFERENCES FOUND', 1
        union all select 'only in primary a', unnest(['unit', 'tailSlate']), 1
        union all select 'only in primary b', unnest(['setup', 'shootDay', 'shootDate', 'unit', 'soundRoll', 'clipNumber', 'recordedTime', 'technicalComment', 'circleStatus',
            'selectType', 'completeShot', 'tailSlate', 'vfxShot', 'vfxNotes', 'interocular', 'inclination', 'tilt', 'gps']), 1
        union all select 'fields a', name, value from a where value > 0
        union all select 'fields b', name, value from b where value > 0
        union all select 'circled', concat(case when o % 7 = 0 then '(blank)' else 'Y' end, ' / ', coalesce(select_type, '(blank)')), count(*) from picked where o % 20 <> 19 group by all
        union all select 'notes', 'unexpectedRepeatedTag', count(*) from supplier where s_suppkey % 25 = 0
        union all select 'notes', 'duplicateCharacter', count(*) from supplier where s_suppkey % 5 = 0
        union all select 'notes', unnest(['objectDescription', 'duplicatedField']), 1
        union all select 'notes', 'sentinelNull', 3
        union all select 'notes', 'duplicateTakeKey', count(*) from d)
    select section, name, cast(value as bigint) as value from report where section <> 'notes' or value > 0""",
)
def fidelity_report_takes(t: Tables) -> DataFrame:
    """Both witnesses against the primary export, in one table of figures."""
    witness = _perturbed(t)
    a = _write_xml(_perturbed_takes(_spread(_lines(t))).drop("o", "n"), _folder(t, "witness_a"), WITNESS_A_ROOT, WITNESS_A_ROW)
    b = _folder(t, "witness_b")
    witness.select(
        "Slate", F.lit("3").alias("Scene"), "Camera", F.lit("r1").alias("Roll"), "Take",
        F.when(F.col("o") % 7 == 0, "").otherwise("Y").alias("Circled"),
    ).write.option("header", "true").csv(b)
    delivery = _delivery(t, staged=True)
    witnesses = {"a": with_take_key(read_witness_a(t.spark, a)), "b": with_take_key(read_witness_b(t.spark, b))}
    return fidelity_report(with_take_key(delivery.takes), witnesses, delivery.notes())


@query(
    "fidelity_days",
    """with c as (select c_custkey as k, c_mktsegment as seg, c_acctbal < 0 as poor from customer), n as (select count(*) as n from c),
    m as (select count(*) as m from c where seg = 'MACHINERY'), p as (select count(*) as p from c where poor)
    select 'keys b' as section, 'matched' as name, 2 * n - p as value from n, p
    union all select 'keys b', 'only_left', p from p
    union all select 'keys b', 'only_right', cast(0 as bigint)
    union all select 'keys b', 'mismatches', m from m
    union all select 'keys b', 'one_sided', cast(0 as bigint)
    union all select 'verdict b', case when m > 0 or p > 0 then 'DIFFERENCES FOUND' else 'EXACT' end, cast(1 as bigint) from m, p
    union all select 'fields b', 'comment mismatch', m from m where m > 0
    union all select 'rows', 'primary', 2 * n from n
    union all select 'rows', 'witness b', 2 * n - p from n, p""",
)
def fidelity_days(t: Tables) -> DataFrame:
    """Two days that use the same labels: every take is compared with its own day's.

    The days' comments differ, and the witness's differ from the first day's for one segment; on the second
    day the witness lacks the poor.
    """
    out = _folder(t, "days")
    for day in ("1", "2"):
        takes = _spread(t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")).select(
            F.concat(F.col("c_custkey"), F.lit("A")).alias("script_scene"), F.lit("A").alias("script_camera"), F.lit("1").alias("script_take"),
            F.concat(F.lit(f"day {day} "), "c_name").alias("script_comment"), "c_mktsegment", "c_acctbal",
        )
        _write_xml(takes.drop("c_mktsegment", "c_acctbal"), f"{day_path(out, 'demo', 'primary', day)}/takes", PRIMARY_ROOT, "shot_properties")
        other = (F.col("c_mktsegment") == "MACHINERY") & F.lit(day == "1")
        rows = takes.filter(f"{day} = 1 or c_acctbal >= 0").select(
            F.col("script_scene").alias("Slate"), F.col("script_camera").alias("Camera"), F.col("script_take").alias("Take"),
            F.when(other, "other").otherwise(F.col("script_comment")).alias("Notes"),
        )
        rows.write.option("header", "true").csv(day_path(out, "demo", "witness", day))
    # The folders of the layout are the days; they are read as files, without partition columns.
    source = lambda name: f"{out}/production=demo/source={name}"
    primary = read_delivery(t.spark, f"{source('primary')}/day=*/takes").takes
    witness = read_witness_b(t.spark, f"{source('witness')}/day=*", multiline=False)
    keyed = [with_delivery_day(with_take_key(df)) for df in (primary, witness)]
    report = fidelity_report(keyed[0], {"b": keyed[1]})
    return report.filter("section in ('keys b', 'verdict b', 'fields b', 'rows')")


# --- the tree catalogue -------------------------------------------------------------------

_META = "array<struct<name:string,mutable:boolean,value:string>>"


def _catalogue(t: Tables) -> DataFrame:
    """Parts as files in a folder per brand; some without metadata, some with a name that shadows."""
    key = F.col("p_partkey")
    name = F.concat(F.lit("p"), key, F.when(key % 3 == 0, ".odd").otherwise(".MOV"))
    brands = t.part.select(F.lit("root").alias("parent_id"), F.col("p_brand").alias("id"), F.col("p_brand").alias("name")).distinct()
    files = t.part.select(F.col("p_brand").alias("parent_id"), F.concat(F.lit("f"), key).alias("id"), name.alias("name"))
    nodes = brands.withColumn("type", F.lit("folder")).unionByName(files.withColumn("type", F.lit("file"))).withColumn("position", F.lit(0))
    walk = walk_tree(nodes, brands.select(F.col("parent_id").alias("id")).distinct())
    pair = lambda n, v: F.struct(F.lit(n).alias("name"), F.lit(True).alias("mutable"), v.cast("string").alias("value"))
    pairs = F.array(
        pair("Slate", F.col("p_brand")), pair("Take", F.col("p_size")),
        pair("Mood", F.col("p_type")), F.when(key % 5 == 0, pair("fileId", F.lit("other"))),
    )
    records = t.part.select(
        F.concat(F.lit("f"), key).alias("id"), name.alias("name"),
        F.when(key % 3 == 0, "model/odd").otherwise("video/quicktime").alias("media_type"), F.col("p_size").cast("bigint").alias("file_size"),
        F.when(key % 7 != 0, F.array_compact(pairs)).cast(_META).alias("metadata"),
    )
    empty = ["parent_id", "status", "view_url", "created_at", "updated_at"]
    placed = records.join(walk.files.select("id", "folder_path", "stack_id"), "id")
    return placed.select("*", *[F.lit(None).cast("string").alias(c) for c in empty])


@query(
    "catalogue_entities",
    """with f as (select p_partkey as k, concat('f', p_partkey) as key, concat('p', p_partkey, case when p_partkey % 3 = 0 then '.odd' else '.MOV' end) as name, p_brand, p_type, p_size from part)
    select 'Asset' as entity_type, key, name as label, null as path, null as structure, case when k % 7 <> 0 then p_type end as mood, case when k % 7 <> 0 then concat(p_brand, '-', p_size) end as slate from f
    union all select 'AssetStructure', key, name, concat('/', p_brand, '/', name), case when k % 3 = 0 then 'digital' else 'digital.movingImage' end, null, null from f""",
)
def catalogue_entities(t: Tables) -> DataFrame:
    """From the nodes of a tree to the two entities of each file, and what its metadata carries."""
    files = file_rows(_catalogue(t), ["Slate", "Take"], "proj")
    built = build_entities({"files": files}, catalogue_mappings()["files"], NAMESPACE)
    carried = built.custom.filter("entity_type = 'Asset'").select(
        "key", F.try_element_at("value", F.lit("Mood")).alias("mood"), F.try_element_at("value", F.lit("SlateId")).alias("slate")
    )
    none = F.lit(None).cast("string")
    assets = built.entities["Asset"].join(carried, "key", "left").select(
        F.lit("Asset").alias("entity_type"), "key", "label", none.alias("path"), none.alias("structure"), "mood", "slate"
    )
    detail = F.col("`assetStructureProperties.fileDetails.filePath`")
    structures = built.entities["AssetStructure"].select(
        F.lit("AssetStructure").alias("entity_type"), "key", "label", detail.alias("path"),
        F.col("assetStructureType").alias("structure"), none.alias("mood"), none.alias("slate"),
    )
    return assets.unionByName(structures)


@query(
    "catalogue_comments",
    """with c as (select distinct concat('f', l_partkey) as key, l_shipdate::date::varchar as text, case when l_returnflag <> 'A' then concat('S', l_suppkey % 3) end as author,
            cast(l_linenumber as varchar) as title from lineitem)
    select 'text' as fact, key, text, author, title from c
    union all select 'asset', concat('f', p_partkey), concat('p', p_partkey, case when p_partkey % 3 = 0 then '.odd' else '.MOV' end), null, null from part
    union all select distinct 'asset', key, null, null, null from c where key not in (select concat('f', p_partkey) from part)""",
)
def catalogue_comments(t: Tables) -> DataFrame:
    """Comments folded onto the assets of their files: equal ones once, an asset for a file not listed."""
    files = file_rows(_catalogue(t), ["Slate", "Take"], "proj")
    comments = t.lineitem.select(
        F.concat(F.lit("f"), "l_partkey").alias("fileId"), F.to_date("l_shipdate").cast("string").alias("commentText"),
        F.when(F.col("l_returnflag") != "A", F.concat(F.lit("S"), F.col("l_suppkey") % 3)).alias("commentAuthor"),
        F.col("l_linenumber").alias("commentFrame"),
    )
    mappings = [m for group in catalogue_mappings().values() for m in group]
    built = build_entities({"files": files, "comments": comments}, mappings, NAMESPACE)
    none = F.lit(None).cast("string")
    texts = built.texts.select(F.lit("text").alias("fact"), "key", "text", "author", "title")
    return texts.unionByName(
        built.entities["Asset"].select(F.lit("asset").alias("fact"), "key", F.col("label").alias("text"), none.alias("author"), none.alias("title"))
    )


@query(
    "catalogue_notes",
    """select 'metadataMissing' as kind, 'files' as place, count(*) as n from part where p_partkey % 7 = 0
    union all select 'metadataNameCollision', 'fileId', count(*) from part where p_partkey % 7 <> 0 and p_partkey % 5 = 0
    union all select 'unclassifiedMediaType', 'model/odd', count(*) from part where p_partkey % 3 = 0""",
)
def catalogue_notes(t: Tables) -> DataFrame:
    notes = file_notes(_catalogue(t))
    return notes.select("kind", F.col("where").alias("place"), F.regexp_extract("detail", r"(\d+)", 1).cast("bigint").alias("n"))


# --- delivered files ----------------------------------------------------------------------


@query(
    "delivered_documents",
    """select 'emptyDirectory' as kind, concat('n=', s_suppkey) as place, null as production from supplier where s_acctbal < 0
    union all select 'wrongDocument', concat('n=', s_suppkey), null from supplier where s_acctbal >= 0 and s_nationkey % 2 = 1
    union all select 'header', concat('n=', s_suppkey), s_name from supplier where s_acctbal >= 0 and s_nationkey % 2 = 0""",
)
def delivered_documents(t: Tables) -> DataFrame:
    """A folder per supplier: some without a file, some with another document, the others with a header."""
    out = _folder(t, "documents")
    uuid, created, source, production, _ = HEADER_TAGS
    element = lambda tag, value: F.concat(F.lit(f"<{tag}>"), value, F.lit(f"</{tag}>"))
    tags = [element(uuid, F.lit("u")), element(created, F.lit("c")), element(source, F.lit("s")), element(production, F.col("s_name"))]
    right = F.concat(F.lit(f'<{PRIMARY_ROOT} Version="1">'), *tags, F.lit(f"</{PRIMARY_ROOT}>"))
    text = F.when(F.col("s_nationkey") % 2 == 0, right).otherwise("<Other><x>1</x></Other>")
    written = t.supplier.filter("s_acctbal >= 0").select(F.col("s_suppkey").alias("n"), text.alias("text"))
    written.repartition("n").write.partitionBy("n").text(out)
    folder = lambda c: F.element_at(F.split(c, "/"), -2)
    placed = lambda df, c: df.withColumn(c, F.concat(folder(c), F.lit("/"), F.element_at(F.split(c, "/"), -1)))
    manifest = stage(placed(file_manifest(t.spark, out), "path"), "manifest")
    header = placed(read_delivery(t.spark, out, staged=True, recursive=True).header, "file_path")
    listed = t.supplier.select(F.concat(F.lit("n="), "s_suppkey").alias("path"))
    wrong = wrong_documents(manifest, header, PRIMARY_ROOT).withColumn("where", folder("where"))
    notes = wrong.unionByName(empty_directories(listed, manifest))
    none = F.lit(None).cast("string")
    found = notes.select("kind", F.col("where").alias("place"), none.alias("production"))
    return found.unionByName(
        header.select(F.lit("header").alias("kind"), folder("file_path").alias("place"), F.col("productionName").alias("production"))
    )


@query("json_arrays", "select c_custkey, c_name, c_mktsegment as segment from customer")
def json_arrays(t: Tables) -> DataFrame:
    """Files that hold one JSON array each, fifty customers to a file, read with their schema."""
    out = _folder(t, "arrays")
    block = F.floor(F.col("c_custkey") / 50)
    arrays = t.customer.groupBy(block.alias("block")).agg(
        F.to_json(F.collect_list(F.struct("c_custkey", "c_name", F.struct(F.col("c_mktsegment").alias("segment")).alias("kind")))).alias("text")
    )
    arrays.repartition("block").write.partitionBy("block").text(out)
    read = json_bundle(t.spark, out, "c_custkey bigint, c_name string, kind struct<segment:string>")
    return read.select("c_custkey", "c_name", F.col("kind.segment").alias("segment"))


@query(
    "migrated_notes",
    """select 'migrated' as kind, concat('v', o_orderkey % 3) as place, concat(count(*), ' entities delivered as v2') as detail
    from orders where o_orderkey % 3 <> 2 group by o_orderkey % 3""",
)
def migrated_notes(t: Tables) -> DataFrame:
    versions = source_versions(t.orders.select(F.concat(F.lit("v"), F.col("o_orderkey") % 3).alias("version")), "version", "v2")
    return version_notes(versions, "v2").withColumnRenamed("where", "place")
