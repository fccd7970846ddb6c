"""File-shaped sources and sinks, on deliveries that Spark derives from the driver tables.

A delivery is written to the shared scratch folder and read back, so these queries also cover the
readers' schemas, their handling of blanks and arrays, and the writers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import number_or_null
from ..operators.quality import EntityRule, page_completeness, report_rows
from ..operators.rules import classify
from ..plans.build import Built, build_entities
from ..plans.bundle import seal_bundle
from ..plans.delivery import (
    PRIMARY_ROOT,
    WITNESS_A_ROOT,
    WITNESS_A_ROW,
    Delivery,
    assets_table,
    circled_against_select,
    compare_witness,
    delivery_mappings,
    read_delivery,
    read_witness_a,
    read_witness_b,
    signature_rules,
    with_take_key,
)
from ..plans.mapping import Edge, FromTable, Mapping, Text
from ..session import scratch_path, stage
from ..sinks import nested_records, write_bundle, write_json, write_table_set
from ..sources.csv import csv_rows
from ..sources.files import day_path, file_manifest, opening_signature, read_days
from ..sources.pages import json_lines, page_items, read_pages
from ..sources.xml import text_schema, xml_rows
from .entities import NAMESPACE
from .registry import Tables, query


def _folder(t: Tables, name: str) -> str:
    return scratch_path(t.spark, name)


# --- plain files ------------------------------------------------------------------------


@query(
    "xml_rows",
    """select cast(p_partkey as varchar) as p_partkey, nullif(case when p_partkey % 3 = 0 then '' else p_name end, '') as p_name,
        p_brand, case when p_partkey % 2 = 0 then concat(p_type, '+', p_brand) else p_type end as tags
    from part""",
)
def xml_rows_parts(t: Tables) -> DataFrame:
    """One row per element; text stays text, an empty element is null, a repeatable tag an array."""
    from ..functions import clean_text

    out = _folder(t, "xml")
    tags = F.when(F.col("p_partkey") % 2 == 0, F.array("p_type", "p_brand")).otherwise(F.array("p_type"))
    rows = t.part.select(
        F.col("p_partkey").alias("@id"),
        F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_name")).alias("name"),
        F.col("p_brand").alias("brand"), tags.alias("tag"),
    )
    rows.write.format("xml").option("rootTag", "parts").option("rowTag", "part").option("attributePrefix", "@").save(out)
    read = xml_rows(t.spark, out, "part", text_schema(["@id", "name", "brand"], {"tag": None}))
    return read.select(
        F.col("`@id`").alias("p_partkey"), clean_text("name").alias("p_name"), F.col("brand").alias("p_brand"),
        F.array_join("tag", "+").alias("tags"),
    )


@query(
    "csv_rows",
    """select cast(o_orderkey as varchar) as o_orderkey, case when o_orderkey % 4 = 0 then null else o_orderstatus end as o_orderstatus,
        concat('said "', o_orderpriority, '", then left') as remark, '007' as code, false as malformed
    from orders""",
)
def csv_rows_orders(t: Tables) -> DataFrame:
    """Quotes inside cells, blanks, and digits that must stay text."""
    out = _folder(t, "csv")
    remark = F.concat(F.lit('said "'), "o_orderpriority", F.lit('", then left'))
    status = F.when(F.col("o_orderkey") % 4 == 0, "  ").otherwise(F.col("o_orderstatus"))
    rows = t.orders.select("o_orderkey", status.alias("o_orderstatus"), remark.alias("remark"), F.lit("007").alias("code"))
    write_table_set({"orders": rows}, out)
    read = csv_rows(t.spark, f"{out}/orders")
    return read.select("o_orderkey", "o_orderstatus", "remark", "code", F.col("_malformed").isNotNull().alias("malformed"))


@query(
    "file_manifest",
    r"""select concat('lang=', lang) as folder, '.txt' as file_extension, 'text/plain' as media_type, true as named,
        cast(sum(strlen(regexp_replace(text, '[\r\n]+', ' ', 'g')) + 1) as bigint) as bytes
    from documents group by lang""",
)
def file_manifest_documents(t: Tables) -> DataFrame:
    out = _folder(t, "files")
    t.documents.select("lang", F.regexp_replace("text", r"[\r\n]+", " ").alias("text")).write.partitionBy("lang").text(out)
    files = file_manifest(t.spark, out).filter(F.col("file_extension") == ".txt")
    folder = F.element_at(F.split("path", "/"), -2)
    named = (F.col("file_name") == F.element_at(F.split("path", "/"), -1)) & F.col("file_name").startswith("part-")
    return files.groupBy(folder.alias("folder"), "file_extension", "media_type").agg(
        F.bool_and(named).alias("named"), F.sum("file_size").cast("bigint").alias("bytes")
    )


@query(
    "delivery_layout",
    """select event_type as day, count(*) as n from events where event_type in ('click', 'error') group by 1""",
)
def delivery_layout(t: Tables) -> DataFrame:
    """Days in the layout of production, source and day; a filter on the day prunes folders."""
    root = _folder(t, "layout")
    for source in ("app", "web"):
        rows = t.events.filter(F.col("user_id") % 2 == (0 if source == "app" else 1))
        base = day_path(root, "demo", source, "x").rsplit("/", 1)[0]
        rows.withColumnRenamed("event_type", "day").write.partitionBy("day").parquet(base)
    days = read_days(t.spark, root)
    return days.filter(F.col("day").isin("click", "error") & (F.col("production") == "demo")).groupBy("day").agg(F.count("*").alias("n"))


@query(
    "landed_pages",
    """select cast(o_orderkey as bigint) as o_orderkey, o_orderstatus, floor(o_orderkey / 50) < 5 as has_more, concat('c', cast(floor(o_orderkey / 50) as bigint) + 1) as next
    from orders""",
)
def landed_pages(t: Tables) -> DataFrame:
    """Entities of all landed pages, in the two envelopes of offset and cursor endpoints."""
    out = _folder(t, "pages")
    page = F.floor(F.col("o_orderkey") / 50)
    pages = t.orders.groupBy(page.alias("page")).agg(F.collect_list(F.struct("o_orderkey", "o_orderstatus")).alias("data"))
    pages.select(
        "data", F.struct((F.col("page") < 5).alias("hasMore")).alias("pagination"),
        F.struct(F.concat(F.lit("c"), F.col("page") + 1).alias("next")).alias("links"),
    ).write.json(out)
    items = page_items(read_pages(t.spark, out, "struct<o_orderkey:bigint,o_orderstatus:string>"))
    return items.select("o_orderkey", "o_orderstatus", "has_more", "next")


@query(
    "landed_completeness",
    """select 'orders' as endpoint, 'unfinished' as problem, null as cursor""",
)
def landed_completeness(t: Tables) -> DataFrame:
    """Page checks computed from the landed pages: the last one says that there is more."""
    out = _folder(t, "pages")
    page = F.floor(F.col("o_orderkey") / 50)
    pages = t.orders.groupBy(page.alias("page")).agg(F.collect_list(F.struct("o_orderkey")).alias("data"))
    pages.select("data", F.struct(F.lit(True).alias("hasMore")).alias("pagination")).write.json(out)
    read = read_pages(t.spark, out, "struct<o_orderkey:bigint>")
    none = F.lit(None).cast("string")
    state = read.select(
        F.lit("orders").alias("endpoint"), F.element_at("data", 1)["o_orderkey"].alias("position"),
        F.size("data").alias("rows"), "has_more", none.alias("cursor"), none.alias("next"),
    )
    return page_completeness(state)


@query("json_bundle", "select c_custkey, c_name, c_mktsegment as segment from customer")
def json_bundle_customers(t: Tables) -> DataFrame:
    """Nested rows written as JSON and read back with their schema."""
    out = _folder(t, "json")
    write_json(t.customer.select("c_custkey", F.struct(F.col("c_name").alias("full"), F.col("c_mktsegment").alias("segment")).alias("name")), out)
    read = json_lines(t.spark, out, "c_custkey bigint, name struct<full:string,segment:string>")
    return read.select("c_custkey", F.col("name.full").alias("c_name"), F.col("name.segment").alias("segment"))


# --- bundles ----------------------------------------------------------------------------

BUNDLE = [
    Mapping(
        "Customer", "customer", "c_custkey",
        properties={"customerName.fullName": "c_name", "nation": "c_nationkey"},
        texts={"annotation": (Text("Segment", "c_mktsegment"),)},
        edges=(Edge("Order", "o_orderkey", source=FromTable("orders", "o_custkey"), inverse=True),),
    ),
    Mapping("Order", "orders", "o_orderkey", properties={"status": "o_orderstatus"}),
]
RECORD = (
    "struct<entityType:string,schemaVersion:string,identifier:array<struct<identifierScope:string,identifierValue:string>>,"
    "customerName:struct<fullName:string>,nation:string,status:string,"
    "annotation:array<struct<title:string,text:string>>,"
    "edges:map<string,map<string,array<struct<identifier:array<struct<identifierScope:string,identifierValue:string>>>>>>>"
)


def _bundle(t: Tables) -> Built:
    return build_entities({"customer": t.customer, "orders": t.orders}, BUNDLE, NAMESPACE)


@query(
    "bundle_records",
    """select 'Customer' as entity_type, c_name as name, null as status, cast(1 as bigint) as texts, count(o_orderkey) as refs from customer left join orders on o_custkey = c_custkey group by c_custkey, c_name
    union all select 'Order', null, o_orderstatus, 0, 1 from orders""",
)
def bundle_records(t: Tables) -> DataFrame:
    """Nested records, three facts to a record, folded back by identifier."""
    records = nested_records(_bundle(t), "v3.0", per_record=3).select(F.from_json("record", RECORD).alias("r")).select("r.*")
    refs = F.aggregate(
        F.flatten(F.transform(F.map_values(F.coalesce("edges", F.create_map().cast("map<string,map<string,array<struct<identifier:array<struct<identifierScope:string,identifierValue:string>>>>>>"))), lambda m: F.map_values(m))),
        F.lit(0).cast("bigint"), lambda n, a: n + F.size(a),
    )
    folded = records.groupBy(F.col("entityType").alias("entity_type"), F.col("identifier")[0]["identifierValue"].alias("id")).agg(
        F.max("customerName.fullName").alias("name"), F.max("status").alias("status"),
        F.sum(F.coalesce(F.size("annotation"), F.lit(0))).alias("texts"), F.sum(refs).alias("refs"),
    )
    return folded.select("entity_type", "name", "status", "texts", "refs")


def _written_bundle(t: Tables) -> str:
    out = _folder(t, "bundle")
    rules = {"Customer": [EntityRule("nation", required=True)], "Order": [EntityRule("status", allowed=("O", "F", "P"))]}
    write_bundle(_bundle(t), rules, out, "v3.0")
    return out


@query(
    "write_bundle",
    """select 'Customer' as entity_type, c_name as name, cast(c_nationkey as varchar) as nation, null as status, 'v3.0' as version, 1 as ids from customer
    union all select 'Order', null, null, o_orderstatus, 'v3.0', 1 from orders""",
)
def write_bundle_customers(t: Tables) -> DataFrame:
    """A valid bundle, staged, published and read back: one record per entity."""
    read = t.spark.read.schema(T.StructType.fromDDL(f"r {RECORD}")["r"].dataType).json(f"{_written_bundle(t)}/entities")
    return read.select(
        F.col("entityType").alias("entity_type"), F.col("customerName.fullName").alias("name"), "nation", "status",
        F.col("schemaVersion").alias("version"), F.size("identifier").alias("ids"),
    )


@query(
    "bundle_parts",
    """select 'edges' as part, 'Customer' as entity_type, cast(o_custkey as varchar) as key, 'has' as name, cast(o_orderkey as varchar) as value from orders where o_custkey in (select c_custkey from customer)
    union all select 'edges', 'Order', cast(o_orderkey as varchar), 'for', cast(o_custkey as varchar) from orders where o_custkey in (select c_custkey from customer)
    union all select 'texts', 'Customer', cast(c_custkey as varchar), 'annotation', c_mktsegment from customer
    union all select 'identifiers', 'Customer', cast(c_custkey as varchar), 'local', null from customer
    union all select 'identifiers', 'Order', cast(o_orderkey as varchar), 'local', null from orders""",
)
def bundle_parts_customers(t: Tables) -> DataFrame:
    """What entities have many of, read back row by row from the folders of the written bundle."""
    out = _written_bundle(t)
    read = lambda part, columns: t.spark.read.schema(f"entityType string, key string, {columns}").json(f"{out}/{part}")
    row = lambda df, part, name, value: df.select(
        F.lit(part).alias("part"), F.col("entityType").alias("entity_type"), "key", F.col(name).alias("name"), value.alias("value")
    )
    parts = [
        row(read("edges", "edgeKey string, toKey string"), "edges", "edgeKey", F.col("toKey")),
        row(read("texts", "path string, text string"), "texts", "path", F.col("text")),
        row(read("identifiers", "identifierScope string"), "identifiers", "identifierScope", F.lit(None).cast("string")),
    ]
    return reduce(DataFrame.unionByName, parts)


# --- the production-day delivery --------------------------------------------------------

_WILD = "o % 10 = 0"
# Take fields as expressions of the order and line number, so that equal keys carry equal rows.
_TAKE = {
    "script_scene": f"case when {_WILD} then cast(1000 + o as {{text}}) else concat(cast(o as {{text}}), 'A') end",
    "script_camera": "case n % 3 when 0 then 'A' when 1 then 'B' else 'C' end",
    "script_take": "case when o % 4 = 0 then concat(cast(n as {text}), '.1 PU') else cast(n as {text}) end",
    "script_shootDay": "concat('Day ', cast(o % 4 as {text}))",
    "script_comment": "case o % 6 when 0 then '(null)' when 1 then '' else concat('Note  ', cast(o as {text})) end",
    "script_lens_height": "cast(n as {text})",
    "script_distance": "cast(n as {text})",
    "script_recorded_time": "case when o % 5 = 0 then '' else concat(cast(n as {text}), '.50') end",
    "script_frame_rate": "'23.976'",
    "script_select_type": "case o % 3 when 0 then '(null)' when 1 then 'Circled' else 'Hold' end",
    "script_shot_description": "concat('Shot ', cast(o as {text}))",
    "script_unit": "case when o % 97 = 0 then '<Unit: 0x60000aeaec30>' else 'main' end",
}


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), F.col("l_suppkey").alias("s"))


def _take_columns(text: str) -> dict[str, str]:
    return {name: expression.format(text=text) for name, expression in _TAKE.items()}


#: Rows that a delivered document holds at most; a document is read by one task.
DOCUMENT_ROWS = 250_000


def _spread(df: DataFrame) -> DataFrame:
    """Rows on every core, for documents that all cores then read; taken while rows are still narrow."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _write_xml(df: DataFrame, out: str, root: str, row: str) -> str:
    """Compressed documents, as element names are most of their text."""
    written = df.write.format("xml").option("rootTag", root).option("rowTag", row).option("attributePrefix", "@")
    written.option("compression", "gzip").option("maxRecordsPerFile", DOCUMENT_ROWS).save(out)
    return out


def _delivery(t: Tables, staged: bool = False) -> Delivery:
    """Takes from lines, scenes from suppliers, shoot days from regions."""
    out = _folder(t, "delivery")
    scene = F.when(F.col("o") % 3 == 0, F.array(F.col("o") % 50, F.col("o") % 50 + 1)).otherwise(F.array(F.col("o") % 50))
    cast_row = lambda number, name: F.struct(number.cast("string").alias("character_number"), name.alias("character_name"))
    takes = _spread(_lines(t)).select(
        *[F.expr(e).alias(c) for c, e in _take_columns("string").items()],
        F.struct(scene.cast("array<string>").alias("scene"), F.lit("101").alias("episode")).alias("related_scenes"),
        F.when(
            F.col("o") % 2 == 0, F.struct(F.array(cast_row(F.col("n"), F.lit("Dante")), cast_row(F.col("n") + 1, F.lit("Oliver"))).alias("character"))
        ).alias("characters_in_scenes"),
    )
    listed = lambda number, name: F.struct(number.cast("string").alias("character_in_scene_number"), name.alias("character_in_scene_name"))
    key = F.col("s_suppkey")
    scenes = _spread(t.supplier.select("s_suppkey")).select(
        (key % 50).cast("string").alias("scene_number"),
        F.concat(F.lit("INT. ROOM "), key % 50).alias("scene_heading"),
        F.when(key % 2 == 0, "(null)").otherwise("slug line").alias("scene_slug"),
        F.when(key % 25 == 0, F.array(F.lit("Day 1"), F.lit("4/8"), F.lit("odd"))).otherwise(F.array(F.lit("Day 1"), F.lit("4/8"))).alias("scene_shoot_day_credited"),
        F.struct(
            F.when(key % 5 == 0, F.array(listed(key, F.lit("Dante")), listed(key, F.lit("Dante")), listed(key, F.lit("Oliver"))))
            .otherwise(F.array(listed(key, F.lit("Dante"))))
            .alias("character_in_scene")
        ).alias("characters_in_scene"),
    )
    days = t.region.select(F.concat(F.lit("Day "), F.col("r_regionkey") + 1).alias("day_number"), F.col("r_name").alias("production_unit"))
    paths = [
        _write_xml(takes, f"{out}/takes", PRIMARY_ROOT, "shot_properties"),
        _write_xml(scenes, f"{out}/scenes", PRIMARY_ROOT, "scene"),
        _write_xml(days, f"{out}/days", PRIMARY_ROOT, "shoot_day"),
    ]
    return read_delivery(t.spark, paths, staged)


_TAKES_SQL = f"""lines as (select l_orderkey as o, l_linenumber as n from lineitem),
    takes as (select o, n, {', '.join(e + ' as ' + c for c, e in _take_columns('varchar').items())} from lines),
    picked as (
        select o, n, case when {_WILD} then null else script_scene end as slate, case when {_WILD} then script_scene end as wild,
            script_camera as camera, script_take as take, cast(o % 4 as varchar) as shoot_day,
            nullif(nullif(script_comment, '(null)'), '') as comment, nullif(script_recorded_time, '') as recorded_time,
            nullif(script_select_type, '(null)') as select_type, script_unit as unit, concat(script_scene, '-', script_take) as full_name,
            case when o % 3 = 0 then concat(o % 50, '; ', o % 50 + 1) else cast(o % 50 as varchar) end as scenes,
            case when o % 4 = 0 then 'PU' end as annotation
        from takes)"""


@query(
    "delivery_takes",
    f"""with {_TAKES_SQL}
    select slate, wild, camera, take, shoot_day, comment, select_type, unit, full_name, scenes, annotation, '101' as episode,
        try_cast(recorded_time as double) as seconds, count(*) as n
    from picked group by all""",
)
def delivery_takes(t: Tables) -> DataFrame:
    takes = _delivery(t).takes.select(
        "slate", F.col("wildTrackNumber").alias("wild"), "camera", "take", F.col("shootDay").alias("shoot_day"), "comment",
        F.col("selectType").alias("select_type"), "unit", F.col("slateFullName").alias("full_name"),
        F.col("narrativeScene").alias("scenes"), F.col("takeAnnotation").alias("annotation"), "episode",
        F.col("recordedTimeSeconds").alias("seconds"),
    )
    return takes.groupBy(*takes.columns).agg(F.count("*").alias("n"))


@query(
    "delivery_characters",
    f"""with {_TAKES_SQL}
    select 'take' as level, full_name as owner, unnest([cast(n as varchar), cast(n + 1 as varchar)]) as number, unnest(['Dante', 'Oliver']) as name from picked where o % 2 = 0
    union all select 'scene', cast(s_suppkey % 50 as varchar), cast(s_suppkey as varchar),
        unnest(case when s_suppkey % 5 = 0 then ['Dante', 'Dante', 'Oliver'] else ['Dante'] end) from supplier""",
)
def delivery_characters(t: Tables) -> DataFrame:
    d = _delivery(t)
    row = lambda df, level, owner: df.select(
        F.lit(level).alias("level"), F.col(owner).alias("owner"), F.col("characterNumber").alias("number"), F.col("characterName").alias("name")
    )
    return row(d.take_characters, "take", "slateFullName").unionByName(row(d.scene_characters, "scene", "narrativeScene"))


@query(
    "delivery_scenes",
    """select cast(s_suppkey % 50 as varchar) as scene, concat('INT. ROOM ', s_suppkey % 50) as heading, case when s_suppkey % 2 <> 0 then 'slug line' end as slug,
        '1' as credited_day, '4/8' as credited_eighths from supplier
    union all select 'day', cast(r_regionkey + 1 as varchar), r_name, null, null from region""",
)
def delivery_scenes(t: Tables) -> DataFrame:
    d = _delivery(t)
    none = F.lit(None).cast("string")
    scenes = d.scenes.select(
        F.col("narrativeScene").alias("scene"), "heading", "slug",
        F.col("shootDayCredited").alias("credited_day"), F.col("eighthsCredited").alias("credited_eighths"),
    )
    days = d.shoot_days.select(
        F.lit("day").alias("scene"), F.col("shootDay").alias("heading"), F.col("unit").alias("slug"), none.alias("credited_day"), none.alias("credited_eighths")
    )
    return scenes.unionByName(days)


@query(
    "delivery_notes",
    f"""with {_TAKES_SQL}, d as (select count(*) as c from picked group by coalesce(slate, wild), camera, n, o % 4 having count(*) > 1)
    select 'unexpectedRepeatedTag' as kind, '' as field, count(*) as n from supplier where s_suppkey % 25 = 0
    union all select 'duplicateCharacter', '', count(*) from supplier where s_suppkey % 5 = 0
    union all select 'objectDescription', 'field unit', 1
    union all select 'duplicatedField', 'shot_properties', 1
    union all select 'sentinelNull', 'field comment', count(*) from takes where script_comment = '(null)'
    union all select 'sentinelNull', 'field selectType', count(*) from takes where script_select_type = '(null)'
    union all select 'sentinelNull', 'field slug', count(*) from supplier where s_suppkey % 2 = 0
    union all select 'duplicateTakeKey', '', count(*) from d having count(*) > 0""",
)
def delivery_notes(t: Tables) -> DataFrame:
    """Extraction notes; a sentinel's count is in its text."""
    notes = _delivery(t, staged=True).notes()
    tally = number_or_null(F.regexp_extract("detail", r"^(\d+) value", 1)).cast("bigint")
    named = F.col("kind").isin("sentinelNull", "objectDescription", "duplicatedField")
    return notes.groupBy("kind", F.when(named, F.col("where")).otherwise("").alias("field")).agg(
        F.sum(F.when(F.col("kind") == "sentinelNull", tally).otherwise(1)).alias("n")
    )


@query(
    "delivery_totals",
    f"""with {_TAKES_SQL} select count(*) as takes, count(distinct slate) + max(case when slate is null then 1 else 0 end) as distinct_slates,
        count(*) filter (wild is not null) as wild_tracks, (select count(*) from supplier) as scenes, (select count(*) from region) as shoot_days
    from picked""",
)
def delivery_totals(t: Tables) -> DataFrame:
    return _delivery(t).totals()


@query(
    "delivery_tables",
    """select 'takes' as name, cast(46 as bigint) as columns, count(*) as value from lineitem
    union all select 'narrativeScenes', 21, count(*) from supplier
    union all select 'narrativeSceneCharacters', 5, count(*) + 2 * count(*) filter (s_suppkey % 5 = 0) from supplier
    union all select 'shootDay', 20, count(*) from region
    union all select 'takeCharacters', 10, 2 * count(*) from lineitem where l_orderkey % 2 = 0""",
)
def delivery_tables(t: Tables) -> DataFrame:
    """The five interim tables with their row and column counts."""
    from ..operators.order import data_columns

    frames = [
        df.agg(F.count("*").alias("value")).select(F.lit(name).alias("name"), F.lit(len(data_columns(df))).cast("bigint").alias("columns"), "value")
        for name, df in _delivery(t, staged=True).tables().items()
    ]
    return reduce(DataFrame.unionByName, frames)


@query(
    "delivery_entities",
    f"""with {_TAKES_SQL}, k as (select distinct slate, full_name, scenes, o from picked),
    scene_edges as (select distinct slate, unnest(case when o % 3 = 0 then [o % 50, o % 50 + 1] else [o % 50] end) as s from k where slate is not null)
    select 'entities' as section, 'ProductionScene' as name, count(distinct slate) as value from k
    union all select 'entities', 'Slate', count(distinct full_name) from k
    union all select 'entities', 'NarrativeScene', count(distinct s_suppkey % 50) from supplier
    union all select 'edges', 'ProductionScene Slate', count(distinct concat(slate, ' ', full_name)) from k where slate is not null
    union all select 'edges', 'Slate ProductionScene', count(distinct concat(slate, ' ', full_name)) from k where slate is not null
    union all select 'edges', 'ProductionScene NarrativeScene', count(*) from scene_edges where s in (select s_suppkey % 50 from supplier)
    union all select 'edges', 'NarrativeScene ProductionScene', count(*) from scene_edges where s in (select s_suppkey % 50 from supplier)
    union all select 'edges', 'NarrativeScene Character', count(distinct concat(s_suppkey % 50, n)) from (
        select s_suppkey, unnest(case when s_suppkey % 5 = 0 then ['Dante', 'Oliver'] else ['Dante'] end) as n from supplier)
    union all select 'external', 'Character', count(distinct concat(s_suppkey % 50, n)) from (
        select s_suppkey, unnest(case when s_suppkey % 5 = 0 then ['Dante', 'Oliver'] else ['Dante'] end) as n from supplier)
    union all select 'withheld', 'sceneHeader', count(distinct slate) from k where o % 3 = 0 and slate is not null""",
)
def delivery_entities(t: Tables) -> DataFrame:
    """Delivery to tables to entities to seal, with the built-in mappings."""
    mappings = [m for m in delivery_mappings() if m.table != "assets"]
    tables = {name: stage(df, name) for name, df in _delivery(t, staged=True).tables().items()}
    built = build_entities(tables, mappings, NAMESPACE).stored("keys", "edges")
    seal = seal_bundle(built, {"Slate": [EntityRule("label", required=True)]})
    edges = report_rows(built.edges, "edges", F.concat_ws(" ", "from_type", "to_type"))
    withheld = report_rows(built.notes, "withheld", F.regexp_extract("detail", r"^(\S+) left out", 1))
    return seal.report().unionByName(edges).unionByName(withheld)


_WITNESS = {
    "Slate": "script_scene", "Camera": "script_camera",
    "Take": "case when o % 4 = 0 then concat(cast(n as {text}), '.10') else cast(n as {text}) end",
    "ShotDescription": "case when o % 8 = 3 then 'other' else upper(script_shot_description) end",
    "FrameRate": "'23.9760'",
    "SelectType": "case when o % 3 = 1 then '' else script_select_type end",
}


def _perturbed(t: Tables, text: str = "string") -> DataFrame:
    return _perturbed_takes(_lines(t), text)


def _perturbed_takes(lines: DataFrame, text: str = "string") -> DataFrame:
    takes = lines.select("o", "n", *[F.expr(e).alias(c) for c, e in _take_columns(text).items()])
    return takes.filter("o % 20 <> 19").select("o", "n", *[F.expr(e.format(text=text)).alias(c) for c, e in _WITNESS.items()])


_COMPARED = f"""{_TAKES_SQL},
    keyed as (select distinct o, n, concat(coalesce(slate, wild), '|', camera, '|', n, case when o % 4 = 0 then '.1' else '' end) as key, select_type from picked)"""


@query(
    "witness_a_fields",
    f"""with {_COMPARED}
    select 'shotDescription' as field, 'mismatch' as difference, count(*) as n, null as note from keyed where o % 20 <> 19 and o % 8 = 3
    union all select 'selectType', 'one_sided', count(*), null from keyed where o % 20 <> 19 and o % 3 = 1
    union all select 'take', 'mismatch', count(*), null from keyed where o % 20 <> 19 and o % 4 = 0
    union all select 'comment', 'one_sided', count(*), null from keyed where o % 20 <> 19 and o % 6 > 1
    union all select 'shootDay', 'one_sided', count(*), null from keyed where o % 20 <> 19
    union all select 'lensHeight', 'one_sided', count(*), null from keyed where o % 20 <> 19
    union all select 'distance', 'one_sided', count(*), 'a copy of lensHeight in the primary export and a placeholder in witness A; not real data' from keyed where o % 20 <> 19
    union all select 'recordedTime', 'one_sided', count(*), null from keyed where o % 20 <> 19 and o % 5 <> 0
    union all select 'keys', 'only_left', count(*), null from keyed where o % 20 = 19""",
)
def witness_a_fields(t: Tables) -> DataFrame:
    """The primary export against witness A, per field.

    Labels such as ``3.1 PU`` and ``3.10`` share a take number, so they match as one take and
    still differ as labels.
    """
    out = _write_xml(_perturbed_takes(_spread(_lines(t))).drop("o", "n"), _folder(t, "witness_a"), WITNESS_A_ROOT, WITNESS_A_ROW)
    r = compare_witness(with_take_key(_delivery(t).takes), with_take_key(read_witness_a(t.spark, out)), "a").stored()
    only = r.only_left().agg(F.count("*").alias("n")).select(
        F.lit("keys").alias("field"), F.lit("only_left").alias("difference"), "n", F.lit(None).cast("string").alias("note")
    )
    return r.by_field().unionByName(only)


@query(
    "witness_b_circled",
    f"""with {_TAKES_SQL} select case when o % 7 = 0 then '(blank)' else 'Y' end as flag, coalesce(select_type, '(blank)') as label, count(*) as n
    from picked where o % 20 <> 19 group by all""",
)
def witness_b_circled(t: Tables) -> DataFrame:
    """Witness B's flag against the primary export's class; every witness row counts."""
    rows = _perturbed(t).select(
        "Slate", F.lit("3").alias("Scene"), "Camera", F.lit("r1").alias("Roll"), "Take",
        F.when(F.col("o") % 7 == 0, "").otherwise("Y").alias("Circled"),
    )
    out = _folder(t, "witness_b")
    rows.write.option("header", "true").csv(out)
    return circled_against_select(with_take_key(_delivery(t).takes), with_take_key(read_witness_b(t.spark, out)))


@query(
    "assets_entities",
    """with d as (select doc_id, case when doc_id % 4 = 0 then 'simMetabanqExport' when doc_id % 4 = 1 then 'silverStackLog' when doc_id % 4 = 2 then 'avidClipBin' else 'unknown' end as kind from documents)
    select 'entities' as section, 'Asset' as name, count(*) as value from d
    union all select 'entities', 'AssetStructure', count(*) from d
    union all select 'entities', 'Provenance', count(*) from d
    union all select 'failures', 'AssetStructure', count(*) from d where kind = 'unknown'
    union all select 'types', kind, count(*) from d group by kind""",
)
def assets_entities(t: Tables) -> DataFrame:
    """Delivered files by content signature, to the three entity types they become."""
    opening = (
        F.when(F.col("doc_id") % 4 == 0, f"<{PRIMARY_ROOT}>\n")
        .when(F.col("doc_id") % 4 == 1, "Slate,Scene,Camera,Roll,Take,Circled\n")
        .when(F.col("doc_id") % 4 == 2, "Heading\r\nFIELD_DELIM\tTABS\n")
        .otherwise("~ ")
    )
    files = t.documents.select(
        F.concat(F.lit("/in/f"), "doc_id", F.lit(".txt")).alias("path"), F.concat(F.lit("f"), "doc_id", F.lit(".txt")).alias("file_name"),
        F.lit(".txt").alias("file_extension"), F.lit("text/plain").alias("media_type"), F.col("n_chars").alias("file_size"),
        F.concat(opening, "text").alias("content"),
    )
    signed = opening_signature(files, "content").withColumn("headings", F.lit(None).cast("array<string>"))
    assets = assets_table(classify(signed, signature_rules()), "demo", "1")
    built = build_entities({"assets": assets}, [m for m in delivery_mappings() if m.table == "assets"], NAMESPACE).stored("keys", "edges")
    seal = seal_bundle(built, {"AssetStructure": [EntityRule("assetStructureType", required=True)]})
    return seal.report().unionByName(report_rows(assets, "types", "documentType"))
