"""Metadata pairs, threads, trees, text lines and nested JSON over the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.eav import (
    field_inventory,
    long_to_columns,
    metadata_columns,
    pairs_to_map,
    shadowed_names,
    unclassified_media,
    without_structural_names,
)
from ..operators.edges import explode_edges
from ..operators.lines import page_lines, report_header
from ..operators.order import head_of_stack
from ..operators.threads import child_shortfall, fill_author, flatten_threads, textless, wanted_children
from ..operators.tree import folder_paths, walk_tree
from ..operators.upgrade import (
    append_source_identifier,
    missing_source_identifier,
    name_domains,
    out_of_project,
    scope_to_project,
    upgrade_context,
)
from ..plans.catalogue import structure_known
from ..sources.pages import unwrap_envelope
from .registry import Tables, query

# --- metadata --------------------------------------------------------------------------


def _pairs(t: Tables) -> DataFrame:
    """Customer attributes as pairs: some nameless, some repeated, one that shadows."""
    pair = lambda name, value, mutable: F.struct(
        name.cast("string").alias("name"), F.lit(mutable).alias("mutable"), value.cast("string").alias("value")
    )
    key = F.col("c_custkey")
    return t.customer.select(
        "c_custkey",
        F.array(
            pair(F.lit("Segment"), F.lower("c_mktsegment"), True),
            pair(F.lit("Nation"), F.col("c_nationkey"), False),
            pair(F.when(key % 4 == 0, "").otherwise("Name"), F.col("c_name"), False),
            pair(F.when(key % 5 == 0, "fileId").otherwise("Segment"), F.when(key % 10 != 3, F.col("c_mktsegment")), True),
            pair(F.concat(F.lit("Custom "), key % 3), F.col("c_nationkey") + 1, True),
        ).alias("metadata"),
    )


@query(
    "eav_columns",
    """select c_custkey, case when c_custkey % 5 = 0 then lower(c_mktsegment) when c_custkey % 10 <> 3 then c_mktsegment end as "Segment",
        cast(c_nationkey as varchar) as "Nation", case when c_custkey % 4 <> 0 then c_name end as "Name",
        cast(1 + case when c_custkey % 5 = 0 then 1 else 0 end as integer) as others,
        cast(c_nationkey + 1 as varchar) as custom
    from customer""",
)
def eav_columns(t: Tables) -> DataFrame:
    wide = metadata_columns(_pairs(t), "metadata", ["Segment", "Nation", "Name"])
    custom = F.try_element_at("metadata_rest", F.concat(F.lit("Custom "), F.col("c_custkey") % 3))
    return wide.select(
        "c_custkey", "Segment", "Nation", "Name", F.size("metadata_rest").alias("others"), custom.alias("custom")
    )


@query(
    "eav_long",
    """select user_id, arg_max(props, event_id) filter (event_type = 'click') as click,
        arg_max(props, event_id) filter (event_type = 'error') as error
    from events where event_type in ('click', 'error') group by user_id""",
)
def eav_long(t: Tables) -> DataFrame:
    """A long table of pairs; one user may have a third of all rows."""
    long = t.events.select("user_id", F.col("event_type").alias("name"), F.col("props").alias("value"), "event_id")
    return long_to_columns(long, "user_id", ["click", "error"], F.col("event_id"))


@query("shadowed", "select 'fileId' as name, count(*) as n from customer where c_custkey % 5 = 0")
def shadowed(t: Tables) -> DataFrame:
    mapped = _pairs(t).withColumn("all", pairs_to_map("metadata"))
    return shadowed_names(mapped, "all", ["fileId", "fileName"])


@query(
    "without_shadowed",
    "select c_custkey, cast(4 - case when c_custkey % 4 = 0 then 1 else 0 end as integer) as fields, false as has_file_id from customer",
)
def without_shadowed(t: Tables) -> DataFrame:
    safe = without_structural_names(pairs_to_map("metadata"), ["fileId", "fileName"])
    return _pairs(t).select(
        "c_custkey", F.size(safe).alias("fields"), F.map_contains_key(safe, "fileId").alias("has_file_id")
    )


@query(
    "field_inventory",
    """with long as (
        select event_type as name, json_extract_string(props, '$.k') as value, event_id % 2 = 0 as mutable from events
        union all select c_mktsegment, c_name, false from customer),
    v as (select name, value, count(*) as n, bool_or(mutable) as mutable, row_number() over (partition by name order by value) as r
        from long where value <> '' group by 1, 2)
    select name, cast(sum(n) as bigint) as populated, count(*) as distinct_values, case when bool_or(mutable) then 'entered' else 'derived' end as origin,
        max(case when r = 1 then value end) as example_1, max(case when r = 2 then value end) as example_2,
        max(case when r = 3 then value end) as example_3
    from v group by name""",
)
def field_inventory_events(t: Tables) -> DataFrame:
    events = t.events.select(
        F.col("event_type").alias("name"), F.get_json_object("props", "$.k").alias("value"),
        (F.col("event_id") % 2 == 0).alias("mutable"),
    )
    customers = t.customer.select(F.col("c_mktsegment").alias("name"), F.col("c_name").alias("value"), F.lit(False).alias("mutable"))
    return field_inventory(events.unionByName(customers))


@query(
    "unclassified_media",
    """select coalesce(media, '(none)') as media_type, count(*) as n from (
        select case page_id % 4 when 0 then 'image/png' when 1 then 'model/x' when 2 then null else 'TEXT/plain' end as media from pages)
    where media is null or media = 'model/x' group by 1""",
)
def unclassified_media_pages(t: Tables) -> DataFrame:
    key = F.col("page_id") % 4
    media = F.when(key == 0, "image/png").when(key == 1, "model/x").when(key == 3, "TEXT/plain")
    rows = t.pages.select(media.alias("media"))
    return unclassified_media(rows.withColumn("known", structure_known("media")), "media", "known")


# --- threads ---------------------------------------------------------------------------


def _threads(t: Tables) -> DataFrame:
    """Every turn as a comment on its conversation; a user's turn has two replies."""
    none = F.lit(None).cast("string")
    nobody = F.lit(None).cast("struct<name:string,email:string>")
    person = F.when(F.col("role") != "system", F.struct(F.col("role").alias("name"), F.concat("role", F.lit("@x")).alias("email")))
    own = F.concat("conv_id", F.lit("-"), "turn")

    def reply(number: int, text: Column) -> Column:
        return F.struct(
            F.concat(own, F.lit(f"/{number}")).alias("id"), text.alias("text"), nobody.alias("owner"),
            F.lit(None).cast("bigint").alias("timestamp"), F.lit("2026-01-24").alias("created_at"), none.alias("updated_at"),
        )

    return t.conversations.select(
        F.col("conv_id").alias("file_id"), own.alias("id"),
        F.when(F.col("turn") % 5 != 4, F.col("text")).alias("text"), person.alias("owner"),
        F.col("turn").alias("timestamp"), F.lit("2026-01-23").alias("created_at"), none.alias("updated_at"),
        F.when(F.col("role") == "user", F.array(reply(1, F.concat(F.lit("Re: "), "text")), reply(2, F.lit("")))).alias("replies"),
    )


@query(
    "threads_flatten",
    """select conv_id as file_id, concat(conv_id, '-', turn) as comment_id, case when turn % 5 <> 4 then text end as text,
        nullif(role, 'system') as author, case when role <> 'system' then concat(role, '@x') end as author_email, turn as frame,
        '2026-01-23' as created_at, null as updated_at, null as reply_to
    from conversations
    union all
    select conv_id, concat(conv_id, '-', turn, '/', i), case when i = 1 then concat('Re: ', text) else '' end, null, null, null,
        '2026-01-24', null, concat(conv_id, '-', turn)
    from conversations, (values (1), (2)) r(i) where role = 'user'""",
)
def threads_flatten(t: Tables) -> DataFrame:
    return flatten_threads(_threads(t))


@query(
    "threads_textless",
    """select count(*) filter (turn % 5 = 4 or text = '') + count(*) filter (role = 'user') as n
    from conversations""",
)
def threads_textless(t: Tables) -> DataFrame:
    return textless(flatten_threads(_threads(t)))


def _counted_files(t: Tables) -> DataFrame:
    """Conversations with the comment count they declare: too high, right, or no count at all."""
    replies = F.when(F.col("role") == "user", 2).otherwise(0)
    counts = t.conversations.groupBy(F.col("conv_id").alias("file_id")).agg(F.sum(1 + replies).alias("c"))
    count = (
        F.when(F.col("file_id") % 4 == 0, (F.col("c") + 3).cast("string"))
        .when(F.col("file_id") % 4 == 1, F.col("c").cast("string"))
        .when(F.col("file_id") % 4 == 2, "-5")
        .otherwise("unknown")
    )
    return counts.select("file_id", count.alias("Comment Count"))


@query(
    "child_shortfall",
    """select conv_id as file_id, count(*) + 2 * count(*) filter (role = 'user') + 3 as expected, count(*) as comments,
        count(*) + 2 * count(*) filter (role = 'user') as got
    from conversations where conv_id % 4 = 0 group by 1""",
)
def child_shortfall_files(t: Tables) -> DataFrame:
    return child_shortfall(_counted_files(t), _threads(t), "Comment Count")


@query("wanted_children", "select distinct conv_id as file_id from conversations where conv_id % 4 < 2")
def wanted_children_files(t: Tables) -> DataFrame:
    return wanted_children(_counted_files(t), "Comment Count").select("file_id")


@query(
    "fill_author",
    """with c as (select *, concat(conv_id, '-', turn) as comment_id, nullif(role, 'system') as author from conversations),
    listing as (select concat(conv_id, '-', turn) as comment_id, concat('user', conv_id) as named from conversations where length(text) % 2 = 0)
    select comment_id, coalesce(author, named) as author, coalesce(author, named) is not null as author_known
    from c left join listing using (comment_id)""",
)
def fill_author_turns(t: Tables) -> DataFrame:
    key = F.concat("conv_id", F.lit("-"), "turn").alias("comment_id")
    replies = t.conversations.select(key, F.nullif("role", F.lit("system")).alias("author"))
    listing = t.conversations.filter("length(text) % 2 = 0").select(key, F.concat(F.lit("user"), "conv_id").alias("author"))
    return fill_author(replies, listing)


# --- trees -----------------------------------------------------------------------------

_TREE = """nodes as (
        select concat('r', r_regionkey) as id, 'top' as parent_id, 'folder' as type, r_name as name from region
        union all select concat('n', n_nationkey), concat('r', n_regionkey), 'folder', n_name from nation
        union all select concat('c', c_custkey), concat('n', c_nationkey), 'folder', c_name from customer
        union all select concat('o', o_orderkey), concat('c', o_custkey),
            case when o_orderkey % 50 = 0 then 'link' when o_orderkey % 5 = 0 then 'version_stack' else 'file' end, concat('order', o_orderkey) from orders
        union all select concat('l', l_orderkey, '-', l_linenumber), concat('o', l_orderkey), 'file', concat('line', l_linenumber) from (select distinct l_orderkey, l_linenumber from lineitem where l_orderkey % 5 = 0 and l_orderkey % 50 <> 0)),
    walked as (
        with recursive w(id, path, depth) as (
            select 'top', '/', 0
            union all select n.id, concat(w.path, n.name, '/'), w.depth + 1 from w join nodes n on n.parent_id = w.id where n.type = 'folder' and w.depth < {deep})
        select * from w)"""


def _nodes(t: Tables) -> DataFrame:
    node = lambda df, key, parent, kind, name, position=F.lit(0): df.select(
        key.alias("id"), parent.alias("parent_id"), kind.alias("type"), name.cast("string").alias("name"), position.alias("position")
    )
    tag = lambda letter, column: F.concat(F.lit(letter), F.col(column))
    folder = F.lit("folder")
    key = F.col("o_orderkey")
    kind = F.when(key % 50 == 0, "link").when(key % 5 == 0, "version_stack").otherwise("file")
    lines = t.lineitem.filter("l_orderkey % 5 = 0 and l_orderkey % 50 <> 0").select("l_orderkey", "l_linenumber").distinct()
    return (
        node(t.region, tag("r", "r_regionkey"), F.lit("top"), folder, F.col("r_name"))
        .unionByName(node(t.nation, tag("n", "n_nationkey"), tag("r", "n_regionkey"), folder, F.col("n_name")))
        .unionByName(node(t.customer, tag("c", "c_custkey"), tag("n", "c_nationkey"), folder, F.col("c_name")))
        .unionByName(node(t.orders, tag("o", "o_orderkey"), tag("c", "o_custkey"), kind, F.concat(F.lit("order"), key)))
        .unionByName(
            node(
                lines, F.concat(F.lit("l"), "l_orderkey", F.lit("-"), "l_linenumber"), tag("o", "l_orderkey"), F.lit("file"),
                F.concat(F.lit("line"), "l_linenumber"), F.col("l_linenumber"),
            )
        )
    )


def _root(t: Tables) -> DataFrame:
    return t.region.select(F.lit("top").alias("id")).distinct()


@query("tree_paths", f"with {_TREE.format(deep=25)} select id, 'top' as root_id, path, depth from walked")
def tree_paths(t: Tables) -> DataFrame:
    folders = _nodes(t).filter("type = 'folder'").select("id", "parent_id", "name")
    return folder_paths(folders, _root(t))


_STACK_FILES = """select n.id, w.path as folder_path, concat(w.path, n.name) as path, null as stack_id
    from nodes n join walked w on n.parent_id = w.id where n.type = 'file'
    union all
    select h.id, w.path, concat(w.path, h.name), s.id from nodes s join walked w on s.parent_id = w.id
    join (select parent_id, arg_min(id, name) as id, min(name) as name from nodes where type = 'file' group by 1) h on h.parent_id = s.id
    where s.type = 'version_stack'"""


@query("tree_files", f"with {_TREE.format(deep=25)} {_STACK_FILES}")
def tree_files(t: Tables) -> DataFrame:
    return walk_tree(_nodes(t), _root(t)).files


@query(
    "tree_notes",
    f"""with {_TREE.format(deep=25)}
    select 'unknownChildType' as kind, concat(w.path, n.name) as "where", 'children of type "link" are skipped' as detail
    from nodes n join walked w on n.parent_id = w.id where n.type = 'link'
    union all
    select 'emptyVersionStack', concat(w.path, s.name), 'stack without files' from nodes s join walked w on s.parent_id = w.id
    where s.type = 'version_stack' and s.id not in (select parent_id from nodes where type = 'file')""",
)
def tree_notes(t: Tables) -> DataFrame:
    return walk_tree(_nodes(t), _root(t)).notes()


@query(
    "tree_too_deep",
    f"""with {_TREE.format(deep=25)}
    select 'tooDeep' as kind, path as "where", 'left unread: below the depth limit' as detail from walked where depth = 3""",
)
def tree_too_deep(t: Tables) -> DataFrame:
    return walk_tree(_nodes(t), _root(t), max_depth=2).notes()


@query(
    "head_of_stack",
    """select cast(c_custkey as varchar) as id, case when c_custkey % 10 = 0 then 'inline' else
            cast(arg_max(o_orderkey, o_orderkey) filter (o_orderstatus <> 'P') as varchar) end as head_id
    from customer left join orders on o_custkey = c_custkey group by c_custkey""",
)
def head_of_stack_orders(t: Tables) -> DataFrame:
    stacks = t.customer.select(
        F.col("c_custkey").cast("string").alias("id"), F.when(F.col("c_custkey") % 10 == 0, "inline").alias("head_version")
    )
    children = t.orders.select(
        F.col("o_custkey").cast("string").alias("parent_id"), F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.col("o_orderstatus") == "P", "folder").otherwise("file").alias("type"), (-F.col("o_orderkey")).alias("position"),
    )
    return head_of_stack(stacks, children).select("id", "head_id")


# --- text lines ------------------------------------------------------------------------


def _runs(t: Tables) -> DataFrame:
    """Every word of every document as a run: eight words to a line, forty lines to a page."""
    words = t.documents.select("doc_id", F.posexplode(F.split("text", " ")).alias("i", "text"))
    line = F.floor(F.col("i") / 8)
    return words.select(
        F.col("doc_id").alias("doc"),
        (F.floor(line / 40) + 1).cast("int").alias("page"),
        ((F.col("i") % 8) * 10.0).alias("x"),
        (800 - (line % 40) * 12 + (F.col("i") % 3) * 0.1).alias("y"),
        "text",
    )


_LINES = r"""words as (select doc_id, unnest(string_split(text, ' ')) as w, generate_subscripts(string_split(text, ' '), 1) - 1 as i from documents),
    lines as (
        select doc_id as doc, cast(i // 320 + 1 as integer) as page, 800 - ((i // 8) % 40) * 12 as y,
            trim(regexp_replace(string_agg(w, ' ' order by i), '\s+', ' ', 'g')) as line
        from words where trim(w, ' ' || chr(9) || chr(10) || chr(13)) <> '' group by 1, 2, 3)"""


@query("page_lines", f"with {_LINES} select doc, page, cast(y as bigint) as y, line from lines where line <> ''")
def page_lines_documents(t: Tables) -> DataFrame:
    return page_lines(_runs(t))


def _report_runs(t: Tables) -> DataFrame:
    """Report headers from order data: print date, heading, day with unit, shoot date."""
    lines = F.array(
        F.concat(F.lit("Printed "), F.date_format("o_orderdate", "M/d/yy")),
        F.lit("DAILY COVERAGE"),
        F.concat(F.lit("Day: Day "), F.col("o_orderkey") % 30, F.lit(" - "), "o_orderpriority"),
        F.concat(F.lit("Date: "), F.date_format("o_orderdate", "MM/dd/yyyy")),
        F.col("o_orderstatus"), F.lit("six"), F.concat(F.lit("Day: Day 99 - late")),
    )
    runs = t.orders.select(F.col("o_orderkey").alias("doc"), F.posexplode(lines).alias("i", "text"))
    return runs.select("doc", F.lit(1).alias("page"), F.lit(0.0).alias("x"), (700.0 - F.col("i") * 12).alias("y"), "text")


@query(
    "report_header",
    """select o_orderkey as doc, concat('20', strftime(o_orderdate, '%y-%m-%d')) as print_date, cast(o_orderkey % 30 as varchar) as shoot_day,
        o_orderpriority as unit, strftime(o_orderdate, '%Y-%m-%d') as shoot_date, 'DAILY COVERAGE' as heading
    from orders""",
)
def report_header_orders(t: Tables) -> DataFrame:
    header = report_header(page_lines(_report_runs(t)))
    return header.select(
        "doc", "print_date", "shoot_day", "unit", "shoot_date", F.col("headings")[1].alias("heading")
    )


# --- entities that arrive ready-made ----------------------------------------------------

PREFIX = "com.example.project."


def _works(t: Tables) -> DataFrame:
    """Orders as creative works of the project their customer stands for; some name it by season."""
    identifier = lambda value: F.array(F.struct(F.lit("demo").alias("identifierScope"), value.alias("identifierValue")))
    project = F.concat(F.lit(PREFIX), F.col("o_custkey"))
    episode = F.concat(F.lit("com.example.episode."), F.col("o_orderkey"))
    by_season = F.col("o_orderkey") % 3 == 0
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "Character").otherwise("CreativeWork").alias("entity_type"),
        identifier(F.when(by_season, episode).otherwise(project)).alias("identifier"),
        F.when(by_season, F.array(F.struct(identifier(project).alias("identifier")))).alias("season"),
    )


@query("scope_project", "select o_orderkey from orders where o_orderstatus = 'P' or o_custkey = 12")
def scope_project(t: Tables) -> DataFrame:
    """Project 12 of many whose numbers start with 12."""
    return scope_to_project(_works(t), f"{PREFIX}12").select("o_orderkey")


@query("out_of_project", "select count(*) as dropped from orders where o_orderstatus <> 'P' and o_custkey <> 12")
def out_of_project_orders(t: Tables) -> DataFrame:
    return out_of_project(_works(t), f"{PREFIX}12")


@query(
    "name_domains",
    """select c_custkey, unnest(case when c_custkey % 4 = 0 then ['desk', 'floor'] when c_custkey % 4 = 3 then ['kept'] else [null] end) as domain,
        c_custkey % 4 = 0 as changed from customer""",
)
def name_domains_customers(t: Tables) -> DataFrame:
    key = F.col("c_custkey") % 4
    inner = lambda name: F.struct(F.col(name).alias("v"))
    value = (
        F.when(key == 0, F.to_json(F.struct(inner("c_name").alias("desk"), inner("c_nationkey").alias("floor"))))
        .when(key == 1, F.to_json(F.struct(inner("c_name").alias("desk"), F.col("c_nationkey").alias("floor"))))
        .when(key == 2, F.to_json(F.array("c_name")))
        .otherwise(F.to_json(F.struct(inner("c_name").alias("desk"))))
    )
    custom = t.customer.select("c_custkey", F.when(key == 3, "kept").alias("domain"), value.alias("value"))
    return name_domains(custom).select("c_custkey", "domain", "changed")


@query(
    "name_domain_values",
    """select c_custkey, d as domain, case when d = 'desk' then c_name else cast(c_nationkey as varchar) end as v
    from customer, (values ('desk'), ('floor')) t(d)""",
)
def name_domain_values(t: Tables) -> DataFrame:
    inner = lambda name: F.struct(F.col(name).alias("v"))
    value = F.to_json(F.struct(inner("c_name").alias("desk"), inner("c_nationkey").alias("floor")))
    custom = t.customer.select("c_custkey", F.lit(None).cast("string").alias("domain"), value.alias("value"))
    return name_domains(custom).select("c_custkey", "domain", F.get_json_object("value", "$.v").alias("v"))


TARGET_VERSION = "v3.0"


def _contexts(t: Tables) -> DataFrame:
    reference = lambda column: F.struct(
        F.array(F.struct(F.lit("demo").alias("identifierScope"), F.col(column).cast("string").alias("identifierValue"))).alias("identifier")
    )
    return t.orders.select(
        F.col("o_orderkey").alias("entity_id"),
        F.when(F.col("o_orderkey") % 3 == 0, TARGET_VERSION).otherwise("v2.6").alias("schema_version"),
        F.lit("shootDay").alias("context_type"),
        F.to_json(F.struct(F.col("o_custkey").alias("day"))).alias("properties"),
        F.to_json(F.struct(F.array(reference("o_custkey"), reference("o_orderkey")).alias("ProductionScene"))).alias("has"),
        F.to_json(F.struct(F.array(reference("o_orderpriority")).alias("CreativeWork"))).alias("for_"),
        F.to_json(F.struct(F.col("o_orderstatus").alias("status"))).alias("custom_data"),
    )


@query(
    "upgrade_entities",
    """select o_orderkey as entity_id, 'v3.0' as schema_version, case when o_orderkey % 3 = 0 then null else o_custkey end as nested_day,
        case when o_orderkey % 3 = 0 then o_custkey end as flat_day, case when o_orderkey % 3 <> 0 then o_orderstatus end as listed_status
    from orders""",
)
def upgrade_entities(t: Tables) -> DataFrame:
    """An entity already at the target version passes through untouched."""
    entities, _ = upgrade_context(_contexts(t), TARGET_VERSION)
    return entities.select(
        "entity_id", "schema_version",
        F.get_json_object("properties", "$.shootDay.day").cast("bigint").alias("nested_day"),
        F.get_json_object("properties", "$.day").cast("bigint").alias("flat_day"),
        F.get_json_object("custom_data", "$[0].value.status").alias("listed_status"),
    )


@query(
    "upgrade_edges",
    """select o_orderkey as entity_id, 'has' as edge_key, 'ProductionScene' as to_type, cast(unnest([o_custkey, o_orderkey]) as varchar) as to_value
    from orders where o_orderkey % 3 <> 0
    union all select o_orderkey, 'for', 'CreativeWork', o_orderpriority from orders where o_orderkey % 3 <> 0""",
)
def upgrade_edges(t: Tables) -> DataFrame:
    return upgrade_context(_contexts(t), TARGET_VERSION)[1]


def _edge_json(t: Tables) -> DataFrame:
    reference = F.struct(
        F.array(F.struct(F.lit("demo").alias("identifierScope"), F.col("c_name").alias("identifierValue"))).alias("identifier")
    )
    key = F.col("c_custkey") % 5
    node = (
        F.when(key == 0, F.to_json(F.array(reference, reference)))
        .when(key == 1, F.to_json(reference))
        .when(key == 2, "7")
        .when(key == 3, "null")
        .otherwise("[]")
    )
    edges = F.concat(F.lit('{"has":{"Slate":'), node, F.lit('},"for":{"Scene":"x"}}'))
    return t.customer.select(F.col("c_custkey").alias("entity_id"), F.when(F.col("c_custkey") % 7 != 0, edges).alias("edges"))


@query(
    "malformed_edges",
    """select c_custkey as entity_id, 'has' as edge_key, 'Slate' as to_type, null as malformed, 'demo' as to_scope, c_name as to_value
    from customer, (values (1), (2)) t(i) where c_custkey % 5 = 0 and c_custkey % 7 <> 0
    union all select c_custkey, 'has', 'Slate', case c_custkey % 5 when 1 then 'object' when 2 then 'number' else 'null' end, null, null
    from customer where c_custkey % 5 in (1, 2, 3) and c_custkey % 7 <> 0
    union all select c_custkey, 'for', 'Scene', 'string', null, null from customer where c_custkey % 7 <> 0""",
)
def malformed_edges(t: Tables) -> DataFrame:
    return explode_edges(_edge_json(t))


@query(
    "source_identifier",
    """select 'Customer' as entity_type, cast(c_custkey as varchar) as entity_id, cast(0 as integer) as ordinal, 'local' as scope, cast(c_custkey as varchar) as value from customer
    union all select 'Customer', cast(c_custkey as varchar), 1, 'source', c_name from customer where c_mktsegment <> 'MACHINERY'""",
)
def source_identifier(t: Tables) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    identifiers = t.customer.select(
        F.lit("Customer").alias("entity_type"), key.alias("entity_id"), F.lit(0).alias("ordinal"), F.lit("local").alias("scope"), key.alias("value")
    )
    named = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name"))
    entities = t.customer.select(key.alias("entity_id"), named.alias("source_id"))
    return append_source_identifier(identifiers, entities, "Customer", "source", "source_id")


@query("source_identifier_missing", "select count(*) as missing from customer where c_mktsegment = 'MACHINERY'")
def source_identifier_missing(t: Tables) -> DataFrame:
    named = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name"))
    return missing_source_identifier(t.customer.select(named.alias("source_id")), "source_id")


@query(
    "unwrap_envelope",
    "select o_orderkey, o_orderstatus as status from orders",
)
def unwrap_envelope_orders(t: Tables) -> DataFrame:
    body = F.struct(F.col("o_orderstatus").alias("status"))
    wrapped = F.col("o_orderkey") % 2 == 0
    rows = t.orders.select("o_orderkey", F.when(wrapped, body).alias("data"), F.when(~wrapped, body).alias("body"))
    return unwrap_envelope(rows, "data", "body").select("o_orderkey", F.col("resource.status").alias("status"))
