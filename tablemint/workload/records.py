"""Queries over nested records, page chains, fingerprints of runs, rule tables and published versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_present
from ..operators.chains import chain_problems, in_chain_order
from ..operators.eav import field_inventory, inventory_sketches, merged_inventory, open_columns
from ..operators.fingerprints import fingerprint, level_differences
from ..operators.nested import PathRule, validate_records
from ..operators.order import ORDER, dense_order, first_match
from ..operators.reconcile import golden_diff, run_difference
from ..operators.rule_tables import classify_joined, prefix_classes, roles_from
from ..plans.build import build_entities
from ..plans.mapping import Edge, Mapping, Rest, Source
from ..session import scratch_path, stage
from ..sinks import clean_up, current_version, new_version, publish_version, versions, write_table_set
from ..sources.csv import csv_rows
from .entities import NAMESPACE
from .registry import Tables, query

# --- nested records -------------------------------------------------------------------


def _text_map(pairs: dict[str, Column], backwards: bool) -> Column:
    """A map of texts with its entries in one order or the other."""
    entries = list(pairs.items())[:: -1 if backwards else 1]
    return F.create_map(*[c for name, value in entries for c in (F.lit(name), value.cast("string"))])


def _order_records(t: Tables, backwards: bool) -> DataFrame:
    """An order as a nested record: structure, custom data per line, and a map of maps.

    ``backwards`` writes every map in the other order and differs where the golden copy allows it: the
    path of the file, the day of each custom entry, and anything marked as a run's own.
    """
    key = F.col("l_orderkey")
    shift = F.lit(1 if backwards else 0)
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(order)).alias("lines"))

    def custom(line: Column) -> Column:
        value = _text_map(
            {"part": line["l_partkey"], "flag": line["l_returnflag"], "shootDay": line["l_linenumber"] + shift}, backwards
        )
        return F.struct(F.lit("lines").alias("domain"), value.alias("value"))

    first = F.element_at("lines", 1)
    inner = _text_map({"status": first["l_linestatus"], "run": F.lit(str(backwards)), "supplier": first["l_suppkey"]}, backwards)
    other = _text_map({"run": F.lit(str(backwards)), "quantity": first["l_quantity"]}, not backwards)
    maps = [F.lit("a"), inner, F.lit("b"), other][:: 1]
    marked = F.create_map(*(maps[2:] + maps[:2] if backwards else maps))
    details = F.struct(
        F.concat(F.lit("/remote/" if backwards else "sources/"), key.cast("string")).alias("filePath"),
        F.size("lines").alias("fileSize"),
    )
    return lines.select(
        key.alias("orderkey"),
        F.struct(F.struct(details.alias("fileDetails")).alias("properties"), F.lit("digital").alias("kind")).alias("structure"),
        F.transform("lines", custom).alias("customData"),
        marked.alias("marked"),
    )


@query(
    "golden_nested",
    """with lines as (
        select l_orderkey as k, first(l_returnflag order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus, l_shipdate) as flag
        from lineitem group by l_orderkey)
    select k as orderkey, case when k % 700 = 3 then 'missing' else 'differing' end as state from lines
    where k % 700 = 3 or k % 90 = 1 or (k % 50 = 2 and flag <> 'R')
    union all select -k - 1, 'extra' from lines where k % 700 = 3""",
)
def golden_nested(t: Tables) -> DataFrame:
    """Nested records against their golden copy: maps in another order, run-specific paths left out."""
    actual = _order_records(t, backwards=True)
    key = F.col("orderkey")
    custom = F.transform(
        "customData",
        lambda c, i: F.when(
            (key % 50 == 2) & (i == 0),
            F.struct(c["domain"].alias("domain"), F.map_concat(F.map_filter(c["value"], lambda k, v: k != "flag"), F.create_map(F.lit("flag"), F.lit("R"))).alias("value")),
        ).otherwise(c),
    )
    changed = actual.select(
        F.when(key % 700 == 3, -key - 1).otherwise(key).alias("orderkey"),
        F.struct(F.col("structure.properties").alias("properties"), F.when(key % 90 == 1, "other").otherwise(F.col("structure.kind")).alias("kind")).alias("structure"),
        custom.alias("customData"),
        "marked",
    )
    ignore = ("structure.properties.fileDetails.filePath", "customData[].value.shootDay", "marked.*.run")
    return golden_diff(_order_records(t, backwards=False), changed, ["orderkey"], ignore)


_REFERENCE = "edges.*.*[].identifier[].identifierValue"
RECORD_RULES = {
    "Order": [
        PathRule("annotation", kind="array", least=1),
        PathRule("annotation[]", only=("author", "title", "text")),
        PathRule("annotation[].title", required=True, allowed=("F",)),
        PathRule("annotation[].text", required=True),
        PathRule("customData[].value.quantity", required=True, kind="number"),
        PathRule(_REFERENCE, required=True, pattern="^[0-9]+$"),
    ],
    "Return": [PathRule("edges.*.*", kind="array"), PathRule("customData[].value.quantity", kind="string")],
}


def _record_texts(t: Tables) -> DataFrame:
    """Orders as JSON records with texts, custom data and references, some of them faulty."""
    key = F.col("l_orderkey")
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(order)).alias("lines"))
    note = lambda x: F.struct(
        F.lit("line").alias("author"),
        x["l_linestatus"].alias("title"),
        F.when(x["l_returnflag"] != "A", x["l_returnflag"]).alias("text"),
        F.when(x["l_quantity"] > 49, "red").alias("colour"),
    )
    custom = lambda x: F.struct(F.lit("demo").alias("domain"), F.struct(x["l_quantity"].cast("int").alias("quantity")).alias("value"))
    part = lambda x: F.struct(
        F.array(F.struct(F.concat(F.when(x["l_partkey"] % 13 == 0, "p").otherwise(""), x["l_partkey"].cast("string")).alias("identifierValue"))).alias("identifier")
    )
    record = F.to_json(
        F.struct(
            F.transform("lines", note).alias("annotation"),
            F.transform("lines", custom).alias("customData"),
            F.struct(F.struct(F.transform("lines", part).alias("Part")).alias("has")).alias("edges"),
        )
    )
    return lines.select(
        F.when(key % 5 == 0, "Return").otherwise("Order").alias("entityType"),
        key.alias("key"),
        F.when(key % 777 == 7, F.substring(record, 1, 9)).otherwise(record).alias("record"),
    )


@query(
    "validate_records",
    """with l as (
        select l_orderkey as k, l_partkey as p, l_quantity as q, l_returnflag as r, l_linestatus as s,
            row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus, l_shipdate) - 1 as i,
            case when l_orderkey % 5 = 0 then 'Return' else 'Order' end as t
        from lineitem),
    ok as (select * from l where k % 777 <> 7), o as (select * from ok where t = 'Order'),
    found as (
        select distinct t, k, '' as path, 'not readable as JSON' as error from l where k % 777 = 7
        union all select t, k, concat('/annotation/', i, '/colour'), 'not expected here' from o where q > 49
        union all select t, k, concat('/annotation/', i, '/title'), 'not among the allowed values' from o where s <> 'F'
        union all select t, k, concat('/annotation/', i, '/text'), 'a value is required' from o where r = 'A'
        union all select t, k, concat('/edges/has/Part/', i, '/identifier/0/identifierValue'), 'not in the expected form' from o where p % 13 = 0
        union all select t, k, concat('/customData/', i, '/value/quantity'), 'string expected, number found' from ok where t = 'Return')
    select t as entity_type, cast(k as varchar) as identifier, path, error from found""",
)
def validate_order_records(t: Tables) -> DataFrame:
    """Rules on texts, custom data and references inside records, each failure with its path."""
    return validate_records(_record_texts(t), RECORD_RULES, "entityType", "key", "record")


# --- chains of landed pages -----------------------------------------------------------

# Pages of six endpoints, one an order: 0 is whole, 1 returns to an earlier page at its end, 2 lacks a page
# near its end, 3 answers one cursor twice, 4 has a side page that joins, 5 lacks its first page.
_CHAIN_SQL = """with n as (
        select o_orderkey % 6 as e, o_orderkey // 6 as i, max(o_orderkey // 6) over (partition by o_orderkey % 6) as last from orders),
    pages as (
        select concat('e', e) as endpoint, e, i, last,
            case when i = 0 and e <> 5 then null when e = 4 and i = 5 then 'side' else concat('c', i) end as cursor,
            case when e = 1 and i = last then 'c7' when i = last then null when e = 4 and i = 4 then 'c6' else concat('c', i + 1) end as next,
            i % 3 as rows, i < last or e = 4 as has_more
        from n where not (e = 2 and i = last - 3)
        union all select 'e3', 3, i, last, concat('c', i), 'c2', 1, true from n where e = 3 and i = 10)"""


def _chained_pages(t: Tables) -> DataFrame:
    endpoint, place = F.col("o_orderkey") % 6, F.floor(F.col("o_orderkey") / 6)
    numbered = t.orders.select(endpoint.alias("e"), place.cast("long").alias("i"))
    lasts = numbered.groupBy("e").agg(F.max("i").alias("last"))
    e, i, last = F.col("e"), F.col("i"), F.col("last")
    named = lambda c: F.concat(F.lit("c"), c)
    pages = numbered.join(lasts, "e").filter(~((e == 2) & (i == last - 3)))
    cursor = F.when((i == 0) & (e != 5), None).when((e == 4) & (i == 5), "side").otherwise(named(i))
    following = (
        F.when((e == 1) & (i == last), "c7").when(i == last, None).when((e == 4) & (i == 4), "c6").otherwise(named(i + 1))
    )
    first = pages.select("e", "i", "last", cursor.alias("cursor"), following.alias("next"), (i % 3).alias("rows"), ((i < last) | (e == 4)).alias("has_more"))
    twice = pages.filter((e == 3) & (i == 10)).select("e", "i", "last", named(i), F.lit("c2"), F.lit(1).cast("long"), F.lit(True))
    return first.union(twice).withColumn("endpoint", F.concat(F.lit("e"), e))


@query(
    "page_chain",
    f"""{_CHAIN_SQL}
    select endpoint, cursor, next, cast(case
        when e = 5 or (e = 2 and i > last - 3) or (e = 4 and cursor = 'side') then null
        when e = 4 and i > 4 then i - 1 else i end as bigint) as chain_position
    from pages""",
)
def page_chain(t: Tables) -> DataFrame:
    """Pages in the order in which a reader who follows the cursors meets them.

    Where one cursor was answered twice the smaller answer is followed, which here leads on.
    """
    return in_chain_order(_chained_pages(t)).select("endpoint", "cursor", "next", "chain_position")


@query(
    "chain_problems",
    f"""{_CHAIN_SQL}
    select endpoint, 'noFirstPage' as problem, null as cursor from pages where e = 5 group by endpoint
    union all select distinct endpoint, 'differingAnswers', cursor from pages where e = 3 and i = 10
    union all select distinct endpoint, 'loop', 'c7' from pages where e = 1
    union all select distinct endpoint, 'missingPage', concat('c', last - 3) from pages where e = 2
    union all select distinct endpoint, 'repeatedCursor', 'c6' from pages where e = 4
    union all select endpoint, 'unreached', cursor from pages
        where e = 5 or (e = 2 and i > last - 3) or cursor = 'side'
    union all select endpoint, 'unfinished', cursor from pages where e = 4 and next is null and has_more and rows > 0""",
)
def chain_problems_orders(t: Tables) -> DataFrame:
    return chain_problems(_chained_pages(t).select("endpoint", "cursor", "next", "rows", "has_more"))


# --- runs compared by fingerprint -----------------------------------------------------


def _runs(t: Tables) -> tuple[DataFrame, DataFrame]:
    """A run over the lines, and a later one with a few changed, a few repeated, in another column order."""
    first = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    changed = F.when((F.col("l_orderkey") % 2_000 == 9) & (F.col("l_returnflag") == "A"), None).otherwise(F.col("l_returnflag"))
    second = first.withColumn("l_returnflag", changed)
    repeated = second.filter("l_orderkey % 3000 = 11")
    return first, second.union(repeated).select("l_returnflag", "l_quantity", "l_orderkey", "l_partkey", "l_linenumber")


_RUN_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag"


@query(
    "run_fingerprints",
    f"""with a as (select {_RUN_COLUMNS} from lineitem),
    b as (select l_orderkey, l_linenumber, l_partkey, l_quantity, case when l_orderkey % 2000 = 9 and l_returnflag = 'A' then null else l_returnflag end as l_returnflag from lineitem),
    c as (select *, 1 as n from a union all select *, -1 from b union all select *, -1 from b where l_orderkey % 3000 = 11)
    select {_RUN_COLUMNS}, case when sum(n) > 0 then 'first' else 'second' end as only_in, cast(abs(sum(n)) as bigint) as copies
    from c group by {_RUN_COLUMNS} having sum(n) <> 0""",
)
def run_fingerprints(t: Tables) -> DataFrame:
    """Rows that two runs do not share; only rows in buckets whose fingerprints differ are shuffled."""
    first, second = _runs(t)
    return run_difference(first, second, prints=(fingerprint(first), fingerprint(second)))


@query(
    "fingerprint_levels",
    """select 'same' as compared, level, cast(0 as bigint) as differing from (values ('run'), ('group'), ('bucket')) v(level)
    union all select 'changed', 'run', count(distinct 1) from lineitem
    where l_orderkey % 3000 = 11 or (l_orderkey % 2000 = 9 and l_returnflag = 'A')""",
)
def fingerprint_levels(t: Tables) -> DataFrame:
    """Equal runs differ at no level, whatever the order of rows and columns; changed ones at the top."""
    first, second = _runs(t)
    shuffled = first.select(*reversed(first.columns)).repartition(5)
    same = level_differences(fingerprint(first), fingerprint(shuffled)).select(F.lit("same").alias("compared"), "level", "differing")
    changed = level_differences(fingerprint(first), fingerprint(second)).filter("level = 'run'")
    return same.union(changed.select(F.lit("changed"), "level", "differing"))


# --- rules that come as tables --------------------------------------------------------


def _signature_rules(t: Tables) -> DataFrame:
    """Rules derived from the parts: prefixes, roots, headings and some patterns."""
    key = F.col("p_partkey")
    basis = (
        F.when(key % 100 == 3, "text_pattern").when(key % 4 == 0, "header_prefix").when(key % 4 == 1, "xml_root").when(key % 4 == 2, "heading")
    )
    value = (
        F.when(key % 100 == 3, F.concat(F.lit("^"), "p_brand", F.lit(" S")))
        .when(key % 4 == 0, F.concat("p_name", F.lit(" "), "p_brand"))
        .when(key % 4 == 1, F.replace("p_name", F.lit(" "), F.lit("_")))
        .otherwise(F.concat("p_type", "p_size"))
    )
    return t.part.select(
        key.alias("rule_no"), basis.alias("basis"), value.alias("value"), F.concat(F.lit("type"), key).alias("document_type"),
        F.col("p_name").alias("description"), F.lit("digital").alias("structure"), F.lit(None).cast("int").alias("expected_per_day"),
    ).filter("basis is not null")


_RULES_SQL = """with rules as (
        select p_partkey as n, case when p_partkey % 100 = 3 then 't' when p_partkey % 4 = 0 then 'p' when p_partkey % 4 = 1 then 'x' when p_partkey % 4 = 2 then 'h' end as b,
            case when p_partkey % 100 = 3 then concat('^', p_brand, ' S') when p_partkey % 4 = 0 then concat(p_name, ' ', p_brand)
                when p_partkey % 4 = 1 then replace(p_name, ' ', '_') else concat(p_type, p_size) end as v
        from part),
    docs as (
        select p_partkey as k, concat(p_name, ' ', p_brand, ' ', p_size) as line, case when p_size % 3 = 0 then replace(p_name, ' ', '_') end as root,
            [concat(p_type, p_size), p_brand] as headings, concat(p_brand, ' ', p_type) as head from part),
    met as (
        select k, n from docs join rules on b = 'x' and root = v
        union all select k, n from docs join rules on b = 'p' and starts_with(line, v)
        union all select k, n from (select k, unnest(headings) as h from docs) join rules on b = 'h' and h = v
        union all select k, n from docs join rules on b = 't' and regexp_matches(head, v)),
    best as (select k, min(n) as n from met group by k)"""


@query(
    "rule_table_joined",
    f"""{_RULES_SQL} select k as part, coalesce('type' || n, 'unknown') as document_type,
        coalesce(case b when 'x' then 'xml_root' when 'p' then 'header_prefix' when 'h' then 'heading' when 't' then 'text_pattern' end, 'unmatched') as classified_by
    from docs left join best using (k) left join rules using (n)""",
)
def rule_table_joined(t: Tables) -> DataFrame:
    """As many rules as parts, joined by index; the first that applies wins."""
    signatures = t.part.select(
        F.col("p_partkey").alias("part"),
        F.concat("p_name", F.lit(" "), "p_brand", F.lit(" "), "p_size").alias("first_line"),
        F.when(F.col("p_size") % 3 == 0, F.replace("p_name", F.lit(" "), F.lit("_"))).alias("xml_root"),
        F.array(F.concat("p_type", "p_size"), F.col("p_brand")).alias("headings"),
        F.concat("p_brand", F.lit(" "), "p_type").alias("head"),
    )
    return classify_joined(signatures, _signature_rules(t), ["part"]).select("part", "document_type", "classified_by")


@query(
    "roles_from_table",
    """with m as (
        select page_id, min(n_nationkey) as n from pages join nation on n_nationkey % 5 <> 4 and regexp_matches(url, concat('(?i)/', n_nationkey)) group by 1)
    select page_id, coalesce(n_name, (select n_name from nation where n_nationkey = 4)) as role
    from pages left join m using (page_id) left join nation on n_nationkey = n""",
)
def roles_from_table(t: Tables) -> DataFrame:
    """Roles by patterns that come as a table; those without a pattern are what is left for the rest."""
    pattern = F.when(F.col("n_nationkey") % 5 != 4, F.concat(F.lit("/"), "n_nationkey"))
    roles = t.nation.select(F.col("n_nationkey").alias("role_no"), F.col("n_name").alias("role"), pattern.alias("pattern"))
    return roles_from(t.pages.select("page_id", "url"), "url", roles).select("page_id", "role")


_PREFIX_SQL = """select p_partkey as n, lower(left(p_name, 2 + cast(p_partkey % 8 as int))) as prefix, p_brand as class from part where p_partkey % 3 > 0"""


@query(
    "prefix_tables",
    f"""with p as ({_PREFIX_SQL}), v as (select distinct lower(p_name) as value from part),
    m as (select value, min_by(class, n) as first, min_by(class, {{'l': -length(prefix), 'n': n}}) as longest from v join p on starts_with(value, prefix) group by 1)
    select p_partkey as part, first, longest from part left join m on value = lower(p_name)""",
)
def prefix_tables(t: Tables) -> DataFrame:
    """Classes by prefix: the first prefix of the table that fits, and the longest."""
    key = F.col("p_partkey")
    table = t.part.filter(key % 3 > 0).select(
        key.alias("rule_no"), F.upper(F.left("p_name", (key % 8 + 2).cast("int"))).alias("prefix"), F.col("p_brand").alias("class")
    )
    first = prefix_classes(t.part.select(key.alias("part"), "p_name"), "p_name", ["part"], table, "first")
    return prefix_classes(first, "p_name", ["part"], table, "longest", longest=True).select("part", "first", "longest")


# --- published versions ---------------------------------------------------------------


@query(
    "published_versions",
    """select 'current' as read, o_orderstatus as status, count(*) as n from orders where o_orderkey % 5 > 0 group by 2
    union all select 'earlier', o_orderstatus, count(*) from orders group by 2""",
)
def published_versions(t: Tables) -> DataFrame:
    """Three versions published one after another: readers follow the pointer, the oldest is cleaned up."""
    out = scratch_path(t.spark, "versions")
    for rows in (t.orders.limit(0), t.orders, t.orders.filter("o_orderkey % 5 > 0")):
        folder = new_version(out)
        rows.select("o_orderstatus").write.parquet(folder)
        publish_version(t.spark, out, folder)
    clean_up(t.spark, out, keep=2)
    kept = versions(t.spark, out)
    read = lambda name, folder: t.spark.read.parquet(folder).select(F.lit(name).alias("read"), F.col("o_orderstatus").alias("status"))
    both = read("current", current_version(t.spark, out)).union(read("earlier", kept[1].folder))
    return both.groupBy("read", "status").agg(F.count("*").alias("n"))


# --- columns called key ---------------------------------------------------------------

KEYED = [
    Mapping(
        "Order", "lines", "l_orderkey", grain="group",
        properties={"flag": Source("Key", when="unanimous"), "first": "Key"},
        custom=Rest("demo", include=("l_suppkey", "keyed")),
        edges=(Edge("Flag", "Key", external=True),),
    ),
    Mapping("Customer", "customers", "key", properties={"segment": "c_mktsegment"}, custom=Rest("demo", include=("key", "c_name"))),
]


@query(
    "key_columns",
    """with l as (select l_orderkey as o, l_returnflag as f, l_suppkey as s from lineitem), g as (
        select o, case when count(distinct f) = 1 then max(f) end as flag, min(f) as least,
            case when count(distinct s) = 1 then max(s) end as s from l group by o)
    select 'flag' as fact, cast(o as varchar) as key, flag as value from g
    union all select 'custom l_suppkey', cast(o as varchar), cast(s as varchar) from g where s is not null
    union all select 'edge', cast(o as varchar), f from (select distinct o, f from l)
    union all select 'segment', cast(c_custkey as varchar), c_mktsegment from customer
    union all select 'custom key', cast(c_custkey as varchar), cast(c_custkey as varchar) from customer
    union all select 'custom c_name', cast(c_custkey as varchar), c_name from customer
    union all select 'withheld', concat('Order ', o), 'propertyWithheld' from g where flag is null""",
)
def key_columns(t: Tables) -> DataFrame:
    """Tables with columns called Key and key: mapped, carried, followed and noted under their own names."""
    lines = t.lineitem.select("l_orderkey", "l_suppkey", F.col("l_returnflag").alias("Key"))
    customers = t.customer.select(F.col("c_custkey").alias("key"), "c_name", "c_mktsegment")
    built = build_entities({"lines": lines, "customers": customers}, KEYED, NAMESPACE)
    row = lambda df, fact, value: df.select(fact.alias("fact"), F.col("key"), value.cast("string").alias("value"))
    custom = built.custom.select("key", F.explode("value").alias("name", "value"))
    edges = built.edges.select(F.col("from_key").alias("key"), "to_key")
    notes = built.notes.select(F.col("where").alias("key"), "kind")
    return (
        row(built.entities["Order"], F.lit("flag"), F.col("flag"))
        .union(row(custom, F.concat(F.lit("custom "), "name"), F.col("value")))
        .union(row(edges, F.lit("edge"), F.col("to_key")))
        .union(row(built.entities["Customer"], F.lit("segment"), F.col("segment")))
        .union(row(notes, F.lit("withheld"), F.col("kind")))
    )


# --- names found in the data ----------------------------------------------------------


@query(
    "open_columns",
    """with e as (select event_id, user_id, event_type, ts, value from events)
    select 'Type' as name, count(*) as n, count(distinct event_type) as distinct_values, count(*) * 2 - count(*) filter (event_id % 4 = 0) as others from e
    union all select 'Often', count(*) filter (event_id % 3 > 0), count(distinct user_id) filter (event_id % 3 > 0), count(*) * 2 - count(*) filter (event_id % 4 = 0) from e""",
)
def open_columns_events(t: Tables) -> DataFrame:
    """Metadata with two frequent names and a tail of names as long as the table: the tail stays a map."""
    key = F.col("event_id")
    pair = lambda n, v: F.struct(n.alias("name"), v.cast("string").alias("value"))
    pairs = F.array_compact(
        F.array(
            pair(F.lit("Type"), F.col("event_type")),
            F.when(key % 3 > 0, pair(F.lit("Often"), F.col("user_id"))),
            pair(F.concat(F.lit("tail "), key), F.col("value")),
            F.when(key % 4 > 0, pair(F.concat(F.lit("Tail "), key), F.col("ts"))),
        )
    )
    wide, names = open_columns(t.events.select("event_id", pairs.alias("metadata")), "metadata", 0.5)
    others = wide.agg(F.sum(F.size("metadata_rest"))).scalar()
    figures = [F.struct(F.lit(c).alias("name"), F.count(f"`{c}`").alias("n"), F.count_distinct(F.col(f"`{c}`")).alias("distinct_values")) for c in names]
    return wide.agg(F.array(*figures).alias("f")).select(F.inline("f")).withColumn("others", others)


@query(
    "inventory_sketches",
    """select event_type as name, count(*) as populated, 'entered' as origin, true as close, true as merged
    from events where value is not null group by 1""",
)
def inventory_sketches_events(t: Tables) -> DataFrame:
    """Distinct counts from sketches of days, merged: within 3 % of the exact ones, as if taken at once."""
    long = t.events.select(
        F.to_date("ts").alias("day"), F.col("event_type").alias("name"), F.col("value").cast("string").alias("value"), F.lit(True).alias("mutable")
    )
    days = merged_inventory(stage(inventory_sketches(long, ["day"]), "sketches"))
    once = field_inventory(long, approximate=True).select("name", F.col("distinct_values").alias("_once"))
    exact = field_inventory(long, examples=1).select("name", F.col("distinct_values").alias("_exact"))
    error = F.abs(F.col("distinct_values") - F.col("_exact"))
    joined = days.join(once, "name").join(exact, "name")
    return joined.select(
        "name", "populated", "origin", (error <= F.ceil(F.col("_exact") * 0.03)).alias("close"),
        (F.abs(F.col("distinct_values") - F.col("_once")) <= F.ceil(F.col("_exact") * 0.03)).alias("merged"),
    )


@query(
    "dense_order",
    """select count(*) as rows, count(*) as numbers, cast(0 as bigint) as lowest, count(*) - 1 as highest,
        count(distinct o_custkey) as customers, cast(0 as bigint) as differing from orders""",
)
def dense_order_orders(t: Tables) -> DataFrame:
    """Rows of several files numbered in source order; the numbers pick the same first rows as the order."""
    out = scratch_path(t.spark, "ordered")
    write_table_set({"orders": t.orders.repartition(5).select("o_orderkey", "o_custkey")}, out)
    read = stage(csv_rows(t.spark, f"{out}/orders").filter(is_present("o_orderkey")), "rows")
    dense = stage(dense_order(read), "numbered")
    pick = lambda df, name: first_match(df.select("o_custkey", "o_orderkey", ORDER), ["o_custkey"]).withColumnRenamed("o_orderkey", name)
    picks = pick(read, "_a").join(pick(dense, "_b"), "o_custkey", "full_outer").agg(
        F.count("*").alias("customers"), F.count_if(~F.col("_a").eqNullSafe(F.col("_b"))).alias("differing")
    )
    number = F.col(ORDER)
    return dense.agg(
        F.count("*").alias("rows"), F.count_distinct(number).alias("numbers"), F.min(number).alias("lowest"), F.max(number).alias("highest"),
        picks.select("customers").scalar().alias("customers"), picks.select("differing").scalar().alias("differing"),
    )
