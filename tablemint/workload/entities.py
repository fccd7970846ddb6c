"""Entity builds over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import first_match, first_present, last_wins, with_order
from ..operators.quality import table_counts
from ..plans.build import Built, build_entities
from ..plans.mapping import Lookup, Mapping, Rest, Source, Text, mappings_for
from ..plans.nest import nest
from .registry import Tables, query

NAMESPACE = "demo"

# Columns that tell all lines of an order apart; their order serves as source order.
LINE_ORDER = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
LINE_ORDER_SQL = ", ".join(LINE_ORDER)


def ordered_lines(t: Tables) -> DataFrame:
    return with_order(t.lineitem, *LINE_ORDER)


def sql_id(entity_type: str, key: str) -> str:
    """The SQL of an entity id, for oracles."""
    seed = f"{len(NAMESPACE)}:{NAMESPACE}|{len(entity_type)}:{entity_type}|"
    return f"sha256(concat('{seed}', length(cast({key} as varchar)), ':', {key}))"


ORDER_MAPPING = Mapping(
    "Order", "lineitem", "l_orderkey", grain="group",
    properties={
        "orderStatus": Source("l_orderkey", lookup=Lookup("orders", "o_orderkey", "o_orderstatus")),
        "returnFlag": Source("l_returnflag", when="unanimous"),
        "firstPart": "l_partkey",
    },
    custom=Rest("demo", include=("l_linestatus", "l_suppkey", "l_quantity", "l_linenumber")),
)


def _orders(t: Tables) -> Built:
    tables = {"lineitem": ordered_lines(t), "orders": t.orders}
    return build_entities(tables, [ORDER_MAPPING], NAMESPACE)


@query(
    "entity_group_orders",
    f"""with lines as (
        select *, row_number() over (partition by l_orderkey order by {LINE_ORDER_SQL}) as rn from lineitem),
    grouped as (
        select l_orderkey,
            case when count(distinct l_returnflag) = 1 then max(l_returnflag) end as flag,
            max(case when rn = 1 then l_partkey end) as part
        from lines group by l_orderkey)
    select cast(l_orderkey as varchar) as key, {sql_id('Order', 'l_orderkey')} as entity_id,
        o_orderstatus as order_status, flag as return_flag, part as first_part
    from grouped left join orders on o_orderkey = l_orderkey""",
)
def entity_group_orders(t: Tables) -> DataFrame:
    return _orders(t).entities["Order"].select(
        "key", "entity_id",
        F.col("orderStatus").alias("order_status"),
        F.col("returnFlag").alias("return_flag"),
        F.col("firstPart").alias("first_part"),
    )


@query(
    "custom_agreed",
    """with agreed as (
        select l_orderkey, unnest([
            {'name': 'l_linestatus', 'value': case when count(distinct l_linestatus) = 1 then max(l_linestatus) end},
            {'name': 'l_suppkey', 'value': case when count(distinct l_suppkey) = 1 then cast(max(l_suppkey) as varchar) end},
            {'name': 'l_quantity', 'value': case when count(distinct l_quantity) = 1 then cast(max(l_quantity) as varchar) end},
            {'name': 'l_linenumber', 'value': case when count(distinct l_linenumber) = 1 then cast(max(l_linenumber) as varchar) end}
        ], recursive := true)
        from lineitem group by l_orderkey)
    select cast(l_orderkey as varchar) as key, 'demo' as domain, name, value from agreed where value is not null""",
)
def custom_agreed(t: Tables) -> DataFrame:
    return _orders(t).custom.select("key", "domain", F.explode("value").alias("name", "value"))


@query(
    "notes_withheld",
    """select 'propertyWithheld' as kind, concat('Order ', l_orderkey) as "where",
        concat('returnFlag left out: rows disagree, ', count(*), ' of them give ', count(distinct l_returnflag),
            ' for "l_returnflag"') as detail
    from lineitem group by l_orderkey having count(distinct l_returnflag) > 1""",
)
def notes_withheld(t: Tables) -> DataFrame:
    return _orders(t).notes


SCENES_CELL = "concat(o_orderpriority, ';', case when o_orderkey % 3 = 0 then o_orderstatus when o_orderkey % 3 = 1 then ' ' else o_orderpriority end)"
SINGLE_MAPPING = Mapping(
    "Order", "orders", "o_orderkey",
    properties={"priority": Source("cell", split=";", when="single"), "all": Source("cell", split=";")},
)


def _single(t: Tables) -> Built:
    rows = t.orders.withColumn("cell", F.when(F.col("o_orderkey") % 50 == 7, ";").otherwise(F.expr(SCENES_CELL)))
    return build_entities({"orders": rows.select("o_orderkey", "cell")}, [SINGLE_MAPPING], NAMESPACE)


_SINGLE_SQL = f"""with cells as (
        select o_orderkey, case when o_orderkey % 50 = 7 then ';' else {SCENES_CELL} end as cell from orders),
    members as (
        select *, list_sort(list_distinct(list_filter(list_transform(string_split(cell, ';'), lambda x: trim(x)), lambda x: x <> ''))) as m
        from cells)"""


@query(
    "single_member",
    f"""{_SINGLE_SQL}
    select cast(o_orderkey as varchar) as key, case when len(m) = 1 then m[1] end as priority,
        nullif(array_to_string(m, ', '), '') as all_members
    from members""",
)
def single_member(t: Tables) -> DataFrame:
    return _single(t).entities["Order"].select("key", "priority", F.col("all").alias("all_members"))


@query(
    "notes_single",
    f"""{_SINGLE_SQL}
    select 'propertyWithheld' as kind, concat('Order ', o_orderkey) as "where",
        concat('priority left out: one member wanted, "cell" lists ', len(m), ' [', coalesce(array_to_string(m, ', '), ''),
            ']') as detail
    from members where len(m) <> 1""",
)
def notes_single(t: Tables) -> DataFrame:
    return _single(t).notes


CUSTOMER_MAPPING = Mapping(
    "Customer", "customer", "c_custkey",
    properties={
        "customerName.fullName": "c_name",
        "segment": "c_mktsegment",
        "balance": Source("balance_text", cast="number"),
        "kind": Source(const="buyer"),
        "nation": Source("c_nationkey", lookup=Lookup("nation", "n_nationkey", "n_name")),
    },
    texts={"annotation": (Text("Segment", "remark", author="desk"), Text("Balance", "balance_text"))},
    custom=Rest("demo", exclude=("c_mktsegment", "c_acctbal")),
)


def _customers(t: Tables) -> Built:
    remark = F.when(F.col("c_custkey") % 3 == 0, F.lower("c_mktsegment")).when(F.col("c_custkey") % 3 == 1, "")
    balance = F.when(F.col("c_custkey") % 5 == 0, "n/a").otherwise(F.col("c_acctbal").cast("decimal(18,2)").cast("string"))
    rows = t.customer.withColumn("remark", remark).withColumn("balance_text", balance)
    return build_entities({"customer": rows, "nation": t.nation}, [CUSTOMER_MAPPING], NAMESPACE)


_CUSTOMER_SQL = """with rows as (
        select *, case when c_custkey % 3 = 0 then lower(c_mktsegment) when c_custkey % 3 = 1 then '' end as remark,
            case when c_custkey % 5 = 0 then 'n/a' else cast(cast(c_acctbal as decimal(18,2)) as varchar) end as balance_text
        from customer)"""


@query(
    "entity_row_customers",
    f"""{_CUSTOMER_SQL}
    select cast(c_custkey as varchar) as key, {sql_id('Customer', 'c_custkey')} as entity_id, c_name as full_name,
        c_mktsegment as segment, try_cast(balance_text as double) as balance, 'buyer' as kind, n_name as nation
    from rows left join nation on n_nationkey = c_nationkey""",
)
def entity_row_customers(t: Tables) -> DataFrame:
    return _customers(t).entities["Customer"].select(
        "key", "entity_id", F.col("`customerName.fullName`").alias("full_name"), "segment", "balance", "kind", "nation"
    )


@query(
    "custom_rest",
    f"""{_CUSTOMER_SQL}
    select cast(c_custkey as varchar) as key, 'demo' as domain, name, value
    from (select c_custkey, unnest([
            {{'name': 'c_nationkey', 'value': cast(c_nationkey as varchar)}},
            {{'name': 'c_custkey', 'value': cast(c_custkey as varchar)}}], recursive := true) from rows)
    where value <> ''""",
)
def custom_rest(t: Tables) -> DataFrame:
    """A column feeding a lookup is still carried; consumed and excluded ones are not."""
    return _customers(t).custom.select("key", "domain", F.explode("value").alias("name", "value"))


@query(
    "entity_texts",
    f"""{_CUSTOMER_SQL}
    select cast(c_custkey as varchar) as key, 'annotation' as path, 'desk' as author, 'Segment' as title, remark as text
    from rows where remark <> ''
    union all
    select cast(c_custkey as varchar), 'annotation', null, 'Balance', balance_text from rows where balance_text <> ''""",
)
def entity_texts(t: Tables) -> DataFrame:
    return _customers(t).texts.drop("entity_type")


FOLD_MAPPING = Mapping(
    "User", "events", "user_id",
    properties={"firstType": "event_type", "firstError": "error_props", "annotation[0].text": "event_type", "annotation[0].title": "props"},
)


def _users(t: Tables) -> Built:
    error = F.when(F.col("event_type") == "error", F.col("props"))
    rows = with_order(t.events.withColumn("error_props", error), "event_id")
    return build_entities({"events": rows}, [FOLD_MAPPING], NAMESPACE)


@query(
    "fold_rows",
    f"""select cast(user_id as varchar) as key, {sql_id('User', 'user_id')} as entity_id,
        arg_min(event_type, event_id) as first_type,
        arg_min(props, event_id) filter (event_type = 'error') as first_error
    from events group by user_id""",
)
def fold_rows(t: Tables) -> DataFrame:
    return _users(t).entities["User"].select(
        "key", "entity_id", F.col("firstType").alias("first_type"), F.col("firstError").alias("first_error")
    )


@query(
    "fold_arrays",
    """select distinct cast(user_id as varchar) as key, event_type as text, props as title from events""",
)
def fold_arrays(t: Tables) -> DataFrame:
    """Array members of all rows of a key, united by value; they stay rows."""
    return _users(t).texts.select("key", "text", "title")


DOCUMENT_MAPPINGS = [
    Mapping("Document", "documents", "doc_id", properties={"language": "lang", "quality": "own_quality"}),
    Mapping("Document", "labels", "doc_id", properties={"quality": "quality", "toxic": "toxic"}),
]


@query(
    "cross_mapping_fold",
    """select cast(coalesce(d.doc_id, l.doc_id) as varchar) as key, lang as language,
        coalesce(case when d.doc_id % 10 = 0 then 9 end, quality) as quality, toxic
    from documents d full outer join labels l on d.doc_id = l.doc_id""",
)
def cross_mapping_fold(t: Tables) -> DataFrame:
    own = F.when(F.col("doc_id") % 10 == 0, F.lit(9))
    tables = {"documents": t.documents.select("doc_id", "lang", own.alias("own_quality")), "labels": t.labels}
    built = build_entities(tables, DOCUMENT_MAPPINGS, NAMESPACE)
    return built.entities["Document"].drop("entity_id")


@query(
    "entity_counts",
    """select 'entities' as section, 'Customer' as name, count(*) as value from customer
    union all select 'entities', 'Order', count(*) from orders""",
)
def entity_counts(t: Tables) -> DataFrame:
    mappings = [Mapping("Customer", "customer", "c_custkey"), Mapping("Order", "orders", "o_orderkey")]
    built = build_entities({"customer": t.customer, "orders": t.orders}, mappings, NAMESPACE)
    return built.counts()


@query(
    "mapping_override",
    """select 'customer' as dataset, cast(c_custkey as varchar) as key, c_name as label from customer
    union all select 'supplier', cast(s_suppkey as varchar), cast(s_suppkey as varchar) from supplier""",
)
def mapping_override(t: Tables) -> DataFrame:
    """A supplied mapping replaces the built-in one for its dataset only."""
    built_in = {
        "customer": [Mapping("Customer", "customer", "c_custkey", properties={"label": "c_custkey"})],
        "supplier": [Mapping("Supplier", "supplier", "s_suppkey", properties={"label": "s_suppkey"})],
    }
    supplied = {"customer": [Mapping("Customer", "anything", "c_custkey", properties={"label": "c_name"})]}
    chosen, _ = mappings_for(built_in, supplied, ["customer", "supplier"])
    built = build_entities({"customer": t.customer, "supplier": t.supplier}, chosen, NAMESPACE)
    return (
        built.entities["Customer"].select(F.lit("customer").alias("dataset"), "key", "label")
        .unionByName(built.entities["Supplier"].select(F.lit("supplier").alias("dataset"), "key", F.col("label").cast("string").alias("label")))
    )


@query(
    "skip_empty_key",
    """select o_orderstatus as key, count(*) as n from orders where o_orderkey % 2 = 0 and o_orderstatus <> 'P' group by 1""",
)
def skip_empty_key(t: Tables) -> DataFrame:
    from ..plans.build import KEY, keyed_rows

    key = F.when(F.col("o_orderkey") % 2 == 0, F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")))
    rows = keyed_rows(Mapping("Order", "orders", "k", skip_empty_key=True), t.orders.withColumn("k", key))
    return rows.groupBy(F.col(KEY).alias("key")).agg(F.count("*").alias("n"))


@query(
    "last_wins",
    f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag from (
        select *, row_number() over (partition by l_orderkey, l_linenumber order by
            {', '.join(c + ' desc' for c in LINE_ORDER)}) as rn from lineitem) where rn = 1""",
)
def last_wins_lines(t: Tables) -> DataFrame:
    kept = ordered_lines(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "_ord")
    return last_wins(kept, ["l_orderkey", "l_linenumber"])


@query(
    "first_match",
    f"""select l_orderkey, l_partkey, l_suppkey from (
        select *, row_number() over (partition by l_orderkey order by {LINE_ORDER_SQL}) as rn from lineitem) where rn = 1""",
)
def first_match_lines(t: Tables) -> DataFrame:
    return first_match(ordered_lines(t).select("l_orderkey", "l_partkey", "l_suppkey", "_ord"), ["l_orderkey"])


@query(
    "first_present",
    """select user_id, arg_min(props, event_id) filter (event_type = 'purchase') as first_purchase from events group by user_id""",
)
def first_present_event(t: Tables) -> DataFrame:
    value = F.when(F.col("event_type") == "purchase", F.col("props")).otherwise("")
    return t.events.groupBy("user_id").agg(first_present(value, F.col("event_id")).alias("first_purchase"))


@query(
    "nested_paths",
    """select cast(c_custkey as varchar) as key, c_name as full_name, c_mktsegment as first_segment,
        case when c_custkey % 2 = 0 then c_name end as second_segment,
        case when c_custkey % 2 = 0 then 2 else 1 end as segments
    from customer""",
)
def nested_paths(t: Tables) -> DataFrame:
    """Flat path columns nested into structs and arrays, then read back by path."""
    flat = t.customer.select(
        F.col("c_custkey").cast("string").alias("key"),
        F.col("c_name").alias("names.legal.fullName"),
        F.col("c_mktsegment").alias("segment[0].title"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("segment[1].title"),
    )
    nested = flat.select("key", *nest([c for c in flat.columns if c != "key"]))
    return nested.select(
        "key",
        F.col("names.legal.fullName").alias("full_name"),
        F.col("segment")[0]["title"].alias("first_segment"),
        F.try_element_at("segment", F.lit(2))["title"].alias("second_segment"),
        F.size("segment").alias("segments"),
    )


@query(
    "table_counts",
    """select 'tables' as section, 'orders' as name, count(*) as value from orders
    union all select 'tables', 'lineitem', count(*) from lineitem
    union all select 'tables', 'documents', count(*) from documents""",
)
def count_tables(t: Tables) -> DataFrame:
    return table_counts({"orders": t.orders, "lineitem": t.lineitem, "documents": t.documents})
