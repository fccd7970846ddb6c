"""Edges, reconciliation and comparison over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_number, loose_text, us_datetime_to_iso
from ..operators.edges import dangling_edges, edge_rows, edge_targets, external_counts
from ..operators.reconcile import Field, Reconciliation, cross_tab, golden_diff, run_difference
from ..plans.build import Built, build_entities
from ..plans.bundle import seal_bundle
from ..plans.mapping import Edge, FromTable, Mapping, Source
from ..operators.quality import EntityRule
from .entities import LINE_ORDER_SQL, NAMESPACE, ordered_lines, sql_id
from .registry import Tables, query

LINKED = [
    Mapping(
        "Customer", "customer", "c_custkey",
        properties={"name": "c_name"},
        edges=(
            Edge("Order", "o_orderkey", source=FromTable("orders", "o_custkey"), inverse=True),
            Edge("Nation", "c_nationkey"),
            Edge("Segment", "c_mktsegment", external=True),
        ),
    ),
    Mapping(
        "Order", "orders", "o_orderkey",
        properties={"status": "o_orderstatus"},
        edges=(Edge("Priority", "priorities", split=";", external=True),),
    ),
    Mapping("Nation", "nation", "n_nationkey", properties={"name": "n_name"}),
]


def _linked(t: Tables, nations: DataFrame | None = None) -> Built:
    orders = t.orders.withColumn("priorities", F.concat("o_orderpriority", F.lit("; "), "o_orderstatus", F.lit(";"), "o_orderpriority"))
    return build_entities({"customer": t.customer, "orders": orders, "nation": t.nation if nations is None else nations}, LINKED, NAMESPACE)


def _edge_counts(df: DataFrame) -> DataFrame:
    return df.select("from_type", "from_key", "from_id", "edge_key", "to_type", "to_key", "to_id", "external", "inverse")


def _edge_sql(from_type, from_key, to_type, to_key, source, edge_key="has", external="false", inverse="false") -> str:
    return f"""select '{from_type}' as from_type, cast({from_key} as varchar) as from_key, {sql_id(from_type, from_key)} as from_id,
        '{edge_key}' as edge_key, '{to_type}' as to_type, cast({to_key} as varchar) as to_key, {sql_id(to_type, to_key)} as to_id,
        {external} as external, {inverse} as inverse from {source}"""


@query(
    "edges_resolve",
    _edge_sql("Customer", "c_custkey", "Order", "o_orderkey", "orders join customer on c_custkey = o_custkey")
    + " union all "
    + _edge_sql("Customer", "c_custkey", "Nation", "c_nationkey", "customer join nation on c_nationkey = n_nationkey"),
)
def edges_resolve(t: Tables) -> DataFrame:
    """Own-table and other-table edges; targets that were not built are skipped."""
    return _edge_counts(_linked(t).edges.filter("not external and not inverse"))


@query(
    "edges_inverse",
    _edge_sql("Order", "o_orderkey", "Customer", "c_custkey", "orders join customer on c_custkey = o_custkey", "for", inverse="true"),
)
def edges_inverse(t: Tables) -> DataFrame:
    return _edge_counts(_linked(t).edges.filter("inverse"))


@query(
    "edges_external",
    _edge_sql("Customer", "c_custkey", "Segment", "c_mktsegment", "customer", external="true")
    + " union all "
    + _edge_sql(
        "Order", "o_orderkey", "Priority", "p",
        "(select distinct o_orderkey, unnest([o_orderpriority, o_orderstatus]) as p from orders)", external="true",
    ),
)
def edges_external(t: Tables) -> DataFrame:
    return _edge_counts(_linked(t).edges.filter("external"))


@query(
    "edges_unresolved",
    """select 'Customer' as from_type, cast(c_custkey as varchar) as from_key, 'Nation' as to_type, cast(c_nationkey as varchar) as to_key
    from customer where c_nationkey in (select n_nationkey from nation anti join supplier on s_nationkey = n_nationkey and s_acctbal > 9000)""",
)
def edges_unresolved(t: Tables) -> DataFrame:
    """Only nations with a rich supplier are built, so edges to the others have no target."""
    rich = t.supplier.filter("s_acctbal > 9000").select(F.col("s_nationkey").alias("n_nationkey"))
    return _linked(t, t.nation.join(rich, "n_nationkey", "left_semi")).unresolved


def _supply_edges(t: Tables) -> tuple[DataFrame, DataFrame]:
    to_supplier = edge_rows(edge_targets(t.lineitem, "l_orderkey", "l_suppkey"), "Order", "Supplier", NAMESPACE)
    to_part = edge_rows(edge_targets(t.lineitem, "l_orderkey", "l_partkey"), "Order", "Part", NAMESPACE)
    suppliers = build_entities(
        {"supplier": t.supplier.filter("s_suppkey % 11 <> 0")}, [Mapping("Supplier", "supplier", "s_suppkey")], NAMESPACE
    )
    return to_supplier.unionByName(to_part), suppliers.identifiers


@query(
    "edge_dangling",
    f"""select distinct {sql_id('Order', 'l_orderkey')} as from_id, 'Supplier' as to_type, {sql_id('Supplier', 'l_suppkey')} as to_id
    from lineitem where l_suppkey % 11 = 0""",
)
def edge_dangling(t: Tables) -> DataFrame:
    edges, identifiers = _supply_edges(t)
    return dangling_edges(edges, identifiers, ["Supplier"])


@query(
    "edge_external_counts",
    "select 'Part' as to_type, count(*) as n from (select distinct l_orderkey, l_partkey from lineitem)",
)
def edge_external_counts(t: Tables) -> DataFrame:
    edges, identifiers = _supply_edges(t)
    return external_counts(edges, identifiers, ["Supplier"])


# --- reconciliation -------------------------------------------------------------------

PERTURBED = """p_partkey + case when p_partkey % 97 = 0 then 1000000 else 0 end as p_partkey,
    case p_partkey % 6 when 0 then concat(' ', upper(p_name), '  ') when 1 then concat(p_name, '!') when 2 then '' else p_name end as p_name,
    case when p_partkey % 5 = 0 then concat(cast(p_size as {text}), '.00') when p_partkey % 5 = 1 then 'x' else cast(p_size as {text}) end as p_size,
    p_brand, p_type"""

PART_FIELDS = [
    Field("name", "p_name", "p_name", loose_text, "case and space do not count"),
    Field("size", "p_size", "p_size", as_number),
    Field("brand", "p_brand", "p_brand"),
    Field("type", "p_type", None),
]

_PART_SIDES = f"""with l as (select p_partkey, p_name, cast(p_size as varchar) as p_size, p_brand from part),
    r as (select {PERTURBED.format(text='varchar')} from part),
    pairs as (
        select l.p_partkey, unnest([
            {{'field': 'name', 'lv': l.p_name, 'rv': r.p_name, 'a': nullif(lower(trim(l.p_name)), ''), 'b': nullif(lower(trim(r.p_name)), '')}},
            {{'field': 'size', 'lv': l.p_size, 'rv': r.p_size, 'a': l.p_size, 'b': regexp_replace(r.p_size, '\\.00$', '')}},
            {{'field': 'brand', 'lv': l.p_brand, 'rv': r.p_brand, 'a': l.p_brand, 'b': r.p_brand}}], recursive := true)
        from l join r using (p_partkey)),
    diff as (
        select p_partkey, field, lv as left_value, rv as right_value,
            case when a is null or b is null then 'one_sided' else 'mismatch' end as difference
        from pairs where a is distinct from b)"""


def _parts(t: Tables) -> Reconciliation:
    left = t.part.select("p_partkey", "p_name", F.col("p_size").cast("string").alias("p_size"), "p_brand", "p_type")
    size = PERTURBED.format(text="string")
    right = t.part.select(*[F.expr(e) for e in _select_list(size)])
    return Reconciliation(left, right, ["p_partkey"], PART_FIELDS)


def _select_list(text: str) -> list[str]:
    from .scalars import _split_top

    return _split_top(text)


@query("reconcile_differences", f"{_PART_SIDES} select * from diff")
def reconcile_differences(t: Tables) -> DataFrame:
    return _parts(t).differences()


@query(
    "reconcile_by_field",
    f"""{_PART_SIDES} select field, difference, count(*) as n,
        case when field = 'name' then 'case and space do not count' end as note from diff group by field, difference""",
)
def reconcile_by_field(t: Tables) -> DataFrame:
    return _parts(t).by_field()


@query("reconcile_sample", f"{_PART_SIDES} select * from diff order by p_partkey, field limit 12")
def reconcile_sample(t: Tables) -> DataFrame:
    return _parts(t).sample(12)


@query(
    "reconcile_keys",
    f"""{_PART_SIDES}
    select p_partkey, 'only_left' as side from l where p_partkey not in (select p_partkey from r)
    union all select p_partkey, 'only_right' from r where p_partkey not in (select p_partkey from l)
    union all select p_partkey, 'matched' from l where p_partkey in (select p_partkey from r)""",
)
def reconcile_keys(t: Tables) -> DataFrame:
    r = _parts(t)
    label = lambda df, name: df.withColumn("side", F.lit(name))
    return label(r.only_left(), "only_left").unionByName(label(r.only_right(), "only_right")).unionByName(label(r.matched(), "matched"))


@query(
    "reconcile_verdict",
    f"""{_PART_SIDES}
    select (select count(*) from l join r using (p_partkey)) as matched,
        (select count(*) from l where p_partkey not in (select p_partkey from r)) as only_left,
        (select count(*) from r where p_partkey not in (select p_partkey from l)) as only_right,
        count(*) filter (difference = 'mismatch') as mismatches, count(*) filter (difference = 'one_sided') as one_sided,
        'DIFFERENCES FOUND' as verdict
    from diff""",
)
def reconcile_verdict(t: Tables) -> DataFrame:
    return _parts(t).summary()


ORDER_FIELDS = [
    Field("lines", "lines", "lines"),
    Field("date", "day", "day", us_datetime_to_iso),
    Field("status", "status", "status", note="lines decide"),
]


@query(
    "reconcile_orders",
    """with l as (
        select o_orderkey, case when o_orderkey % 4 = 0 then null else o_orderstatus end as status, o_custkey % 7 as lines,
            strftime(o_orderdate, '%m/%d/%Y %H:%M:%S') as day from orders),
    r as (
        select l_orderkey as o_orderkey, max(l_linestatus) as status, count(*) as lines from lineitem group by 1),
    pairs as (
        select o_orderkey, unnest([
            {'field': 'lines', 'a': cast(l.lines as varchar), 'b': cast(r.lines as varchar)},
            {'field': 'status', 'a': l.status, 'b': r.status}], recursive := true)
        from l join r using (o_orderkey))
    select field, case when a is null or b is null then 'one_sided' else 'mismatch' end as difference, count(*) as n,
        case when field = 'status' then 'lines decide' end as note
    from pairs where a is distinct from b group by all
    union all select 'keys', 'only_left', count(*), null from l where o_orderkey not in (select o_orderkey from r)""",
)
def reconcile_orders(t: Tables) -> DataFrame:
    """Orders against what their lines say; dates agree once both are in one format."""
    left = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus")).alias("status"),
        (F.col("o_custkey") % 7).alias("lines"),
        F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss").alias("day"),
    )
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_linestatus").alias("status"), F.count("*").alias("lines")
    )
    dates = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("day"))
    right = per_order.join(dates, "o_orderkey")
    r = Reconciliation(left, right, ["o_orderkey"], ORDER_FIELDS)
    missing = r.only_left().agg(F.count("*").alias("n")).select(
        F.lit("keys").alias("field"), F.lit("only_left").alias("difference"), "n", F.lit(None).cast("string").alias("note")
    )
    return r.by_field().unionByName(missing)


@query(
    "crosstab_flags",
    f"""with ref as (
        select l_orderkey, arg_max(flag, rn) as label from (
            select l_orderkey, case when l_partkey % 5 = 0 then null else l_linestatus end as flag,
                row_number() over (partition by l_orderkey order by {LINE_ORDER_SQL}) as rn from lineitem) group by 1),
    last as (
        select l_orderkey, case when l_partkey % 5 = 0 then null else l_linestatus end as label from (
            select *, row_number() over (partition by l_orderkey order by {', '.join(c + ' desc' for c in LINE_ORDER_SQL.split(', '))}) as rn
            from lineitem) where rn = 1)
    select coalesce(case when l_suppkey % 4 = 0 then null else l_returnflag end, '(blank)') as flag,
        coalesce(label, '(blank)') as label, count(*) as n
    from lineitem join last using (l_orderkey) group by all""",
)
def crosstab_flags(t: Tables) -> DataFrame:
    reference = ordered_lines(t).select(
        "l_orderkey", F.when(F.col("l_partkey") % 5 != 0, F.col("l_linestatus")).alias("label"), "_ord"
    )
    witness = t.lineitem.select("l_orderkey", F.when(F.col("l_suppkey") % 4 != 0, F.col("l_returnflag")).alias("flag"))
    return cross_tab(reference, witness, ["l_orderkey"], "flag", "label")


@query(
    "golden_diff",
    """with a as (
        select o_orderkey + case when o_orderkey % 500 = 3 then 10000000 else 0 end as o_orderkey,
            case when o_orderkey % 400 = 1 then 'X' else o_orderstatus end as s, o_orderpriority as p from orders)
    select coalesce(o.o_orderkey, a.o_orderkey) as o_orderkey,
        case when a.o_orderkey is null then 'missing' when o.o_orderkey is null then 'extra' else 'differing' end as state
    from orders o full outer join a on o.o_orderkey = a.o_orderkey
    where a.o_orderkey is null or o.o_orderkey is null or s <> o_orderstatus or p <> o_orderpriority""",
)
def golden_diff_orders(t: Tables) -> DataFrame:
    """A re-run against its golden copy; the date stands for a run-specific column."""
    key = F.col("o_orderkey")
    actual = t.orders.select(
        (key + F.when(key % 500 == 3, 10000000).otherwise(0)).alias("o_orderkey"),
        "o_orderpriority",
        F.when(key % 400 == 1, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.date_add("o_orderdate", 1).alias("o_orderdate"), "o_custkey", "o_totalprice",
    )
    return golden_diff(t.orders, actual, ["o_orderkey"], ignore=("o_orderdate",))


@query(
    "run_difference",
    """select o_orderkey, o_orderstatus, 'first' as only_in, cast(1 as bigint) as copies from orders where o_orderkey % 300 = 5
    union all select o_orderkey, 'X', 'second', 1 from orders where o_orderkey % 300 = 5""",
)
def run_difference_orders(t: Tables) -> DataFrame:
    first = t.orders.select("o_orderkey", "o_orderstatus")
    changed = F.when(F.col("o_orderkey") % 300 == 5, "X").otherwise(F.col("o_orderstatus"))
    second = t.orders.select("o_orderkey", changed.alias("o_orderstatus"))
    return run_difference(first, second)


@query(
    "idempotent",
    "select count(*) as entities, cast(0 as bigint) as changed from orders",
)
def idempotent(t: Tables) -> DataFrame:
    """Two builds from differently ordered rows give the same entities."""
    mapping = [Mapping("Order", "orders", "o_orderkey", properties={"status": "o_orderstatus", "day": Source("o_orderpriority")})]
    build = lambda df: build_entities({"orders": df}, mapping, NAMESPACE).entities["Order"]
    first = build(t.orders)
    second = build(t.orders.repartition("o_custkey"))
    changed = run_difference(first, second).agg(F.count("*").alias("changed"))
    return first.agg(F.count("*").alias("entities")).select("entities", changed.scalar().alias("changed"))


@query(
    "report_counts",
    """select 'entities' as section, 'Customer' as name, count(*) as value from customer
    union all select 'entities', 'Order', count(*) from orders
    union all select 'entities', 'Nation', count(*) from nation
    union all select 'failures', 'Order', count(*) from orders where o_orderstatus = 'P' having count(*) > 0
    union all select 'external', 'Segment', count(*) from customer
    union all select 'external', 'Priority', 2 * count(*) from orders""",
)
def report_counts(t: Tables) -> DataFrame:
    """The figures of a sealed bundle."""
    rules = {"Order": [EntityRule("status", required=True, allowed=("O", "F"))], "Customer": [EntityRule("name", required=True)]}
    return seal_bundle(_linked(t).stored("keys", "edges"), rules).report()
