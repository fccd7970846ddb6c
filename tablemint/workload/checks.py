"""Data-quality operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.notes import all_notes, note_rows
from ..operators.order import by_day, by_name, top_sample
from ..operators.quality import (
    EntityRule,
    Role,
    check_manifest,
    distinct_values,
    duplicate_keys,
    duplicate_members,
    exactly_one,
    fallback_day,
    inputs_for_role,
    is_copied,
    leaked_fields,
    missing_sources,
    page_completeness,
    report_rows,
    require_rows,
    sentinel_tally,
    shared_identifiers,
    source_versions,
    uncontrolled_values,
    validate_entities,
)
from ..operators.rules import SignatureRule, assign_role, classify, expected_shortfall, unclassified_notes
from ..sources.files import opening_signature
from ..plans.delivery import concat_tables
from .registry import Tables, query


@query(
    "dup_keys",
    "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1",
)
def dup_keys(t: Tables) -> DataFrame:
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "dup_within_parent",
    "select l_orderkey, l_returnflag, l_linestatus, count(*) - 1 as repeats from lineitem group by 1, 2, 3 having count(*) > 1",
)
def dup_within_parent(t: Tables) -> DataFrame:
    return duplicate_members(t.lineitem, ["l_orderkey"], ["l_returnflag", "l_linestatus"])


_SENTINEL = """case when p_partkey % 7 = 0 then '(null)' else p_name end as p_name,
    case when p_partkey % 11 = 0 then '(null)' else p_type end as p_type, p_brand"""


@query(
    "sentinel_tally",
    """select 'p_name' as field, count(*) as n from part where p_partkey % 7 = 0
    union all select 'p_type', count(*) from part where p_partkey % 11 = 0""",
)
def sentinel_tally_parts(t: Tables) -> DataFrame:
    rows = t.part.selectExpr(*[e for e in _SENTINEL.replace("\n", " ").split(", ")])
    return sentinel_tally(rows, ["p_name", "p_type", "p_brand"])


@query(
    "copied_column",
    """select 'name' as pair, bool_and(a is not distinct from b) as copied from (select case when c_custkey % 3 = 0 then c_name end as a, case when c_custkey % 3 = 0 then c_name end as b from customer)
    union all select 'segment', bool_and(c_name is not distinct from c_mktsegment) from customer
    union all select 'empty', false""",
)
def copied_column(t: Tables) -> DataFrame:
    rows = t.customer.withColumn("a", F.when(F.col("c_custkey") % 3 == 0, F.col("c_name"))).withColumn("b", F.col("a"))
    label = lambda df, name: df.select(F.lit(name).alias("pair"), "copied")
    return (
        label(is_copied(rows, "a", "b"), "name")
        .unionByName(label(is_copied(rows, "c_name", "c_mktsegment"), "segment"))
        .unionByName(label(is_copied(rows.filter("c_custkey < 0"), "a", "b"), "empty"))
    )


@query("leaked_fields", "select 'unit' as field from part where p_partkey % 50 = 0 limit 1")
def leaked_fields_parts(t: Tables) -> DataFrame:
    unit = F.when(F.col("p_partkey") % 50 == 0, F.concat(F.lit("<Unit: 0x"), F.lower(F.hex("p_partkey")), F.lit(">")))
    near = F.concat(F.lit("<Unit: "), F.col("p_name"), F.lit(">"))
    return leaked_fields(t.part.withColumn("unit", unit).withColumn("near", near))


@query(
    "totals",
    """select count(*) as takes, count(distinct slate) + max(case when slate is null then 1 else 0 end) as distinct_slates,
        count(*) filter (wild) as wild_tracks
    from (select case when l_linenumber <> 7 then concat(l_linenumber, l_returnflag) end as slate, l_linenumber = 7 as wild from lineitem)""",
)
def totals(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.when(F.col("l_linenumber") != 7, F.concat("l_linenumber", "l_returnflag")).alias("slate"),
        (F.col("l_linenumber") == 7).alias("wild"),
    )
    return rows.agg(
        F.count("*").alias("takes"), distinct_values("slate").alias("distinct_slates"), F.count_if("wild").alias("wild_tracks")
    )


PART_RULES = [
    EntityRule("label", required=True),
    EntityRule("brand", pattern=r"^Brand#[1-9]$"),
    EntityRule("type", allowed=("ECONOMY", "STANDARD", "PROMO")),
    EntityRule("size_text", numeric=True),
]


@query(
    "validate_rules",
    """with e as (
        select concat('demo/', p_partkey) as identifier, case when p_partkey % 9 = 0 then '' else p_name end as label, p_brand as brand,
            p_type as type, case when p_partkey % 13 = 0 then 'large' else cast(p_size as varchar) end as size_text from part)
    select 'Part' as entity_type, identifier, '/label is required' as error from e where label = ''
    union all select 'Part', identifier, '/brand does not match its pattern' from e where not regexp_matches(brand, '^Brand#[1-9]$')
    union all select 'Part', identifier, '/type is not an allowed value' from e where type not in ('ECONOMY', 'STANDARD', 'PROMO')
    union all select 'Part', identifier, '/size_text is not a number' from e where try_cast(size_text as double) is null""",
)
def validate_rules(t: Tables) -> DataFrame:
    entities = t.part.select(
        F.concat(F.lit("demo/"), "p_partkey").alias("entity_id"),
        F.when(F.col("p_partkey") % 9 == 0, "").otherwise(F.col("p_name")).alias("label"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
        F.when(F.col("p_partkey") % 13 == 0, "large").otherwise(F.col("p_size").cast("string")).alias("size_text"),
    )
    return validate_entities(entities, PART_RULES, entity_type="Part")


@query(
    "controlled_values",
    """select p_brand as value, count(*) as n from part
    where p_brand not in (select concat('Brand#', s_suppkey) from supplier where s_suppkey < 12) group by 1""",
)
def controlled_values(t: Tables) -> DataFrame:
    allowed = t.supplier.filter("s_suppkey < 12").select(F.concat(F.lit("Brand#"), "s_suppkey").alias("value"))
    return uncontrolled_values(t.part, "p_brand", allowed)


@query(
    "id_unique",
    """select 'text' as scope, sha256(text) as value from documents group by text having count(distinct doc_id) > 1""",
)
def id_unique(t: Tables) -> DataFrame:
    """Documents that a content hash would give one identifier."""
    identifiers = t.documents.select(
        F.lit("Document").alias("entity_type"), F.col("doc_id").alias("entity_id"),
        F.lit("text").alias("scope"), F.sha2("text", 256).alias("value"),
    )
    return shared_identifiers(identifiers)


TEXT_RULES = [
    SignatureRule("xml_root", "html", "webPage", "Web page", "digital.document"),
    SignatureRule("xml_root", "article", "article", "Article", "digital.document"),
    SignatureRule("header_prefix", "The ", "prose", "Prose", "digital.document", expected_per_day=3),
    SignatureRule("text_pattern", r"^[A-Z][a-z]+ [a-z]+ ", "sentence", "Sentence", "digital.document"),
    SignatureRule("header_prefix", "#", "heading", "Heading", "digital.data"),
]
_SIGNED = rf"""texts as (
        select concat('d', doc_id) as name, lang as day, case when doc_id % 10 = 0 then concat('<?xml version="1.0"?>', chr(10), '<article>', text) when doc_id % 10 = 1 then concat('The ', text) else text end as body from documents
        union all select concat('p', page_id), 'web', html from pages),
    heads as (select name, day, body as head from texts),
    signed as (
        select name, day, head,
            coalesce(list_filter(list_transform(string_split_regex(head, '\r?\n'), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '')[1], '') as first_line,
            nullif(regexp_extract(regexp_replace(head, '<\?xml[^?]*\?>', '', 'g'), '<([A-Za-z_][\w.-]*)[\s>]', 1), '') as xml_root
        from heads),
    classified as (
        select name, day, xml_root,
            case when xml_root = 'html' then 'webPage' when xml_root = 'article' then 'article'
                when starts_with(first_line, 'The ') then 'prose'
                when regexp_matches(head, '^[A-Z][a-z]+ [a-z]+ ') then 'sentence'
                when starts_with(first_line, '#') then 'heading' else 'unknown' end as document_type,
            case when xml_root in ('html', 'article') then 'xml_root' when starts_with(first_line, 'The ') then 'header_prefix'
                when regexp_matches(head, '^[A-Z][a-z]+ [a-z]+ ') then 'text_pattern'
                when starts_with(first_line, '#') then 'header_prefix' else 'unmatched' end as classified_by
        from signed)"""


def _classified(t: Tables) -> DataFrame:
    body = (
        F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit('<?xml version="1.0"?>\n<article>'), "text"))
        .when(F.col("doc_id") % 10 == 1, F.concat(F.lit("The "), "text"))
        .otherwise(F.col("text"))
    )
    documents = t.documents.select(F.concat(F.lit("d"), "doc_id").alias("name"), F.col("lang").alias("day"), body.alias("body"))
    pages = t.pages.select(F.concat(F.lit("p"), "page_id").alias("name"), F.lit("web").alias("day"), F.col("html").alias("body"))
    signed = opening_signature(documents.unionByName(pages), "body").withColumn("headings", F.lit(None).cast("array<string>"))
    return classify(signed, TEXT_RULES)


@query("rule_classify", f"with {_SIGNED} select name, document_type, classified_by, xml_root from classified")
def rule_classify(t: Tables) -> DataFrame:
    return _classified(t).select("name", "document_type", "classified_by", "xml_root")


@query(
    "notes_unclassified",
    f"""with {_SIGNED} select 'unclassifiedDocument' as kind, name as "where",
        'no content signature matched; add a rule for it' as detail from classified where document_type = 'unknown'""",
)
def notes_unclassified(t: Tables) -> DataFrame:
    return unclassified_notes(_classified(t), "name")


@query(
    "expected_per_day",
    f"""with {_SIGNED} select day, document_type, count(*) as n, cast(3 as bigint) as expected from classified
    where document_type = 'prose' group by 1, 2 having count(*) <> 3""",
)
def expected_per_day(t: Tables) -> DataFrame:
    return expected_shortfall(_classified(t), TEXT_RULES, "day")


@query(
    "assign_roles",
    """select page_id, case when regexp_matches(url, '(?i)/A') then 'lead' when regexp_matches(url, '(?i)[0-9]{3}') then 'numbered'
        else 'delivery' end as role from pages""",
)
def assign_roles(t: Tables) -> DataFrame:
    roles = [("lead", "/A"), ("delivery", None), ("numbered", "[0-9]{3}"), ("late", None)]
    return t.pages.select("page_id", assign_role("url", roles).alias("role"))


ROLES = [Role("en", "English", required=True, max_files=20), Role("de", "German", required=True), Role("fr", "French", max_files=1)]


def _manifest(t: Tables) -> tuple[DataFrame, DataFrame]:
    inputs = t.documents.select(
        F.col("source").alias("run_id"), F.col("lang").alias("role"),
        F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("f"), "doc_id")).alias("file_name"),
        F.when(F.col("doc_id") % 17 == 0, "").otherwise(F.concat(F.lit("ref"), "doc_id")).alias("ref"),
    )
    runs = t.documents.select(F.col("source").alias("run_id")).unionByName(t.region.select(F.col("r_name").alias("run_id")))
    return inputs, runs


@query(
    "check_manifest",
    """with i as (
        select source as run_id, lang as role, case when doc_id % 5 <> 0 then concat('f', doc_id) end as file_name,
            case when doc_id % 17 = 0 then '' else concat('ref', doc_id) end as ref from documents),
    runs as (select distinct source as run_id from documents union select r_name from region),
    c as (select runs.run_id, count(i.run_id) as n, count(*) filter (role = 'en') as en, count(*) filter (role = 'de') as de,
            count(*) filter (role = 'fr') as fr from runs left join i on i.run_id = runs.run_id group by 1)
    select run_id, 'inputWithoutRef' as kind, concat('"', coalesce(file_name, '(unnamed)'), '" names no place to read from') as detail from i where ref = ''
    union all select run_id, 'unknownRole', concat('"', coalesce(file_name, ref), '": role "', role, '" is not declared') from i where role not in ('en', 'de', 'fr')
    union all select run_id, 'tooFewFiles', concat('files: ', n, ', wanted 2 or more') from c where n < 2
    union all select run_id, 'tooManyFiles', concat('files: ', n, ', wanted 50 or fewer') from c where n > 50
    union all select run_id, 'missingRequiredRole', 'role "en" (English) has no file' from c where en = 0
    union all select run_id, 'missingRequiredRole', 'role "de" (German) has no file' from c where de = 0
    union all select run_id, 'tooManyForRole', concat('files of role "en": ', en, ', wanted 20 or fewer') from c where en > 20
    union all select run_id, 'tooManyForRole', concat('files of role "fr": ', fr, ', wanted 1 or fewer') from c where fr > 1""",
)
def check_manifest_documents(t: Tables) -> DataFrame:
    inputs, runs = _manifest(t)
    return check_manifest(inputs, runs, ROLES, min_files=2, max_files=50)


@query("inputs_for_role", "select source as run_id, count(*) as n from documents where lang = 'de' group by 1")
def inputs_for_role_documents(t: Tables) -> DataFrame:
    inputs, _ = _manifest(t)
    return inputs_for_role(inputs, "de").groupBy("run_id").agg(F.count("*").alias("n"))


@query(
    "exactly_one",
    """with f as (select lang as day, concat(source, '-', doc_id, '.txt') as name from documents),
    days as (select distinct lang as day from documents),
    m as (select day, name, unnest(list_filter([case when regexp_matches(name, '^src1-') then 'primary' end,
            case when regexp_matches(name, '^src2-[0-9]{1,2}[.]') then 'witness' end, case when regexp_matches(name, '^none-') then 'absent' end], lambda x: x is not null)) as role from f),
    c as (select day, role, count(*) as n from m group by 1, 2),
    w as (select day, role, required from days, (values ('primary', true), ('witness', false), ('absent', true)) r(role, required))
    select day, role, 'none' as problem, cast(0 as bigint) as n, null as name from w anti join c using (day, role) where required
    union all select day, role, 'ambiguous', n, name from c join m using (day, role) where n > 1""",
)
def exactly_one_documents(t: Tables) -> DataFrame:
    files = t.documents.select(
        F.col("lang").alias("day"), F.concat("source", F.lit("-"), "doc_id", F.lit(".txt")).alias("name")
    )
    patterns = [("primary", "^src1-", True), ("witness", "^src2-[0-9]{1,2}[.]", False), ("absent", "^none-", True)]
    return exactly_one(files, t.documents.select(F.col("lang").alias("day")), patterns)


_PAGES_SQL = """with cut as (
        select concat('status', o_orderstatus) as endpoint, cast(floor(o_orderkey / 50) as bigint) as position, count(*) as rows from orders group by 1, 2),
    ends as (select endpoint, max(position) as last from cut group by 1),
    pages as (
        select endpoint, position, rows, position < last or endpoint = 'statusP' as has_more, concat('c', position) as cursor,
            case when position = last then null when position % 40 = 7 then 'c3' when position % 90 = 11 then 'lost' else concat('c', position + 1) end as next
        from cut join ends using (endpoint))"""


def _cut_pages(t: Tables) -> DataFrame:
    endpoint = F.concat(F.lit("status"), "o_orderstatus")
    cut = t.orders.groupBy(endpoint.alias("endpoint"), F.floor(F.col("o_orderkey") / 50).cast("bigint").alias("position")).agg(
        F.count("*").alias("rows")
    )
    ends = cut.groupBy("endpoint").agg(F.max("position").alias("last"))
    position, last = F.col("position"), F.col("last")
    following = (
        F.when(position == last, None)
        .when(position % 40 == 7, "c3")
        .when(position % 90 == 11, "lost")
        .otherwise(F.concat(F.lit("c"), position + 1))
    )
    return cut.join(ends, "endpoint").select(
        "endpoint", "position", "rows",
        ((position < last) | (F.col("endpoint") == "statusP")).alias("has_more"),
        F.concat(F.lit("c"), position).alias("cursor"), following.alias("next"),
    )


@query(
    "page_completeness",
    f"""{_PAGES_SQL}, named as (select endpoint, next as cursor, count(*) as n from pages where next is not null group by 1, 2)
    select endpoint, 'unfinished' as problem, null as cursor from pages p join ends using (endpoint) where position = last and has_more and rows > 0
    union all select endpoint, 'repeatedCursor', cursor from named where n > 1
    union all select endpoint, 'missingPage', cursor from named anti join pages using (endpoint, cursor)""",
)
def page_completeness_orders(t: Tables) -> DataFrame:
    return page_completeness(_cut_pages(t))


@query(
    "missing_sources",
    """select 'endpointUnavailable' as kind, source as "where", 'expected but not landed' as detail
    from (select n_name as source from nation) where source not in (select n_name from nation join customer on c_nationkey = n_nationkey where c_acctbal > 9800)""",
)
def missing_sources_nations(t: Tables) -> DataFrame:
    landed = t.customer.filter("c_acctbal > 9800").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return missing_sources(t.nation.select(F.col("n_name").alias("source")), landed.select(F.col("n_name").alias("source")))


@query("require_rows", "select count(*) as rows from orders")
def require_rows_orders(t: Tables) -> DataFrame:
    return require_rows(t.orders, "no orders landed")


@query(
    "source_versions",
    """select case when doc_id % 3 = 0 then 'v2.6' else 'v3.0' end as version, count(*) as n, doc_id % 3 = 0 as migrated
    from documents where doc_id % 7 <> 0 group by all""",
)
def source_versions_documents(t: Tables) -> DataFrame:
    version = F.when(F.col("doc_id") % 7 == 0, "").when(F.col("doc_id") % 3 == 0, "v2.6").otherwise("v3.0")
    return source_versions(t.documents.select(version.alias("version")), "version", "v3.0")


@query(
    "fallback_day",
    """select 'one' as run, event_id, case when event_id % 2 = 0 then '1' else '1' end as day from events
    union all select 'many', event_id, case when event_id % 3 = 0 then '1' when event_id % 3 = 1 then '2' else '9' end from events""",
)
def fallback_day_events(t: Tables) -> DataFrame:
    one = t.events.select("event_id", F.when(F.col("event_id") % 2 == 0, "1").alias("day"))
    many = t.events.select("event_id", F.when(F.col("event_id") % 3 == 0, "1").when(F.col("event_id") % 3 == 1, "2").alias("day"))
    label = lambda df, name: df.select(F.lit(name).alias("run"), "event_id", "day")
    return label(fallback_day(one, "day", "9"), "one").unionByName(label(fallback_day(many, "day", "9"), "many"))


@query(
    "concat_days",
    """select event_id, event_type, case when event_type = 'error' then user_id end as user_id, case when event_type <> 'error' then props end as props from events""",
)
def concat_days(t: Tables) -> DataFrame:
    """Days whose tables do not have the same columns."""
    first = {"events": t.events.filter("event_type = 'error'").select("event_id", "event_type", "user_id")}
    second = {"events": t.events.filter("event_type <> 'error'").select("event_id", "event_type", "props")}
    return concat_tables([first, second])["events"]


@query(
    "sorted_names",
    "select distinct case when p_partkey % 2 = 0 then upper(p_brand) else lower(p_brand) end as name from part",
)
def sorted_names(t: Tables) -> DataFrame:
    """Locale order: case decides only between otherwise equal names, lower case first."""
    name = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_brand")).otherwise(F.lower("p_brand"))
    return by_name(t.part.select(name.alias("name")).distinct(), "name")


@query(
    "sorted_days",
    "select day from (select concat(l_linenumber * 5) as day from lineitem union select concat(r_name, ' unit') from region) order by try_cast(day as int) nulls last, day",
)
def sorted_days(t: Tables) -> DataFrame:
    days = t.lineitem.select((F.col("l_linenumber") * 5).cast("string").alias("day")).distinct()
    units = t.region.select(F.concat("r_name", F.lit(" unit")).alias("day")).distinct()
    return by_day(days.unionByName(units), "day")


@query("top_sample", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def top_sample_orders(t: Tables) -> DataFrame:
    return top_sample(t.orders.select("o_orderkey", "o_totalprice"), 10, F.desc("o_totalprice"), "o_orderkey")


@query(
    "note_report",
    """select 'notes' as section, 'sentinelNull' as name, count(*) as value from supplier where s_acctbal < 0 having count(*) > 0
    union all select 'notes', 'duplicateTakeKey', count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)""",
)
def note_report(t: Tables) -> DataFrame:
    """Notes of several operators in one table, counted by kind."""
    cells = t.supplier.select("s_name", F.when(F.col("s_acctbal") < 0, "(null)").otherwise(F.col("s_acctbal").cast("string")).alias("cell"))
    sentinels = note_rows(cells.filter("cell = '(null)'"), "sentinelNull", F.col("s_name"), "absent")
    duplicates = note_rows(
        duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]), "duplicateTakeKey", F.col("l_orderkey"), "shared key"
    )
    return report_rows(all_notes([sentinels, duplicates]), "notes", "kind")
