"""Scalar functions on dirty text derived from the tables by one expression in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    as_number,
    cast_as,
    child_path,
    clean_text,
    compare_value,
    entity_id,
    ext_name,
    id_combined,
    is_object_description,
    is_present,
    is_wild_track,
    iso_date,
    join_list,
    loose_text,
    named_members,
    positive_count,
    project_identifier,
    recorded_seconds,
    scene_slate,
    sentinel_null,
    shoot_day_number,
    slate_full_name,
    slate_id,
    split_list,
    straighten_quotes,
    take_annotation,
    take_key,
    take_number,
    typed_number,
    us_datetime_to_iso,
    wild_track_number,
)
from ..plans.catalogue import MEDIA_STRUCTURES, structure_for, structure_known
from .registry import Tables, query

# The white-space class of tablemint.functions.text, as RE2 reads it.
WS = (
    r"[\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
    r"\x{202F}\x{205F}\x{3000}\x{FEFF}]"
)
TRIM = f"^{WS}+|{WS}+$"

DIRTY_NAME = """case p_partkey % 8
    when 0 then '(null)'
    when 1 then ''
    when 2 then concat(chr(9), ' ', p_name, chr(160), ' ')
    when 3 then concat('<Unit: 0x', substr(sha2_hex, 1, 10), '>')
    when 4 then concat('It’s  ', upper(p_name), '   “', p_brand, '”')
    when 5 then concat('   ', chr(10))
    when 6 then cast(null as varchar(9))
    else p_name end"""


def _dirty_parts(t: Tables) -> DataFrame:
    hashed = t.part.withColumn("sha2_hex", F.sha2(F.col("p_partkey").cast("string"), 256))
    return hashed.selectExpr("p_partkey", f"{DIRTY_NAME.replace('varchar(9)', 'string')} as raw")


DIRTY_PARTS_SQL = f"""dirty as (
    select p_partkey, {DIRTY_NAME.replace('varchar(9)', 'varchar')} as raw
    from (select *, sha256(cast(p_partkey as varchar)) as sha2_hex from part))"""


@query(
    "fn_text",
    rf"""with {DIRTY_PARTS_SQL}
    select p_partkey,
        nullif(regexp_replace(raw, '{TRIM}', '', 'g'), '') as cleaned,
        nullif(raw, '(null)') as without_sentinel,
        translate(raw, '‘’‛“”', '''''''""') as straight,
        lower(regexp_replace(regexp_replace(translate(raw, '‘’‛“”', '''''''""'), '{WS}+', ' ', 'g'),
            '{TRIM}', '', 'g')) as loose,
        regexp_matches(raw, '^<[A-Za-z]+: 0x[0-9a-f]+>$') as leaked,
        raw is not null and raw <> '' as present
    from dirty""",
)
def fn_text(t: Tables) -> DataFrame:
    raw = F.col("raw")
    return _dirty_parts(t).select(
        "p_partkey",
        clean_text(raw).alias("cleaned"),
        sentinel_null(raw).alias("without_sentinel"),
        straighten_quotes(raw).alias("straight"),
        loose_text(raw).alias("loose"),
        is_object_description(raw).alias("leaked"),
        is_present(raw).alias("present"),
    )


NUMBER_CASE = """case o_orderkey % 9
    when 0 then concat(cast(o_custkey as {text}), '.', cast(o_orderkey % 1000 as {text}), '00')
    when 1 then concat('00', cast(o_custkey as {text}))
    when 2 then concat(' +', cast(o_custkey as {text}), '.50 ')
    when 3 then concat(cast(o_custkey as {text}), 'd')
    when 4 then '0x1F'
    when 5 then concat('-', cast(o_custkey as {text}), '.000')
    when 6 then 'na'
    when 7 then cast(null as {text})
    else concat(cast(o_custkey as {text}), 'e2') end"""


@query(
    "fn_numbers",
    rf"""with raw as (
        select o_orderkey, {NUMBER_CASE.format(text="varchar")} as raw from orders),
    parts as (
        select *, trim(raw) as t,
            regexp_matches(trim(raw), '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$') as plain from raw),
    numbers as (select *, case when plain then cast(t as double) end as n from parts)
    select o_orderkey,
        case when t = '0x1F' then '31'
            when plain and n = floor(n) then cast(cast(n as bigint) as varchar)
            when plain then regexp_replace(regexp_replace(regexp_replace(t, '^\+', ''), '^(-?)0+(\d)', '\1\2'), '0+$', '')
            else raw end as number_text,
        n as seconds,
        case when n > 0 then n else 0.0::double end as positive,
        case when regexp_matches(raw, '^-?\d+(\.\d+)?([eE][+-]?\d+)?$') then try_cast(raw as double) end as typed,
        case when plain then n end as as_number_cast
    from numbers""",
)
def fn_numbers(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr("o_orderkey", f"{NUMBER_CASE.format(text='string')} as raw")
    return rows.select(
        "o_orderkey",
        as_number("raw").alias("number_text"),
        recorded_seconds("raw").alias("seconds"),
        positive_count("raw").alias("positive"),
        typed_number("raw").alias("typed"),
        cast_as("raw", "number").alias("as_number_cast"),
    )


@query(
    "fn_dates",
    r"""with raw as (
        select o_orderkey,
            case when o_orderkey % 3 = 0 then strftime(o_orderdate, '%m/%d/%Y %H:%M:%S')
                else strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') end as stamp,
            case o_orderkey % 4
                when 0 then concat(month(o_orderdate), '/', day(o_orderdate), '/', right(cast(year(o_orderdate) as varchar), 2))
                when 1 then concat(' ', month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate))
                when 2 then strftime(o_orderdate, '%Y-%m-%d')
                else 'undated' end as short
        from orders),
    parts as (
        select *, regexp_extract_all(short, '\d+') as d,
            regexp_matches(trim(short), '^(\d{1,2})/(\d{1,2})/(\d{2,4})$') as us from raw)
    select o_orderkey,
        regexp_replace(stamp, '^(\d{2})/(\d{2})/(\d{4})\s+(\d{2}:\d{2}:\d{2})$', '\3-\1-\2T\4') as iso_stamp,
        case when us then concat(case when length(d[3]) = 2 then '20' else '' end, d[3], '-', lpad(d[1], 2, '0'), '-',
            lpad(d[2], 2, '0')) end as iso_day,
        case when regexp_matches(short, '^\d{4}-\d{2}-\d{2}$') then concat(short, 'T00:00:00Z') end as midnight,
        case when o_orderkey % 2 = 0 then true end as flag
    from parts""",
)
def fn_dates(t: Tables) -> DataFrame:
    stamp = F.when(
        F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    short = (
        F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "M/d/yy"))
        .when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "' 'M/d/yyyy"))
        .when(F.col("o_orderkey") % 4 == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise("undated")
    )
    rows = t.orders.select("o_orderkey", stamp.alias("stamp"), short.alias("short"))
    flag = F.when(F.col("o_orderkey") % 2 == 0, " TRUE").otherwise("maybe")
    return rows.select(
        "o_orderkey",
        us_datetime_to_iso("stamp").alias("iso_stamp"),
        iso_date("short").alias("iso_day"),
        F.when(F.col("short").rlike("^[0-9]{4}-"), cast_as("short", "datetime")).alias("midnight"),
        cast_as(flag, "boolean").alias("flag"),
    )


LABELS = """case l_orderkey % 5 when 0 then cast(1000 + l_linenumber as {text}) when 1 then ''
        when 2 then concat('R', cast(l_linenumber as {text}), '/', cast(l_suppkey as {text}))
        else concat(cast(l_linenumber as {text}), 'A') end as slate,
    case l_partkey % 5 when 0 then concat(cast(l_linenumber as {text}), ' PU') when 1 then 'PU'
        when 2 then concat(cast(l_linenumber as {text}), '.1 PU') when 3 then cast(null as {text})
        else cast(l_linenumber as {text}) end as take,
    case l_suppkey % 3 when 0 then concat('Day ', cast(l_linenumber as {text})) when 1 then 'second unit'
        else cast(l_linenumber as {text}) end as day,
    l_returnflag as camera"""


@query(
    "fn_labels",
    rf"""with rows as (select {LABELS.format(text="varchar")} from lineitem),
    named as (
        select *, regexp_matches(slate, '^\d{{4,}}$') as wild,
            regexp_matches(take, '^\s*(\d+(?:\.\d+)?)\s*(.*)$') as numbered,
            regexp_extract(take, '^\s*(\d+(?:\.\d+)?)\s*(.*)$', 1) as num,
            nullif(trim(regexp_extract(take, '^\s*(\d+(?:\.\d+)?)\s*(.*)$', 2)), '') as rest from rows)
    select
        case when regexp_matches(day, '(?i)^\s*(?:day\s*)?(\d+)\s*$') then regexp_extract(day, '(\d+)', 1) else day end as shoot_day,
        case when slate <> '' and take <> '' then concat(slate, '-', take) end as full_name,
        case when trim(slate) <> '' and trim(take) <> '' then concat(trim(slate), '-', trim(take)) end as slate_take,
        case when not wild then slate end as scene, case when wild then slate end as wild_number, wild,
        case when numbered then cast(num as double) end as number,
        case when numbered then rest else take end as annotation,
        concat(slate, '|', camera, '|', case when numbered then num else coalesce(take, '') end) as key,
        count(*) as n
    from named group by all""",
)
def fn_labels(t: Tables) -> DataFrame:
    rows = t.lineitem.selectExpr(*[p for p in _split_top(LABELS.format(text="string"))])
    split = rows.select(
        "*", scene_slate("slate").alias("scene"), wild_track_number("slate").alias("wild_number"), is_wild_track("slate").alias("wild"),
        take_number("take").alias("number"),
    )
    named = split.select(
        shoot_day_number("day").alias("shoot_day"),
        slate_full_name("slate", "take").alias("full_name"),
        slate_id("slate", "take").alias("slate_take"),
        "scene", "wild_number", "wild",
        "number",
        take_annotation("take").alias("annotation"),
        take_key("scene", "wild_number", "camera", "take", "number").alias("key"),
    )
    return named.groupBy(*named.columns).agg(F.count("*").alias("n"))


def _split_top(text: str) -> list[str]:
    """Split a select list at the commas outside of parentheses."""
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(text):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(text[start:i])
            start = i + 1
    return [*parts, text[start:]]


@query(
    "fn_lists",
    rf"""with cells as (
        select p_partkey, concat(p_type, '; ', p_name, ';; ', p_type, ' ;', p_brand) as cell,
            nullif(concat_ws('; ', nullif(case when p_partkey % 2 = 0 then p_name end, ''), nullif(p_brand, '')), '') as joined,
            concat_ws('; ', case when p_partkey % 3 = 0 then p_name else p_brand end, cast(p_partkey as varchar)) as named
        from part)
    select p_partkey,
        array_to_string(list_sort(list_distinct(list_filter(
            list_transform(string_split(cell, ';'), lambda x: regexp_replace(x, '{TRIM}', '', 'g')), lambda x: x <> ''))), '|') as members,
        joined, named
    from cells""",
)
def fn_lists(t: Tables) -> DataFrame:
    member = lambda display, key: F.struct(
        display.alias("display_name"),
        F.lit(None).cast("string").alias("name"),
        F.when(display.isNull(), F.col("p_brand")).alias("email"),
        key.cast("string").alias("id"),
    )
    nobody = F.lit(None).cast("string")
    people = F.array(
        member(F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")), F.col("p_partkey")),
        F.struct(nobody.alias("display_name"), nobody.alias("name"), nobody.alias("email"), F.col("p_partkey").cast("string").alias("id")),
    )
    cell = F.concat("p_type", F.lit("; "), "p_name", F.lit(";; "), "p_type", F.lit(" ;"), "p_brand")
    return t.part.select(
        "p_partkey",
        F.array_join(split_list(cell, ";"), "|").alias("members"),
        join_list(F.array(F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")), F.lit(""), F.col("p_brand"))).alias("joined"),
        named_members(people).alias("named"),
    )


_MEDIA = ["IMAGE/png", "text/csv", "text/html", "application/pdf", "application/x-odd", "video/mp4"]
_MEDIA_CASE = "case page_id % 6 " + " ".join(f"when {i} then '{m}'" for i, m in enumerate(_MEDIA)) + " end"
_STRUCTURE_CASE = "case " + " ".join(
    f"when starts_with(lower(media), '{p}') then '{c}'" for p, c in MEDIA_STRUCTURES
) + " end"


@query(
    "fn_paths",
    rf"""with rows as (select page_id, url, {_MEDIA_CASE} as media,
            case when page_id % 4 = 0 then '.hidden' when page_id % 4 = 1 then concat('Take.', page_id, '.MOV')
                else url end as name from pages)
    select page_id, nullif(lower(regexp_extract(name, '[^./](\.[^./]*)$', 1)), '') as extension,
        coalesce({_STRUCTURE_CASE}, 'digital') as structure, ({_STRUCTURE_CASE}) is not null as known,
        concat('/', name) as file_path, concat('/', name, '/') as folder_path
    from rows""",
)
def fn_paths(t: Tables) -> DataFrame:
    name = (
        F.when(F.col("page_id") % 4 == 0, ".hidden")
        .when(F.col("page_id") % 4 == 1, F.concat(F.lit("Take."), "page_id", F.lit(".MOV")))
        .otherwise(F.col("url"))
    )
    rows = t.pages.select("page_id", F.expr(_MEDIA_CASE).alias("media"), name.alias("name"))
    return rows.select(
        "page_id",
        ext_name("name").alias("extension"),
        structure_for("media").alias("structure"),
        structure_known("media").alias("known"),
        child_path(F.lit("/"), "name", folder=False).alias("file_path"),
        child_path(F.lit("/"), "name", folder=True).alias("folder_path"),
    )


PROJECT_PREFIX = "com.example.project."


@query(
    "fn_ids",
    f"""select c_custkey,
        sha256(concat('4:demo|8:Customer|', length(c_name), ':', c_name)) as entity_id,
        concat('demo/', c_name) as combined,
        concat('{PROJECT_PREFIX}', c_custkey) = '{PROJECT_PREFIX}12' as in_project
    from customer""",
)
def fn_ids(t: Tables) -> DataFrame:
    own = F.concat(F.lit(PROJECT_PREFIX), "c_custkey")
    return t.customer.select(
        "c_custkey",
        entity_id("Customer", "c_name", "demo").alias("entity_id"),
        id_combined(F.lit("demo"), "c_name").alias("combined"),
        (own == project_identifier("12", PROJECT_PREFIX)).alias("in_project"),
    )


@query(
    "fn_compare",
    rf"""with {DIRTY_PARTS_SQL}
    select p_partkey,
        case when raw is not null and raw <> '' then lower(regexp_replace(regexp_replace(
            translate(raw, '‘’‛“”', '''''''""'), '{WS}+', ' ', 'g'), '{TRIM}', '', 'g')) end as loose_form,
        case when raw is not null and raw <> '' then raw end as plain_form
    from dirty""",
)
def fn_compare(t: Tables) -> DataFrame:
    return _dirty_parts(t).select(
        "p_partkey",
        compare_value("raw", loose_text).alias("loose_form"),
        compare_value("raw", None).alias("plain_form"),
    )
