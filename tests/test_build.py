"""Mappings: grains, withholding, folding, edges and plan-time checks."""

import re

import pytest
from pyspark.sql import functions as F

from tablemint.operators.order import with_order
from tablemint.plans.build import build_entities
from tablemint.plans.mapping import Edge, FromTable, Lookup, Mapping, MappingError, Rest, Source, Text, mappings_for
from tablemint.workload import QUERIES


@pytest.fixture(scope="module")
def takes(spark):
    data = [
        (1, "3A-1", "3A", "3", "a door", "main", "c1", "x", None),
        (2, "3A-2", "3A", "3", "a door", "main", "c2", "", "note"),
        (3, "R13-1", "R13", "13; 15", "stairs", "main", "c1", None, None),
        (4, "R13-2", "R13", "15;13", "roof", "", "c1", None, None),
        (5, "1001-1", None, "3", None, "main", "c1", "y", None),
        (6, "9-1", "9", " ; ", None, "main", "c1", None, None),
    ]
    df = spark.createDataFrame(
        data, "n int, name string, scene string, narrative string, description string, unit string, roll string, tech string, comment string"
    )
    return with_order(df, "n")


@pytest.fixture(scope="module")
def scenes(spark):
    df = spark.createDataFrame(
        [(1, "3", "INT. ROOM"), (2, "3", "INT. OTHER"), (3, "13", "EXT."), (4, "15", None)], "n int, narrative string, heading string"
    )
    return with_order(df, "n")


SCENE = Mapping(
    "Scene", "takes", "scene", grain="group", skip_empty_key=True,
    properties={
        "label": "scene",
        "header": Source("narrative", split=";", when="single", lookup=Lookup("scenes", "narrative", "heading")),
        "all": Source("narrative", split=";"),
        "descriptor": Source("description", when="unanimous"),
    },
    texts={"annotation": (Text("Comment", "comment"),)},
    custom=Rest("demo", exclude=("name",)),
    edges=(Edge("Slate", "name", inverse=True), Edge("Narrative", "narrative", split=";"), Edge("Missing", "roll", external=True)),
)
SLATE = Mapping("Slate", "takes", "name", properties={"label": "name", "unit": "unit"})
NARRATIVE = Mapping("Narrative", "scenes", "narrative", grain="group", properties={"heading": "heading"})


@pytest.fixture(scope="module")
def built(takes, scenes):
    return build_entities({"takes": takes, "scenes": scenes}, [SCENE, SLATE, NARRATIVE], "demo")


def test_group_grain_resolves_rows_together(built, rows):
    assert rows(built.entities["Scene"], "key", "label", "header", "all", "descriptor") == [
        ("3A", "3A", "INT. ROOM", "3", "a door"),
        ("9", "9", None, "", None),
        ("R13", "R13", None, "13, 15", None),
    ]


def test_withheld_values_are_noted_with_exact_counts(built, rows):
    assert rows(built.notes, "kind", "where", "detail") == [
        ("propertyWithheld", "Scene 9", 'header left out: one member wanted, "narrative" lists 0 []'),
        ("propertyWithheld", "Scene R13", 'descriptor left out: rows disagree, 2 of them give 2 for "description"'),
        ("propertyWithheld", "Scene R13", 'header left out: one member wanted, "narrative" lists 2 [13, 15]'),
    ]


def test_custom_data_needs_presence_on_every_row(built):
    got = {r.key: dict(r.value) for r in built.custom.filter("entity_type = 'Scene'").collect()}
    # Columns that properties and texts consume are not carried; tech is blank on one row of 3A
    # and unit on one row of R13.
    assert got == {"3A": {"unit": "main"}, "R13": {"roll": "c1"}, "9": {"n": "6", "unit": "main", "roll": "c1"}}


def test_texts_of_a_group_come_from_its_first_row(built, rows):
    # The only comment of 3A is on its second row, so the scene has none.
    assert rows(built.texts) == []


def test_edges_are_distinct_resolved_and_mirrored(built, rows):
    edges = built.edges
    own = edges.filter("from_type = 'Scene' and to_type = 'Slate'")
    assert rows(own, "from_key", "to_key") == [("3A", "3A-1"), ("3A", "3A-2"), ("9", "9-1"), ("R13", "R13-1"), ("R13", "R13-2")]
    mirrored = edges.filter("inverse")
    assert rows(mirrored, "from_type", "from_key", "to_key") == sorted(
        [("Slate", b, a) for a, b in rows(own, "from_key", "to_key")], key=repr
    )
    assert rows(edges.filter("to_type = 'Narrative'"), "from_key", "to_key") == [("3A", "3"), ("R13", "13"), ("R13", "15")]
    assert rows(edges.filter("external"), "from_key", "to_type", "to_key") == [
        ("3A", "Missing", "c1"), ("3A", "Missing", "c2"), ("9", "Missing", "c1"), ("R13", "Missing", "c1")
    ]


def test_edge_ids_are_the_ids_of_the_entities(built, rows):
    ids = {r.key: r.entity_id for r in built.entities["Slate"].collect()}
    for r in built.edges.filter("to_type = 'Slate'").collect():
        assert r.to_id == ids[r.to_key]


def test_an_empty_key_fails_unless_skipped(takes):
    with pytest.raises(Exception, match="no value for key column"):
        mapping = Mapping("Scene", "takes", "scene", grain="group", properties={"label": "scene"})
        build_entities({"takes": takes}, [mapping], "demo").entities["Scene"].collect()


def test_rows_of_one_key_fold(spark, rows):
    df = with_order(
        spark.createDataFrame([(2, "a", "late", "t2"), (1, "a", "", "t1"), (3, "a", "last", "t1"), (4, "b", None, None)],
                              "n int, k string, v string, t string"), "n")
    mapping = Mapping("E", "t", "k", properties={"v": "v", "annotation[0].text": "t"})
    built = build_entities({"t": df}, [mapping], "demo")
    assert rows(built.entities["E"], "key", "v") == [("a", "late"), ("b", None)]
    assert rows(built.texts, "key", "text") == [("a", "t1"), ("a", "t2")]


def test_a_second_mapping_fills_gaps_only(spark, rows):
    first = spark.createDataFrame([("a", "own", None), ("b", "", "x")], "k string, v string, w string")
    second = spark.createDataFrame([("a", "other", 1), ("b", "filled", 2), ("c", "new", 3)], "k string, v string, z int")
    mappings = [
        Mapping("E", "one", "k", properties={"v": "v", "w": "w"}),
        Mapping("E", "two", "k", properties={"v": "v", "z": "z"}),
    ]
    built = build_entities({"one": first, "two": second}, mappings, "demo")
    assert rows(built.entities["E"], "key", "v", "w", "z") == [("a", "own", None, 1), ("b", "filled", "x", 2), ("c", "new", None, 3)]


def test_open_columns_are_carried_under_their_own_names(spark):
    df = spark.createDataFrame([("a", {"Scene": "3", "Rating": "", "Codec": "x"})], "k string, meta map<string,string>")
    mapping = Mapping("E", "t", "k", custom=Rest("demo", exclude=("Codec",)))
    built = build_entities({"t": df}, [mapping], "demo")
    assert [dict(r.value) for r in built.custom.collect()] == [{"k": "a", "Scene": "3"}]
    with pytest.raises(MappingError):
        build_entities({"t": df}, [Mapping("E", "t", "k", grain="group", custom=Rest("demo"))], "demo")


def test_edges_from_another_table_stay_with_built_entities(spark, rows):
    scenes = spark.createDataFrame([("3",), ("4",)], "s string")
    people = spark.createDataFrame([("3", "Dante"), ("3", "Dante"), ("9", "Nobody"), ("4", "")], "s string, name string")
    mapping = Mapping("Scene", "scenes", "s", edges=(Edge("Character", "name", source=FromTable("people", "s"), external=True),))
    built = build_entities({"scenes": scenes, "people": people}, [mapping], "demo")
    assert rows(built.edges, "from_key", "to_key", "external") == [("3", "Dante", True)]


def test_edges_follow_the_rules_given(takes, scenes, rows):
    rules = {("Scene", "Slate"): ("has", "belongsTo")}
    built = build_entities({"takes": takes, "scenes": scenes}, [SCENE, SLATE, NARRATIVE], "demo", edge_rules=rules)
    assert rows(built.edges.select("edge_key", "from_type", "to_type").distinct()) == [
        ("belongsTo", "Slate", "Scene"), ("has", "Scene", "Slate")
    ]


def test_mapping_order_does_not_matter_for_edges(takes, scenes, rows):
    build = lambda order: build_entities({"takes": takes, "scenes": scenes}, order, "demo").edges
    assert rows(build([SCENE, SLATE, NARRATIVE])) == rows(build([NARRATIVE, SLATE, SCENE]))


def test_all_mapping_problems_are_reported_before_any_read(takes):
    mapping = Mapping(
        "Scene", "takes", "scene", grain="page",
        properties={"a": "nothing", "b": Source("name", cast="decimal"), "c": Source()}, edges=(Edge("X", "gone"),),
    )
    with pytest.raises(MappingError) as error:
        build_entities({"takes": takes}, [mapping, Mapping("Y", "absent", "k")], "demo")
    for part in ("grain 'page'", "no column nothing", "'decimal'", "neither a column nor a constant", "no column gone", "table is not present"):
        assert part in str(error.value)


def test_identity_may_come_from_the_identifier_property(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, n int")
    mapping = Mapping("E", "t", properties={"identifier[0].identifierValue": "k"})
    assert rows(build_entities({"t": df}, [mapping], "demo").entities["E"], "key") == [("a",), ("b",)]


def test_supplied_mappings_replace_per_dataset():
    built_in = {"files": [Mapping("A", "files", "k")], "comments": [Mapping("B", "comments", "k")]}
    chosen, notes = mappings_for(built_in, {"files": [Mapping("C", "x", "k")]}, ["files", "comments"])
    assert [(m.entity_type, m.table) for m in chosen] == [("C", "files"), ("B", "comments")]
    assert notes[0][:2] == ("mappingFromTemplate", "files")


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    """The aggregation over a key must have a partial step, so that a hot key is no hot task."""
    df = spark.range(1000).select(F.lit("hot").alias("k"), (F.col("id") % 3).cast("string").alias("v"), F.col("id").alias("n"))
    mapping = Mapping("E", "t", "k", grain="group", properties={"v": Source("v", when="unanimous"), "first": "v"}, custom=Rest("demo"))
    built = build_entities({"t": with_order(df, "n")}, [mapping], "demo")
    plan = built.entities["E"]._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert [r.detail for r in built.notes.collect()] == ['v left out: rows disagree, 1000 of them give 3 for "v"']


def test_columns_called_key(spark, rows):
    """A table may have columns called key in any case; results keep their names apart."""
    table = spark.createDataFrame(
        [("a", "k1", 1), ("a", "k1", 2), ("b", "k2", 3), ("b", "k3", 3)], "id string, Key string, n int"
    )
    group = Mapping(
        "E", "t", "id", grain="group", properties={"agreed": Source("Key", when="unanimous"), "first": "Key"},
        texts={"note": (Text("Key", "Key"),)}, custom=Rest("demo", include=("Key", "n", "id")), edges=(Edge("K", "Key", external=True),),
    )
    row = Mapping("R", "t", "Key", properties={"n": "n"}, custom=Rest("demo", include=("Key",)))
    built = build_entities({"t": table}, [group, row], "demo")
    assert rows(built.entities["E"], "key", "agreed", "first") == [("a", "k1", "k1"), ("b", None, "k2")]
    assert rows(built.entities["R"], "key", "n") == [("k1", 1), ("k2", 3), ("k3", 3)]
    custom = {(r.entity_type, r.key): dict(r.value) for r in built.custom.collect()}
    assert custom == {("E", "a"): {"id": "a"}, ("E", "b"): {"id": "b", "n": "3"}, ("R", "k1"): {"Key": "k1"}, ("R", "k2"): {"Key": "k2"}, ("R", "k3"): {"Key": "k3"}}
    assert rows(built.edges, "from_key", "to_key") == [("a", "k1"), ("b", "k2"), ("b", "k3")]
    assert rows(built.texts.filter("entity_type = 'E'"), "key", "text") == [("a", "k1"), ("b", "k2")]
    assert rows(built.notes, "where") == [("E b",)]


def test_agreement_of_plain_types_is_a_hash_aggregate(spark, rows):
    table = spark.createDataFrame(
        [("a", 1, 1.5, True, None), ("a", 1, 2.5, True, 4), ("b", 2, float("nan"), None, 5), ("b", 2, float("nan"), None, 5)],
        "id string, i int, d double, b boolean, n long",
    )
    mapping = Mapping("E", "t", "id", grain="group", custom=Rest("demo", include=("i", "d", "b", "n")))
    custom = build_entities({"t": table}, [mapping], "demo").custom
    assert {r.key: dict(r.value) for r in custom.collect()} == {"a": {"i": "1", "b": "true"}, "b": {"i": "2", "d": "NaN", "n": "5"}}
    plan = custom._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_rows_in_another_order_are_not_brought_into_a_fixed_number_of_tasks(spark, tmp_path):
    orders = spark.range(100).selectExpr("id as o_orderkey", "id % 7 as o_custkey", "'O' as o_orderstatus", "'1' as o_orderpriority")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    found = QUERIES["idempotent"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and not re.search(r"RepartitionByExpression \[o_custkey#\d+L?\], \d", plan)
    assert [tuple(r) for r in found.collect()] == [(100, 0)]


def test_custom_entries_are_worked_out_once(spark, rows):
    """The filter for empty entries is no second copy of every cell below the grouping."""
    mapping = Mapping("T", "t", "k", custom=Rest("demo"))
    table = spark.sql("select * from values ('1', 'a', map('m', 'x')), ('2', null, map('m', '')), ('3', '', null), ('1', 'a', map('m', 'x')) t(k, c, more)")
    built = build_entities({"t": table.withColumn("c", F.concat("c", F.lit("!")))}, [mapping], "demo")
    assert sorted((r.key, sorted(r.value.items())) for r in built.custom.collect()) == [
        ("1", [("c", "a!"), ("k", "1"), ("m", "x")]), ("2", [("k", "2")]), ("3", [("c", "!"), ("k", "3")]),
    ]
    held = built.custom._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in held.splitlines() if "Filter" in line and "map_entries" in line]
    assert filters == []
