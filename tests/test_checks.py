"""Reconciliation, rules and quality operators on small fixtures."""

import pytest
from pyspark.sql import functions as F

from tablemint.functions import as_number, loose_text
from tablemint.operators.order import by_day, by_name, first_match, head_of_stack, last_wins, with_order
from tablemint.operators.quality import (
    EntityRule, Role, check_manifest, duplicate_members, exactly_one, fallback_day, is_copied, leaked_fields,
    page_completeness, require_rows, sentinel_tally, shared_identifiers, unexpected_columns, validate_entities,
)
from tablemint.operators import reconcile
from tablemint.operators.reconcile import Field, Reconciliation, Witness, cross_tab, golden_diff, reconcile_witnesses, run_difference
from tablemint.operators.rules import assign_role, check_patterns, classify
from tablemint.plans.delivery import signature_rules

FIELDS = [
    Field("fps", "fps", "fps", as_number),
    Field("text", "text", "text", loose_text, "quotes differ"),
    Field("own", "own", None),
]


def _side(spark, data):
    return with_order(spark.createDataFrame(data, "n int, k string, fps string, text string, own string"), "n")


def test_reconcile_uses_the_last_row_of_a_key(spark, rows):
    left = _side(spark, [(1, "a", "24", "x", "o"), (2, "a", "23.976", "It’s", "o"), (3, "b", None, "t", "o"), (4, "l", "1", "1", "1")])
    right = _side(spark, [(1, "a", "23.9760", "IT'S ", None), (2, "b", "24", "", None), (3, "r", "1", "1", None)])
    r = Reconciliation(left, right, ["k"], FIELDS)
    assert rows(r.differences()) == [
        ("b", "fps", None, "24", "one_sided"), ("b", "text", "t", "", "one_sided"),
    ]
    assert rows(r.only_left()) == [("l",)] and rows(r.only_right()) == [("r",)] and rows(r.matched()) == [("a",), ("b",)]
    assert rows(r.summary()) == [(2, 1, 1, 0, 2, "DIFFERENCES FOUND")]
    assert rows(r.by_field()) == [("fps", "one_sided", 1, None), ("text", "one_sided", 1, "quotes differ")]


def test_one_sided_values_do_not_fail_the_verdict(spark, rows):
    left = _side(spark, [(1, "a", "24", "x", None)])
    right = _side(spark, [(1, "a", "24.0", None, None)])
    assert rows(Reconciliation(left, right, ["k"], FIELDS).summary()) == [(1, 0, 0, 0, 1, "PASS")]
    empty = right.filter("false")
    absent = Reconciliation(left, empty, ["k"], FIELDS, delivered=False).summary()
    assert rows(absent) == [(0, 1, 0, 0, 0, "NOT DELIVERED")]


def test_equal_texts_are_not_normalized(spark, rows):
    def normal(value):
        return F.when(value == "same", F.raise_error(F.lit("normalized"))).otherwise(F.lower(value))

    left = spark.createDataFrame([("a", "same", "X"), ("b", "A", "y"), ("c", None, "")], "k string, v string, w string")
    right = spark.createDataFrame([("a", "same", "x"), ("b", "B", "y"), ("c", "", "z")], "k string, v string, w string")
    r = Reconciliation(left, right, ["k"], [Field("v", "v", "v", normal), Field("w", "w", "w", normal)])
    assert rows(r.differences()) == [("b", "v", "A", "B", "mismatch"), ("c", "w", "", "z", "one_sided")]
    assert "filter(" not in r.differences()._jdf.queryExecution().optimizedPlan().toString()


def test_a_normal_form_that_is_null_is_one_sided(spark, rows):
    number = lambda value: F.when(value.rlike("^[0-9]+$"), value)
    left = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", "x"), ("d", "x")], "k string, v string")
    right = spark.createDataFrame([("a", "y"), ("b", "y"), ("c", None), ("d", "2")], "k string, v string")
    r = Reconciliation(left, right, ["k"], [Field("v", "v", "v", number)])
    assert rows(r.differences(), "k", "difference") == [("a", "one_sided"), ("d", "one_sided")]


def test_witnesses_are_compared_in_one_grouping_as_each_by_itself(spark, rows, monkeypatch):
    row = "day string, k string, v string, label string, _ord int"
    # Keys repeat, are null in part, or are held by one side only.
    left = spark.createDataFrame(
        [("1", "a", "x", "old", 1), ("1", "a", "y", "new", 2), ("1", None, "n", "n", 3), ("1", "b", "x", None, 4), ("1", "c", " Z", "z", 5), ("2", "c", "w", "z", 6)], row
    )
    one = spark.createDataFrame([("1", "a", "y", 1), ("1", None, "n", 2), ("1", "d", "x", 3), ("1", "c", "z", 4)], "day string, k string, v string, _ord int")
    two = spark.createDataFrame([("1", "a", "x", 9), ("1", "a", "q", 8), ("2", "c", None, 7)], "day string, k string, w string, _ord int")
    none = two.filter("false").drop("_ord")
    keys = ["day", "k"]
    witnesses = {
        "one": Witness(one, [Field("v", "v", "v", loose_text)]),
        "two": Witness(two, [Field("v", "v", "w"), Field("label", "label", None)]),
        "none": Witness(none, [Field("v", "v", "w")], delivered=False),
    }
    stored = []
    write = reconcile.stage
    monkeypatch.setattr(reconcile, "stage", lambda df, name: stored.append(df) or write(df, name))
    compared, last = reconcile_witnesses(left, witnesses, keys, ("label",))
    assert len(stored) == 1
    plan = stored[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max_by" in plan and "Join" not in plan
    for name, w in witnesses.items():
        alone = Reconciliation(left, w.rows, keys, w.fields, w.delivered)
        for figure in ("summary", "by_field", "differences", "only_left", "only_right", "matched"):
            assert rows(getattr(compared[name], figure)()) == rows(getattr(alone, figure)()), (name, figure)
    assert rows(last) == sorted([("1", "a", "new"), ("1", None, "n"), ("1", "b", None), ("1", "c", "z"), ("2", "c", "z")], key=repr)
    flags = one.withColumnRenamed("v", "flag")
    assert rows(cross_tab(last, flags, keys, "flag", "label", unique=True)) == rows(cross_tab(left, flags, keys, "flag", "label"))


def test_cross_tab_counts_every_witness_row(spark, rows):
    reference = with_order(spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", None)], "n int, k string, label string"), "n")
    witness = spark.createDataFrame([("a", "Y"), ("a", "Y"), ("b", None), ("z", "Y")], "k string, flag string")
    assert rows(cross_tab(reference, witness, ["k"], "flag", "label")) == [("(blank)", "(blank)", 1), ("Y", "y", 2)]


def test_golden_and_run_difference(spark, rows):
    a = spark.createDataFrame([("1", "x", "p1"), ("2", "y", "p2"), ("3", "z", "p3")], "k string, v string, path string")
    b = spark.createDataFrame([("q1", "x", "1"), ("q2", "Y", "2"), ("q4", "w", "4")], "path string, v string, k string")
    assert rows(golden_diff(a, b, ["k"], ignore=("path",))) == [("2", "differing"), ("3", "missing"), ("4", "extra")]
    assert rows(run_difference(a, a.orderBy(F.desc("k")))) == []
    doubled = a.unionAll(a.limit(1))
    assert run_difference(a, doubled).count() == 1


def test_first_and_last_in_source_order(spark, rows):
    df = with_order(spark.createDataFrame([(3, "a", "c"), (1, "a", None), (2, "a", "b")], "n int, k string, v string"), "n")
    assert rows(last_wins(df, ["k"]), "k", "v") == [("a", "c")]
    assert rows(first_match(df, ["k"]), "k", "v") == [("a", None)]


def test_head_of_stack_prefers_the_inline_head(spark, rows):
    stacks = spark.createDataFrame([("s1", "h"), ("s2", None), ("s3", None)], "id string, head_version string")
    children = spark.createDataFrame(
        [("s1", "x", "file", 0), ("s2", "f", "folder", 0), ("s2", "g", "file", 1), ("s2", "z", "file", 2)],
        "parent_id string, id string, type string, position int",
    )
    assert rows(head_of_stack(stacks, children), "id", "head_id") == [("s1", "h"), ("s2", "g"), ("s3", None)]


def test_name_and_day_order(spark):
    names = spark.createDataFrame([("b",), ("A",), ("a",), ("Z",), ("é",)], "name string")
    assert [r.name for r in by_name(names, "name").collect()] == ["a", "A", "b", "é", "Z"]
    days = spark.createDataFrame([("10",), ("2",), ("x",), ("1",)], "day string")
    assert [r.day for r in by_day(days, "day").collect()] == ["1", "2", "10", "x"]


def test_signature_rules_match_in_order(spark, rows):
    df = spark.createDataFrame(
        [
            ("log", ["1/2/26", "DAILY EDITOR'S LOG"], None, "", ""),
            ("detail", ["x", "DETAILED EDITOR'S LOG"], None, "", ""),
            ("xml", None, "ScriptESIMMetabanq", "<?xml", ""),
            ("csv", None, None, "Slate,Scene,Camera,Roll,Take,Circled,Lens", ""),
            ("bin", None, None, "Heading", "Heading\r\nFIELD_DELIM\tTABS"),
            ("near", ["DAILY EDITOR'S LOG x"], "scriptesimmetabanq", "slate,", " Heading"),
        ],
        "name string, headings array<string>, xml_root string, first_line string, head string",
    )
    got = rows(classify(df, signature_rules()), "name", "document_type", "classified_by")
    assert got == [
        ("bin", "avidClipBin", "text_pattern"), ("csv", "silverStackLog", "header_prefix"),
        ("detail", "detailedEditorLog", "heading"), ("log", "dailyEditorLog", "heading"),
        ("near", "unknown", "unmatched"), ("xml", "simMetabanqExport", "xml_root"),
    ]


def test_roles_fall_back_to_the_first_without_pattern(spark, rows):
    df = spark.createDataFrame([("Show SIM metabanq.XML",), ("other.pdf",)], "name string")
    roles = [("sim", r"sim metabanq\.xml$"), ("delivery", None), ("late", None)]
    assert rows(df.select("name", assign_role("name", roles).alias("r")), "r") == [("delivery",), ("sim",)]
    with pytest.raises(Exception):
        check_patterns([("x", "(")])


def test_exactly_one(spark, rows):
    files = spark.createDataFrame([("1", "a sim.xml"), ("1", "b sim.xml"), ("2", "a sim.xml"), ("2", "x.csv")], "day string, name string")
    days = spark.createDataFrame([("1",), ("2",), ("3",)], "day string")
    patterns = [("sim", r"sim\.xml$", True), ("csv", r"\.csv$", False)]
    assert rows(exactly_one(files, days, patterns)) == [
        ("1", "sim", "ambiguous", 2, "a sim.xml"), ("1", "sim", "ambiguous", 2, "b sim.xml"), ("3", "sim", "none", 0, None),
    ]


def test_manifest_problems_are_reported_together(spark, rows):
    inputs = spark.createDataFrame(
        [("r1", "sim", "a", "ref"), ("r1", "sim", "b", None), ("r1", "odd", None, "ref"), ("r1", None, "c", "ref")],
        "run_id string, role string, file_name string, ref string",
    )
    runs = spark.createDataFrame([("r1",), ("r2",)], "run_id string")
    roles = [Role("sim", "Primary", required=True, max_files=1), Role("delivery", "Files")]
    got = rows(check_manifest(inputs, runs, roles, max_files=3), "run_id", "kind")
    assert got == sorted([
        ("r1", "inputWithoutRef"), ("r1", "unknownRole"), ("r1", "unknownRole"), ("r1", "tooManyFiles"), ("r1", "tooManyForRole"),
        ("r2", "tooFewFiles"), ("r2", "missingRequiredRole"),
    ])


def test_entity_rules(spark, rows):
    df = spark.createDataFrame([("e1", "", "x", "12"), ("e2", "l", None, "1z")], "entity_id string, label string, `a.b` string, size string")
    rules = [EntityRule("label", required=True), EntityRule("a.b", allowed=("y",)), EntityRule("size", pattern="^[0-9]+$", numeric=True)]
    assert rows(validate_entities(df, rules, entity_type="T")) == [
        ("T", "e1", "/a/b is not an allowed value"), ("T", "e1", "/label is required"),
        ("T", "e2", "/size does not match its pattern"), ("T", "e2", "/size is not a number"),
    ]
    with pytest.raises(ValueError, match="no column gone"):
        validate_entities(df, [EntityRule("gone")], entity_type="T")
    assert unexpected_columns(["label", "x"], {"label"}, "T") == ["T has no property x"]


def test_counters(spark, rows):
    df = spark.createDataFrame(
        [("(null)", "a", "a", "<Unit: 0xab>"), ("x", None, None, None), ("(null)", "b", "b", "<Unit: zz>")],
        "s string, l string, r string, u string",
    )
    assert rows(sentinel_tally(df, ["s", "l"])) == [("s", 2)]
    assert rows(is_copied(df, "l", "r")) == [(True,)]
    assert rows(is_copied(df, "l", "s")) == [(False,)]
    assert rows(is_copied(df.filter("false"), "l", "r")) == [(False,)]
    assert rows(leaked_fields(df)) == [("u",)]
    parents = spark.createDataFrame([("p", "1", "Dante"), ("p", "1", "Dante"), ("p", None, "D"), ("p", None, "D"), ("q", "1", "Dante")], "p string, n string, m string")
    assert rows(duplicate_members(parents, ["p"], ["n", "m"])) == sorted([("p", "1", "Dante", 1), ("p", None, "D", 1)], key=repr)


def test_shared_identifiers(spark, rows):
    ids = spark.createDataFrame(
        [("A", "1", "s", "v"), ("A", "1", "s", "v"), ("B", "1", "s", "v"), ("A", "2", "s", "w")],
        "entity_type string, entity_id string, scope string, value string",
    )
    assert rows(shared_identifiers(ids)) == [("s", "v")]


def test_fallback_day(spark, rows):
    one = spark.createDataFrame([("1",), (None,)], "day string")
    two = spark.createDataFrame([("1",), ("2",), (None,)], "day string")
    assert rows(fallback_day(one, "day", "9")) == [("1",), ("1",)]
    assert rows(fallback_day(two, "day", "9")) == [("1",), ("2",), ("9",)]
    assert rows(fallback_day(two, "day")) == [("1",), ("2",), (None,)]


def test_page_completeness(spark, rows):
    pages = spark.createDataFrame(
        [
            ("good", 0, 2, True, None, None), ("good", 1, 1, False, None, None),
            ("cut", 0, 2, True, None, None), ("empty", 0, 2, True, None, None), ("empty", 1, 0, True, None, None),
            ("loop", 0, 1, False, "a", "b"), ("loop", 1, 1, False, "b", "b"), ("gap", 0, 1, False, "a", "z"),
        ],
        "endpoint string, position int, rows int, has_more boolean, cursor string, next string",
    )
    assert rows(page_completeness(pages)) == [
        ("cut", "unfinished", None), ("gap", "missingPage", "z"), ("loop", "repeatedCursor", "b"),
    ]


def test_an_empty_run_is_an_error(spark):
    with pytest.raises(Exception, match="nothing landed"):
        require_rows(spark.range(0), "nothing landed").collect()
