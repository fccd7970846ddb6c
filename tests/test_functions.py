"""Scalar functions on the values a delivery really contains."""

import pytest
from pyspark.sql import functions as F

from tablemint import functions as fn

NBSP, BOM = " ", "﻿"


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in sorted(df.select("i", function(F.col("v")).alias("r")).collect())]


@pytest.mark.parametrize(
    "function, cases",
    [
        (fn.clean_text, {" a ": "a", "\t\n": None, "": None, f"{NBSP}x{BOM}": "x", "a b": "a b", None: None}),
        (fn.sentinel_null, {"(null)": None, "null": "null", "": "", None: None}),
        (fn.straighten_quotes, {"‘a’ “b”": "'a' \"b\"", "‛": "'"}),
        (fn.loose_text, {" It’s  A\nTest ": "it's a test", f"A{NBSP}B": "a b"}),
        (fn.is_object_description, {"<Unit: 0x60000aeaec30>": True, "<Unit: 0x>": False, "<Unit 1: 0xab>": False}),
        (fn.shoot_day_number, {"Day 1": "1", "day3": "3", " 12 ": "12", "1A": "1A", "Day": "Day", None: None}),
        (fn.as_number, {"0x1f": "31", "0x123456789abcdef": "81985529216486896", "1e20": "100000000000000000000", "1e21": "1e+21",
                        "0.0000012345678901234": "0.0000012345678901234", "2.5e-8": "2.5e-8"}),
        (fn.as_number, {"23.976": "23.976", "23.9760": "23.976", "90.0": "90", "007": "7", "1e3": "1000", "-0": "0",
                        "1d": "1d", "na": "na", "0x10": "16", ".5": "0.5", "+4": "4", None: None}),
        (fn.us_datetime_to_iso, {"01/23/2026 15:41:51": "2026-01-23T15:41:51", "99/99/2026 15:41:51": "2026-99-99T15:41:51",
                                 "1/23/2026 15:41:51": "1/23/2026 15:41:51", "2026-01-23T15:41:51": "2026-01-23T15:41:51"}),
        (fn.iso_date, {"1/23/26": "2026-01-23", "01/3/2026": "2026-01-03", " 1/2/26 ": "2026-01-02", "1/2/3": None, "x": None, None: None}),
        (fn.scene_slate, {"3A": "3A", "1001": None, "R13/15": "R13/15", "100": "100", None: None}),
        (fn.wild_track_number, {"3A": None, "1001": "1001", None: None}),
        (fn.is_wild_track, {"3A": False, "1001": True, None: False}),
        (fn.take_number, {"1": 1.0, "6 PU": 6.0, "6.1 PU": 6.1, "4.1": 4.1, "PU": None, None: None}),
        (fn.take_annotation, {"1": None, "6 PU": "PU", "6.1 PU": "PU", "PU": "PU", None: None}),
        (fn.ext_name, {"a.MOV": ".mov", "a.b.txt": ".txt", "notes": None, ".hidden": None, "dir.x/name": None, "a.": ".", None: None}),
        (fn.positive_count, {"3": 3.0, "-1": 0.0, "x": 0.0, "": 0.0, None: 0.0, "2.5": 2.5}),
        (fn.recorded_seconds, {"12.5": 12.5, "": None, "1d": None, None: None}),
        (fn.typed_number, {"12": 12.0, '"12"': None, "true": None, "null": None, "-1.5e2": -150.0}),
        (fn.iso_datetime, {"2026-01-23": "2026-01-23T00:00:00Z", "2026-01-23T10:00:00Z": "2026-01-23T10:00:00Z",
                           "2026-01-23T10:00:00+02:00": "2026-01-23T08:00:00Z", "soon": None, "2026-13-01": None}),
    ],
    ids=lambda p: getattr(p, "__name__", ""),
)
def test_text_function(spark, function, cases):
    assert apply(spark, function, list(cases)) == list(cases.values())


def test_iso_datetime_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        values = ["2026-01-23", "2026-01-23T10:00:00Z"]
        assert apply(spark, fn.iso_datetime, values) == ["2026-01-23T00:00:00Z", "2026-01-23T10:00:00Z"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    "kind, cases",
    [
        ("number", {"1.5": 1.5, "1d": None, "": None}),
        ("string", {"a": "a"}),
        ("boolean", {"true": True, "FALSE": False, "yes": None}),
        ("datetime", {"2026-01-23": "2026-01-23T00:00:00Z"}),
    ],
)
def test_cast(spark, kind, cases):
    assert apply(spark, lambda c: fn.cast_as(c, kind), list(cases)) == list(cases.values())


def test_unknown_cast_is_refused():
    with pytest.raises(ValueError):
        fn.cast_as("v", "decimal")


def test_split_list_is_a_sorted_set(spark):
    split = lambda c: fn.split_list(c, ";")
    assert apply(spark, split, ["15; 13;;13 ", " ; ", None, "a|b"]) == [["13", "15"], [], None, ["a|b"]]
    assert apply(spark, lambda c: fn.split_list(c, "|"), ["b|a"]) == [["a", "b"]]


def test_join_list(spark):
    assert apply(spark, fn.join_list, [["a", "", None, "b"], [], None], "array<string>") == ["a; b", None, None]


def test_take_key_tells_decimal_takes_apart_and_folds_annotations(spark):
    df = spark.createDataFrame(
        [("3A", None, "A", "6 PU"), ("3A", None, "A", "6.0"), ("3A", None, None, "6.1 PU"), (None, "1001", "A", "PU"), (None, None, "A", None),
         ("1", None, "A", "06.10"), ("1", None, "A", "10"), ("1", None, "A", "0"), ("1", None, "A", "100.00 x"), ("1", None, "A", "6.1.2"),
         ("1", None, "A", "1.5 with a long annotation"), ("1", None, "A", "6.")],
        "s string, w string, c string, t string",
    )
    keys = [r[0] for r in df.select(fn.take_key("s", "w", "c", "t")).collect()]
    assert keys == ["3A|A|6", "3A|A|6", "3A||6.1", "1001|A|PU", "null|A|",
                    "1|A|6.1", "1|A|10", "1|A|0", "1|A|100", "1|A|6.1", "1|A|1.5", "1|A|6"]


def test_slate_names_need_both_parts(spark):
    df = spark.createDataFrame([("3A", "1"), ("3A", ""), (None, "1"), (" 3A ", " 2 ")], "s string, t string")
    got = [tuple(r) for r in df.select(fn.slate_full_name("s", "t"), fn.slate_id("s", "t")).collect()]
    assert got == [("3A-1", "3A-1"), (None, None), (None, None), (" 3A - 2 ", "3A-2")]


def test_entity_ids_do_not_collide_across_parts(spark):
    df = spark.createDataFrame([("b|1:c",), ("1",)], "k string")
    ids = [r[0] for r in df.select(fn.entity_id("A", "k", "n")).collect()]
    ids += [r[0] for r in df.select(fn.entity_id("A|5:b|1:c", "k", "n")).collect()]
    ids += [r[0] for r in df.select(fn.entity_id("A", "k", "n2")).collect()]
    assert len(set(ids)) == 6


def test_scalar_functions_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("1", "2")], "s string, t string")
    plan = df.select(
        fn.loose_text("s"), fn.as_number("s"), fn.take_key("s", "s", "t", "t"), fn.iso_datetime("s"), fn.split_list("s", ";")
    )._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_numbers_written_in_full_keep_their_spelling(spark):
    texts = ["0.001", "0.1", "1.1", "-2.5", "1.10", "9999999.5", "12345678.25", "0.0009", "3.0", "0.30000000000000004", "1e22", "1.5e-7"]
    df = spark.createDataFrame([(t, float(t)) for t in texts], "t string, n double")
    wanted = ["0.001", "0.1", "1.1", "-2.5", "1.1", "9999999.5", "12345678.25", "0.0009", "3", "0.30000000000000004", "1e+22", "1.5e-7"]
    assert [r[0] for r in df.select(fn.number_text(F.col("n"))).collect()] == wanted


def test_a_number_held_already_is_not_read_again(spark):
    df = spark.sql("select * from values ('1', '06.10 PU'), ('2', 'PU'), (null, '3'), ('4', null) t(slate, take)")
    held = df.withColumn("n", fn.take_number("take"))
    none = F.lit(None).cast("string")
    twice = fn.take_key("slate", none, none, "take"), fn.take_key("slate", none, none, "take", "n")
    assert [r[0] for r in held.select(twice[0]).collect()] == [r[0] for r in held.select(twice[1]).collect()] == ["1||6.1", "2||PU", "null||3", "4||"]


def test_short_labels_are_spelled_as_their_numbers(spark):
    labels = [
        "0", "00", "1", "01", "10", "1.0", "1.10", "0.5", "00.5", "0.10", "0.000001", "0.0000001", "123456789012", "1234567890123",
        "123456789012.05", "12345678.123456", "12345678.120000", "99999999.999999", "1" * 30, "9" * 400, "6.1 PU", "06.10 PU", "5\n", "5\nPU", " 5", "5.", "5.5.5", "PU", "", None,
    ]
    df = spark.createDataFrame([(v,) for v in labels], "v string")
    none = F.lit(None).cast("string")
    by_text = fn.take_key(F.lit("s"), none, F.lit("A"), "v")
    by_number = fn.take_key(F.lit("s"), none, F.lit("A"), "v", number=fn.take_number("v"))
    assert df.filter(~by_text.eqNullSafe(by_number)).count() == 0
    # A label that is its own spelling is never made a double.
    spelled = df.filter("v in ('0', '1', '10', '0.5', '12345678.123456')")
    assert spelled.filter(by_text == F.concat(F.lit("s|A|"), "v")).count() == 5
    plain = spelled.filter(fn.as_number("v") == F.col("v"))
    assert plain.count() == 5


def test_plain_text_only_loses_its_case(spark):
    values = ["A b", " A", "A ", "A  b", "A\tb", "É", "A\n", "", "a", "It’s", f"A{NBSP}", "A b C"]
    assert apply(spark, fn.loose_text, values) == ["a b", "a", "a", "a b", "a b", "é", "a", "", "a", "it's", "a", "a b c"]
