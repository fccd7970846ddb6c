"""One key holds a third of all rows: results against plain Python, and plans that combine early."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablemint.operators.order import with_order
from tablemint.operators.reconcile import Field, Reconciliation, cross_tab
from tablemint.plans.build import build_entities
from tablemint.plans.mapping import Edge, Mapping, Rest, Source

SIZE = 3000


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    rows = []
    for n in range(SIZE):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(200)}"
        rows.append((n, key, rng.choice([None, "", "a", "b"]) if key != "k7" else "a", rng.choice(["x", "y; z", "z;y", " ; "]), f"t{rng.randrange(5)}"))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def frame(spark, data):
    return with_order(spark.createDataFrame(data, "n int, k string, v string, c string, t string").repartition(16), "n")


def test_group_build_against_plain_python(frame, data, rows):
    mapping = Mapping(
        "E", "t", "k", grain="group",
        properties={"first": "v", "agreed": Source("v", when="unanimous"), "one": Source("c", split=";", when="single")},
        custom=Rest("demo", include=("t",)), edges=(Edge("T", "t", external=True), Edge("C", "c", split=";", external=True)),
    )
    built = build_entities({"t": frame}, [mapping], "demo")
    groups = defaultdict(list)
    for row in sorted(data):
        groups[row[1]].append(row)
    expected, custom, edges, notes = [], {}, set(), 0
    for key, members in groups.items():
        present = [r[2] for r in members if r[2]]
        agreed = present[0] if len(set(present)) == 1 else None
        notes += len(set(present)) > 1
        cell = sorted({p.strip() for p in members[0][3].split(";")} - {""})
        notes += len(cell) != 1
        expected.append((key, present[0] if present else None, agreed, cell[0] if len(cell) == 1 else None))
        if len({r[4] for r in members}) == 1:
            custom[key] = {"t": members[0][4]}
        edges |= {(key, "T", r[4]) for r in members}
        edges |= {(key, "C", p.strip()) for r in members for p in r[3].split(";") if p.strip()}
    assert rows(built.entities["E"], "key", "first", "agreed", "one") == sorted(expected, key=repr)
    assert {r.key: dict(r.value) for r in built.custom.collect()} == custom
    assert rows(built.edges, "from_key", "to_type", "to_key") == sorted(edges, key=repr)
    assert built.notes.count() == notes


def test_reconcile_and_cross_tab_against_plain_python(spark, frame, data, rows):
    witness = [(n, k, None if n % 5 == 0 else v, t) for n, k, v, _, t in data if k != "k3"]
    right = with_order(spark.createDataFrame(witness, "n int, k string, v string, t string"), "n")
    last_left, last_right = {}, {}
    for row in sorted(data):
        last_left[row[1]] = row
    for row in sorted(witness, key=lambda r: r[0]):
        last_right[row[1]] = row
    r = Reconciliation(frame, right, ["k"], [Field("v", "v", "v"), Field("t", "t", "t")])
    blank = lambda v: v or None
    expected = [
        (k, "v") for k in last_left if k in last_right and blank(last_left[k][2]) != blank(last_right[k][2])
    ] + [(k, "t") for k in last_left if k in last_right and last_left[k][4] != last_right[k][3]]
    assert rows(r.differences(), "k", "field") == sorted(expected, key=repr)
    counts = defaultdict(int)
    for _, k, v, _t in witness:
        counts[("(blank)" if v is None else v, last_left[k][4])] += 1
    assert rows(cross_tab(frame, right, ["k"], "v", "t"), "flag", "label", "n") == sorted(((a, b, n) for (a, b), n in counts.items()), key=repr)


def test_row_fold_against_plain_python(frame, data, rows):
    built = build_entities({"t": frame}, [Mapping("E", "t", "k", properties={"v": "v", "annotation[0].text": "t"})], "demo")
    first = {}
    for _, k, v, _, _ in sorted(data):
        first[k] = first.get(k) or v or None
    assert rows(built.entities["E"], "key", "v") == sorted(first.items(), key=repr)
    assert rows(built.texts, "key", "text") == sorted({(k, t) for _, k, _, _, t in data}, key=repr)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_plan_sends_a_whole_key_to_one_task(frame, spark):
    built = build_entities(
        {"t": frame}, [Mapping("E", "t", "k", grain="group", properties={"v": Source("v", when="unanimous"), "f": "v"}, custom=Rest("d"))], "demo"
    )
    for df in (built.entities["E"], built.custom, built.notes, Reconciliation(frame, frame, ["k"], [Field("v", "v", "v")]).differences()):
        plan = _plan(df)
        assert "Window" not in plan and "collect_list" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
        assert "partial_" in plan


def test_scans_read_only_what_a_build_needs(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(50).select(F.col("id").cast("string").alias("k"), *[F.lit(i).alias(f"c{i}") for i in range(20)]).write.parquet(path)
    built = build_entities({"t": spark.read.parquet(path)}, [Mapping("E", "t", "k", properties={"a": "c3"})], "demo")
    plan = _plan(built.entities["E"])
    assert "ReadSchema: struct<k:string,c3:int>" in plan
    assert "ReadSchema: struct<k:string>" in _plan(built.identifiers)


def test_a_fold_of_two_mappings_shuffles_each_side_once(spark):
    one = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("v"))
    two = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("y").alias("w"))
    mappings = [Mapping("E", "one", "k", properties={"v": "v"}), Mapping("E", "two", "k", properties={"w": "w"})]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(build_entities({"one": one, "two": two}, mappings, "demo").entities["E"])
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
