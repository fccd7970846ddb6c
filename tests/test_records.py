"""Nested records, page chains and fingerprints against plain Python."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from tablemint.operators import fingerprints
from tablemint.operators import chains as chains_module
from tablemint.operators.chains import chain_positions, chain_problems, in_chain_order
from tablemint.operators.eav import field_inventory, frequent_names, inventory_sketches, merged_inventory, open_columns
from tablemint.operators.fingerprints import added, differing_buckets, fingerprint, level_differences, row_bucket
from tablemint.operators.nested import PathRule, canonical_text, path_steps, validate_records
from tablemint.operators.order import ORDER, dense_order, first_match, last_wins
from tablemint.operators.reconcile import golden_diff, run_difference
from tablemint.session import stage
from tablemint.sources.csv import csv_rows

# --- canonical form -------------------------------------------------------------------


def dropped(value, path):
    """A parsed value without what stands at a path, by walking it."""
    step, rest = path[0], path[1:]
    if step == "[]":
        if not isinstance(value, list):
            return value
        return [dropped(v, rest) for v in value] if rest else []
    if not isinstance(value, dict):
        return value
    names = list(value) if step == "*" else [step] if step in value else []
    out = dict(value)
    for name in names:
        if rest:
            out[name] = dropped(out[name], rest)
        else:
            del out[name]
    return out


def made(rng, depth=0):
    kind = rng.randrange(7 if depth < 4 else 4)
    if kind < 4:
        return [rng.randrange(9), rng.choice(["a", 'q"\\', "é\n", ""]), None, True][kind]
    if kind == 4:
        return [made(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["a", "b", "c.d", 'k"', "é", "z"]): made(rng, depth + 1) for _ in range(rng.randrange(5))}


def shuffled(rng, value):
    if isinstance(value, dict):
        names = rng.sample(list(value), len(value))
        return {n: shuffled(rng, value[n]) for n in names}
    return [shuffled(rng, v) for v in value] if isinstance(value, list) else value


PATHS = [("a",), ("a", "b"), ("a", "[]"), ("b", "[]", "a"), ("*", "a"), ("*", "*"), ("c.d", "*", "b"), ("a", "[]", "[]", "b"), ('k"', "é")]


@pytest.mark.parametrize("drop", [[], PATHS[:1], PATHS[1:5], PATHS[4:6], PATHS[6:], PATHS])
def test_canonical_text_matches_a_walk(spark, drop):
    rng = random.Random(len(drop))
    values = [{"v": made(rng), "a": made(rng), "b": [made(rng)]} for _ in range(120)]
    rows = [(i, json.dumps(v, ensure_ascii=False), json.dumps(shuffled(rng, v))) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, one string, two string")
    text = lambda c: canonical_text(F.parse_json(c), drop)
    for r in df.select("i", text("one").alias("one"), text("two").alias("two")).collect():
        want = values[r["i"]]
        # A longer path is applied first, so that what a shorter one drops is gone in the end.
        for path in sorted(drop, key=len, reverse=True):
            want = dropped(want, path)
        assert r["one"] == r["two"]
        got = json.loads(r["one"], object_pairs_hook=lambda pairs: pairs)
        assert json.loads(r["one"]) == want

        def names_sorted(value):
            if isinstance(value, list) and value and isinstance(value[0], tuple):
                assert [n for n, _ in value] == sorted((n for n, _ in value), key=str.encode)
                return all(names_sorted(v) for _, v in value)
            return all(names_sorted(v) for v in value) if isinstance(value, list) else True

        assert names_sorted(got)


def test_paths_are_read():
    assert path_steps("a.b[].c") == ("a", "b", "[]", "c")
    assert path_steps("a[][].*") == ("a", "[]", "[]", "*")
    assert path_steps(("a.b", "[]")) == ("a.b", "[]")
    for wrong in ("", "a..b", ".a", "a[0]", "a]["):
        with pytest.raises(ValueError):
            path_steps(wrong)


def test_golden_diff_of_nested_columns(spark, rows):
    schema = "k int, a struct<b:struct<c:string,d:decimal(9,2)>>, m map<string,map<string,string>>, l array<struct<x:string,y:int>>, day date"
    make = lambda *r: spark.createDataFrame(list(r), schema)
    day = __import__("datetime").date(2026, 1, 1)
    base = (1, (("c", None),), {"x": {"p": "1", "q": "2"}, "y": {}}, [("1", 1), ("2", None)], day)
    one = make(base, (2, None, None, None, None), (3, (("c", None),), {}, [], None), (5, (("c", None),), {"x": {"p": "1"}}, [("1", 1)], None))
    two = make(
        (1, (("other", None),), {"y": {}, "x": {"q": "2", "p": "9"}}, [("1", 7), ("2", 8)], None),
        (2, None, None, None, None),
        (4, None, None, None, None),
        (5, (("c", None),), {"x": {"p": "2"}}, [("1", 1)], None),
    )
    paths = ["day", "a.b.c", "l[].y", ("m", "x", "p")]
    assert rows(golden_diff(one, two, ["k"], tuple(paths))) == [(3, "missing"), (4, "extra")]
    assert rows(golden_diff(one, two, ["k"], tuple(paths[:-1]))) == [(1, "differing"), (3, "missing"), (4, "extra"), (5, "differing")]
    assert rows(golden_diff(one, one, ["k"])) == []


# --- rules on records -----------------------------------------------------------------


def test_rules_at_paths(spark, rows):
    good = {"name": "n", "notes": [{"text": "t", "at": 1}], "edges": {"has": {"Part": [{"id": "7"}]}}, "size": 1.5}
    bad = {
        "name": "", "notes": [{"text": None}, {"at": "x", "more": 1}, 5], "size": "big", "open": [],
        "edges": {"has": {"Part": [{"id": "p"}, {}], "Tool": {"id": "1"}}, "for": 3},
    }
    records = [("T", "1", json.dumps(good)), ("T", "2", json.dumps(bad)), ("T", "3", "{"), ("T", "4", None), ("U", "5", "{}"), ("T", "6", "[]")]
    df = spark.createDataFrame(records, "kind string, id string, body string")
    rules = {
        "T": [
            PathRule("name", required=True, allowed=("n", "m")),
            PathRule("", only=("name", "notes", "edges", "size", "open")),
            PathRule("notes", kind="array"),
            PathRule("notes[].text", required=True, kind="string"),
            PathRule("notes[]", only=("text", "at")),
            PathRule("size", kind="number"),
            PathRule("open", least=1),
            PathRule("edges.*.*", kind="array"),
            PathRule("edges.*.*[].id", required=True, pattern="^[0-9]+$"),
        ]
    }
    assert rows(validate_records(df, rules, "kind", "id", "body")) == sorted(
        [
            ("T", "2", "/name", "a value is required"),
            ("T", "2", "/name", "not among the allowed values"),
            ("T", "2", "/notes/0/text", "a value is required"),
            ("T", "2", "/notes/1/text", "a value is required"),
            ("T", "2", "/notes/1/more", "not expected here"),
            ("T", "2", "/size", "number expected, string found"),
            ("T", "2", "/open", "at least 1 expected"),
            ("T", "2", "/edges/has/Tool", "array expected, object found"),
            ("T", "2", "/edges/has/Part/0/id", "not in the expected form"),
            ("T", "2", "/edges/has/Part/1/id", "a value is required"),
            ("T", "3", "", "not readable as JSON"),
            ("T", "4", "", "not readable as JSON"),
        ],
        key=repr,
    )
    parsed = df.select("kind", "id", F.try_parse_json("body").alias("body"))
    assert rows(validate_records(parsed, rules, "kind", "id", "body")) == rows(validate_records(df, rules, "kind", "id", "body"))
    plan = validate_records(df, rules, "kind", "id", "body")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    with pytest.raises(ValueError):
        PathRule("a", kind="list")


# --- chains ---------------------------------------------------------------------------


def walked(pages):
    """Positions and problems of every endpoint, by following one page after another."""
    positions, problems = {}, set()
    by = {}
    for endpoint, cursor, following, rows, more in pages:
        by.setdefault(endpoint, {}).setdefault(cursor, []).append((following, rows, more))
    for endpoint, answers in by.items():
        follow = {}
        for cursor, found in answers.items():
            nexts = {f for f, _, _ in found}
            named = sorted(n for n in nexts if n is not None)
            follow[cursor] = named[0] if named else None
            if len(nexts) > 1:
                problems.add((endpoint, "differingAnswers", cursor))
        met, at = {}, None
        if None not in answers:
            problems.add((endpoint, "noFirstPage", None))
        else:
            while True:
                met[at] = len(met)
                following = follow[at]
                if following is None:
                    break
                if following in met:
                    problems.add((endpoint, "loop", following))
                    break
                if following not in answers:
                    problems.add((endpoint, "missingPage", following))
                    break
                at = following
        for cursor in answers:
            if cursor in met:
                positions[endpoint, cursor] = met[cursor]
                if any(f is None and more and rows > 0 for f, rows, more in answers[cursor]):
                    problems.add((endpoint, "unfinished", cursor))
            else:
                problems.add((endpoint, "unreached", cursor))
        for target in {f for f in follow.values() if f is not None}:
            naming = [c for c, f in follow.items() if f == target]
            if len(naming) > 1 and any(c not in met for c in naming):
                problems.add((endpoint, "repeatedCursor", target))
    return positions, problems


def chains(rng):
    pages = []
    for e in range(40):
        length = rng.choice([1, 2, 3, 17, 64, 65, 130])
        cursors = [None] + [f"c{i}" for i in range(1, length)]
        for i, cursor in enumerate(cursors):
            following = cursors[i + 1] if i + 1 < length else None
            pages.append([f"e{e}", cursor, following, rng.randrange(3), rng.random() < 0.5])
        own = [p for p in pages if p[0] == f"e{e}"]
        fault = e % 8
        if fault == 1:
            own[-1][2] = rng.choice(cursors[1:] or ["c1"])
        elif fault == 2:
            pages.remove(rng.choice(own))
        elif fault == 3:
            pages.append([f"e{e}", own[-1][1], "c1", 1, True])
        elif fault == 4:
            pages.append([f"e{e}", "side", rng.choice(cursors[1:] or [None]), 1, True])
        elif fault == 5:
            pages.remove(own[0])
        elif fault == 6:
            pages += [[f"e{e}", "x", "y", 1, True], [f"e{e}", "y", "x", 1, True], list(own[0])]
        elif fault == 7:
            pages.append([f"e{e}", "", None, 1, True])
    rng.shuffle(pages)
    return [tuple(p) for p in pages]


def test_chains_match_a_walk(spark):
    pages = chains(random.Random(7))
    df = spark.createDataFrame(pages, "endpoint string, cursor string, next string, rows long, has_more boolean")
    positions, problems = walked(pages)
    got = {(r["endpoint"], r["id"][1:] if r["id"] else None): r["position"] for r in chain_positions(df).collect()}
    assert got == positions
    found = [tuple(r) for r in chain_problems(df).collect()]
    assert len(found) == len(set(found)) and set(found) == problems
    assert {p for _, p, _ in problems} == {
        "noFirstPage", "differingAnswers", "loop", "missingPage", "repeatedCursor", "unreached", "unfinished"
    }
    ordered = in_chain_order(df)
    assert ordered.count() == len(pages)
    for r in ordered.collect():
        assert r["chain_position"] == positions.get((r["endpoint"], r["cursor"]))


def test_long_chains_are_shortened_before_they_are_doubled(spark, monkeypatch):
    monkeypatch.setattr(chains_module, "DOUBLED_STEPS", 1000)
    staged = []

    def counted(df, name):
        held = stage(df, name)
        staged.append((name, held.count()))
        return held

    monkeypatch.setattr(chains_module, "stage", counted)
    pages = chains(random.Random(11))
    df = spark.createDataFrame(pages, "endpoint string, cursor string, next string, rows long, has_more boolean")
    positions, _ = walked(pages)
    got = {(r["endpoint"], r["id"][1:] if r["id"] else None): r["position"] for r in chain_positions(df).collect()}
    assert got == positions
    # Every round leaves fewer steps, and only few are doubled; doubling alone held all of them in every round.
    steps, jumps = ([n for name, n in staged if name == wanted] for wanted in ("page-steps", "page-jumps"))
    assert len(steps) > 2 and all(b < 0.9 * a for a, b in itertools.pairwise(steps))
    assert steps[-1] <= 1000 < steps[0] and all(n <= steps[-1] for n in jumps)


def test_no_pages(spark):
    df = spark.createDataFrame([], "endpoint string, cursor string, next string, rows long, has_more boolean")
    assert chain_problems(df).collect() == [] and in_chain_order(df).collect() == []


# --- fingerprints ---------------------------------------------------------------------


def table_of(spark, rows):
    return spark.createDataFrame(rows, "a int, b string, c double")


def test_fingerprints_tell_runs_apart(spark, rows):
    rng = random.Random(3)
    base = [(rng.choice([None, *range(50)]), rng.choice([None, "", "x", "y" * 9]), rng.random()) for _ in range(3_000)]
    one = table_of(spark, base)
    print_of = lambda r: fingerprint(table_of(spark, r), 64)
    same = table_of(spark, rng.sample(base, len(base))).repartition(7).select("c", "a", "b")
    assert differing_buckets(fingerprint(one, 64), fingerprint(same, 64)).count() == 0
    assert rows(added(print_of(base[:1_000]), print_of(base[1_000:]))) == rows(fingerprint(one, 64))

    a, b, c = base[5]
    for other in [base[1:], base + base[7:8], base[:5] + [("" if a is None else None, b, c)][:0] + [(a, "new", c)] + base[6:]]:
        two = table_of(spark, other)
        prints = (fingerprint(one, 64), fingerprint(two, 64))
        assert rows(run_difference(one, two, prints, 64)) == rows(run_difference(one, two)) != []
        touched = {r[0] for r in run_difference(one, two).select(row_bucket(["a", "b", "c"], 64)).collect()}
        assert {r[0] for r in differing_buckets(*prints).collect()} == touched
        levels = dict(rows(level_differences(*prints, group=8)))
        assert levels["run"] == 1 and levels["bucket"] == len(touched)
        assert levels["group"] == len({t // 8 for t in touched})


def test_nulls_and_empty_texts_differ(spark):
    values = [(1, None, 2.0), (1, "", 2.0), (None, "1", 2.0), (None, None, None), (1, None, None)]
    prints = [sorted(map(tuple, fingerprint(table_of(spark, [v]), 8).collect())) for v in values]
    assert all(a != b for a, b in itertools.combinations(prints, 2))


def test_equal_buckets_are_not_shuffled(spark):
    one = table_of(spark, [(i, "x", 1.0) for i in range(5_000)])
    two = table_of(spark, [(i, "x" if i != 77 else "y", 1.0) for i in range(5_000)])
    prints = (fingerprint(one), fingerprint(two))
    difference = run_difference(one, two, prints)
    plan = difference._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert difference.count() == 2
    wanted = differing_buckets(*prints)
    read = [fingerprints.rows_of_buckets(df, wanted).count() for df in (one, two)]
    assert max(read) < 20
    assert run_difference(one, one, (prints[0], prints[0])).count() == 0


def test_empty_runs(spark):
    none = table_of(spark, [])
    some = table_of(spark, [(1, "x", 1.0)])
    assert fingerprint(none).count() == 0
    assert run_difference(none, some, (fingerprint(none), fingerprint(some))).count() == 1


# --- names, sketches and orders found in the data -------------------------------------


def test_frequent_names_are_exact(spark, rows):
    rng = random.Random(9)
    names = ["a"] * 400 + ["b"] * 101 + ["c"] * 99 + [None, ""] * 20 + [f"tail {i}" for i in range(360)]
    rng.shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(6)
    assert rows(frequent_names(df, 0.1)) == [("a", 400), ("b", 101)]
    assert rows(frequent_names(df, 0.001)) == sorted([(n, names.count(n)) for n in set(names) if n], key=repr)
    assert rows(frequent_names(df.limit(0), 0.1)) == []
    with pytest.raises(ValueError):
        frequent_names(df, 0.0)


def test_open_columns_keep_the_tail_in_a_map(spark):
    kind = "array<struct<name:string,value:string>>"
    records = [(i, [("Often", f"o{i}"), ("often", "other case"), ("id", "shadow"), (f"tail {i}", "t")][: 4 if i % 4 else 2]) for i in range(40)]
    records += [(40, None), (41, []), (42, [("Often", "first"), ("Often", "last")])]
    df = spark.createDataFrame(records, f"id int, metadata {kind}")
    wide, names = open_columns(df, "metadata", 0.5, structural=["kept"])
    assert names == ["Often"]
    got = {r["id"]: (r["Often"], r["metadata_rest"]) for r in wide.collect()}
    assert got[1] == ("o1", {"often": "other case", "id": "shadow", "tail 1": "t"})
    assert got[40] == (None, None) and got[41] == (None, {}) and got[42] == ("last", {})
    assert open_columns(df.limit(0), "metadata", 0.5)[1] == []


def test_sketches_of_days_add_up(spark):
    rows = [(i % 5, f"f{i % 3}", str(i % (37 * (1 + i % 3))), i % 7 == 0) for i in range(20_000)] + [(0, "f0", "", True), (0, None, "x", True)]
    long = spark.createDataFrame(rows, "day int, name string, value string, mutable boolean")
    exact = {r["name"]: r for r in field_inventory(long).collect()}
    days = merged_inventory(inventory_sketches(long, ["day"]))
    for found in (days.collect(), field_inventory(long, approximate=True).collect()):
        assert {r["name"] for r in found} == set(exact)
        for r in found:
            assert r["populated"] == exact[r["name"]]["populated"] and r["origin"] == exact[r["name"]]["origin"]
            assert abs(r["distinct_values"] - exact[r["name"]]["distinct_values"]) <= 0.03 * exact[r["name"]]["distinct_values"]
    many = spark.range(200_000).select(F.lit("f").alias("name"), F.col("id").cast("string").alias("value"), F.lit(False).alias("mutable"))
    assert abs(field_inventory(many, approximate=True).first()["distinct_values"] - 200_000) < 6_000


def test_dense_order_numbers_rows_of_files(spark, tmp_path, rows):
    for name, lines in (("b", range(100)), ("a", range(100, 250)), ("c", [])):
        (tmp_path / f"{name}.csv").write_text("n,k\n" + "".join(f"{i},{i % 9}\n" for i in lines))
    read = csv_rows(spark, f"{tmp_path}/*.csv", multiline=False)
    dense = dense_order(read)
    got = [int(r["n"]) for r in dense.orderBy(ORDER).collect()]
    assert got == [*range(100, 250), *range(100)]
    assert rows(dense, ORDER) == sorted([(i,) for i in range(250)], key=repr)
    for pick in (first_match, last_wins):
        assert rows(pick(dense, ["k"]), "k", "n") == rows(pick(read, ["k"]), "k", "n")
    thinned = dense_order(read.filter("n % 3 = 0"))
    assert [int(r["n"]) for r in thinned.orderBy(ORDER).collect()] == [i for i in got if i % 3 == 0]
    assert rows(dense_order(read.limit(0))) == []


def test_members_are_taken_out_of_a_record_once(spark):
    """Each copy of an object's members costs as much as the object, so rules share one."""
    rules = {"T": [PathRule("a[].b", required=True, kind="string", allowed=("x",), pattern="x"), PathRule("c.d.e", required=True, kind="number")]}
    df = spark.createDataFrame([("T", "1", "{}")], "kind string, id string, body string")
    plan = validate_records(df, rules, "kind", "id", "body")._jdf.queryExecution().optimizedPlan().toString()
    assert "map<string,variant>" not in plan


def test_paths_are_left_out_before_records_are_made(spark, rows):
    schema = "k int, a struct<b:int,c:struct<d:string>>, m map<string,struct<p:int,q:int>>, l array<map<string,int>>"
    one = spark.createDataFrame([(1, (1, ("x",)), {"u": (1, 2), "v": None}, [{"p": 1, "q": 2}, None]), (2, None, None, None)], schema)
    two = spark.createDataFrame([(1, (1, ("y",)), {"v": None, "u": (7, 2)}, [{"q": 2, "p": 5}, None]), (2, None, None, None)], schema)
    paths = ("a.c.d", "m.*.p", "l[].p")
    assert rows(golden_diff(one, two, ["k"], paths)) == []
    assert "variant>" not in golden_diff(one, two, ["k"], paths)._jdf.queryExecution().optimizedPlan().toString()
    for left in range(3):
        assert rows(golden_diff(one, two, ["k"], paths[:left] + paths[left + 1 :])) == [(1, "differing")]
    # What a path empties stays as an empty object, and differs from an absent one.
    none = two.withColumn("a", F.expr("named_struct('b', a.b, 'c', cast(null as struct<d:string>))"))
    assert rows(golden_diff(one, none, ["k"], paths)) == [(1, "differing"), (2, "differing")]
