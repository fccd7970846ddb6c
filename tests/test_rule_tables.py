"""Rules as tables against the compiled form, and published versions with readers in between."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from tablemint.operators import rule_tables
from tablemint.operators.rule_tables import (
    classify_by, classify_joined, compiled_rules, expected_from, matching_prefixes, prefix_classes, roles_from, unknown_bases,
)
from tablemint.operators.rules import SignatureRule, assign_role, classify, prefix_class
from tablemint.sinks import clean_up, current_version, new_version, publish_version, versions, write_bundle
from tablemint.sinks.tables import _file_system
from tablemint.sinks.versions import POINTERS, _put

RULES = "rule_no int, basis string, value string, document_type string, description string, structure string, expected_per_day int"


def rules_of(spark, rng, n):
    words = ["ab", "abc", "b", "c d", "", "<x", "é"]
    bases = ["heading", "xml_root", "header_prefix", "text_pattern"]
    return spark.createDataFrame(
        [(2 * i, rng.choice(bases), rng.choice(words) + rng.choice(["", "a", "1"]), f"t{i % 9}", None if i % 4 else "d", "s", i % 3 or None) for i in range(n)],
        RULES,
    )


def signatures_of(spark, rng, n):
    words = ["ab", "abc", "b1", "c d", "", "x", "é", "éa", None]
    rows = []
    for i in range(n):
        lead = rng.choice(words[:-1])
        headings = None if i % 5 == 0 else [rng.choice(words) for _ in range(rng.randrange(4))]
        rows.append((i, None if i == 3 else f"f{i}", lead + "abc", rng.choice(words), headings, lead + rng.choice(["", "1 ab", "c d"])))
    return spark.createDataFrame(rows, "id int, name string, first_line string, xml_root string, headings array<string>, head string")


@pytest.mark.parametrize("n, block", [(1, 10), (40, 3), (40, 100)])
def test_joined_rules_match_the_compiled_form(spark, rows, n, block):
    rng = random.Random(n + block)
    rules, signatures = rules_of(spark, rng, n), signatures_of(spark, rng, 200)
    want = rows(classify(signatures, compiled_rules(rules)))
    assert rows(classify_joined(signatures, rules, ["id", "name"], block)) == want
    assert rows(classify_by(signatures, rules, ["id", "name"])) == want
    assert rows(classify_by(signatures, rules, ["id", "name"], limit=n - 1)) == want
    assert compiled_rules(rules, n - 1) is None


def test_compiled_rules_shuffle_nothing_and_hot_values_do_not_multiply(spark):
    rng = random.Random(1)
    signatures = signatures_of(spark, rng, 50).withColumn("xml_root", F.lit("hot"))
    rules = spark.createDataFrame([(i, "xml_root", "hot", f"t{i}", None, "s", None) for i in range(100)], RULES)
    plan = classify_by(signatures, rules, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    joined = classify_joined(signatures, rules, ["id"])
    assert joined.count() == 50 and {r["document_type"] for r in joined.collect()} == {"t0"}


def test_patterns_stay_in_spark_and_no_plan_grows_with_them(spark, rows):
    signatures = signatures_of(spark, random.Random(2), 30)
    table = [(1, "zzz9"), (1, "^ab"), (7, "^ab"), (9, None)] + [(10 + i, f"never{i}") for i in range(40)]
    rules = spark.createDataFrame([(n, "text_pattern", v, f"t{n}", None, "s", None) for n, v in table], RULES)
    joined = classify_joined(signatures, rules, ["id"], block=1)
    assert "never" not in joined._jdf.queryExecution().optimizedPlan().toString()
    want = sorted((r["id"], "t1" if r["head"].startswith("ab") else "unknown") for r in signatures.collect())
    assert sorted(rows(joined, "id", "document_type")) == want and {d for _, d in want} == {"t1", "unknown"}


def test_rules_without_a_known_basis(spark, rows):
    rules = spark.createDataFrame([(1, "header", "x", "t", None, None, None), (2, None, "x", "t", None, None, None), (3, "heading", "x", "t", None, None, None)], RULES)
    assert rows(unknown_bases(rules), "rule_no") == [(1,), (2,)]
    with pytest.raises(ValueError, match="unknown basis"):
        classify(signatures_of(spark, random.Random(1), 3), [SignatureRule("header", "x", "t", "", "")])


def test_expected_counts_from_the_table(spark, rows):
    rules = spark.createDataFrame([(2, "heading", "a", "t", None, None, 3), (1, "heading", "b", "t", None, None, 2), (3, "heading", "c", "u", None, None, None)], RULES)
    classified = spark.createDataFrame([("d1", "t"), ("d1", "t"), ("d2", "t"), ("d2", "u")], "day string, document_type string")
    assert rows(expected_from(classified, rules, "day")) == [("d2", "t", 1, 2)]


def test_prefixes_first_and_longest(spark, rows):
    table = [(3, "image/", "still"), (1, "image/sv", "vector"), (2, "IMAGE/SVG", "svg"), (4, "image/", "late"), (5, "", "any")]
    rules = spark.createDataFrame(table, "rule_no int, prefix string, class string")
    values = [("a", "image/svg+xml"), ("b", "IMAGE/png"), ("c", "text/plain"), ("d", None), ("a", "image/svg+xml")]
    df = spark.createDataFrame(values, "k string, v string")
    in_order = [(p.lower(), c) for _, p, c in sorted(table)]
    want = sorted((tuple(r) for r in df.select("k", "v", prefix_class("v", in_order)).collect()), key=repr)
    assert rows(prefix_classes(df, "v", ["k"], rules, "c")) == want
    longest = {r["k"]: r["c"] for r in prefix_classes(df, "v", ["k"], rules, "c", longest=True).collect()}
    assert longest == {"a": "svg", "b": "still", "c": "any", "d": "any"}
    one = spark.createDataFrame([("im", 1)], "value string, _rule int")
    assert rows(matching_prefixes(df, "v", ["k"], one), "k", "value") == [("a", "im"), ("a", "im")]


@pytest.mark.parametrize("limit", [1, 2, 50])
def test_roles_from_a_table(spark, rows, limit):
    table = [(5, "late", "a"), (1, "lead", "^A"), (2, "rest", None), (3, "digits", "[0-9]{3}"), (4, "other", ""), (9, "b", "b$")]
    roles = spark.createDataFrame(table, "role_no int, role string, pattern string")
    names = spark.createDataFrame([("axe",), ("Tab",), ("x123",), ("zzz",), (None,), ("b",)], "name string")
    in_order = [(r, p) for _, r, p in sorted(table)]
    want = sorted((tuple(r) for r in names.select("name", assign_role("name", in_order)).collect()), key=repr)
    assert rows(roles_from(names, "name", roles, limit=limit)) == want
    assert rule_tables.COMPILED > 0


# --- published versions ---------------------------------------------------------------


def write(spark, out, label):
    folder = new_version(out)
    spark.createDataFrame([(label,)] * 3, "label string").write.parquet(folder)
    return folder


def read(spark, out):
    found = spark.read.parquet(current_version(spark, out)).collect()
    assert len(found) == 3 and len({r["label"] for r in found}) == 1
    return found[0]["label"]


def test_a_reader_between_any_two_steps_sees_one_whole_version(spark, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        current_version(spark, out)
    one = write(spark, out, "one")
    with pytest.raises(FileNotFoundError):
        current_version(spark, out)
    publish_version(spark, out, one)
    assert read(spark, out) == "one"
    two = write(spark, out, "two")
    assert read(spark, out) == "one"
    name = two.rsplit("/", 1)[1]
    for part in ("", name[:5], name, f"{name}\n", f"{name}\nen"):  # a pointer that is still being written
        _put(spark, f"{out}/{POINTERS}/000000000002-{len(part)}", part)
        assert read(spark, out) == "one"
    assert publish_version(spark, out, two).number == 3
    assert read(spark, out) == "two"


def test_concurrent_writers(spark, tmp_path):
    out = str(tmp_path / "out")
    publish_version(spark, out, write(spark, out, "start"))
    seen, stop = [], threading.Event()

    def reader():
        while not stop.is_set():
            seen.append(read(spark, out))

    def writer(label):
        for i in range(3):
            publish_version(spark, out, write(spark, out, f"{label}{i}"))

    watching = threading.Thread(target=reader)
    writers = [threading.Thread(target=writer, args=(label,)) for label in "ab"]
    watching.start()
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    stop.set()
    watching.join()
    assert len(versions(spark, out)) == 7 and set(seen) <= {"start", *[f"{c}{i}" for c in "ab" for i in range(3)]}
    assert read(spark, out) in ("a2", "b2")


def test_clean_up_keeps_the_newest_and_work_in_progress(spark, tmp_path):
    out = str(tmp_path / "out")
    folders = []
    for label in "abcd":
        folders.append(write(spark, out, label))
        publish_version(spark, out, folders[-1])
    pending = write(spark, out, "pending")
    assert clean_up(spark, out, keep=2) == sorted(folders[:2])
    assert [v.folder for v in versions(spark, out)] == [folders[3], folders[2]]
    assert read(spark, out) == "d"
    publish_version(spark, out, pending)
    assert read(spark, out) == "pending"
    crashed = write(spark, out, "crashed")
    files, location, _ = _file_system(spark, crashed)
    age = files.getFileStatus(location).getModificationTime()
    assert clean_up(spark, out, 9, unpublished_after_ms=1_000, now_ms=age + 999) == []
    assert clean_up(spark, out, 9, unpublished_after_ms=1_000, now_ms=age + 1_000) == [crashed]
    publish_version(spark, out, folders[3])  # an earlier version made current again
    assert read(spark, out) == "d"
    clean_up(spark, out, keep=1)
    assert read(spark, out) == "d"
    with pytest.raises(ValueError):
        clean_up(spark, out, keep=0)


def test_a_versioned_bundle(spark, tmp_path):
    from tablemint.plans.build import build_entities
    from tablemint.plans.mapping import Mapping

    out = str(tmp_path / "bundle")
    mapping = [Mapping("Person", "p", "id", properties={"name": "name"})]
    for names in (["Ann", "Bo"], ["Cy"]):
        table = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
        write_bundle(build_entities({"p": table}, mapping, "demo"), {}, out, "v3", versioned=True)
        folder = current_version(spark, out)
        assert {r["name"] for r in spark.read.json(f"{folder}/entities").collect()} == set(names)
    assert len(versions(spark, out)) == 2
