"""Metadata, threads, trees, lines, edges and upgrades on small fixtures."""

import random

from pyspark.sql import functions as F

from tablemint.operators.eav import field_inventory, metadata_columns, pairs_to_map, shadowed_notes
from tablemint.operators.edges import explode_edges, malformed_notes
from tablemint.operators.lines import page_lines, report_header
from tablemint.operators.threads import (
    author_notes, child_shortfall, fill_author, flatten_threads, shortfall_notes, textless_notes,
)
from tablemint.operators.tree import folder_paths, walk_tree
from tablemint.operators.upgrade import (
    append_source_identifier, domain_notes, identifier_notes, missing_source_identifier, name_domains, out_of_project,
    scope_notes, scope_to_project, upgrade_context,
)
from tablemint.session import cut_lineage, scratch_path, shared_dir, stage

PAIRS = "id string, metadata array<struct<name:string,mutable:boolean,value:string>>"


def test_metadata_names_are_verbatim_and_the_last_one_wins(spark):
    df = spark.createDataFrame(
        [("f", [("Scene", True, "1"), ("Scene", True, "2"), (None, True, "x"), ("", True, "y"), ("VFX Reqiured", True, "no")]), ("g", []), ("h", None)],
        PAIRS,
    )
    got = {r.id: (r.Scene, r.metadata_rest) for r in metadata_columns(df, "metadata", ["Scene", "Take"]).collect()}
    assert got == {"f": ("2", {"VFX Reqiured": "no"}), "g": (None, {}), "h": (None, None)}


def test_shadowing_names_are_noted(spark, rows):
    df = spark.createDataFrame([("f", [("fileId", True, "x")]), ("g", [("fileId", True, "y"), ("a", True, "b")])], PAIRS)
    notes = shadowed_notes(df.withColumn("m", pairs_to_map("metadata")), "m", ["fileId"])
    assert [(r.kind, r.where, r.detail[:9]) for r in notes.collect()] == [("metadataNameCollision", "fileId", "2 file(s)")]


def test_field_inventory_does_not_depend_on_hot_fields(spark, rows):
    long = spark.range(500).select(
        F.when(F.col("id") < 400, "hot").otherwise("cold").alias("name"), (F.col("id") % 7).cast("string").alias("value"),
        (F.col("id") == 450).alias("mutable"),
    )
    assert rows(field_inventory(long)) == [("cold", 100, 7, "entered", "0", "1", "2"), ("hot", 400, 7, "derived", "0", "1", "2")]


THREAD = (
    "file_id string, id string, text string, owner struct<name:string,email:string>, timestamp bigint, created_at string, "
    "updated_at string, replies array<struct<id:string,text:string,owner:struct<name:string,email:string>,timestamp:bigint,"
    "created_at:string,updated_at:string>>"
)


def test_threads_and_their_counts(spark, rows):
    threads = spark.createDataFrame(
        [
            ("f", "c1", "first", ("Ann", "a@x"), 12, "t", None, [("r1", "reply", None, None, "t", None)]),
            ("f", "c2", None, None, None, "t", None, None),
        ],
        THREAD,
    )
    flat = flatten_threads(threads)
    assert rows(flat, "file_id", "comment_id", "author", "frame", "reply_to") == [
        ("f", "c1", "Ann", 12, None), ("f", "c2", None, None, None), ("f", "r1", None, None, "c1"),
    ]
    assert rows(textless_notes(flat, "comments"), "kind", "detail") == [("commentWithoutText", "1 comment(s) carry no text")]
    files = spark.createDataFrame([("f", "3"), ("g", "1"), ("h", "0"), ("i", None)], "file_id string, c string")
    short = child_shortfall(files, threads, "c")
    assert rows(short) == [("g", 1, 0, 0)]
    assert [r.kind for r in shortfall_notes(short).collect()] == ["commentCountShort"]
    filled = fill_author(flat, spark.createDataFrame([("r9", "Bob")], "comment_id string, author string"))
    assert rows(author_notes(filled), "where") == [("r1",)]
    known = fill_author(flat, spark.createDataFrame([("r1", "Bob"), ("c1", "Other")], "comment_id string, author string"))
    assert rows(known, "comment_id", "author") == [("c1", "Ann"), ("c2", None), ("r1", "Bob")]


def _walk_by_hand(nodes, root, max_depth):
    """The walk as the words say it: breadth-first from the root."""
    children, found, deep = {}, {}, {}
    for i, parent, name in nodes:
        children.setdefault(parent, []).append((i, name))
    queue = [(root, "/", 0)]
    while queue:
        at, path, depth = queue.pop(0)
        found[at] = (path, depth)
        for i, name in children.get(at, []):
            below = f"{path}{name}/"
            if depth + 1 > max_depth:
                deep[i] = below
            else:
                queue.append((i, below, depth + 1))
    return found, deep


def test_folder_paths_agree_with_a_walk(spark):
    rng = random.Random(7)
    # A deep chain, a wide hot folder, random folders, a cycle and an orphan.
    nodes = [(f"d{i}", "root" if i == 0 else f"d{i - 1}", f"n{i}") for i in range(40)]
    nodes += [(f"w{i}", "d2", f"w{i}") for i in range(60)]
    nodes += [(f"r{i}", rng.choice(["root", *[f"r{j}" for j in range(i)]]), f"r{i}") for i in range(60)]
    nodes += [("x1", "x2", "x1"), ("x2", "x1", "x2"), ("o1", "gone", "o1"), ("o2", "o1", "o2")]
    folders = spark.createDataFrame(nodes, "id string, parent_id string, name string")
    roots = spark.createDataFrame([("root",)], "id string")
    for depth in (1, 3, 25):
        found, deep = _walk_by_hand(nodes, "root", depth)
        got = {r.id: (r.path, r.depth) for r in folder_paths(folders, roots, depth).collect()}
        expected = {**found, **{i: (p, depth + 1) for i, p in deep.items()}}
        assert got == expected


def test_walk_reports_what_it_does_not_follow(spark, rows):
    nodes = spark.createDataFrame(
        [
            ("root", "f1", "file", "slate_01.mov", 0, None), ("root", "day", "folder", "Day 01", 1, None),
            ("day", "f2", "file", "notes.xyzzy", 0, None), ("root", "s1", "version_stack", "cut", 2, None),
            ("s1", "v2", "file", "cut_v2.mov", 0, None), ("s1", "v1", "file", "cut_v1.mov", 1, None),
            ("root", "s2", "version_stack", "empty", 3, None), ("root", "q", "board", "plan", 4, None),
            ("day", "deep", "folder", "deep", 1, None), ("deep", "f3", "file", "lost.mov", 0, None),
        ],
        "parent_id string, id string, type string, name string, position int, head_version string",
    )
    walk = walk_tree(nodes, spark.createDataFrame([("root",)], "id string"), max_depth=1)
    assert rows(walk.files, "id", "path", "stack_id") == [
        ("f1", "/slate_01.mov", None), ("f2", "/Day 01/notes.xyzzy", None), ("v2", "/cut_v2.mov", "s1"),
    ]
    assert rows(walk.notes(), "kind", "where") == [
        ("emptyVersionStack", "/empty"), ("tooDeep", "/Day 01/deep/"), ("unknownChildType", "/plan"),
    ]


def test_lines_and_header(spark, rows):
    runs = spark.createDataFrame(
        [
            ("d", 1, 50.0, 700.2, "LOG"), ("d", 1, 10.0, 699.8, "DAILY   EDITOR'S"), ("d", 1, 10.0, 712.0, "Printed 1/23/26"),
            ("d", 1, 5.0, 690.0, "  "), ("d", 1, 10.0, 680.0, "Day: Day 3 - Main Unit"), ("d", 1, 10.0, 670.0, "Date: 1/22/26"),
            ("d", 1, 1.0, 100.0, "a"), ("d", 1, 1.0, 90.0, "b"), ("d", 1, 1.0, 80.0, "Day: Day 9 - late"), ("d", 2, 1.0, 900.0, "page two"),
        ],
        "doc string, page int, x double, y double, text string",
    )
    lines = page_lines(runs)
    assert rows(lines.filter("page = 1 and y = 700"), "line") == [("DAILY EDITOR'S LOG",)]
    header = report_header(lines).first()
    assert (header.print_date, header.shoot_day, header.unit, header.shoot_date) == ("2026-01-23", "3", "Main Unit", "2026-01-22")
    assert header.headings[1] == "DAILY EDITOR'S LOG" and len(header.headings) == 7
    assert len(report_header(lines, top=6).first().headings) == 6


def test_a_header_of_any_height(spark):
    texts = ["Printed 1/23/26", *[f"note {i}" for i in range(8)], "Day: Day 3 - Main Unit"]
    runs = spark.createDataFrame([("d", 1, 0.0, 700.0 - 12 * i, text) for i, text in enumerate(texts)], "doc string, page int, x double, y double, text string")
    header = report_header(page_lines(runs)).first()
    assert (header.print_date, header.shoot_day, header.unit) == ("2026-01-23", "3", "Main Unit")


def test_edges_of_any_shape_are_reported_not_thrown(spark, rows):
    ref = '{"identifier":[{"identifierScope":"s","identifierValue":"v"}]}'
    df = spark.createDataFrame(
        [
            ("a", f'{{"has":{{"Slate":[{ref},{ref}],"Scene":{ref}}}}}'), ("b", '{"has":{"Slate":null,"X":3,"Y":true,"Z":[]}}'),
            ("c", None), ("d", "{}"), ("e", '{"has":{"Slate":[{"identifier":[]}]}}'),
        ],
        "id string, edges string",
    )
    got = rows(explode_edges(df), "id", "to_type", "malformed", "to_value")
    assert got == [
        ("a", "Scene", "object", None), ("a", "Slate", None, "v"), ("a", "Slate", None, "v"),
        ("b", "Slate", "null", None), ("b", "X", "number", None), ("b", "Y", "boolean", None), ("e", "Slate", None, None),
    ]
    assert malformed_notes(explode_edges(df), "id").count() == 4


def test_scope_keeps_episodes_and_tells_prefixes_apart(spark, rows):
    prefix = "com.example.project."
    kind = "array<struct<identifierScope:string,identifierValue:string>>"
    ids = lambda v: [("s", v)]
    data = [
        (1, "CreativeWork", ids(f"{prefix}129593"), None), (2, "CreativeWork", ids(f"{prefix}128054"), None),
        (3, "CreativeWork", ids("episode.1"), [(ids(f"{prefix}129593"),)]), (4, "CreativeWork", ids("episode.2"), [(ids(f"{prefix}128054"),)]),
        (5, "CreativeWork", ids(f"{prefix}12959"), None), (6, "Character", ids("role.1"), None), (7, "CreativeWork", None, None),
    ]
    df = spark.createDataFrame(data, f"n int, entity_type string, identifier {kind}, season array<struct<identifier:{kind}>>")
    assert rows(scope_to_project(df, f"{prefix}129593"), "n") == [(1,), (3,), (6,)]
    dropped = out_of_project(df, f"{prefix}129593")
    assert rows(dropped) == [(4,)]
    assert rows(scope_notes(dropped, "works"), "kind", "where") == [("outOfProject", "works")]
    assert scope_notes(out_of_project(df.filter("n = 6"), f"{prefix}129593"), "works").count() == 0


def test_domains_are_named_only_where_every_value_is_an_object(spark, rows):
    df = spark.createDataFrame(
        [
            (1, None, '{"desk":{"phase":{"name":"Shooting"}}}'), (2, None, '{"duration":"0:00","done":false}'),
            (3, "own", '{"desk":{}}'), (4, None, "{}"), (5, None, "[1]"), (6, None, '{"a":{},"b":[1]}'), (7, None, None),
        ],
        "n int, domain string, value string",
    )
    got = rows(name_domains(df), "n", "domain", "value", "changed")
    assert got == [
        (1, "desk", '{"phase":{"name":"Shooting"}}', True), (2, None, '{"duration":"0:00","done":false}', False),
        (3, "own", '{"desk":{}}', False), (4, None, "{}", False), (5, None, "[1]", False), (6, None, '{"a":{},"b":[1]}', False), (7, None, None, False),
    ]


def test_named_domains_and_second_identifiers_are_noted(spark, rows):
    df = spark.createDataFrame([(1, None, '{"a":{},"b":{}}'), (2, "own", "{}")], "n int, domain string, value string")
    assert rows(domain_notes(name_domains(df), "n", "api"), "kind", "detail") == [
        ("customDataDomains", "named the customData domain on 1 entities from the source's own key")
    ]
    entities = spark.createDataFrame([("e1", "f1"), ("e2", "")], "entity_id string, file_id string")
    own = spark.createDataFrame([("A", "e1", 0, "local", "e1"), ("A", "e2", 0, "local", "e2")],
                                "entity_type string, entity_id string, ordinal int, scope string, value string")
    both = append_source_identifier(own, entities, "A", "source", "file_id")
    assert rows(both.filter("ordinal = 1")) == [("A", "e1", 1, "source", "f1")]
    missing = missing_source_identifier(entities, "file_id")
    assert rows(identifier_notes(missing, "files", "source"), "kind", "detail") == [
        ("sourceIdentifierMissing", "1 entities did not receive a source identifier")
    ]


def test_stored_frames_live_in_the_shared_folder(spark, rows):
    df = spark.range(5)
    folder = shared_dir(spark)
    assert scratch_path(spark, "x").startswith(folder) and scratch_path(spark, "x") != scratch_path(spark, "x")
    local = lambda path: "/" + path.replace("file:", "").strip("/")
    assert all(local(f).startswith(local(folder)) for f in stage(df, "numbers").inputFiles())
    cut = cut_lineage(df.filter("id > 2"))
    assert rows(cut) == [(3,), (4,)] and "Range" not in cut._jdf.queryExecution().toString()


def test_upgrading_twice_changes_nothing(spark, rows):
    ref = '[{"identifier":[{"identifierScope":"s","identifierValue":"p1"}]}]'
    df = spark.createDataFrame(
        [("c1", "v2.6", "shootDay", '{"shootDay":1,"shootDate":"2026-01-23"}', f'{{"ProductionScene":{ref}}}', f'{{"CreativeWork":{ref}}}', '{"x":{"y":1}}')],
        "entity_id string, schema_version string, context_type string, properties string, has string, for_ string, custom_data string",
    )
    entities, edges = upgrade_context(df, "v3.0")
    row = entities.first()
    assert row.properties == '{"shootDay":{"shootDay":1,"shootDate":"2026-01-23"}}'
    assert row.custom_data == '[{"domain":null,"value":{"x":{"y":1}}}]'
    assert rows(edges) == [("c1", "for", "CreativeWork", "p1"), ("c1", "has", "ProductionScene", "p1")]
    again = entities.withColumn("context_type", F.lit("shootDay")).withColumn("has", F.lit(None).cast("string")).withColumn("for_", F.lit(None).cast("string"))
    twice, more = upgrade_context(again, "v3.0")
    assert rows(twice) == rows(entities) and more.count() == 0


def test_deep_chains_and_cycles_end(spark):
    chain = [(f"d{i - 1}" if i else "root", f"d{i}", "folder", f"d{i}", 0) for i in range(40)]
    files = [(f"d{i}", f"f{i}", "file", f"f{i}", 0) for i in range(40)]
    cycle = [("c1", "c2", "folder", "c2", 0), ("c2", "c1", "folder", "c1", 0), ("c1", "cf", "file", "cf", 0)]
    nodes = spark.createDataFrame(
        [("", "root", "folder", "root", 0), *chain, *files, *cycle],
        "parent_id string, id string, type string, name string, position int",
    ).withColumn("head_version", F.lit(None).cast("string"))
    walk = walk_tree(nodes, spark.createDataFrame([("root",)], "id string"))
    assert walk.files.count() == 40 and walk.too_deep.count() == 0


def test_runs_are_moved_before_they_are_gathered(spark):
    """No task gathers the partition it reads, whose size nothing bounds."""
    runs = spark.createDataFrame([("d", 1, 2.0, 10.0, "b"), ("d", 1, 1.0, 10.2, "a"), ("d", 1, None, 10.4, "n")], "doc string, page int, x double, y double, text string")
    lines = page_lines(runs)
    assert [r.line for r in lines.collect()] == ["n a b"]
    plan = page_lines(runs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("RepartitionByExpression")
