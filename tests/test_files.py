"""Readers, writers and the built-in sources on files written by the test."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tablemint import session
from tablemint.operators.quality import EntityRule
from tablemint.operators.tree import walk_tree
from tablemint.plans.build import build_entities
from tablemint.plans.bundle import InvalidBundle
from tablemint.plans.catalogue import catalogue_mappings, check_structures, file_notes, file_rows, structure_for
from tablemint.plans import delivery as delivery_plans
from tablemint.plans.delivery import (
    PRIMARY_ROOT, circled_against_select, compare_witness, delivery_mappings, fidelity_report, read_delivery, read_witness_a, read_witness_b,
    with_delivery_day, with_take_key,
)
from tablemint.plans.mapping import Edge, Mapping, Rest, Text
from tablemint.sinks import nested_records, write_bundle, write_table_set
from tablemint.sinks.tables import publish, written_tables
from tablemint.sources.csv import csv_rows, malformed_rows
from tablemint.sources.files import empty_directories, file_manifest, file_signatures, opening_signature, wrong_documents
from tablemint.sources.pages import json_bundle, page_items, read_pages
from tablemint.sources.xml import text_schema, xml_rows
from tablemint.workload import deliveries


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


PRIMARY = f"""<?xml version="1.0" encoding="UTF-8"?>
<{PRIMARY_ROOT} Version="2">
  <UUID>u-1</UUID><created>2026-01-23</created><source_type>x</source_type><production_name>Show</production_name>
  <script>
    <scene><scene_number>3</scene_number><scene_heading>INT. ROOM</scene_heading><scene_slug>(null)</scene_slug>
      <scene_script_revision>&lt;Unit: 0x60000aeaec30&gt;</scene_script_revision>
      <scene_shoot_day_credited>Day 1</scene_shoot_day_credited><scene_shoot_day_credited>4/8</scene_shoot_day_credited>
      <characters_in_scene>
        <character_in_scene><character_in_scene_number>1</character_in_scene_number><character_in_scene_name>DANTE</character_in_scene_name></character_in_scene>
        <character_in_scene><character_in_scene_number>1</character_in_scene_number><character_in_scene_name>DANTE</character_in_scene_name></character_in_scene>
      </characters_in_scene></scene>
    <scene><scene_number>13</scene_number><scene_heading>EXT.</scene_heading></scene>
    <scene><scene_number>15</scene_number></scene>
  </script>
  <shoot_days><shoot_day><day_number>Day 1</day_number><production_unit>Main</production_unit></shoot_day></shoot_days>
  <shots>
    <shot_properties><script_scene>3A</script_scene><script_camera>A</script_camera><script_take>1</script_take>
      <script_shootDay>Day 1</script_shootDay><script_comment>(null)</script_comment><script_frame_rate>23.976</script_frame_rate>
      <script_recorded_time>12.50</script_recorded_time><script_start_date_time>2026-01-23T15:41:51</script_start_date_time>
      <script_shot_description>It's “fine”</script_shot_description><script_select_type>Hold</script_select_type>
      <related_scenes><scene>3</scene><episode/></related_scenes>
      <characters_in_scenes><character><character_number>1</character_number><character_name>DANTE</character_name></character></characters_in_scenes>
    </shot_properties>
    <shot_properties><script_scene>R13/15</script_scene><script_camera>A</script_camera><script_take>6.1 PU</script_take>
      <script_distance>5</script_distance><script_lens_height>5</script_lens_height>
      <related_scenes><scene>13</scene><scene>15</scene></related_scenes></shot_properties>
    <shot_properties><script_scene>1001</script_scene><script_camera></script_camera><script_take>PU</script_take>
      <related_scenes><scene>3</scene></related_scenes></shot_properties>
    <shot_properties><script_scene>1001</script_scene><script_take>PU</script_take></shot_properties>
  </shots>
</{PRIMARY_ROOT}>
"""
WITNESS_A = """<ScriptEMetaData Version="1"><UUID>u</UUID>
  <ShotProperties><Slate>3A</Slate><Camera>A</Camera><Take>1</Take><FrameRate>23.9760</FrameRate><ShotDescription>IT'S "FINE"</ShotDescription>
    <StartDateTime>01/23/2026 15:41:51</StartDateTime><SelectType>Circled</SelectType><StripBoardDay>1</StripBoardDay><RecordedTime>12.5</RecordedTime>
    <RelatedScenes><Scene>3</Scene></RelatedScenes></ShotProperties>
  <ShotProperties><Slate>9</Slate><Camera>A</Camera><Take>1</Take></ShotProperties>
</ScriptEMetaData>"""
WITNESS_B = """Slate,Scene,Camera,Roll,Take,Circled,Notes
3A,3,A,,1,Y,fine
R13/15,"13",A,r1,6.1,,"a "quoted" note, broken"
3A,3,A,r2,1,Y,again

1001,3,,r1,PU,N
"""


@pytest.fixture(scope="module")
def delivery(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("delivery")
    return read_delivery(spark, put(folder / "sim.xml", PRIMARY))


def test_takes_of_a_document(delivery, rows):
    got = rows(delivery.takes, "slate", "wildTrackNumber", "isWildTrack", "camera", "take", "takeAnnotation", "slateFullName", "narrativeScene", "recordedTimeSeconds")
    assert got == sorted([
        ("3A", None, False, "A", "1", None, "3A-1", "3", 12.5), ("R13/15", None, False, "A", "6.1 PU", "PU", "R13/15-6.1 PU", "13; 15", None),
        (None, "1001", True, None, "PU", "PU", "1001-PU", "3", None), (None, "1001", True, None, "PU", "PU", "1001-PU", None, None),
    ], key=repr)
    assert rows(delivery.header, "uuid", "productionName", "schemaVersion") == [("u-1", "Show", "2")]


def test_deliveries_are_written_compressed_in_bounded_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(deliveries, "DOCUMENT_ROWS", 200)
    names = [f"column_with_a_long_name_{i}" for i in range(20)]
    df = spark.range(1000).repartition(1).select(*[F.col("id").cast("string").alias(n) for n in names])
    out = deliveries._write_xml(df, str(tmp_path / "out"), "rows", "row")
    sizes = [f.stat().st_size for f in (tmp_path / "out").glob("part-*")]
    assert len(sizes) == 5 and sum(sizes) < 1000 * sum(map(len, names)) / 4
    read = xml_rows(spark, out, "row", text_schema(names))
    assert read.count() == 1000 and read.select(names[0]).distinct().count() == 1000


def test_files_are_listed_only_for_the_elements_that_are_read(spark, tmp_path, rows, monkeypatch):
    for n in range(3):
        put(tmp_path / "in" / f"n={n}" / "sim.xml", PRIMARY)
    scanned = []

    def counted(spark, path, row_tag, *args):
        scanned.append(row_tag)
        return xml_rows(spark, path, row_tag, *args)

    monkeypatch.setattr(delivery_plans, "xml_rows", counted)
    read = read_delivery(spark, str(tmp_path / "in"), staged=True, recursive=True)
    assert rows(read.header, "productionName") == [("Show",)] * 3 and len({r.file_path for r in read.header.collect()}) == 3
    assert scanned == [PRIMARY_ROOT]


def test_scenes_do_not_mix_with_the_scene_tags_of_takes(delivery, rows):
    assert rows(delivery.scenes, "narrativeScene", "heading", "slug", "shootDayCredited", "eighthsCredited") == sorted([
        ("3", "INT. ROOM", None, "1", "4/8"), ("13", "EXT.", None, None, None), ("15", None, None, None, None),
    ], key=repr)
    assert delivery.scene_characters.count() == 2 and delivery.take_characters.count() == 1
    assert rows(delivery.totals()) == [(4, 3, 2, 3, 1)]


def test_delivery_notes(delivery, rows):
    assert rows(delivery.notes(), "kind", "where") == sorted([
        ("duplicateCharacter", "scene 3"), ("objectDescription", "field scriptRevision"), ("duplicateTakeKey", "1001||PU"),
        ("duplicatedField", "shot_properties"), ("sentinelNull", "field comment"), ("sentinelNull", "field slug"),
    ])


def test_interim_tables_name_production_and_day(delivery, rows):
    tables = delivery.tables()
    assert {n: len([c for c in t.columns if c != "_ord"]) for n, t in tables.items()} == {
        "shootDay": 20, "narrativeScenes": 21, "narrativeSceneCharacters": 5, "takes": 46, "takeCharacters": 10,
    }
    assert rows(tables["narrativeScenes"].select("productionName", "shootDay").distinct()) == [("Show", "1")]
    # A take's own day is kept, also where it is absent.
    assert rows(tables["takes"], "slateFullName", "shootDay")[-1] == ("R13/15-6.1 PU", None)


def test_staged_delivery_is_the_same(spark, tmp_path, delivery, rows):
    staged = read_delivery(spark, put(tmp_path / "sim.xml", PRIMARY), staged=True)
    for name, df in staged.tables().items():
        assert rows(df.drop("_ord")) == rows(delivery.tables()[name].drop("_ord"))


def _reads(df) -> str:
    """The files that a plan reads."""
    return " ".join(df.inputFiles())


def test_notes_of_a_staged_delivery_pass_over_the_takes_once(spark, tmp_path, delivery, rows, monkeypatch):
    kept = []
    write = delivery_plans.stage
    monkeypatch.setattr(delivery_plans, "stage", lambda df, name: kept.append((name, df)) or write(df, name))
    staged = read_delivery(spark, put(tmp_path / "sim.xml", PRIMARY), staged=True)
    notes = staged.notes()
    assert rows(notes) == rows(delivery.notes())
    # All that is asked of the takes' columns is one row, and what is left to read holds no take.
    over_takes = [name for name, df in kept if "/shots-" in _reads(df)]
    assert sorted(over_takes) == ["context", "duplicates", "findings"] and "/shots-" not in _reads(notes)


def test_the_context_of_a_staged_delivery_is_found_once(spark, tmp_path, monkeypatch):
    staged = read_delivery(spark, put(tmp_path / "sim.xml", PRIMARY), staged=True)
    assert all("/context-" in _reads(df) for df in staged.tables().values())
    assert "/shots-" not in _reads(staged.tables()["narrativeScenes"])


def test_stored_edges_hold_keys_only(spark, delivery, rows, monkeypatch):
    from tablemint.plans import build

    columns = {}
    write = build.stage
    monkeypatch.setattr(build, "stage", lambda df, name: columns.update({name: df.columns}) or write(df, name))
    built = build_entities(delivery.tables(), [m for m in delivery_mappings() if m.table != "assets"], "Show")
    stored = built.stored("keys", "edges")
    assert not {"from_id", "to_id"} & set(columns["edges"])
    assert stored.edges.columns == built.edges.columns and rows(stored.edges) == rows(built.edges)
    assert rows(stored.unresolved) == rows(built.unresolved)


def test_a_report_parses_the_camera_log_once(spark, tmp_path, delivery, rows, monkeypatch):
    kept = []
    write = delivery_plans.stage
    monkeypatch.setattr(delivery_plans, "stage", lambda df, name: kept.append(name) or write(df, name))
    a = with_take_key(read_witness_a(spark, put(tmp_path / "a.xml", WITNESS_A)))
    b = with_take_key(read_witness_b(spark, put(tmp_path / "b.csv", WITNESS_B)))
    report = fidelity_report(with_take_key(delivery.takes), {"a": a, "b": b})
    assert kept == ["witness-b"] and "b.csv" not in _reads(report)
    assert rows(report.filter("section = 'circled'"), "name", "value") == [("(blank) / (blank)", 1), ("N / (blank)", 1), ("Y / Hold", 2)]
    assert rows(report.filter("section like 'keys %' and name in ('matched', 'only_left', 'only_right')"), "section", "name", "value") == [
        ("keys a", "matched", 1), ("keys a", "only_left", 2), ("keys a", "only_right", 1),
        ("keys b", "matched", 3), ("keys b", "only_left", 0), ("keys b", "only_right", 0),
    ]
    late = fidelity_report(with_take_key(delivery.takes), {"a": None})
    assert rows(late.filter("section = 'verdict a'"), "name") == [("NOT DELIVERED",)]


def test_staging_splits_methods_too_long_to_compile(spark, tmp_path, monkeypatch):
    limit = "spark.sql.codegen.hugeMethodLimit"
    seen = []
    df = spark.range(3)
    write = type(df).write
    monkeypatch.setattr(type(df), "write", property(lambda self: seen.append(spark.conf.get(limit)) or write.fget(self)))
    given = spark.conf.get(limit)
    assert session.stage(df, "small").count() == 3
    assert int(seen[0]) <= 8000 and spark.conf.get(limit) == given
    spark.conf.set(limit, "4000")
    try:
        session.stage(df, "smaller")
    finally:
        spark.conf.set(limit, given)
    assert seen[1] == "4000"


def test_witnesses(spark, tmp_path, delivery, rows):
    primary = with_take_key(delivery.takes)
    a = with_take_key(read_witness_a(spark, put(tmp_path / "a.xml", WITNESS_A)))
    r = compare_witness(primary, a, "a")
    assert len([f for f in r.fields if f.right]) == 35
    assert rows(r.differences(), "field", "left_value", "right_value") == [("selectType", "Hold", "Circled")]
    assert rows(r.only_right()) == [("9|A|1",)]
    b = read_witness_b(spark, put(tmp_path / "b.csv", WITNESS_B))
    assert rows(b, "slate", "wildTrackNumber", "take", "Circled")[:1] == [("3A", None, "1", "Y")]
    assert malformed_rows(b).select("slate", "_malformed").count() == 2
    keyed = with_take_key(b)
    assert len([f for f in compare_witness(primary, keyed, "b").fields if f.right]) == 19
    assert rows(circled_against_select(primary, keyed)) == [("(blank)", "(blank)", 1), ("N", "(blank)", 1), ("Y", "Hold", 2)]


def test_a_scene_with_stray_text_is_kept_and_noted(spark, tmp_path, rows):
    text = PRIMARY.replace("<scene><scene_number>13", "<scene>struck out <scene_number>13").replace("<scene><scene_number>15</scene_number></scene>", "<scene>all text</scene>")
    stray = read_delivery(spark, put(tmp_path / "sim.xml", text))
    assert rows(stray.scenes, "narrativeScene", "heading") == [("13", "EXT."), ("3", "INT. ROOM")]
    assert rows(stray.notes().filter("kind = 'strayText'"), "where", "detail") == [("scene 13", 'text outside of any element: "struck out"')]
    assert set(stray.tables()["narrativeScenes"].columns) == set(read_delivery(spark, put(tmp_path / "b.xml", PRIMARY)).tables()["narrativeScenes"].columns)


def test_days_that_share_labels_are_compared_by_day(spark, tmp_path, rows):
    header = "Slate,Scene,Camera,Roll,Take,Circled,Notes\n"
    for day, note in (("1", "one"), ("2", "two")):
        put(tmp_path / f"day={day}" / "sim.xml", PRIMARY.replace("<script_comment>(null)", f"<script_comment>{note}"))
        put(tmp_path / f"day={day}" / "b.csv", header + f"3A,3,A,,1,Y,{note}\n")
    takes = read_delivery(spark, f"{tmp_path}/day=*/*.xml").takes
    witness = read_witness_b(spark, f"{tmp_path}/day=*/*.csv")
    left, right = with_delivery_day(with_take_key(takes)), with_delivery_day(with_take_key(witness))
    by_day = compare_witness(left, right, "b")
    assert rows(by_day.differences().filter("field = 'comment'")) == []
    assert rows(by_day.summary(), "matched", "only_left", "only_right") == [(2, 4, 0)]
    assert rows(circled_against_select(left, right)) == [("Y", "Hold", 2)]
    section = fidelity_report(left, {"b": right}).filter("section = 'keys b' and name = 'matched'")
    assert rows(section, "value") == [(2,)]
    # Without days the two share their keys, and one of each pair is all that is compared.
    folded = compare_witness(with_take_key(takes), with_take_key(witness), "b")
    assert rows(folded.summary(), "matched") == [(1,)]


def test_delivery_to_entities(delivery, rows):
    mappings = [m for m in delivery_mappings() if m.table != "assets"]
    built = build_entities(delivery.tables(), mappings, "Show")
    assert rows(built.entities["ProductionScene"], "key", "sceneHeader", "sceneDescriptor") == [
        ("3A", "INT. ROOM", "It's “fine”"), ("R13/15", None, None),
    ]
    assert rows(built.entities["Slate"], "key", "shootDay", "recordingFPS") == [
        ("1001-PU", None, None), ("3A-1", 1.0, 23.976), ("R13/15-6.1 PU", None, None),
    ]
    custom = {(r.entity_type, r.key): dict(r.value) for r in built.custom.collect()}
    assert custom["ProductionScene", "R13/15"]["lensHeight"] == "5" and "distance" not in custom["ProductionScene", "R13/15"]
    assert rows(built.edges.filter("to_type = 'NarrativeScene'"), "from_key", "to_key") == [("3A", "3"), ("R13/15", "13"), ("R13/15", "15")]
    assert rows(built.edges.filter("external"), "to_key") == [("DANTE",)]


def test_wrong_documents_and_empty_directories(spark, tmp_path, rows):
    put(tmp_path / "day" / "good.xml", PRIMARY)
    put(tmp_path / "day" / "bad.xml", "<Other/>")
    (tmp_path / "day" / "empty").mkdir()
    manifest = file_manifest(spark, str(tmp_path))
    assert rows(manifest, "file_name", "file_extension", "media_type") == [
        ("bad.xml", ".xml", "application/xml"), ("good.xml", ".xml", "application/xml"),
    ]
    header = read_delivery(spark, str(tmp_path / "day" / "*.xml")).header
    local = lambda df, c: df.withColumn(c, F.regexp_replace(c, "^file:/*", "/"))
    notes = wrong_documents(local(manifest, "path"), local(header, "file_path"), PRIMARY_ROOT)
    assert [os.path.basename(r.where) for r in notes.collect()] == ["bad.xml"]
    listed = spark.createDataFrame([(str(tmp_path / "day"),), (str(tmp_path / "day" / "empty"),)], "path string")
    assert rows(empty_directories(listed, local(manifest, "path")), "kind", "where") == [("emptyDirectory", "empty")]


def test_opening_signatures_survive_a_cut_character(spark, tmp_path, rows):
    put(tmp_path / "a.txt", "\n\r\n  first line \nsecond" + "é" * 5000)
    put(tmp_path / "b.xml", '<?xml version="1.0"?>\n<Root a="1"><x/></Root>')
    got = rows(file_signatures(spark, str(tmp_path)), "file_name", "first_line", "xml_root")
    assert got == [("a.txt", "first line", None), ("b.xml", '<?xml version="1.0"?>', "Root")]


def test_csv_keeps_malformed_rows_and_types_nothing(spark, tmp_path, rows):
    path = put(tmp_path / "x.csv", 'a,b,c\n007, x ,""\n"q ""ok""","line\nbreak",1\nshort,row\nlong,1,2,3\n"bad "quote"",1,2\n\n')
    df = csv_rows(spark, path)
    good = df.filter("_malformed is null")
    assert rows(good, "a", "b", "c") == sorted([("007", "x", None), ('q "ok"', "line\nbreak", "1")], key=repr)
    assert malformed_rows(df).count() == 3 and df.count() == 5
    assert [r.a for r in df.orderBy("_ord").collect()][0] == "007"


def test_pages_and_bundles(spark, tmp_path, rows):
    for i, page in enumerate([{"data": [{"id": 1}, {"id": 2}], "pagination": {"hasMore": True}}, {"data": [], "links": {"next": "n"}}]):
        put(tmp_path / "pages" / f"{i}.json", json.dumps(page))
    pages = read_pages(spark, str(tmp_path / "pages"), "struct<id:int>")
    assert rows(pages, "has_more", "next") == [(False, "n"), (True, None)]
    assert rows(page_items(pages), "id") == [(1,), (2,)]
    path = put(tmp_path / "slate.json", json.dumps([{"entityType": "Slate"}, {"entityType": "Slate"}], indent=2))
    assert json_bundle(spark, path, "entityType string").count() == 2


def test_table_sets_replace_and_prune(spark, tmp_path, rows):
    out = str(tmp_path / "tables")
    df = spark.createDataFrame([("a", None), ('say "x", y', "b")], "x string, y string")
    put(tmp_path / "tables" / "foreign" / "kept.txt", "not a table of a run")
    write_table_set({"one": df, "stale": df}, out)
    assert written_tables(spark, out) == {"one", "stale"}
    write_table_set({"one": df}, out)
    assert sorted(os.listdir(out)) == ["_tables", "foreign", "one"]
    assert os.listdir(f"{out}/foreign") == ["kept.txt"]
    assert rows(csv_rows(spark, f"{out}/one"), "x", "y") == rows(df)


@pytest.fixture(scope="module")
def small(spark):
    people = spark.createDataFrame([("p1", "Ann", "n1"), ("p2", None, None)], "k string, name string, note string")
    links = spark.createDataFrame([("p1", f"t{i:03d}") for i in range(25)] + [("p2", "t000")], "k string, t string")
    mappings = [
        Mapping("Person", "people", "k", properties={"names.full": "name"}, texts={"annotation": (Text("Note", "note"),)}, custom=Rest("demo")),
        Mapping("Person", "links", "k", edges=(Edge("Thing", "t", external=True),)),
    ]
    return build_entities({"people": people, "links": links}, mappings, "demo")


def test_a_publish_that_fails_keeps_the_last_output(spark, tmp_path):
    out = str(tmp_path / "out")
    put(tmp_path / "out" / "part", "first")
    with pytest.raises(FileNotFoundError):
        publish(spark, str(tmp_path / "never-staged"), out)
    assert (tmp_path / "out" / "part").read_text() == "first"
    # A run that died after it moved the output aside.
    os.rename(out, str(tmp_path / ".out.previous"))
    with pytest.raises(FileNotFoundError):
        publish(spark, str(tmp_path / "never-staged"), out)
    assert (tmp_path / "out" / "part").read_text() == "first"
    put(tmp_path / "staged" / "part", "second")
    publish(spark, str(tmp_path / "staged"), out)
    assert (tmp_path / "out" / "part").read_text() == "second" and sorted(p.name for p in tmp_path.iterdir()) == ["out"]


def test_nested_records_split_without_losing_anything(small):
    whole = [json.loads(r.record) for r in nested_records(small, "v3", per_record=100).collect()]
    assert len(whole) == 2
    ann = next(r for r in whole if r.get("names"))
    assert ann["names"] == {"full": "Ann"} and ann["annotation"] == [{"title": "Note", "text": "n1"}]
    assert len(ann["edges"]["has"]["Thing"]) == 25 and ann["customData"][0]["value"] == {"k": "p1"}
    parts = [json.loads(r.record) for r in nested_records(small, "v3", per_record=4).collect()]
    mine = [r for r in parts if r["identifier"] == ann["identifier"]]
    assert len(mine) > 3 and sum("names" in r for r in mine) == 1
    refs = [json.dumps(x) for r in mine for x in r.get("edges", {}).get("has", {}).get("Thing", [])]
    assert sorted(refs) == sorted(json.dumps(x) for x in ann["edges"]["has"]["Thing"])


def test_a_second_identifier_follows_the_first(spark, small):
    extra = spark.createDataFrame([("Person", "p1", "source", "id-1")], "entity_type string, key string, scope string, value string")
    records = [json.loads(r.record) for r in nested_records(small, "v3", per_record=100, extra_identifiers=extra).collect()]
    found = {len(r["identifier"]): r for r in records}
    assert found[2]["identifier"][1] == {"identifierScope": "source", "identifierValue": "id-1"}
    assert found[2]["identifier"][0]["identifierScope"] == "local" and found[2]["names"]["full"] == "Ann"


def test_nothing_is_written_unless_every_entity_is_valid(spark, small, tmp_path):
    out = str(tmp_path / "bundle")
    with pytest.raises(InvalidBundle, match="1 of 2 entities failed validation. First: Person .*names/full is required"):
        write_bundle(small, {"Person": [EntityRule("names.full", required=True)]}, out, "v3")
    assert not os.path.exists(out)
    write_bundle(small, {"Person": [EntityRule("names.full", allowed=("Ann",))]}, out, "v3")
    write_bundle(small, {}, out, "v3")
    assert sorted(d for d in os.listdir(out) if d[0] not in "._") == ["customData", "edges", "entities", "identifiers", "texts"]
    records = [r.asDict(True) for r in spark.read.json(f"{out}/entities").collect()]
    assert len(records) == 2 and all(len(r["identifier"]) == 1 and r["schemaVersion"] == "v3" for r in records)
    assert {(r.key, r.toKey) for r in spark.read.json(f"{out}/edges").collect()} == {("p1", f"t{i:03d}") for i in range(25)} | {("p2", "t000")}
    assert [r.text for r in spark.read.json(f"{out}/texts").collect()] == ["n1"]
    assert [p.name for p in tmp_path.iterdir()] == ["bundle"]


def test_catalogue_from_tree_to_entities(spark, rows):
    nodes = spark.createDataFrame(
        [("root", "f1", "file", "slate_01.mov", 0), ("root", "day", "folder", "Day 01", 1), ("day", "f2", "file", "notes.xyzzy", 0)],
        "parent_id string, id string, type string, name string, position int",
    )
    walk = walk_tree(nodes, spark.createDataFrame([("root",)], "id string"))
    meta = "array<struct<name:string,mutable:boolean,value:string>>"
    records = spark.createDataFrame(
        [
            ("f1", "slate_01.mov", "video/quicktime", 10, [("Slate", True, "13A"), ("Take", True, "1"), ("fileId", True, "evil"), ("Video Codec", False, "x"), ("Mood", True, "sad")]),
            ("f2", "notes.xyzzy", "model/odd", None, [("Slate", True, "13B")]),
        ],
        f"id string, name string, media_type string, file_size bigint, metadata {meta}",
    )
    empty = ["parent_id", "status", "view_url", "created_at", "updated_at"]
    files = records.join(walk.files.select("id", "folder_path", "stack_id"), "id").select("*", *[F.lit(None).cast("string").alias(c) for c in empty])
    table = file_rows(files, ["Slate", "Take", "Video Codec"], "proj")
    assert rows(table, "fileId", "filePath", "fileExtension", "assetStructureType", "SlateId") == [
        ("f1", "/slate_01.mov", ".mov", "digital.movingImage", "13A-1"), ("f2", "/Day 01/notes.xyzzy", ".xyzzy", "digital", None),
    ]
    assert rows(file_notes(files), "kind", "where") == [("metadataNameCollision", "fileId"), ("unclassifiedMediaType", "model/odd")]
    comments = spark.createDataFrame(
        [("f1", "nice", "Ann", 12.0), ("f1", "nice", "Ann", 12.0), ("f1", "again", None, None), ("f1", None, None, None)],
        "fileId string, commentText string, commentAuthor string, commentFrame double",
    )
    mappings = catalogue_mappings()
    built = build_entities({"files": table, "comments": comments}, mappings["files"] + mappings["comments"], "demo")
    assert rows(built.entities["Asset"], "key", "label") == [("f1", "slate_01.mov"), ("f2", "notes.xyzzy")]
    assert rows(built.texts, "key", "text", "author", "title") == [("f1", "again", None, None), ("f1", "nice", "Ann", "12.0")]
    custom = {(r.entity_type, r.key): dict(r.value) for r in built.custom.collect()}
    assert custom["AssetStructure", "f1"] == {"fileSize": "10", "Video Codec": "x"}
    assert custom["Asset", "f1"]["Mood"] == "sad" and "Video Codec" not in custom["Asset", "f1"]
    assert custom["Asset", "f1"]["fileId"] == "f1"
    assert rows(built.edges, "from_type", "to_type", "from_key") == [("Asset", "AssetStructure", "f1"), ("Asset", "AssetStructure", "f2")]


def test_structures_are_checked_before_any_read(spark, rows):
    check_structures({"digital", "digital.image", "digital.movingImage", "digital.audio", "digital.data", "digital.document"})
    with pytest.raises(ValueError, match="digital.audio"):
        check_structures({"digital"})
    df = spark.createDataFrame([("TEXT/csv",), ("text/plain",), (None,)], "m string")
    assert rows(df.select("m", structure_for("m").alias("s")), "s") == [("digital",), ("digital.data",), ("digital.document",)]


def test_csv_files_are_read_by_their_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Slate,Take,Notes\n4A,1,x\n")
    (tmp_path / "b.csv").write_text("Take,Slate,Notes,Extra\n2,4B,y,z\n")
    rows = {r["Slate"]: r for r in csv_rows(spark, str(tmp_path)).collect()}
    assert (rows["4A"]["Take"], rows["4A"]["Notes"], rows["4A"]["Extra"]) == ("1", "x", None)
    assert (rows["4B"]["Take"], rows["4B"]["Notes"], rows["4B"]["Extra"]) == ("2", "y", "z")
    assert all(r["_malformed"] is None for r in rows.values())


def test_signature_after_a_long_comment(spark):
    text = "<!-- " + "licence " * 1000 + "-->\n<Root >"
    df = opening_signature(spark.createDataFrame([(text,)], "content string"), "content")
    assert df.first()["xml_root"] == "Root"


def test_facts_of_a_record_are_gathered_once(small):
    """One grouping lists a record's facts; slots, predicates and types are told apart inside of it."""
    plan = nested_records(small, "v3", per_record=4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_set(") == 1 and "collect_list(" not in plan
