"""The production-day delivery: primary XML and two witnesses to tables, checks and mappings."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    clean_text,
    is_wild_track,
    recorded_seconds,
    scene_slate,
    sentinel_null,
    shoot_day_number,
    slate_full_name,
    take_annotation,
    take_key,
    wild_track_number,
)
from ..functions.text import SENTINEL
from ..operators.notes import all_notes, note_rows
from ..operators.order import ORDER
from ..operators.quality import (
    column_findings,
    distinct_values,
    duplicate_keys,
    found_copied,
    found_leaks,
    found_sentinels,
    report_rows,
    table_counts,
)
from ..operators.reconcile import Reconciliation, Witness, cross_tab, left_only_fields, reconcile_witnesses, shared_fields
from ..operators.rules import SignatureRule
from ..session import stage
from ..sources.csv import CORRUPT, csv_rows
from ..sources.xml import text_schema, xml_rows
from .fields import (
    TRANSFORMS,
    TagField,
    compared_fields,
    day_fields,
    scene_fields,
    take_fields,
    witness_a_tags,
    witness_b_columns,
)
from .mapping import Edge, FromTable, Lookup, Mapping, Rest, Source, Text

# Root elements, row tags and column orders of the delivery.
PRIMARY_ROOT = "ScriptESIMMetabanq"
WITNESS_A_ROOT = "ScriptEMetaData"
WITNESS_A_ROW = "ShotProperties"
HEADER_TAGS = ["UUID", "created", "source_type", "production_name", "@Version"]
TAKE_LEAD = [
    "slateFullName", "slate", "productionScene", "narrativeScene", "wildTrackNumber", "isWildTrack",
    "episode", "camera", "take", "takeAnnotation", "setup",
]
TAKE_CHARACTER_COLUMNS = [
    "slateFullName", "productionScene", "narrativeScene", "slate", "camera", "take",
    "characterNumber", "characterName",
]
SCENE_CHARACTER_COLUMNS = ["narrativeScene", "characterNumber", "characterName"]

# Content signatures in matching order: basis, compared value, type, description,
# structure, number expected per day.
SIGNATURE_RULES = (
    SignatureRule("heading", "DAILY EDITOR'S LOG", "dailyEditorLog", "Daily Editor's Log", "digital.document", 2),
    SignatureRule("heading", "DETAILED EDITOR'S LOG", "detailedEditorLog", "Detailed Editor's Log", "digital.document", None),
    SignatureRule("heading", "DAILY TIMECODE LOG", "dailyTimecodeLog", "Daily Timecode Log", "digital.document", None),
    SignatureRule("heading", "DAILY COVERAGE", "dailyCoverage", "Daily Coverage", "digital.document", None),
    SignatureRule("heading", "DAILY PROGRESS REPORT", "dailyProgressReport", "Daily Progress Report", "digital.document", None),
    SignatureRule("heading", "EDITOR REPORT", "editorReport", "Editor Report", "digital.document", None),
    SignatureRule("heading", "SCRIPT FACING PAGE", "facingAndLinedScript", "Script Facing Page and Lined Script", "digital.document", None),
    SignatureRule("xml_root", "ScriptESIMMetabanq", "simMetabanqExport", "SIM Metabanq Export", "digital.data", None),
    SignatureRule("xml_root", "ScriptEMetaData", "editorLogExport", "Editor Log Metadata Export", "digital.data", None),
    SignatureRule("header_prefix", "Slate,Scene,Camera,Roll,Take,Circled", "silverStackLog", "SilverStack Camera Log", "digital.data", None),
    SignatureRule("text_pattern", r"^Heading\s*[\r\n]+FIELD_DELIM\b", "avidClipBin", "Avid Clip Bin", "digital.data", None),
)
ASSET_FUNCTION = "technicalReferenceMaterial"
DOMAIN = "Script-E"
NO_INFORMATION = ("distance", "productionName")
PROVENANCE_REASON = "Generated by Script-E as a production day deliverable"


def signature_rules() -> list[SignatureRule]:
    return list(SIGNATURE_RULES)


# --- projections --------------------------------------------------------------------------


def pick(fields: list[TagField], resolve: bool = True) -> list[Column]:
    """Rename tags to columns; with ``resolve`` the sentinel becomes null and transforms apply."""
    cleaned = [(f, clean_text(f"`{f.tag}`")) for f in fields]
    return [(resolved(f, value) if resolve else value).alias(f.column) for f, value in cleaned]


def resolved(field: TagField, value: Column) -> Column:
    """A cleaned cell as a value: the sentinel is null and the field's transform applies."""
    value = sentinel_null(value)
    return TRANSFORMS[field.transform](value) if field.transform else value


def project(df: DataFrame, columns: list[str], context: list[str]) -> DataFrame:
    """An explicit column order: context first unless the row has its own, absent columns null."""
    lead = [c for c in context if c not in columns]
    have = set(df.columns)
    cells = [F.col(f"`{c}`") if c in have else F.lit(None).cast("string").alias(c) for c in [*lead, *columns]]
    return df.select(*cells, *([F.col(ORDER)] if ORDER in have else []))


def concat_tables(per_day: list[dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Same-named tables of many days as one; a column a day lacks is null there."""
    names = dict.fromkeys(name for tables in per_day for name in tables)
    return {
        name: reduce(
            lambda a, b: a.unionByName(b, allowMissingColumns=True), [t[name] for t in per_day if name in t]
        )
        for name in names
    }


def _related_scenes(column: str) -> Column:
    # Blank members are null, and are not joined.
    return F.nullif(F.array_join(F.transform(F.col(column), clean_text), "; "), F.lit(""))


def split_slate_columns(df: DataFrame) -> DataFrame:
    """Separate wild-track numbers from slates; ``_slate`` keeps the slate as delivered."""
    return (
        df.withColumn("_slate", F.col("slate"))
        .withColumn("wildTrackNumber", wild_track_number("_slate"))
        .withColumn("isWildTrack", is_wild_track("_slate"))
        .withColumn("slate", scene_slate("_slate"))
    )


# --- primary export -----------------------------------------------------------------------


class Delivery:
    """All days of a delivery at once; every table carries ``file_path`` and source order.

    Each frame is planned when it is first asked for, so files are listed, and with ``staged`` parsed,
    only for the elements that are read.
    """

    def __init__(self, spark: SparkSession, path: str | list[str], staged: bool = False, recursive: bool = False):
        self._spark, self._path, self._staged, self._recursive = spark, path, staged, recursive

    def _rows(self, row_tag: str, schema: T.StructType) -> DataFrame:
        return xml_rows(self._spark, self._path, row_tag, schema, self._recursive)

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return stage(df, name) if self._staged else df

    @cached_property
    def header(self) -> DataFrame:
        header = self._rows(PRIMARY_ROOT, text_schema(HEADER_TAGS)).select(
            "file_path",
            *[
                clean_text(f"`{tag}`").alias(name)
                for tag, name in zip(HEADER_TAGS, ["uuid", "created", "sourceType", "productionName", "schemaVersion"])
            ],
        )
        return self._keep(header, "header")

    @cached_property
    def _elements(self) -> DataFrame:
        character = ["character_in_scene_number", "character_in_scene_name"]
        scene_schema = text_schema([f.tag for f in scene_fields()], {"scene_shoot_day_credited": None})
        scene_schema = scene_schema.add(
            "characters_in_scene", text_schema([], {"character_in_scene": character})
        ).add("_VALUE", "string")
        # A take names its scenes in elements of the same tag that hold text only.
        elements = self._rows("scene", scene_schema)
        filled = [F.col(f"`{f.tag}`") for f in scene_fields()]
        elements = elements.filter(
            F.coalesce(*filled, F.get("scene_shoot_day_credited", F.lit(0)), F.to_json("characters_in_scene")).isNotNull()
        )
        return self._keep(elements.withColumnRenamed("_VALUE", "_stray"), "scenes")

    @cached_property
    def _scenes(self) -> DataFrame:
        credited = F.transform("scene_shoot_day_credited", clean_text)
        return self._elements.select(
            *pick(scene_fields()),
            shoot_day_number(F.try_element_at(credited, F.lit(1))).alias("shootDayCredited"),
            F.try_element_at(credited, F.lit(2)).alias("eighthsCredited"),
            F.coalesce(F.size("scene_shoot_day_credited"), F.lit(0)).alias("_credited_count"),
            clean_text("_stray").alias("_stray"),
            F.struct(*pick(scene_fields(), resolve=False)).alias("_raw"),
            "file_path", ORDER,
        )

    @cached_property
    def scenes(self) -> DataFrame:
        return self._scenes.drop("_raw")

    @cached_property
    def scene_characters(self) -> DataFrame:
        return self._elements.select(
            sentinel_null(clean_text("scene_number")).alias("narrativeScene"), "file_path", ORDER,
            F.posexplode("characters_in_scene.character_in_scene").alias("_position", "_c"),
        ).select(
            "narrativeScene",
            clean_text("_c.character_in_scene_number").alias("characterNumber"),
            clean_text("_c.character_in_scene_name").alias("characterName"),
            "file_path",
            F.struct(F.col(ORDER).alias("scene"), F.col("_position").alias("position")).alias(ORDER),
        )

    @cached_property
    def _days(self) -> DataFrame:
        return self._keep(self._rows("shoot_day", text_schema([f.tag for f in day_fields()])), "days")

    @cached_property
    def _shoot_days(self) -> DataFrame:
        raw = F.struct(*pick(day_fields(), resolve=False)).alias("_raw")
        return self._days.select(*pick(day_fields()), raw, "file_path", ORDER)

    @cached_property
    def shoot_days(self) -> DataFrame:
        return self._shoot_days.drop("_raw")

    @cached_property
    def _shots(self) -> DataFrame:
        """Cells of the takes, cleaned once for all that read them."""
        take_schema = text_schema([f.tag for f in take_fields()])
        take_schema = take_schema.add(
            "related_scenes", text_schema(["episode"], {"scene": None})
        ).add("characters_in_scenes", text_schema([], {"character": ["character_number", "character_name"]}))
        shots = self._rows("shot_properties", take_schema).select(
            *pick(take_fields(), resolve=False),
            _related_scenes("related_scenes.scene").alias("narrativeScene"),
            clean_text("related_scenes.episode").alias("episode"),
            F.col("characters_in_scenes.character").alias("_characters"),
            "file_path", ORDER,
        )
        return self._keep(shots, "shots")

    @cached_property
    def _takes(self) -> DataFrame:
        fields = take_fields()
        picked = self._shots.select(
            *[resolved(f, F.col(f.column)).alias(f.column) for f in fields],
            "narrativeScene", "episode", "_characters",
            F.struct(*[f.column for f in fields]).alias("_raw"),
            "file_path", ORDER,
        )
        return (
            split_slate_columns(picked)
            .withColumn("slateFullName", slate_full_name("_slate", "take"))
            .withColumn("productionScene", F.col("slate"))
            .withColumn("recordedTimeSeconds", recorded_seconds("recordedTime"))
            .withColumn("takeAnnotation", take_annotation("take"))
        )

    @cached_property
    def takes(self) -> DataFrame:
        return self._takes.drop("_characters", "_slate", "_raw")

    @cached_property
    def take_characters(self) -> DataFrame:
        return self._takes.select(
            "slateFullName", "productionScene", "narrativeScene", "slate", "camera", "take", "file_path", ORDER,
            F.posexplode("_characters").alias("_position", "_c"),
        ).select(
            "slateFullName", "productionScene", "narrativeScene", "slate", "camera", "take",
            clean_text("_c.character_number").alias("characterNumber"),
            clean_text("_c.character_name").alias("characterName"),
            "file_path",
            F.struct(F.col(ORDER).alias("take"), F.col("_position").alias("position")).alias(ORDER),
        )

    @cached_property
    def _context(self) -> DataFrame:
        first = lambda df, name: df.groupBy("file_path").agg(
            F.min_by("shootDay", ORDER).alias(name)
        )
        context = (
            self.header.select("file_path", "productionName")
            .join(first(self.shoot_days, "_day"), "file_path", "left")
            .join(first(self.takes, "_take_day"), "file_path", "left")
            .select("file_path", "productionName", F.coalesce("_day", "_take_day").alias("shootDay"))
        )
        # Every table joins it, and it sorts all takes by file.
        return self._keep(context, "context")

    def context(self) -> DataFrame:
        """One row per file: its production and its day, the first shoot day's or first take's."""
        return self._context

    def tables(self) -> dict[str, DataFrame]:
        """The five interim tables, each naming its production and day."""
        context = self.context()
        take_columns = [*TAKE_LEAD, *[f.column for f in take_fields() if f.column not in TAKE_LEAD], "recordedTimeSeconds"]
        shapes = {
            "shootDay": (self.shoot_days, [f.column for f in day_fields()]),
            "narrativeScenes": (self.scenes, [*[f.column for f in scene_fields()], "shootDayCredited", "eighthsCredited"]),
            "narrativeSceneCharacters": (self.scene_characters, SCENE_CHARACTER_COLUMNS),
            "takes": (self.takes, take_columns),
            "takeCharacters": (self.take_characters, TAKE_CHARACTER_COLUMNS),
        }
        out = {}
        for name, (df, columns) in shapes.items():
            shared = [c for c in ("productionName", "shootDay") if c not in columns]
            joined = df.join(context.select("file_path", *shared), "file_path", "left")
            out[name] = project(joined, columns, ["productionName", "shootDay"])
        return out

    def take_key(self) -> Column:
        return take_key("slate", "wildTrackNumber", "camera", "take")

    def totals(self) -> DataFrame:
        """One row: takes, distinct slates (no slate counts as one), wild tracks, scenes, days."""
        takes = self.takes.agg(
            F.count("*").alias("takes"),
            distinct_values("slate").alias("distinct_slates"),
            F.count_if("isWildTrack").alias("wild_tracks"),
        )
        return takes.withColumn(
            "scenes", self.scenes.agg(F.count("*")).scalar()
        ).withColumn("shoot_days", self.shoot_days.agg(F.count("*")).scalar())

    def notes(self) -> DataFrame:
        """Everything worth reporting about the extraction."""
        repeated = note_rows(
            self.scenes.filter("_credited_count > 2"), "unexpectedRepeatedTag",
            F.concat(F.lit("scene "), F.coalesce("narrativeScene", F.lit("null"))),
            F.concat("_credited_count", F.lit(" elements scene_shoot_day_credited, of which two have a meaning")),
        )
        stray = note_rows(
            self.scenes.filter(F.col("_stray").isNotNull()), "strayText",
            F.concat(F.lit("scene "), F.coalesce("narrativeScene", F.lit("null"))),
            F.concat(F.lit('text outside of any element: "'), "_stray", F.lit('"')),
        )
        who = F.struct("characterNumber", "characterName")
        earlier = self.scene_characters.groupBy("file_path", "narrativeScene", f"{ORDER}.scene", who.alias("_who")).agg(
            (F.count("*") - 1).alias("repeats")
        ).filter("repeats > 0")
        characters = note_rows(
            # The members of one scene's cast list; each repeat is a finding of its own.
            earlier.withColumn("_each", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))),
            "duplicateCharacter",
            F.concat(F.lit("scene "), F.coalesce("narrativeScene", F.lit("null"))),
            F.concat(F.col("_who.characterName"), F.lit(" (#"), F.col("_who.characterNumber"), F.lit(") repeats in the cast list")),
        )
        # What one pass over a table finds in its columns.
        over = lambda df, *copied: self._keep(
            column_findings(df.drop("file_path", "_slate", "_stray"), "_raw", *copied), "findings"
        )
        of_takes = over(self._takes, "distance", "lensHeight")
        findings = [of_takes, over(self._scenes), over(self._shoot_days)]
        leaked = reduce(DataFrame.unionByName, [found_leaks(f) for f in findings]).distinct()
        tallies = reduce(DataFrame.unionByName, [found_sentinels(f) for f in findings])
        sentinels = tallies.groupBy("field").agg(F.sum("n").alias("n"))
        # A key is repeated within its production and day, in however many files they are delivered.
        context = self.context().select("file_path", "productionName", F.col("shootDay").alias("_day"))
        dated = self.takes.join(context, "file_path", "left").withColumn("_day", F.coalesce("shootDay", "_day"))
        repeats = duplicate_keys(dated, [F.col("productionName"), F.col("_day"), self.take_key().alias("_key")])
        duplicates = self._keep(repeats, "duplicates")
        copied = found_copied(of_takes).filter("copied")
        field = F.concat(F.lit("field "), F.col("field"))
        return all_notes(
            [
                repeated,
                stray,
                characters,
                note_rows(leaked, "objectDescription", field, "holds the printed form of a program object instead of a value"),
                note_rows(
                    duplicates, "duplicateTakeKey", F.col("_key"),
                    F.concat("n", F.lit(" takes of one day have this key; sources compare only the last")),
                ),
                note_rows(copied, "duplicatedField", "shot_properties", "distance is identical to lensHeight for every take"),
                note_rows(
                    sentinels, "sentinelNull", field,
                    F.concat("n", F.lit(f' value(s) were the literal "{SENTINEL}" and count as absent')),
                ),
            ]
        )


def read_delivery(spark: SparkSession, path: str | list[str], staged: bool = False, recursive: bool = False) -> Delivery:
    """Scan the primary exports of any number of days.

    With ``staged`` the four scans are stored as tables first, so that XML is parsed once however
    many tables, checks and entities are made from it.  ``recursive`` reads every file below the path,
    which lists many folders in parallel where a glob is resolved by the driver alone.
    """
    return Delivery(spark, path, staged, recursive)


# --- witnesses ----------------------------------------------------------------------------


def read_witness_a(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Take rows of the metadata XML."""
    schema = text_schema([*[f.tag for f in witness_a_tags()], "ProductionName", "SourceType"]).add(
        "RelatedScenes", text_schema([], {"Scene": None})
    )
    rows = xml_rows(spark, path, WITNESS_A_ROW, schema).select(
        *pick(witness_a_tags()),
        clean_text("ProductionName").alias("productionName"),
        clean_text("SourceType").alias("sourceType"),
        _related_scenes("RelatedScenes.Scene").alias("narrativeScene"),
        "file_path", ORDER,
    )
    return split_slate_columns(rows).drop("_slate")


def read_witness_b(spark: SparkSession, path: str | list[str], multiline: bool | None = None) -> DataFrame:
    """Take rows of the camera-log CSV; ``_malformed`` marks rows that do not parse."""
    rows = csv_rows(spark, path, multiline=multiline)
    absent = lambda name: F.col(f"`{name}`") if name in rows.columns else F.lit(None).cast("string")
    picked = rows.select(
        *[absent(f.tag).alias(f.column) for f in witness_b_columns()],
        absent("Scene").alias("narrativeScene"),
        absent("Circled").alias("Circled"),
        CORRUPT, "file_path", ORDER,
    )
    return split_slate_columns(picked).drop("_slate")


def with_take_key(takes: DataFrame) -> DataFrame:
    return takes.withColumn("take_key", take_key("slate", "wildTrackNumber", "camera", "take"))


#: The day a row was delivered for: labels are unique within a day, not over all of them.
DAY = "delivery_day"


def with_delivery_day(df: DataFrame) -> DataFrame:
    """Rows with the day of their folder in the layout of ``day_path``; blank outside of it."""
    return df.withColumn(DAY, F.regexp_extract("file_path", "/day=([^/]+)/", 1))


def comparison_keys(*sides: DataFrame) -> list[str]:
    """The take key, within the day where all sides have one."""
    return [DAY, "take_key"] if all(DAY in df.columns for df in sides) else ["take_key"]


def compare_witness(primary: DataFrame, witness: DataFrame, which: str, keys: list[str] | None = None, delivered: bool = True) -> Reconciliation:
    """Compare takes with witness ``a`` or ``b``; both sides carry ``take_key``, and are compared day by
    day when both have been given their ``with_delivery_day``."""
    keys = keys or comparison_keys(primary, witness)
    return Reconciliation(primary, witness, keys, compared_fields(which), delivered)


def compare_witnesses(
    primary: DataFrame, witnesses: dict[str, DataFrame | None], keys: list[str], carried: tuple[str, ...] = ()
) -> tuple[dict[str, Reconciliation], DataFrame]:
    """``compare_witness`` of several witnesses at once, stored; also the primary's last take per key with
    the columns ``carried``.  A witness that is None was not delivered."""

    def side(which: str) -> Witness:
        fields, witness = compared_fields(which), witnesses[which]
        if witness is None:
            absent = sorted({f.right for f in shared_fields(fields)} - set(keys))
            witness = primary.filter(F.lit(False)).select(*keys, *[F.lit(None).cast("string").alias(c) for c in absent])
        return Witness(witness, fields, delivered=witnesses[which] is not None)

    return reconcile_witnesses(primary, {which: side(which) for which in witnesses}, keys, carried)


def circled_against_select(
    primary: DataFrame, witness_b: DataFrame, keys: list[str] | None = None, unique: bool = False
) -> DataFrame:
    return cross_tab(primary, witness_b, keys or comparison_keys(primary, witness_b), "Circled", "selectType", unique)


def fidelity_report(
    primary: DataFrame, witnesses: dict[str, DataFrame | None], notes: DataFrame | None = None, keys: list[str] | None = None
) -> DataFrame:
    """How far the witnesses bear out the primary export, as ``report(section, name, value)``.

    Row counts of each side, keys matched and missing, verdict, differences per field, fields that only
    the primary export has, the flag of witness ``b`` against the primary's class, and the notes by kind.
    A witness that is None was not delivered.
    """
    keys = keys or comparison_keys(primary, *[w for w in witnesses.values() if w is not None])
    delivered = {which: w for which, w in witnesses.items() if w is not None}
    if "b" in delivered:
        # Read for its comparison, its flags and its rows: parsed once.
        read = [*keys, "Circled", *sorted({f.right for f in shared_fields(compared_fields("b"))} - {*keys, "Circled"})]
        order = [ORDER] if ORDER in delivered["b"].columns else []
        delivered["b"] = stage(delivered["b"].select(*[f"`{c}`" for c in read], *order), "witness-b")
    parts = [table_counts({"primary": primary}, "rows")]
    row = lambda section, name, value: F.struct(
        F.lit(section).alias("section"), name.alias("name"), value.cast("bigint").alias("value")
    )
    carried = ("selectType",) if "b" in delivered else ()
    outcomes, last = {}, None
    if witnesses:
        outcomes, last = compare_witnesses(primary, {w: delivered.get(w) for w in witnesses}, keys, carried)
    for which, compared in outcomes.items():
        fields = compared_fields(which)
        if which in delivered:
            parts.append(table_counts({f"witness {which}": delivered[which]}, "rows"))
        figures = ["matched", "only_left", "only_right", "mismatches", "one_sided"]
        lines = [row(f"keys {which}", F.lit(c), F.col(c)) for c in figures]
        lines.append(row(f"verdict {which}", F.col("verdict"), F.lit(1)))
        lines.extend(row(f"only in primary {which}", F.lit(f.name), F.lit(1)) for f in left_only_fields(fields))
        parts.append(compared.summary().select(F.inline(F.array(*lines))))
        named = row(f"fields {which}", F.concat_ws(" ", "field", "difference"), F.col("n"))
        parts.append(compared.by_field().select(F.inline(F.array(named))))
    if "b" in delivered:
        flags = circled_against_select(last, delivered["b"], keys, unique=True)
        parts.append(flags.select(F.inline(F.array(row("circled", F.concat_ws(" / ", "flag", "label"), F.col("n"))))))
    if notes is not None:
        parts.append(report_rows(notes, "notes", "kind"))
    return reduce(DataFrame.unionByName, parts)


# --- mappings -----------------------------------------------------------------------------


# Entity types, property paths, columns and titles that results are compared by.
def delivery_mappings() -> list[Mapping]:
    """Six entity types from takes, scenes and delivered files."""
    scene = Mapping(
        "ProductionScene", "takes", "productionScene", grain="group", skip_empty_key=True,
        properties={
            "label": "productionScene",
            "productionSceneName.fullName": "productionScene",
            "sceneNumber": "productionScene",
            "sceneHeader": Source(
                "narrativeScene", split=";", when="single", lookup=Lookup("narrativeScenes", "narrativeScene", "heading")
            ),
            "sceneDescriptor": Source("shotDescription", when="unanimous"),
        },
        custom=Rest(DOMAIN, exclude=(*NO_INFORMATION, "slate", "slateFullName", "take")),
        edges=(
            Edge("Slate", "slateFullName", inverse=True),
            Edge("NarrativeScene", "narrativeScene", split=";", inverse=True),
        ),
    )
    slate = Mapping(
        "Slate", "takes", "slateFullName",
        properties={
            "label": "slateFullName",
            "slateName.fullName": "slateFullName",
            "description": "shotDescription",
            "cameraLabel": "camera",
            "cameraUnit": "unit",
            "cameraRoll": "cameraRoll",
            "soundRoll": "soundRoll",
            "shootDate": "shootDate",
            "shootDay": Source("shootDay", cast="number"),
            "recordingFPS": Source("recordingFPS", cast="number"),
        },
        texts={
            "annotation": (
                Text("Comment", "comment"), Text("Technical Comment", "technicalComment"), Text("VFX Notes", "vfxNotes"),
            )
        },
        custom=Rest(DOMAIN, exclude=(*NO_INFORMATION, "slate", "productionScene")),
    )
    narrative = Mapping(
        "NarrativeScene", "narrativeScenes", "narrativeScene", grain="group",
        properties={
            "label": "heading", "sceneNumber": "narrativeScene", "narrativeSceneName.fullName": "heading",
        },
        texts={
            "slugline": (Text("Scene Slug", "slug"),),
            "annotation": (Text("Script Supervisor Questions", "questions"),),
        },
        custom=Rest(DOMAIN, exclude=(*NO_INFORMATION, "heading", "shootDay", "scriptRevision")),
        edges=(
            Edge("Character", "characterName", source=FromTable("narrativeSceneCharacters", "narrativeScene"), external=True),
        ),
    )
    asset = Mapping(
        "Asset", "assets", "fileName",
        properties={
            "label": "description",
            "assetName.fullName": "description",
            "description": "description",
            "assetFunction.assetFunctionType": Source(const=ASSET_FUNCTION),
        },
        custom=Rest(
            DOMAIN,
            exclude=(
                *NO_INFORMATION, "fileName", "filePath", "fileExtension", "mediaType", "fileSize",
                "assetStructureType", "assetFunctionType", "printDate",
            ),
        ),
        edges=(Edge("AssetStructure", "fileName"), Edge("Provenance", "fileName")),
    )
    details = "assetStructureProperties.fileDetails"
    structure = Mapping(
        "AssetStructure", "assets", "fileName",
        properties={
            "label": "fileName",
            "assetStructureName.fullName": "fileName",
            "assetStructureType": "assetStructureType",
            f"{details}.fileName": "fileName",
            f"{details}.filePath": "filePath",
            f"{details}.fileExtension": "fileExtension",
            f"{details}.mediaType": "mediaType",
        },
    )
    provenance = Mapping(
        "Provenance", "assets", "fileName",
        properties={
            "createdOn": Source("printDate", cast="datetime"),
            "reason": Source(const=PROVENANCE_REASON),
        },
    )
    return [scene, slate, narrative, asset, structure, provenance]


def assets_table(classified: DataFrame, production: str | None, day: str | None) -> DataFrame:
    """Classified file signatures as the ``assets`` table; a file's own day outranks ``day``.

    ``classified`` may lack the columns that only a report header gives; they are then null.
    """
    have = set(classified.columns)
    text = lambda name: F.col(name) if name in have else F.lit(None).cast("string")
    return classified.select(
        F.lit(production).cast("string").alias("productionName"),
        F.coalesce(text("shoot_day"), F.lit(day).cast("string")).alias("shootDay"),
        F.col("file_name").alias("fileName"),
        F.col("document_type").alias("documentType"),
        "description",
        F.col("structure").alias("assetStructureType"),
        F.when(F.col("document_type") != "unknown", F.lit(ASSET_FUNCTION)).alias("assetFunctionType"),
        F.col("classified_by").alias("classifiedBy"),
        text("print_date").alias("printDate"),
        text("shoot_date").alias("shootDate"),
        text("unit").alias("unit"),
        (F.col("page_count") if "page_count" in have else F.lit(None)).cast("int").alias("pageCount"),
        F.col("file_extension").alias("fileExtension"),
        F.col("media_type").alias("mediaType"),
        F.col("file_size").alias("fileSize"),
        F.col("path").alias("filePath"),
    )
