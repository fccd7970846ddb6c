"""The folder-tree catalogue: files, metadata and comment threads to tables and mappings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ext_name, slate_id
from ..operators.eav import pairs_to_map, shadowed_notes, unclassified_media, without_structural_names
from ..operators.notes import all_notes, note_rows
from ..operators.rules import prefix_class
from .mapping import Edge, Mapping, Rest, Source

# Structure per media-type prefix, the first match wins.
MEDIA_STRUCTURES = [
    ("image/", "digital.image"),
    ("video/", "digital.movingImage"),
    ("audio/", "digital.audio"),
    ("text/csv", "digital.data"),
    ("text/", "digital.document"),
    ("application/pdf", "digital.document"),
    ("application/msword", "digital.document"),
    ("application/vnd.openxmlformats-officedocument.wordprocessingml", "digital.document"),
    ("application/rtf", "digital.document"),
    ("application/json", "digital.data"),
    ("application/xml", "digital.data"),
    ("application/vnd.ms-excel", "digital.data"),
    ("application/vnd.openxmlformats-officedocument.spreadsheetml", "digital.data"),
    ("application/zip", "digital.data"),
]
FALLBACK_STRUCTURE = "digital"
DOMAIN = "Frame.io"
SOURCE_SCOPE = "frame.io"

# Columns every file has, and metadata fields the source derives itself.
STRUCTURAL_COLUMNS = [
    "fileId", "fileName", "filePath", "fileExtension", "mediaType", "fileSize", "assetStructureType",
    "frameioAccountId", "frameioProjectId", "frameioProjectName", "frameioWorkspaceId", "frameioParentId",
    "frameioVersionStackId", "frameioViewUrl", "frameioStatus", "frameioCreatedAt", "frameioUpdatedAt", "SlateId",
]
DERIVED_COLUMNS = [
    "Alpha Channel", "Audio Bit Depth", "Audio Bit Rate", "Audio Channels", "Audio Codec", "Audio Sample Rate",
    "Bit Rate", "Color Space", "Comment Count", "Date Uploaded", "Duration", "Dynamic Range", "End Time",
    "File Size", "File Type", "Format", "Frame Rate", "Name", "Page Count", "Resolution - Height",
    "Resolution - Width", "Seen By", "Source Filename", "Start Time", "Transcript", "Uploader",
    "Video Bit Rate", "Video Codec", "Visual Bit Depth",
]


def structure_for(media_type: Column | str) -> Column:
    return F.coalesce(prefix_class(media_type, MEDIA_STRUCTURES), F.lit(FALLBACK_STRUCTURE))


def structure_known(media_type: Column | str) -> Column:
    return prefix_class(media_type, MEDIA_STRUCTURES).isNotNull()


def check_structures(allowed: set[str]) -> None:
    """Fail before any data is read when the table names a value the target does not allow."""
    used = {value for _, value in MEDIA_STRUCTURES} | {FALLBACK_STRUCTURE}
    bad = sorted(used - allowed)
    if bad:
        raise ValueError(f"structure values not allowed: {', '.join(bad)}")


def file_rows(files: DataFrame, declared: list[str], project: str, account: str | None = None, project_name: str | None = None, workspace: str | None = None) -> DataFrame:
    """The ``files`` table, one row per walked file.

    ``files(id, name, media_type, file_size, parent_id, status, view_url, created_at, updated_at,
    folder_path, stack_id, metadata array<struct<name, mutable, value>>)``.  Declared metadata names
    become columns, those that would shadow a structural column do not, and the others stay in the
    ``metadata`` map.  All of it is a projection of one row.
    """
    values = files.withColumn("_all", pairs_to_map(F.coalesce("metadata", F.array().cast(files.schema["metadata"].dataType))))
    safe = without_structural_names("_all", STRUCTURAL_COLUMNS)
    columns = [c for c in declared if c not in STRUCTURAL_COLUMNS]
    literal = lambda v: F.lit(v).cast("string")
    return values.select(
        F.col("id").alias("fileId"),
        F.col("name").alias("fileName"),
        F.concat("folder_path", F.coalesce("name", F.lit(""))).alias("filePath"),
        ext_name("name").alias("fileExtension"),
        F.col("media_type").alias("mediaType"),
        F.col("file_size").alias("fileSize"),
        structure_for("media_type").alias("assetStructureType"),
        literal(account).alias("frameioAccountId"),
        literal(project).alias("frameioProjectId"),
        literal(project_name).alias("frameioProjectName"),
        literal(workspace).alias("frameioWorkspaceId"),
        F.col("parent_id").alias("frameioParentId"),
        F.col("stack_id").alias("frameioVersionStackId"),
        F.col("view_url").alias("frameioViewUrl"),
        F.col("status").alias("frameioStatus"),
        F.col("created_at").alias("frameioCreatedAt"),
        F.col("updated_at").alias("frameioUpdatedAt"),
        slate_id(F.try_element_at("_all", F.lit("Slate")), F.try_element_at("_all", F.lit("Take"))).alias("SlateId"),
        *[F.try_element_at("_all", F.lit(c)).alias(c) for c in columns],
        F.map_filter(safe, lambda k, v: ~k.isin(*columns) if columns else F.lit(True)).alias("metadata"),
    )


def file_notes(files: DataFrame) -> DataFrame:
    """Shadowed names, files without metadata and media types no rule knows."""
    mapped = files.withColumn("_all", pairs_to_map("metadata"))
    bare = files.agg(F.count_if(F.col("metadata").isNull()).alias("n")).filter("n > 0")
    unknown = unclassified_media(files.withColumn("_known", structure_known("media_type")), "media_type", "_known")
    return all_notes(
        [
            shadowed_notes(mapped, "_all", STRUCTURAL_COLUMNS),
            note_rows(bare, "metadataMissing", "files", F.concat("n", F.lit(" file(s) arrived with no metadata array"))),
            note_rows(
                unknown, "unclassifiedMediaType", F.col("media_type"),
                F.concat("n", F.lit(f' file(s) recorded as "{FALLBACK_STRUCTURE}"')),
            ),
        ]
    )


# Entity types, property paths and columns that results are compared by.
def catalogue_mappings() -> dict[str, list[Mapping]]:
    """Mappings per dataset: two entity types from files, comments folded onto one of them."""
    technical = tuple(c for c in DERIVED_COLUMNS if c != "Comment Count")
    on_structure = ("filePath", "fileExtension", "mediaType", "fileSize", "assetStructureType")
    identity = (
        "fileId", "frameioAccountId", "frameioProjectId", "frameioProjectName", "frameioWorkspaceId",
        "frameioParentId", "frameioVersionStackId", "frameioViewUrl", "frameioStatus", "frameioCreatedAt",
        "frameioUpdatedAt",
    )
    details = "assetStructureProperties.fileDetails"
    asset = Mapping(
        "Asset", "files", "fileId",
        properties={"label": "fileName", "assetName.fullName": "fileName"},
        custom=Rest(DOMAIN, exclude=(*on_structure, *technical)),
        edges=(Edge("AssetStructure", "fileId"),),
    )
    structure = Mapping(
        "AssetStructure", "files", "fileId",
        properties={
            "label": "fileName",
            "assetStructureName.fullName": "fileName",
            "assetStructureType": "assetStructureType",
            f"{details}.fileName": "fileName",
            f"{details}.filePath": "filePath",
            f"{details}.fileExtension": "fileExtension",
            f"{details}.mediaType": "mediaType",
        },
        custom=Rest(DOMAIN, exclude=identity, include=("fileSize", *technical)),
    )
    comments = Mapping(
        "Asset", "comments", "fileId",
        properties={
            "annotation[0].text": "commentText",
            "annotation[0].author": "commentAuthor",
            "annotation[0].title": Source("commentFrame", cast="string"),
        },
    )
    return {"files": [asset, structure], "comments": [comments]}
