"""Folder trees as adjacency lists.

Only folders need iteration.  Their paths are found by pointer doubling: in every round each
folder replaces its pointer by its pointer's pointer and prepends the path between, so a tree of
depth ``d`` needs ``log2(d)`` joins over the folders, not ``d``.  Files, stacks and unknown
children then join their folder once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import child_path
from ..session import cut_lineage
from .notes import all_notes, note_rows
from .order import head_of_stack


@dataclass(frozen=True)
class Walk:
    """What a walk found: folders and files with paths, and notes."""

    folders: DataFrame
    files: DataFrame
    too_deep: DataFrame
    empty_stacks: DataFrame
    unknown: DataFrame

    def notes(self) -> DataFrame:
        return all_notes(
            [
                note_rows(self.too_deep, "tooDeep", F.col("path"), "left unread: below the depth limit"),
                note_rows(self.empty_stacks, "emptyVersionStack", F.col("path"), "stack without files"),
                note_rows(
                    self.unknown, "unknownChildType", F.col("path"),
                    F.concat(F.lit('children of type "'), "type", F.lit('" are skipped')),
                ),
            ]
        )


def folder_paths(folders: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``(id, root_id, path, depth)`` of every folder below a root, or within ``max_depth + 1`` of one.

    ``folders(id, parent_id, name)`` and ``roots(id)``; a root's own path is ``/``.  Folders that
    reach no root, cycles included, do not appear, as a walk from the root never meets them.
    Joins look up a unique folder id, and the skewed side is the one Spark can split.
    """
    steps = folders.join(roots, "id", "left_anti").select(
        "id",
        F.col("parent_id").alias("at"),
        child_path(F.lit(""), "name", folder=True).alias("path"),
        F.lit(1).alias("depth"),
        F.lit(False).alias("done"),
    )
    top = roots.select(
        "id", F.col("id").alias("at"), F.lit("/").alias("path"), F.lit(0).alias("depth"), F.lit(True).alias("done")
    )
    state = cut_lineage(steps.unionByName(top))
    while True:
        waiting = state.filter(~F.col("done"))
        if waiting.isEmpty():
            break
        target = state.select(
            F.col("id").alias("at"),
            F.col("at").alias("_at"),
            F.col("path").alias("_path"),
            F.col("depth").alias("_depth"),
            F.col("done").alias("_done"),
        )
        moved = (
            waiting.join(target, "at")
            .select(
                "id",
                F.col("_at").alias("at"),
                F.concat("_path", "path").alias("path"),
                (F.col("_depth") + F.col("depth")).alias("depth"),
                F.col("_done").alias("done"),
            )
        )
        if max_depth is not None:
            moved = moved.filter(F.col("depth") <= max_depth + 1)
        moved = cut_lineage(moved)
        # Every round reaches folders twice as deep; one that reaches none leaves only cycles.
        if moved.filter("done").isEmpty():
            break
        state = cut_lineage(state.filter("done").unionByName(moved))
    return state.filter("done").select("id", F.col("at").alias("root_id"), "path", "depth")


def walk_tree(nodes: DataFrame, roots: DataFrame, max_depth: int | None = None) -> Walk:
    """Walk ``nodes(parent_id, id, type, name, position, head_version?)`` from ``roots(id)``.

    Without ``max_depth`` the whole tree is walked.  With it, a folder at ``max_depth + 1`` is reported
    and not descended into; what lies below it is not part of the walk.  A version stack contributes its one head file.
    """
    folders = nodes.filter(F.col("type") == "folder").select("id", "parent_id", "name")
    reached = folder_paths(folders, roots, max_depth)
    deep = F.lit(False) if max_depth is None else F.col("depth") > max_depth
    inside = reached.filter(~deep)
    # A child is placed by its folder's id, which is unique, so a folder that holds a third of
    # all files is split by the skew join and never multiplied.
    placed = nodes.filter(F.col("type") != "folder").join(
        inside.select(F.col("id").alias("parent_id"), F.col("path").alias("folder_path"), "depth"),
        "parent_id",
    )
    plain = placed.filter(F.col("type") == "file").select(
        "id", "folder_path", child_path("folder_path", "name", folder=False).alias("path"),
        F.lit(None).cast(nodes.schema["id"].dataType).alias("stack_id"),
    )
    stacks = placed.filter(F.col("type") == "version_stack")
    heads = head_of_stack(stacks, nodes)
    names = nodes.select(
        F.col("id").cast("string").alias("head_id"), F.col("name").alias("_head_name"), F.col("id").alias("_head")
    )
    found = heads.filter(F.col("head_id").isNotNull()).join(names, "head_id").select(
        F.col("_head").alias("id"), "folder_path",
        F.concat("folder_path", F.coalesce("_head_name", F.lit(""))).alias("path"),
        F.col("id").alias("stack_id"),
    )
    label = F.concat("folder_path", F.coalesce("name", F.col("id").cast("string")))
    return Walk(
        folders=inside,
        files=plain.unionByName(found),
        too_deep=reached.filter(deep),
        empty_stacks=heads.filter(F.col("head_id").isNull()).select("id", label.alias("path")),
        unknown=placed.filter(~F.col("type").isin("file", "version_stack")).select("id", "type", label.alias("path")),
    )
