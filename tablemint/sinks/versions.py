"""Publishing by pointer: versions in folders of their own, and small pointer objects written last.

A version is written to a new folder under ``out``.  It is published by one more object under
``out/_versions`` whose name begins with the version's number and whose text names the folder.  Nothing
is renamed, replaced or deleted on the way, so this holds on object stores: readers follow the pointer
with the highest number that is complete, and see one whole version at any time.  Two writers that take
the same number write pointers of different names; the order of names decides, alike for every reader.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from .tables import _file_system

POINTERS = "_versions"
#: Last line of a pointer; one without it is still being written.
_END = "end"


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    pointer: str


def new_version(out: str) -> str:
    """A folder for a version that no other writer uses and no pointer names yet."""
    return f"{out.rstrip('/')}/version-{uuid.uuid4().hex}"


def _listed(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Names and modification times (ms) of what a folder holds; none when it is absent."""
    files, location, _ = _file_system(spark, folder)
    if not files.exists(location):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in files.listStatus(location)]


def _text(spark: SparkSession, path: str) -> str | None:
    files, location, jvm = _file_system(spark, path)
    try:
        stream = files.open(location)
    except Exception as error:  # noqa: BLE001
        if "FileNotFoundException" in str(error):
            return None  # cleaned up since it was listed
        raise
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _put(spark: SparkSession, path: str, text: str) -> None:
    files, location, _ = _file_system(spark, path)
    stream = files.create(location, False)
    stream.write(bytearray(text.encode()))
    stream.close()


def versions(spark: SparkSession, out: str) -> list[Version]:
    """Published versions, the current one first.  Pointers that are not complete are left out."""
    out = out.rstrip("/")
    found = []
    for name, _ in sorted(_listed(spark, f"{out}/{POINTERS}"), reverse=True):
        number = name.split("-")[0]
        if not number.isdigit():
            continue
        lines = (_text(spark, f"{out}/{POINTERS}/{name}") or "").split("\n")
        if len(lines) == 2 and lines[1] == _END:
            found.append(Version(int(number), f"{out}/{lines[0]}", f"{out}/{POINTERS}/{name}"))
    return found


def current_version(spark: SparkSession, out: str) -> str:
    """The folder to read: that of the newest complete pointer."""
    found = versions(spark, out)
    if not found:
        raise FileNotFoundError(f"no version of {out} has been published")
    return found[0].folder


def publish_version(spark: SparkSession, out: str, folder: str) -> Version:
    """Make a finished folder the current version.

    The number is one more than the highest that stands, complete or not, so a later publication never
    sorts before an earlier one that had ended.
    """
    out, name = out.rstrip("/"), folder.rstrip("/").rsplit("/", 1)[1]
    taken = [int(n.split("-")[0]) for n, _ in _listed(spark, f"{out}/{POINTERS}") if n.split("-")[0].isdigit()]
    number = max(taken, default=0) + 1
    pointer = f"{out}/{POINTERS}/{number:012d}-{uuid.uuid4().hex}"
    _put(spark, pointer, f"{name}\n{_END}")
    return Version(number, f"{out}/{name}", pointer)


def clean_up(spark: SparkSession, out: str, keep: int = 2, unpublished_after_ms: int | None = None, now_ms: int | None = None) -> list[str]:
    """Delete versions but the newest ``keep``; returns the deleted folders.

    A pointer goes before its folder, so no pointer names a folder that is gone; readers that follow the
    current pointer are safe while fewer than ``keep`` versions are published during their read.  Folders
    that no pointer names are writers' work in progress and stay, unless ``unpublished_after_ms`` is given
    and they have not changed for that long before ``now_ms``.
    """
    if keep < 1:
        raise ValueError("at least the current version is kept")
    out = out.rstrip("/")
    published = versions(spark, out)
    held = {v.folder for v in published[:keep]}
    deleted = []

    def delete(path: str) -> None:
        files, location, _ = _file_system(spark, path)
        files.delete(location, True)

    for version in published[keep:]:
        delete(version.pointer)
        if version.folder not in held:
            delete(version.folder)
            deleted.append(version.folder)
    if unpublished_after_ms is not None and now_ms is not None:
        named = {v.folder for v in published}
        for name, changed in _listed(spark, out):
            folder = f"{out}/{name}"
            if name.startswith("version-") and folder not in named and now_ms - changed >= unpublished_after_ms:
                delete(folder)
                deleted.append(folder)
    return sorted(set(deleted))
