"""Stored tables as folders that never change, and a log of commits that says which folders are current.

A writer fills new folders, then adds one small file to the log. Until that file is there readers see the old folders, and
from then on the new ones, all of them at once. A commit is written under another name and renamed, so half a commit is never read.
One writer at a time is assumed; two that start from the same commit collide in its number, and the later one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession

LOG = "_commits"
# Commits whose folders stay: the current one and the one that running readers may still use.
KEPT = 2


class CommitError(RuntimeError):
    """A commit could not be added to the log."""


@dataclass(frozen=True)
class Commit:
    """Folders by name, relative to the root, and what is known of them."""

    number: int
    folders: dict[str, str]
    facts: dict[str, Any] = field(default_factory=dict)


def file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The file system of a path, and the path, as Hadoop sees them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file that this library wrote."""
    files, folder = file_system(spark, path)
    files.delete(folder, True)


def rename(spark: SparkSession, old: str, new: str) -> bool:
    """Whether a file or folder now has its new name; never over one that is there."""
    files, source = file_system(spark, old)
    target = file_system(spark, new)[1]
    return not files.exists(target) and files.rename(source, target)


def new_version() -> str:
    return uuid.uuid4().hex


def _commits(spark: SparkSession, root: str) -> list[Commit]:
    """All commits, oldest first."""
    files, log = file_system(spark, f"{root}/{LOG}")
    if not files.exists(log):
        return []
    found = []
    for status in files.listStatus(log):
        name = status.getPath().getName()
        if name.endswith(".json") and not name.startswith("."):
            stream = files.open(status.getPath())
            try:
                content = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
            found.append(Commit(int(name.removesuffix(".json")), content["folders"], content["facts"]))
    return sorted(found, key=lambda c: c.number)


def current(spark: SparkSession, root: str) -> Commit | None:
    """The last commit under ``root``, if there is one."""
    return next(reversed(_commits(spark, root)), None)


def commit(
    spark: SparkSession,
    root: str,
    folders: Mapping[str, str],
    facts: Mapping[str, Any] | None = None,
    after: Commit | None = None,
) -> Commit:
    """Make ``folders`` the current ones; ``after`` is the commit they replace."""
    made = Commit((after.number if after else 0) + 1, dict(folders), dict(facts or {}))
    target = f"{root}/{LOG}/{made.number:012d}.json"
    beside = f"{root}/{LOG}/.{made.number:012d}-{uuid.uuid4().hex}"
    files, path = file_system(spark, beside)
    stream = files.create(path, False)
    try:
        stream.write(json.dumps({"folders": made.folders, "facts": made.facts}).encode())
    finally:
        stream.close()
    if not rename(spark, beside, target):
        remove(spark, beside)
        raise CommitError(f"{target} could not be written")
    return made


def retract(spark: SparkSession, root: str, made: Commit) -> None:
    """Take a commit back: the one before it is current again."""
    remove(spark, f"{root}/{LOG}/{made.number:012d}.json")


def prune(spark: SparkSession, root: str, kept: int = KEPT) -> None:
    """Remove all but the last commits, and the folders that only those name."""
    commits = _commits(spark, root)
    old, new = commits[:-kept], commits[-kept:]
    held = {folder for c in new for folder in c.folders.values()}
    for c in old:
        for folder in set(c.folders.values()) - held:
            remove(spark, f"{root}/{folder}")
        remove(spark, f"{root}/{LOG}/{c.number:012d}.json")
