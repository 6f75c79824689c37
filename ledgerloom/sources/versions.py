"""Tables and models that are published together, one version after the other.

A version is a folder of its own. It counts from the moment its commit, a small numbered file that
names the folder, stands in ``_commits``; the commit is written elsewhere and then renamed to a number that
must be free, so a reader sees all of a version or the one before, whatever fails and whenever.
Readers take the commit with the highest number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from ledgerloom.session import hadoop_path

_COMMITS = "_commits"


@dataclass
class Version:
    """A published version: where it lies, and what was said about it."""

    number: int
    folder: str
    names: list[str] = field(default_factory=list)
    details: dict = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"


def _read(spark: SparkSession, path: str) -> str:
    files, place = hadoop_path(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, text: str) -> None:
    files, place = hadoop_path(spark, path)
    stream = files.create(place, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _numbers(spark: SparkSession, root: str) -> list[int]:
    files, place = hadoop_path(spark, f"{root}/{_COMMITS}")
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _version(spark: SparkSession, root: str, number: int) -> Version:
    said = json.loads(_read(spark, f"{root}/{_COMMITS}/{number:012d}.json"))
    return Version(number, f"{root}/{said['folder']}", said["names"], said["details"])


def current(spark: SparkSession, root: str) -> Version | None:
    """The latest version, or None if there is none."""
    numbers = _numbers(spark, root)
    return _version(spark, root, numbers[-1]) if numbers else None


def stage(root: str) -> str:
    """The path of a new folder for a version that is being written."""
    return f"{root}/version-{uuid.uuid4().hex}"


def commit(
    spark: SparkSession, root: str, folder: str, names: list[str], details: dict | None = None
) -> Version:
    """Make what was written to ``folder``, a path from ``stage``, the latest version."""
    said = json.dumps({"folder": folder.removeprefix(f"{root}/"), "names": names, "details": details or {}})
    draft = f"{root}/{_COMMITS}/.draft-{uuid.uuid4().hex}"
    files, place = hadoop_path(spark, draft)
    files.mkdirs(place.getParent())
    _write(spark, draft, said)
    while True:
        number = max(_numbers(spark, root), default=0) + 1
        target = hadoop_path(spark, f"{root}/{_COMMITS}/{number:012d}.json")[1]
        # Another writer may take the number first; then the next one is tried.
        if not files.exists(target) and files.rename(place, target):
            return _version(spark, root, number)


def publish(
    spark: SparkSession, root: str, names: list[str], write: Callable[[str], dict | None]
) -> Version:
    """Write a version by ``write(folder)``, which returns its details, and commit it. What a
    failed ``write`` leaves behind is deleted."""
    folder = stage(root)
    try:
        details = write(folder)
    except BaseException:
        files, place = hadoop_path(spark, folder)
        files.delete(place, True)
        raise
    return commit(spark, root, folder, names, details)


def forget(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` versions, commits first, and return how many."""
    old = _numbers(spark, root)[:-keep]
    for number in old:
        version = _version(spark, root, number)
        for path in (f"{root}/{_COMMITS}/{number:012d}.json", version.folder):
            files, place = hadoop_path(spark, path)
            files.delete(place, True)
    return len(old)
