"""Versioned folders with an atomic publish.

A versioned table is a root folder with immutable data folders and small manifests:

    <root>/data/part=<version>-<id>/...     written once, never changed
    <root>/manifests/<version>.json    what a version consists of

A writer stages data folders and then publishes a manifest that names them. The manifest is written
under another name and renamed into place, which the file system does at once or not at all, so a
reader sees the version before or the version after, whenever the writer is killed. Folders that no
manifest names are invisible; :func:`vacuum` removes them later. Two writers that started from the same
version can't both publish: the second one's rename finds the name taken.

The rename must be atomic and must not replace an existing file (HDFS, local and network file systems);
on object stores without such a rename a table format with its own commit service takes this place.
Only names, versions and the manifests' few entries pass through the driver, never data."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ConcurrentPublish(RuntimeError):
    """Another writer has published the version that this one was based on."""


@dataclass
class Manifest:
    """A published (or staged) version: its number and what it says."""

    version: int
    content: dict[str, Any] = field(default_factory=dict)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, hidden ones left out; empty if there is no such folder."""
    fs, p = _fs(spark, path), _path(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in names if not n.startswith((".", "_")))


def _manifests(root: str) -> str:
    return f"{root.rstrip('/')}/manifests"


def versions(spark: SparkSession, root: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in list_folder(spark, _manifests(root)) if n.endswith(".json")]


def read_manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest | None:
    """The newest published version (or ``version``), None where nothing was published. An unreadable
    manifest is an error: it isn't an empty table."""
    if version is None:
        published = versions(spark, root)
        if not published:
            return None
        version = published[-1]
    path = f"{_manifests(root)}/{version:012d}.json"
    file = _fs(spark, path).open(_path(spark, path))
    try:
        return Manifest(version, json.loads(bytes(file.readAllBytes())))
    finally:
        file.close()


def stage_folder(root: str, base: Manifest | None) -> str:
    """A fresh data folder for the version after ``base``."""
    return f"{root.rstrip('/')}/data/part={(base.version if base else 0) + 1:012d}-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, root: str, base: Manifest | None, content: dict[str, Any]) -> Manifest:
    """Makes ``content`` the version after ``base``, at once or not at all."""
    made = Manifest((base.version if base else 0) + 1, content)
    name, folder = f"{made.version:012d}.json", _manifests(root)
    draft = _path(spark, f"{folder}/_{name}.{uuid.uuid4().hex[:12]}")
    fs = _fs(spark, folder)
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(content, indent=1, sort_keys=True).encode()))
    finally:
        out.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(draft).toUri(), spark._jsc.hadoopConfiguration())
    never_replace = spark._sc._gateway.new_array(options, 1)
    never_replace[0] = options.NONE
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(_path(spark, f"{folder}/{name}")), never_replace)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
            raise ConcurrentPublish(f"{root}: version {made.version} was published by another writer") from e
        raise
    return made


def folders_of(content: Any, root: str) -> set[str]:
    """Names of the data folders that a manifest's content mentions anywhere."""
    if isinstance(content, dict):
        return set().union(*(folders_of(v, root) for v in content.values()))
    if isinstance(content, list):
        return set().union(*(folders_of(v, root) for v in content))
    start = f"{root.rstrip('/')}/data/"
    return {content[len(start):].split("/")[0]} if isinstance(content, str) and content.startswith(start) else set()


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Removes manifests but the newest ``keep`` and the data folders that those don't name. Folders staged
    for a version to come are left alone. Readers of older versions must have ended."""
    published = versions(spark, root)
    if not published:
        return []
    kept = published[-max(keep, 1):]
    named = set().union(*(folders_of(read_manifest(spark, root, v).content, root) for v in kept))
    gone = [n for n in list_folder(spark, f"{root.rstrip('/')}/data") if n not in named and int(n.removeprefix("part=").split("-")[0]) <= published[-1]]
    fs = _fs(spark, root)
    for v in published[:-len(kept)]:  # first the names, then what they named
        fs.delete(_path(spark, f"{_manifests(root)}/{v:012d}.json"), False)
    for n in gone:
        fs.delete(_path(spark, f"{root.rstrip('/')}/data/{n}"), True)
    return gone
