"""Stored tables in versions, so that replacing one is a single step and readers keep what they have.

A table's folder holds one folder per version and, for each published one, an empty file of the same
name among the pointers. The greatest pointer is the current version. Data are written first and
whole; creating the pointer publishes them. Nothing is deleted before that, so whoever stops between
the steps leaves the earlier version in place, and a plan made on it goes on reading it until it is
retired by ``keep`` later ones.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

VERSIONS, POINTERS = "versions", "_published"


def filesystem(spark: SparkSession, path: str):
    """The path and its file system, whatever storage Spark is set up for."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    where, files = filesystem(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []


def published(spark: SparkSession, path: str) -> list[str]:
    """Names of the published versions, oldest first."""
    return [n for n in children(spark, f"{path.rstrip('/')}/{POINTERS}") if n[:1].isdigit()]


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version."""
    names = published(spark, path)
    return f"{path.rstrip('/')}/{VERSIONS}/{names[-1]}" if names else None


def _point(spark: SparkSession, path: str, name: str) -> None:
    """Publish a version that is written whole: one atomic step."""
    where, files = filesystem(spark, f"{path}/{POINTERS}/{name}")
    files.create(where, False).close()


def _remove(spark: SparkSession, path: str) -> None:
    where, files = filesystem(spark, path)
    files.delete(where, True)


def publish(spark: SparkSession, path: str, write: Callable[[str], None], keep: int = 2) -> str:
    """Have ``write`` fill the folder of a new version, then make it the current one; returns its folder.

    The newest ``keep`` versions stay. Of two writers at once both succeed and the greater name is
    current. A plain table that stood in the folder before goes with the version it preceded.
    """
    path = path.rstrip("/")
    before = published(spark, path)
    number = int(before[-1].split("-")[0]) + 1 if before else 1
    name = f"{number:010d}-{uuid.uuid4().hex[:12]}"
    write(f"{path}/{VERSIONS}/{name}")
    _point(spark, path, name)
    for old in published(spark, path)[: -max(1, keep)]:
        # First the pointer: a version is never current without its data.
        _remove(spark, f"{path}/{POINTERS}/{old}")
        _remove(spark, f"{path}/{VERSIONS}/{old}")
    if len(before) >= keep:
        for stray in set(children(spark, path)) - {VERSIONS, POINTERS}:
            _remove(spark, f"{path}/{stray}")
    return f"{path}/{VERSIONS}/{name}"


def sweep(spark: SparkSession, path: str, older_than: float = 86_400.0) -> list[str]:
    """Remove what interrupted writers left, unless it changed within ``older_than`` seconds."""
    path, kept, gone = path.rstrip("/"), set(published(spark, path)), []
    for name in children(spark, f"{path}/{VERSIONS}"):
        where, files = filesystem(spark, f"{path}/{VERSIONS}/{name}")
        if name not in kept and files.getFileStatus(where).getModificationTime() / 1000 <= time.time() - older_than:
            files.delete(where, True)
            gone.append(name)
    return gone
