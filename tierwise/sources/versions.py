"""Versions of a warehouse under one root: written apart, made current by one marker.

``root/versions/<id>`` holds a refresh, ``root/committed/<time>-<id>`` is an empty file that says it is whole. The current version is that
of the last marker. Creating a file is atomic in every Hadoop file system and object store, so a reader finds the old
version or the new one, never a mixture, and a refresh that dies leaves no marker. Earlier versions stay for readers that are still at them until
``keep`` newer ones are committed.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import SparkSession


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _files(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def new_version(root: str) -> tuple[str, str]:
    """(id, folder) of a version to be written; ids ascend with the time of their start."""
    version = f"{_now()}-{uuid.uuid4().hex[:8]}"
    return version, os.path.join(root, "versions", version)


def commit(spark: SparkSession, root: str, version: str) -> None:
    fs, at = _files(spark, os.path.join(root, "committed", f"{_now()}-{version}"))
    fs.create(at, False).close()


def committed(spark: SparkSession, root: str) -> list[str]:
    """Ids of whole versions, the current one last."""
    return [name.split("-", 1)[1] for name in _names(spark, os.path.join(root, "committed"))]


def current(spark: SparkSession, root: str) -> str | None:
    """Folder of the current version; None where no refresh was committed."""
    done = committed(spark, root)
    return os.path.join(root, "versions", done[-1]) if done else None


def retire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` committed versions, and what refreshes that began before those left uncommitted."""
    kept = committed(spark, root)[-keep:]
    gone = [v for v in _names(spark, os.path.join(root, "versions")) if kept and v not in kept and v < min(kept)]
    for version in gone:
        fs, at = _files(spark, os.path.join(root, "versions", version))
        fs.delete(at, True)
        for marker in _names(spark, os.path.join(root, "committed")):
            if marker.split("-", 1)[1] == version:
                fs.delete(_files(spark, os.path.join(root, "committed", marker))[1], False)
    return gone
