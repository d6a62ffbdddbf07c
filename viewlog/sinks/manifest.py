"""Versioned manifests: small JSON files beside a table, the newest of which is in force.

A version is written under a name of its own and then renamed to its number,
which fails if another writer took that number first. A reader sees the version
before or the one after, whole, and may hold on to one it has read. File names
order the versions, so the pointer is a listing of one small folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

FOLDER = "_manifest"


class VersionTaken(RuntimeError):
    """Another writer committed the version first; read again and redo the work."""


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _name(version: int) -> str:
    return f"v{version:012d}.json"


def versions(spark: SparkSession, root: str, folder: str = FOLDER) -> list[int]:
    """The committed versions, oldest first."""
    p, fs = _path(spark, f"{root.rstrip('/')}/{folder}")
    if not fs.exists(p):
        return []
    names = (st.getPath().getName() for st in fs.listStatus(p))
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def load(spark: SparkSession, root: str, version: int | None = None, folder: str = FOLDER) -> tuple[int, dict] | None:
    """The given version (default: the newest) with its number; None if there is none."""
    if version is None:
        have = versions(spark, root, folder)
        if not have:
            return None
        version = have[-1]
    p, fs = _path(spark, f"{root.rstrip('/')}/{folder}/{_name(version)}")
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return version, json.loads(text)


def commit(spark: SparkSession, root: str, version: int, content: dict, folder: str = FOLDER) -> int:
    """Put ``content`` in force as ``version``; raises ``VersionTaken`` if that number is taken."""
    jvm = spark.sparkContext._jvm
    base = f"{root.rstrip('/')}/{folder}"
    draft, fs = _path(spark, f"{base}/.draft-{uuid.uuid4().hex}")
    final, _ = _path(spark, f"{base}/{_name(version)}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(content, ensure_ascii=False, sort_keys=True).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), options)
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e):
            raise VersionTaken(f"version {version} of {root}") from e
        raise
    return version


def forget(spark: SparkSession, root: str, old: Iterable[int], folder: str = FOLDER) -> None:
    """Delete versions that no reader holds any more."""
    for v in old:
        p, fs = _path(spark, f"{root.rstrip('/')}/{folder}/{_name(v)}")
        fs.delete(p, False)
