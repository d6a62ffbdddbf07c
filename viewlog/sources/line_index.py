"""A sparse line index per source file version, so that offset batches read
their bytes only.

A file is indexed once per version (listed size and modification time): one
pass counts the lines of each byte range and marks the place of every
``MARK_LINES``-th one. The index holds one small row per range, with the number
of lines before it, under ``index_path/source_file=<name>/``; a manifest records
the version. A batch of lines ``[offset, offset + n)`` becomes byte ranges that
start at the last mark before its first line and end at the first mark past its
last (``sources.line_source``): the text is read where it lies and copied
nowhere. A file whose listing no longer matches its manifest entry is indexed
again; the index of a file that is fully ingested is dropped, but its manifest
entry stays, so a later batch knows that there is nothing left to read.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import json
import re
import weakref
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..sinks import tables
from . import line_source as LS

_SESSIONS: weakref.WeakSet[SparkSession] = weakref.WeakSet()
_SUFFIX = re.compile(r"(\.jsonl?)?(\.gz|\.bz2|\.zst|\.deflate)?$")
_MARKS = T.ArrayType(T.StructType([T.StructField("line", T.LongType()), T.StructField("at", T.LongType())]))
INDEX_SCHEMA = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("uri", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("stop", T.LongType()),
        T.StructField("lines", T.LongType()),
        T.StructField("marks", _MARKS),
        T.StructField("base", T.LongType()),  # lines of the file before the range
        T.StructField(C.SOURCE_FILE, T.StringType()),
    ]
)
MANIFEST_SCHEMA = "source_file string, file_size bigint, file_mtime bigint, lines bigint, built_at timestamp"


@dataclasses.dataclass(frozen=True)
class SourceFile:
    name: str
    paths: tuple[str, ...]  # for reading, in the order of their lines
    uris: tuple[str, ...]  # the same as encoded URIs
    sizes: tuple[int, ...]
    size: int
    mtime: int  # epoch milliseconds (latest part)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _visible(name: str) -> bool:
    return not (name.startswith("_") or name.startswith("."))


def _files_under(spark: SparkSession, path: str) -> list:
    p, fs = _fs(spark, path)
    it = fs.listFiles(p, True)
    out = []
    while it.hasNext():
        st = it.next()
        if _visible(st.getPath().getName()):
            out.append(st)
    return out


def list_source_files(spark: SparkSession, root: str, files: Sequence[str] | None = None) -> dict[str, SourceFile]:
    """Logical source files under ``root`` from the file listing (no data
    read): ``source_file=<name>/`` directories, or one file per name."""
    root = root.rstrip("/")
    groups: dict[str, list] = {}
    parts = tables.list_partition_values(spark, root, C.SOURCE_FILE)
    if parts:
        for name in parts:
            if files and name not in files:
                continue
            groups[name] = _files_under(spark, f"{root}/{C.SOURCE_FILE}={name}")
    else:
        p, fs = _fs(spark, root)
        for st in fs.listStatus(p):
            fname = st.getPath().getName()
            if st.isFile() and _visible(fname):
                name = _SUFFIX.sub("", fname)
                if not files or name in files:
                    groups.setdefault(name, []).append(st)
    out = {}
    for name, sts in groups.items():
        if not sts:
            continue
        sts = sorted(sts, key=lambda st: st.getPath().toString())
        out[name] = SourceFile(
            name,
            tuple(st.getPath().toString() for st in sts),
            tuple(st.getPath().toUri().toString() for st in sts),
            tuple(int(st.getLen()) for st in sts),
            sum(int(st.getLen()) for st in sts),
            max(int(st.getModificationTime()) for st in sts),
        )
    return out


def _manifest(spark: SparkSession, manifest_path: str) -> dict[str, tuple[int, int, int]]:
    if not tables.path_exists(spark, manifest_path):
        return {}
    m = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_path)
    latest = m.groupBy(C.SOURCE_FILE).agg(
        F.max_by(F.struct("file_size", "file_mtime", "lines"), F.col("built_at")).alias("m")
    )
    return {r[0]: (r[1]["file_size"], r[1]["file_mtime"], r[1]["lines"]) for r in latest.collect()}


def _record(spark: SparkSession, manifest_path: str, rows: list[tuple]) -> None:
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    spark.createDataFrame([(*r, now) for r in rows], MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(manifest_path)


def _registered(spark: SparkSession) -> None:
    """Make the data source known to the session, its code sent along with it."""
    if spark not in _SESSIONS:
        cloudpickle.register_pickle_by_value(LS)
        spark.dataSource.register(LS.LogLines)
        _SESSIONS.add(spark)


def _source(spark: SparkSession, mode: str, ranges: Sequence[LS.Range]) -> DataFrame:
    _registered(spark)
    spec = json.dumps([dataclasses.astuple(r) for r in ranges])
    tasks = str(2 * spark.sparkContext.defaultParallelism)
    return spark.read.format(LS.LogLines.name()).option("mode", mode).option("ranges", spec).option("tasks", tasks).load()


def build_index(spark: SparkSession, index_path: str, files: Sequence[SourceFile], range_bytes: int | None = None) -> dict[str, int]:
    """Write the index of the given files, replacing earlier ones; returns the lines of each."""
    size = range_bytes or LS.RANGE_BYTES
    ranges = [r for f in files for part, (uri, n) in enumerate(zip(f.uris, f.sizes, strict=True))
              for r in LS.cut_ranges(uri, f.name, part, n, size)]
    if not ranges:
        return {f.name: 0 for f in files}
    before = Window.partitionBy(C.SOURCE_FILE).orderBy("part", "start").rowsBetween(Window.unboundedPreceding, -1)
    # The window sees one row per range of a file.
    found = _source(spark, "index", ranges).withColumn("base", F.coalesce(F.sum("lines").over(before), F.lit(0)).cast("bigint"))
    (found.select(*INDEX_SCHEMA.fieldNames()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(C.SOURCE_FILE).parquet(index_path))
    per_file = _index(spark, index_path, [f.name for f in files]).groupBy(C.SOURCE_FILE).agg(F.sum("lines"))
    return {f.name: 0 for f in files} | {r[0]: int(r[1]) for r in per_file.collect()}


def _index(spark: SparkSession, index_path: str, names: Sequence[str]) -> DataFrame:
    """Index rows of the named files: a filter on the partition column."""
    idx = spark.read.schema(INDEX_SCHEMA).option("basePath", index_path).parquet(index_path)
    return idx.filter(F.col(C.SOURCE_FILE).isin(list(names)))


def ensure_index(spark: SparkSession, index_path: str, listing: dict[str, SourceFile],
                 offsets: dict[str, int] | None = None) -> dict[str, int]:
    """Build missing and stale indexes of the listed files; returns the line
    count of each. A file read up to its last line (``offsets``) at the recorded
    size and time is left alone; one whose index was dropped is indexed again if
    an earlier offset is asked for."""
    manifest_path = f"{index_path.rstrip('/')}_manifest"
    known = _manifest(spark, manifest_path)
    read_to = offsets or {}
    stale = [
        n for n, sf in listing.items()
        if known.get(n, (None, None, None))[:2] != (sf.size, sf.mtime)
        or (read_to.get(n, 0) < known[n][2] and not tables.path_exists(spark, _of_file(index_path, n)))
    ]
    counts = {n: known[n][2] for n in listing if n not in stale}
    if stale:
        built = build_index(spark, index_path, [listing[n] for n in stale])
        counts |= built
        _record(spark, manifest_path, [(n, listing[n].size, listing[n].mtime, built[n]) for n in stale])
    return counts


def lines_of(spark: SparkSession, index_path: str, wanted: Sequence[tuple[str, int, int]]) -> DataFrame:
    """value, source_file, row_index: lines ``[start, stop)`` of each file, read
    from the byte ranges that hold them. One row per range reaches the driver,
    as the tasks of the read that it becomes."""
    want = spark.createDataFrame(list(wanted), f"{C.SOURCE_FILE} string, _from bigint, _to bigint")
    idx = _index(spark, index_path, [n for n, _, _ in wanted]).join(want, C.SOURCE_FILE)
    idx = idx.where("base < _to AND base + lines > _from")
    first = F.expr("element_at(filter(marks, m -> base + m.line <= _from), -1)")
    past = F.expr("get(filter(marks, m -> base + m.line >= _to), 0)")
    rows = idx.select("uri", C.SOURCE_FILE, "part", "start", "stop", "lines", "base", "_from", "_to",
                      F.when(F.expr("exists(marks, m -> base + m.line <= _from)"), first).alias("mark"), past.alias("end")).collect()
    ranges = []
    for r in sorted(rows, key=lambda r: (r[C.SOURCE_FILE], r["part"], r["start"])):
        row = max(r["base"], r["_from"])
        line, at = (r["mark"]["line"], r["mark"]["at"]) if r["mark"] is not None else (0, None)
        ranges.append(LS.Range(
            r["uri"], r[C.SOURCE_FILE], r["part"], r["start"] if at is None else at, r["end"]["at"] if r["end"] is not None else r["stop"],
            at is not None, row, row - r["base"] - line, min(r["_to"], r["base"] + r["lines"]) - row,
        ))
    lines = _source(spark, "lines", ranges)
    # The raw bytes as text, as a text scan gives them.
    return lines.select(F.col("value").cast("string").alias("value"), C.SOURCE_FILE, C.ROW_INDEX)


def drop_finished(spark: SparkSession, index_path: str, finished: Sequence[str]) -> None:
    """Remove the index of files that are fully ingested. Their manifest entries
    stay: ``ensure_index`` rebuilds one when the file changes or an earlier
    offset is asked for."""
    for n in finished:
        tables.delete_path(spark, _of_file(index_path, n))


def _of_file(index_path: str, name: str) -> str:
    return f"{index_path.rstrip('/')}/{C.SOURCE_FILE}={name}"
