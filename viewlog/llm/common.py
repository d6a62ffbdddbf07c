"""Shared helpers: scratch tables, Arrow settings, and vectorised tokenising.

Words are ``[^\\x20\\x09-\\x0D]+``. In UTF-8 none of those separators occurs
inside a multi-byte character, so words are found on the raw bytes:
``bytes.split()`` gives exactly these words and ``bytes.lower()`` lower-cases
exactly A-Z.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Rows in one Arrow batch: whole texts of some KB each, so a batch stays at a few MB.
BATCH_ROWS = 512
#: Text that one numpy step handles; longer texts are cut at word boundaries.
CHUNK_BYTES = 1 << 20

_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}
_OPEN: list[tuple[SparkSession, str]] = []


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, as a batch holds whole texts; and this package on every executor."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _ship(spark: SparkSession) -> None:
    """Send the package to the executors, which need not have it installed; once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    # Spark's file server hands this file of the driver to executors, also to those that join later.
    folder = tempfile.TemporaryDirectory(prefix="viewlog-package-")
    archive = f"{folder.name}/{package.name}_{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(archive)
    _SHIPPED[sc.applicationId] = folder


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialize(df: DataFrame, name: str, held: bool = False, by: str | None = None) -> DataFrame:
    """Write ``df`` to the cluster's shared scratch folder, in a folder per value of ``by`` if given, and read it back.

    Later stages restart from the files when an executor is lost. The folder is
    deleted when the application ends, or by ``release`` unless it is held.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    if not held:
        _OPEN.append((spark, path))
    written = spark.read.schema(df.schema).parquet(path)
    written.scratch_path = path
    return written


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files that no live plan refers to.

    Call it after ``materialize``: the cleaner works off garbage collection of
    the driver's references, which a small driver heap may postpone for long.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release() -> None:
    """Delete the scratch tables written so far.

    Only for callers that have consumed every result of earlier operators, as a
    pipeline has that writes each stage before the next begins.
    """
    while _OPEN:
        _delete(*_OPEN.pop())


def discard(df: DataFrame) -> None:
    """Delete the table that ``materialize`` gave as ``df``, once later tables hold all that is needed of it."""
    entry = (df.sparkSession, df.scratch_path)
    if entry in _OPEN:
        _OPEN.remove(entry)
        _delete(*entry)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, mod ``parts``; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0))


def bytes_of(column: pa.Array) -> list[bytes]:
    """The texts as bytes; null counts as empty."""
    return [x if x is not None else b"" for x in column.to_pylist()]


def sub_batches(sizes: list[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to at most ``limit`` (one item at least)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


# --- word positions and 64-bit word hashes on raw bytes ----------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_LONG = 1 << 12
_tables: dict[str, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    key = str(base)
    have = _tables.get(key)
    if have is None or len(have) < n:
        step = np.full(n, base, dtype=np.uint64)
        step[0] = 1
        _tables[key] = have = np.cumprod(step, dtype=np.uint64)
    return have


def _byte_values() -> np.ndarray:
    if "bytes" not in _tables:
        _tables["bytes"] = np.frombuffer(b"".join(xxhash.xxh3_64_digest(bytes([b])) for b in range(256)), dtype=">u8").astype(np.uint64)
    return _tables["bytes"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(33))) * _MIX1
    h = (h ^ (h >> np.uint64(29))) * _MIX2
    return h ^ (h >> np.uint64(32))


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, first byte of each word, byte after it, words before each text and in all).

    The texts are joined by one newline each, which is no part of any word.
    """
    buf = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    word = ~_SPACE[buf]
    before = np.empty_like(word)
    if len(word):
        before[0] = False
        before[1:] = word[:-1]
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(before & ~word)
    if len(ends) < len(starts):
        ends = np.append(ends, len(buf))
    at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return buf, starts, ends, np.searchsorted(starts, at)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    out = np.empty(len(starts), dtype=np.uint64)
    values = _byte_values()
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + CHUNK_BYTES, side="right"))
        j = max(j, i + 1)
        lo, hi = int(starts[i]), int(ends[j - 1])
        part = buf[lo:hi]
        if lower:
            part = _LOWER[part]
        sums = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(values[part] * _powers(_BASE, hi - lo + 1)[: hi - lo], out=sums[1:], dtype=np.uint64)
        s, e = starts[i:j] - lo, ends[i:j] - lo
        h = (sums[e] - sums[s]) * _powers(_BASE_INV, hi - lo + 1)[s]
        out[i:j] = mix(h ^ ((e - s).astype(np.uint64) << np.uint64(40)))
        i = j
    for k in np.flatnonzero(ends - starts > _LONG):  # a polynomial hash is weak on long strings
        w = buf[starts[k] : ends[k]]
        out[k] = xxhash.xxh3_64_intdigest((_LOWER[w] if lower else w).tobytes())
    return out


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` consecutive word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out = out * np.uint64(_BASE) + h[j : j + n]
    return mix(out)
