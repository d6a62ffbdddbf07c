"""Operator 4, quality rules: base limits on a document and cross-document line frequency.

Lines are normalised (lower-case A-Z, runs of white space as one space) and
hashed. For every host (``source``) and line, the distinct documents that hold
it are counted over all documents; copies of one text count once, since copies
are not boilerplate. A line above both limits (``MAX_DOCS`` documents, and
``MAX_SHARE`` of the host's distinct documents) is removed from its host's
documents, and a document that loses more than ``MAX_REMOVED`` of its words is
depleted and rejected.

Defined results: a null or empty text has no words and fails the base rule; a
null host is a host of its own; repeated rows are judged alike; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, drop_shuffles, materialize, mix, prepare, sub_batches, window_hashes, word_hashes, word_spans

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
MAX_DOCS = 20
MAX_SHARE = 0.01
MAX_REMOVED = 0.7

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True
_BLANK = b" \t\n\r\x0b\x0c"


def base_statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    buf, starts, ends, bounds = word_spans(texts)
    at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    n = np.diff(bounds)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[at[1:]] - sums[at[:-1]]

    inside = np.zeros(len(buf) + 1, dtype=np.int8)
    inside[starts] += 1
    np.subtract.at(inside, ends, 1)
    in_word = np.cumsum(inside[:-1]).astype(bool)
    text = np.repeat(np.arange(len(texts)), n)
    h = window_hashes(word_hashes(buf, starts, ends), WINDOW)
    repeat = np.zeros(len(starts), dtype=bool)
    if len(h):
        whole = np.flatnonzero(text[: len(h)] == text[WINDOW - 1 :])
        key = mix(h[whole] ^ mix(text[whole].astype(np.uint64) + np.uint64(1)))
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        twice = whole[counts[inverse] > 1]
        for k in range(WINDOW):
            repeat[twice + k] = True
    dup = np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        lines = [x for x in t.split(b"\n") if x.strip(_BLANK)]
        dup[i] = len(lines) - len(set(lines))
    return {
        "n_words": n.astype(np.int64),
        "word_chars": per_text(in_word & ((buf & 0xC0) != 0x80)).astype(np.int64),
        "n_symbols": per_text(_SYMBOL[buf]).astype(np.int64),
        "n_dup_lines": dup,
        "n_repeat_words": np.bincount(text, weights=repeat, minlength=len(texts)).astype(np.int64),
    }


def normal(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def line_hash(line: bytes) -> bytes:
    return xxhash.xxh3_128_digest(normal(line))


def lines_of(text: bytes) -> dict[bytes, int]:
    """Hash of each distinct normalised line that holds a word -> its words in the text."""
    out: dict[bytes, int] = {}
    for line in text.split(b"\n"):
        words = line.lower().split()
        if words:
            key = xxhash.xxh3_128_digest(b" ".join(words))
            out[key] = out.get(key, 0) + len(words)
    return out


_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def analyse(docs: DataFrame, host: str = "source", with_text: bool = False) -> DataFrame:
    """A row per document: row number, id, host, statistics, digest of the text, and its lines."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = bytes_of(batch.column("text"))
            for lo, hi in sub_batches([len(t) for t in texts]):
                part = texts[lo:hi]
                stats = base_statistics(part)
                found = [lines_of(t) for t in part]
                ends = np.cumsum([0, *map(len, found)])
                flat = pa.StructArray.from_arrays(
                    [pa.array([k for f in found for k in f], pa.binary()), pa.array([v for f in found for v in f.values()], pa.int64())],
                    ["line", "words"],
                )
                columns = [
                    pa.array(row + np.arange(hi - lo)),
                    batch.column("doc_id").slice(lo, hi - lo),
                    batch.column("host").slice(lo, hi - lo),
                    *(pa.array(stats[s]) for s in _STATS),
                    pa.array([xxhash.xxh3_128_digest(t) for t in part], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                ]
                names = ["row", "doc_id", "host", *_STATS, "digest", "lines"]
                if with_text:
                    columns.append(pa.array(part, pa.binary()))
                    names.append("text")
                yield pa.RecordBatch.from_arrays(columns, names)
                row += hi - lo

    schema = f"row long, doc_id {id_type}, host string, {', '.join(f'{s} long' for s in _STATS)}, digest binary, lines array<struct<line: binary, words: long>>"
    # A marker before the name keeps a null host apart from one with an empty name.
    named = F.when(F.col(host).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(host).cast("string")))
    source = docs.select("doc_id", named.alias("host"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, schema + (", text binary" if with_text else ""))


def frequent_lines(base: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """host, line of the lines above both limits; distinct texts are counted before they are summed."""
    held = base.select("host", "digest", F.explode("lines.line").alias("line")).distinct()
    counts = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_docs)
    hosts = base.select("host", "digest").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    return counts.join(hosts, "host").where(F.col("n") > F.col("host_docs") * max_share).select("host", "line")


def judge(base: DataFrame, frequent: DataFrame, max_removed: float = MAX_REMOVED) -> DataFrame:
    """The documents of ``analyse`` with removed_words, removed (their removed lines), base_failed and kept."""
    each = base.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.line", "l.words")
    removed = each.join(frequent, ["host", "line"]).groupBy("row").agg(F.sum("words").alias("lost"), F.collect_list("line").alias("removed"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    joined = base.drop("lines", "digest").join(removed, "row", "left").withColumn("removed_words", F.coalesce("lost", F.lit(0)).cast("long"))
    return joined.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("removed_words") <= F.col("n_words") * F.lit(max_removed))
    )


def rule_verdicts(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, the base statistics, removed_words, base_failed and kept of every document."""
    prepare(docs.sparkSession)
    base = materialize(analyse(docs, host), "line-rules")
    frequent = materialize(frequent_lines(base), "frequent-lines")
    drop_shuffles(docs.sparkSession)
    return judge(base, frequent).select("doc_id", *_STATS, "base_failed", "kept", "removed_words")


def clean(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id and text of the kept documents, without their hosts' frequent lines."""
    prepare(docs.sparkSession)
    base = materialize(analyse(docs, host, with_text=True), "line-rules")
    kept = judge(base, materialize(frequent_lines(base), "frequent-lines")).where("kept")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, removed in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist(), strict=True):
                drop = set(removed or ())
                left = [x for x in text.split(b"\n") if not drop or line_hash(x) not in drop]
                texts.append(b"\n".join(left).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return kept.select("doc_id", "text", "removed").mapInArrow(run, f"doc_id {id_type}, text string")
