"""Operator 2, substring deduplication by suffix automata of reference shards.

A window is ``window`` consecutive words. A word goes if a window that covers it
has a word sequence that also starts earlier: in a smaller doc_id, or earlier in
the same document. Windows are judged on the input.

Sending the automaton of every reference shard to every document would cost the
square of the corpus, so the shards are cut by content. Each window has an
anchor, its least 8-word hash; equal windows have equal anchors. Only anchors
that occur twice matter. The run of windows around one occurrence of such an
anchor is a segment, and the segments of one anchor form a shard: in order of
document and position, each streams through the suffix automaton of the earlier
ones. Its matching statistics (the longest earlier match that ends at each word)
give the maximal spans of at least ``window`` words, which are removed; then the
segment joins the reference, unless all of it was there already.

Copies within a task are settled there: only the first of equal segments is
sent. Anchors with more than ``HOT`` occurrences have unbounded shards; their
windows are dealt out singly, by the hash of the whole window. So no shard holds
more than ``HOT`` segments, or distinct windows' copies beyond one per task.

Defined results: null, empty and short texts have no window and lose nothing;
rows that repeat an id and its text are one document and get equal results; of
unequal texts with one id, the order is by text hash; null ids come last; an
empty table gives an empty result; other columns are ignored, or kept as they
are by ``dedup``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bytes_of, discard, drop_shuffles, materialize, prepare, sub_batches, window_hashes, word_hashes, word_spans

WINDOW = 20
GRAM = 8
HOT = 256
#: Segments that a task remembers to settle copies on the spot.
REMEMBER = 150_000
_LAST_ID = (1 << 63) - 1


class SuffixAutomaton:
    """Suffix automaton of several word sequences, built word by word."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, words: list[bytes]) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _state(self, length: int, edges: dict[bytes, int], link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        """The state of the strings that end p's edge ``w``, apart from the longer ones of q."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: bytes) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return self._split(last, w, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w, self.next[p][w])
        return new

    def matches(self, words: list[bytes]) -> list[int]:
        """Matching statistics: the longest match that ends at each word."""
        state, size, out = 0, 0, []
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if w in self.next[state]:
                state, size = self.next[state][w], size + 1
            out.append(size)
        return out


def spans(matches: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal word ranges covered by matches of at least ``window`` words."""
    out: list[tuple[int, int]] = []
    for end, size in enumerate(matches, 1):
        if size >= window:
            if out and end - window <= out[-1][1]:
                out[-1] = (out[-1][0], end)
            else:
                out.append((end - window, end))
    return out


def anchors(h: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word of each window, its anchor's position, hashes of all grams) for all texts of a batch."""
    grams = window_hashes(h, gram)
    width = window - gram + 1
    sizes = np.maximum(np.diff(bounds) - window + 1, 0)
    if not sizes.sum():
        return np.empty(0, np.int64), np.empty(0, np.int64), grams
    first = np.repeat(bounds[:-1], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    least = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1)
    return first, first + least[first], grams


def keyed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns as k0, k1, ... with __id, __t (hash of the text), __key (hash of both) and __text."""
    text = F.col("text").cast("binary")
    base = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).alias("__id"), F.xxhash64(F.coalesce(text, F.lit(b""))).alias("__t"), text.alias("__text"))
    return base.withColumn("__key", F.xxhash64("__id", "__t"))


def anchor_rows(keys: DataFrame, window: int, gram: int) -> DataFrame:
    """h, __key, c: a document's distinct anchors and how many positions each has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, key = bytes_of(batch.column("__text")), batch.column("__key").to_numpy()
            for lo, hi in sub_batches([len(t) for t in texts]):
                buf, starts, ends, bounds = word_spans(texts[lo:hi])
                _, at, grams = anchors(word_hashes(buf, starts, ends), bounds, window, gram)
                at = np.unique(at)
                owner = np.searchsorted(bounds, at, side="right") - 1
                pairs = np.stack([owner.astype(np.uint64), grams[at]], axis=1)
                order = np.lexsort((pairs[:, 1], pairs[:, 0]))
                pairs = pairs[order]
                new = np.ones(len(pairs), dtype=bool)
                new[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
                first = np.flatnonzero(new)
                c = np.diff(np.append(first, len(pairs)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.ascontiguousarray(pairs[first, 1]).view(np.int64)),
                        pa.array(key[lo:hi][pairs[first, 0].astype(np.int64)]),
                        pa.array(c.astype(np.int64)),
                    ],
                    ["h", "__key", "c"],
                )

    return keys.select("__key", "__text").mapInArrow(run, "h long, __key long, c long")


def segments(keys: DataFrame, window: int, gram: int) -> DataFrame:
    """Shard key, place and words of each document's segments; no words where a copy in the task settles them.

    h, __id, __t, start, windows, content. A row without content is removed as a whole.
    """
    rows = anchor_rows(keys, window, gram)
    repeated = rows.groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") > 1)
    hits = rows.select("h", "__key").join(repeated, "h")
    hits = hits.groupBy("__key").agg(F.collect_list("h").alias("hs"), F.collect_list("c").alias("cs"))
    given = keys.select("__id", "__t", "__key", "__text").join(hits, "__key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bytes, tuple[int, int, int]] = {}
        for batch in batches:
            texts = bytes_of(batch.column("__text"))
            ids, hashes = batch.column("__id").to_pylist(), batch.column("__t").to_pylist()
            for lo, hi in sub_batches([len(t) for t in texts]):
                buf, starts, ends, bounds = word_spans(texts[lo:hi])
                h = word_hashes(buf, starts, ends)
                first, at, grams = anchors(h, bounds, window, gram)
                whole = window_hashes(h, window)
                data = buf.tobytes()
                out: list[list] = [[], [], [], [], [], []]
                per_text = np.searchsorted(first, bounds)
                for k in range(hi - lo):
                    a, b = int(per_text[k]), int(per_text[k + 1])
                    hs = np.array(batch.column("hs")[lo + k].as_py(), dtype=np.int64).view(np.uint64)
                    cs = np.array(batch.column("cs")[lo + k].as_py(), dtype=np.int64)
                    order = np.argsort(hs)
                    hs, cs = hs[order], cs[order]
                    anchor = grams[at[a:b]]
                    place = np.minimum(np.searchsorted(hs, anchor), len(hs) - 1)
                    known = hs[place] == anchor
                    hot = cs[place] > HOT
                    # A segment begins where the anchor's position changes; every window of a hot anchor is one.
                    begins = np.ones(b - a, dtype=bool)
                    begins[1:] = (at[a + 1 : b] != at[a : b - 1]) | hot[1:]
                    begin = np.flatnonzero(begins)
                    end = np.append(begin[1:], b - a)
                    take = known[begin]
                    for i, j in zip(begin[take].tolist(), end[take].tolist(), strict=True):
                        w0, w1 = int(first[a + i]), int(first[a + j - 1]) + window
                        content = b" ".join(data[starts[w0] : ends[w1 - 1]].split())
                        key = int(anchor[i]) if not hot[i] else int(whole[w0])
                        me = (ids[lo + k], hashes[lo + k], w0 - int(bounds[k]))
                        digest = xxhash.xxh3_128_digest(content, seed=key)
                        have = best.get(digest)
                        if have == me:
                            continue
                        if have is None or me < have:
                            if len(best) >= REMEMBER:
                                best.clear()
                            best[digest] = me
                        else:
                            content = None
                        for column, value in zip(out, (key - (1 << 64) if key >> 63 else key, *me, j - i, content), strict=True):
                            column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["h", "__id", "__t", "start", "windows", "content"]
                )

    schema = "h long, __id long, __t long, start long, windows long, content binary"
    return given.select("__id", "__t", "__text", "hs", "cs").mapInArrow(run, schema)


def repeated_spans(found: DataFrame, window: int) -> DataFrame:
    """__id, __t, a, b: word ranges to remove, from each shard's automaton."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seen, automaton, waiting = None, {}, None, None
        for batch in batches:
            out: list[list[int]] = [[], [], [], []]
            for h, i, t, start, content in zip(*(batch.column(c).to_pylist() for c in ("h", "__id", "__t", "start", "content")), strict=True):
                if h != shard:
                    shard, seen, automaton, waiting = h, {}, None, None
                me = (i, t, start)
                if content in seen:
                    ranges = [(0, content.count(b" ") + 1)] if seen[content] != me else []
                else:
                    seen[content] = me
                    words = content.split()
                    if waiting is None and automaton is None:
                        waiting, ranges = words, []  # the automaton is built once a second sequence comes
                    else:
                        if automaton is None:
                            automaton = SuffixAutomaton()
                            automaton.add(waiting)
                        matches = automaton.matches(words)
                        ranges = spans(matches, window)
                        if min(matches[window - 1 :]) < window:
                            automaton.add(words)
                for a, b in ranges:
                    for column, value in zip(out, (i, t, start + a, start + b), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["__id", "__t", "a", "b"])

    sent = found.where("content IS NOT NULL").select("h", "__id", "__t", "start", "content")
    in_order = sent.repartition("h").sortWithinPartitions("h", "__id", "__t", "start")
    streamed = in_order.mapInArrow(run, "__id long, __t long, a long, b long")
    settled = found.where("content IS NULL").select(
        "__id", "__t", F.col("start").alias("a"), (F.col("start") + F.col("windows") + F.lit(window - 1)).alias("b")
    )
    return streamed.union(settled)


def _removed(keys: DataFrame, window: int, gram: int) -> DataFrame:
    """The keyed documents with the ranges to remove (null for none)."""
    spark = keys.sparkSession
    found = materialize(segments(keys, window, gram), "substring-segments")
    drop_shuffles(spark)
    ranges = materialize(repeated_spans(found, window), "substring-ranges")
    discard(found)
    drop_shuffles(spark)
    per_doc = ranges.groupBy("__id", "__t").agg(F.collect_list("a").alias("__a"), F.collect_list("b").alias("__b"))
    return keys.drop("__key").join(per_doc, ["__id", "__t"], "left")


def kept_words(text: bytes, a: list[int] | None, b: list[int] | None) -> tuple[int, int, bytes]:
    """Words, removed words, and the kept words joined by one space."""
    words = text.split()
    if not a:
        return len(words), 0, b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, a, 1)
    np.subtract.at(change, b, 1)
    keep = np.cumsum(change[:-1]) == 0
    return len(words), int((~keep).sum()), b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def digests(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    prepare(docs.sparkSession)
    ready = _removed(keyed(docs, ["doc_id"]), window, gram)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [kept_words(t, a, b) for t, a, b in zip(bytes_of(batch.column("__text")), batch.column("__a").to_pylist(), batch.column("__b").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k0"),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return ready.select("k0", "__text", "__a", "__b").mapInArrow(run, f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string")


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The documents with their own columns; a text that loses words is its kept words joined by one space."""
    prepare(docs.sparkSession)
    names = [c for c in docs.columns if c != "text"]
    ready = _removed(keyed(docs, names), window, gram)
    plain = [f"k{i}" for i in range(len(names))]
    schema = T.StructType([*(T.StructField(k, docs.schema[c].dataType) for k, c in zip(plain, names, strict=True)), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t, a, b in zip(batch.column("__text").to_pylist(), batch.column("__a").to_pylist(), batch.column("__b").to_pylist(), strict=True):
                texts.append(t if not a else kept_words(t, a, b)[2])
            columns = [*(batch.column(k) for k in plain), pa.array([None if t is None else t.decode("utf-8", "replace") for t in texts], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*plain, "text"])

    cleaned = ready.select(*plain, "__text", "__a", "__b").mapInArrow(run, schema).toDF(*names, "text")
    return cleaned.select([F.col(f"`{c}`") for c in docs.columns])
