"""Operator 11, phrase collocations counted by broadcast double-array tries.

Level by level, as in Apriori, a phrase is a candidate only if its parts are
frequent:

1. Words are counted exactly (partial counts per task, then by language and word).
2. Pairs of frequent words are counted under 64-bit word hashes, and triples of
   which both pairs are left. Filters of a fixed size (Bloom filters of the
   frequent words and pairs) tell tasks what is frequent. Filters and hashes can
   only let too much through, so no frequent phrase is lost.
3. The candidates that are left, as strings, are dealt by the hash of their first
   two words into shards of at most about ``SHARD_PHRASES``. One task per shard
   builds a double-array trie over the digits of its word numbers; each trie is
   broadcast, and the texts go through it: numpy moves the states of all text
   positions one level at a time, and accepting states are counted by
   ``bincount``. Summed over tasks, these counts are the phrases' exact
   frequencies. Where there are several shards, one pass over the texts deals
   their positions by the same hash, so that a trie meets only the parts of the
   texts where one of its phrases may begin.

Scores, containment and the ranking are joins and windows over frequent phrases
only; the ranking is taken per (language, hash slice) before it is taken per
language.

The broadcast has a fixed bound (one shard). The dealt parts hold each position
in one shard only, three words of it at most, so the work over all shards grows
with the texts and not with the number of shards.

Defined results: a null or empty text has no words; a null language is ``und``;
repeated rows count each; ties in score and frequency go by the phrase's bytes;
an empty table gives an empty result; other columns are ignored. Texts are cut
into steps at piece borders only, so their length does not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, discard, drop_shuffles, materialize, mix, prepare, sub_batches, word_hashes, word_spans

LEAST_COUNT, COVERED_PERCENT, TOP = 10, 50, 2000
UNKNOWN_LANG = "und"
#: Candidates in one broadcast trie (some 60 bytes each).
SHARD_PHRASES = 1_000_000
#: Bits of a filter: 16 MB.
FILTER_BITS = 1 << 27
#: Words that a task counts, and hashed phrases that it gathers, before it hands them on.
TASK_WORDS, TASK_PHRASES = 300_000, 1_500_000
#: Text in one dealt row, and in the rows that a dealing task gathers; the tasks at least that one shard's rows are spread over.
DEALT_BYTES, TASK_BYTES, SPREAD = 1 << 15, 1 << 24, 8
#: Rows of hashed phrases that are sent at once.
SENT_ROWS = 1 << 16
#: Slices of a language that are ranked on their own first.
SLICES = 64

_BREAK = b"\n"
#: A word that no text holds: its byte is not in UTF-8.
_BREAK_WORD = b" \xff "
_TABLE = bytearray(range(256))
_TABLE[65:91] = range(97, 123)
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = 10
_TABLE[9] = 32
_DIGIT = 512
_MUL = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str) -> bytes:
    """A-Z lower-cased, every piece separator a newline, every word separator a space."""
    return text.encode().translate(_TABLE)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
        if text:
            yield UNKNOWN_LANG if lang is None else lang, normal(text)


def _segments(text: bytes) -> Iterator[bytes]:
    """Parts of about ``CHUNK_BYTES`` that end at piece borders."""
    while len(text) > CHUNK_BYTES:
        at = text.rfind(_BREAK, 0, CHUNK_BYTES)
        at = at if at >= 0 else text.find(_BREAK, CHUNK_BYTES)
        if at < 0:
            break
        yield text[:at]
        text = text[at + 1 :]
    yield text


def word_counts(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """lang, word, n: frequent words; the row without a word holds the number of all words of its language."""

    def counted(total: dict[str, Counter[bytes]]) -> pa.RecordBatch:
        langs = [x for x, c in total.items() for _ in range(len(c) + 1)]
        words = [w for c in total.values() for w in [*(x.decode() for x in c), None]]
        n = [m for c in total.values() for m in [*c.values(), c.total()]]
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int64())], ["lang", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, Counter[bytes]] = {}
        for batch in batches:
            for lang, text in _rows(batch):
                total.setdefault(lang, Counter()).update(text.split())
                if len(total[lang]) > TASK_WORDS:
                    yield counted({lang: total.pop(lang)})
            if len(total) > 64 and sum(map(len, total.values())) > TASK_WORDS:
                yield counted(total)
                total = {}
        if total:
            yield counted(total)

    rows = docs.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | F.col("word").isNull())


def _salt(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def _salted(spans: tuple[np.ndarray, ...], langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of ``word_spans`` under its language, and the number of its piece."""
    buf, starts, ends, at = spans
    h = word_hashes(buf, starts, ends)
    salt = np.array([_salt(x) for x in langs], dtype=np.uint64)
    h = mix(h ^ np.repeat(salt, np.diff(at)))
    return h, np.cumsum(buf == 10)[starts]


def _hashes(texts: list[bytes], langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word under its language, and the number of its piece."""
    return _salted(word_spans(texts), langs)


def hashed_words(words: DataFrame) -> DataFrame:
    """lang, word, n and the hash h that ``_hashes`` gives to the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                h, _ = _hashes([w.encode() for w in b.column("word").to_pylist()], b.column("lang").to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(h.view(np.int64))], [*b.schema.names, "h"])

    return words.select("lang", "word", "n").mapInArrow(run, "lang string, word string, n long, h long")


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _MUL + b)


def bloom(keys: DataFrame, bits: int) -> np.ndarray:
    """A filter of the hashes in the columns of ``keys`` (one for each word of a phrase), at most ``bits`` / 8 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = [c.to_numpy().view(np.uint64) for c in b.columns]
            places = np.concatenate(_places(reduce(_pair, h), bits))
            flags = np.uint64(1) << (places & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((places >> np.uint64(6)).astype(np.int64)), pa.array(flags.view(np.int64))], ["at", "flags"])

    merged = keys.mapInArrow(run, "at long, flags long").groupBy("at").agg(F.expr("bit_or(flags)").alias("flags"))
    found = merged.toArrow()  # one row per 64 bits of the filter at most
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[found.column("at").to_numpy()] = found.column("flags").to_numpy().view(np.uint64)
    return out


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return h & np.uint64(bits - 1), (h >> np.uint64(32)) & np.uint64(bits - 1)


def _passes(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    ok = np.ones(len(h), dtype=bool)
    for p in _places(h, 64 * len(filter_)):
        ok &= (filter_[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return ok


def frequent_hashes(docs: DataFrame, size: int, filter_: Broadcast, least: int = LEAST_COUNT) -> DataFrame:
    """h1 ... h<size>: hashes of the phrases of ``size`` words that may be frequent.

    ``filter_`` holds what is frequent one level below: words for pairs, pairs for triples.
    """
    names = [f"h{k + 1}" for k in range(size)]

    def emitted(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        parts.clear()
        order = np.argsort(reduce(_pair, columns))
        new = np.zeros(len(order), dtype=bool)
        new[:1] = True
        for k, c in enumerate(columns):
            columns[k] = c = c[order]
            new[1:] |= c[1:] != c[:-1]
        del order
        at = np.flatnonzero(new)
        out = pa.RecordBatch.from_arrays([*(pa.array(c[at].view(np.int64)) for c in columns), pa.array(np.diff(np.append(at, len(new))))], [*names, "n"])
        del columns, new, at, c
        for lo in range(0, out.num_rows, SENT_ROWS):  # the JVM holds one whole batch of each task
            yield out.slice(lo, SENT_ROWS)

    def phrases(texts: list[bytes], langs: list[str]) -> list[np.ndarray]:
        h, piece = _hashes(texts, langs)
        m = len(h) - size + 1
        if m <= 0:
            return [h[:0]] * size
        inside = piece[:m] == piece[size - 1 :]
        if size == 2:
            known = _passes(filter_.value, h)
            inside &= known[:m] & known[1:]
        else:
            known = _passes(filter_.value, _pair(h[:-1], h[1:]))
            inside &= known[:m] & known[1 : m + 1]
        return [h[k : m + k][inside] for k in range(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = []
        for batch in batches:
            rows = [(x, s) for x, t in _rows(batch) for s in _segments(t)]
            for lo, hi in sub_batches([len(s) for _, s in rows]):
                parts.append(phrases([s for _, s in rows[lo:hi]], [x for x, _ in rows[lo:hi]]))
                if sum(len(p[0]) for p in parts) > TASK_PHRASES:
                    yield from emitted(parts)
        if parts:
            yield from emitted(parts)

    rows = docs.select("lang", "text").mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "n"]))
    return rows.groupBy(*names).agg(F.sum("n").alias("n")).where(F.col("n") >= least).select(*names)


def candidates(docs: DataFrame, words: DataFrame, least: int = LEAST_COUNT, filter_bits: int = FILTER_BITS) -> DataFrame:
    """pid, lang, w1, w2, w3 (null for pairs) and their hashes h1, h2, h3: every phrase that may be frequent, and some that are not."""
    sc = docs.sparkSession.sparkContext
    known = materialize(hashed_words(words.where("word IS NOT NULL")), "colloc-hashed")
    one = sc.broadcast(bloom(known.select("h"), filter_bits))
    pairs = materialize(frequent_hashes(docs, 2, one, least), "colloc-pairs")
    two = sc.broadcast(bloom(pairs, filter_bits))
    triples = frequent_hashes(docs, 3, two, least)
    found = pairs.select("h1", "h2", F.lit(None).cast("long").alias("h3")).unionByName(triples)
    for k in (1, 2, 3):
        names = known.select(F.col("h").alias(f"h{k}"), F.col("word").alias(f"w{k}"), *([F.col("lang")] if k == 1 else []))
        found = found.join(names, f"h{k}", "left" if k == 3 else "inner")
    out = materialize(found.select(F.monotonically_increasing_id().alias("pid"), "lang", "w1", "w2", "w3", "h1", "h2", "h3"), "colloc-candidates")
    one.destroy()
    two.destroy()
    discard(pairs)
    return out


# --- shards --------------------------------------------------------------------


def _shard(h1: np.ndarray, h2: np.ndarray, shards: int) -> np.ndarray:
    """The shard of the phrases that begin with these two words."""
    return ((h1 ^ (h2 >> np.uint64(7))) & np.uint64(0x7FFFFFFF)).astype(np.int64) % shards


def shard_column(shards: int) -> Column:
    """``_shard`` of the columns h1 and h2."""
    return F.expr(f"CAST(((h1 ^ shiftrightunsigned(h2, 7)) & 2147483647L) % {shards} AS INT)")


def _parts(texts: list[bytes], langs: list[str], two: np.ndarray, three: np.ndarray, shards: int) -> Iterator[tuple[int, str, bytes]]:
    """shard, lang, text: the words of the shard's phrases in ``texts``.

    Words that follow each other in a piece do so here, all others are in pieces
    of their own. So a phrase of the shard occurs here as often as in ``texts``.
    """
    buf, starts, ends, at = spans = word_spans(texts)
    h, piece = _salted(spans, langs)
    n = len(h)
    if n < 2:
        return
    pair = _pair(h[:-1], h[1:])
    begins = (piece[:-1] == piece[1:]) & _passes(two, pair)
    names = list(dict.fromkeys(langs))
    group = _shard(h[:-1], h[1:], shards) * len(names) + np.repeat([names.index(x) for x in langs], np.diff(at))[:-1]
    key = group * (n + 1) + np.arange(n - 1)
    pairs, triples = np.flatnonzero(begins), np.flatnonzero(begins[:-1] & begins[1:])
    triples = triples[_passes(three, _pair(pair[triples], h[triples + 2]))]
    key = np.unique(np.concatenate([key[pairs], key[pairs] + 1, key[triples] + 2]))
    if not len(key):
        return
    group, word = np.divmod(key, n + 1)
    last = np.append((np.diff(key) > 1) | (np.diff(piece[word]) > 0), True)
    size = ends[word] - starts[word] + 1
    stop = np.cumsum(size)
    out = buf[np.repeat((starts[word] - stop + size).astype(np.int32), size) + np.arange(stop[-1], dtype=np.int32)]
    out[stop - 1] = np.where(last, 10, 32)
    ends_at = np.flatnonzero(np.append(np.diff(group) > 0, True))
    data, lo = out.tobytes(), 0
    for g, hi in zip(group[ends_at].tolist(), stop[ends_at].tolist(), strict=True):
        yield g // len(names), names[g % len(names)], data[lo:hi]
        lo = hi


def deal(docs: DataFrame, found: DataFrame, shards: int, filter_bits: int = FILTER_BITS) -> DataFrame:
    """shard, lang, text: the parts of the texts that matter to each shard of ``found``; see ``_parts``."""
    sc = docs.sparkSession.sparkContext
    width = max(SPREAD, -(-int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards))
    two = sc.broadcast(bloom(found.where("h3 IS NULL").select("h1", "h2"), filter_bits))
    three = sc.broadcast(bloom(found.where("h3 IS NOT NULL").select("h1", "h2", "h3"), filter_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str], bytearray] = {}
        spread = TaskContext.get().partitionId()

        def emitted(keys: list[tuple[int, str]]) -> pa.RecordBatch:
            nonlocal spread
            texts = [held.pop(k).decode() for k in keys]
            to = (np.arange(spread, spread + len(keys)) % width).astype(np.int32)
            spread += len(keys)
            return pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in keys], pa.int32()), pa.array(to), pa.array([x for _, x in keys], pa.string()), pa.array(texts, pa.string())],
                ["shard", "spread", "lang", "text"],
            )

        for batch in batches:
            rows = [(x, s) for x, t in _rows(batch) for s in _segments(t)]
            for lo, hi in sub_batches([len(s) for _, s in rows]):
                for shard, lang, text in _parts([s for _, s in rows[lo:hi]], [x for x, _ in rows[lo:hi]], two.value, three.value, shards):
                    held.setdefault((shard, lang), bytearray()).extend(text)
                full = list(held) if sum(map(len, held.values())) > TASK_BYTES else [k for k, t in held.items() if len(t) >= DEALT_BYTES]
                if full:
                    yield emitted(full)
        if held:
            yield emitted(list(held))

    rows = docs.select("lang", "text").mapInArrow(run, "shard int, spread int, lang string, text string")
    out = materialize(rows.repartition("shard", "spread").drop("spread"), "colloc-dealt", by="shard")
    two.destroy()
    three.destroy()
    return out


# --- the trie ------------------------------------------------------------------


def double_array(parent: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and the slot of each node; node 0 is the root, in slot 0.

    The child of slot s by symbol c is slot base[s] + c if its check is s. Nodes
    with many children are placed one by one while the array is nearly empty;
    the others in rounds, each trying a place for all that have none.
    """
    rng = np.random.default_rng(1)
    nodes = len(parent)
    order = np.argsort(parent[1:], kind="stable") + 1
    owner, first, count = np.unique(parent[order], return_index=True, return_counts=True)
    wide = int(1.7 * nodes) + 64 * _DIGIT
    taken = np.zeros(wide + 2 * _DIGIT, dtype=bool)
    taken[:1] = True
    base_of = np.zeros(nodes, dtype=np.int64)
    slot = np.zeros(nodes, dtype=np.int64)
    top = 1
    by_count = np.argsort(-count, kind="stable")
    big = int(np.searchsorted(-count[by_count], -24, side="right"))
    for i in by_count[:big]:
        children = order[first[i] : first[i] + count[i]]
        symbols = symbol[children]
        for base in [*rng.integers(1, top + 1, 16).tolist(), top]:
            if base == top and top + _DIGIT >= len(taken):
                taken = np.concatenate([taken, np.zeros(len(taken) // 2 + _DIGIT, dtype=bool)])
            if not taken[base + symbols].any():
                break
        taken[base + symbols] = True
        slot[children] = base + symbols
        base_of[owner[i]] = base
        top = max(top, base + int(symbols.max()) + 1)
    for least in (12, 6, 3, 2, 1):
        left = by_count[big:]
        left = left[(count[left] >= least) & (base_of[owner[left]] == 0)]
        while len(left):
            n = count[left]
            rows = np.repeat(np.arange(len(left)), n)
            children = order[np.repeat(first[left], n) + np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)]
            base = rng.integers(1, len(taken) - _DIGIT, len(left))
            at = base[rows] + symbol[children]
            claim = np.full(len(taken), -1, dtype=np.int32)
            claim[at] = rows
            fails = np.bincount(rows, weights=taken[at] | (claim[at] != rows), minlength=len(left)) > 0
            ok = ~fails[rows]
            taken[at[ok]] = True
            slot[children[ok]] = at[ok]
            base_of[owner[left[~fails]]] = base[~fails]
            if fails.mean() > 0.97 and len(left) > 64:
                taken = np.concatenate([taken, np.zeros(len(taken) // 8, dtype=bool)])
            left = left[fails]
    size = len(taken)
    base, check = np.zeros(size, dtype=np.int32), np.full(size, -1, dtype=np.int32)
    base[slot] = base_of
    check[slot[1:]] = slot[parent[1:]]
    return base, check, slot


def _coded(chunks: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """The distinct texts, and for each text its place there (-1 for null)."""
    coded = pa.chunked_array(chunks, pa.string()).cast(pa.large_string()).combine_chunks().dictionary_encode()
    return coded.dictionary, coded.indices.fill_null(-1).to_numpy().astype(np.int64)


def build_trie(phrases: pa.Table) -> dict[str, object]:
    """The double-array trie of the rows pid, lang, w1, w2, w3, and its vocabulary per language."""
    n = phrases.num_rows
    langs, lang = _coded(phrases.column("lang").chunks)
    words, word = _coded([c for k in range(3) for c in phrases.column(f"w{k + 1}").chunks])
    there = word >= 0
    known, number_of = np.unique((np.tile(lang, 3) * len(words) + word)[there], return_inverse=True)
    ids = np.zeros(3 * n, dtype=np.int64)
    ids[there] = number_of + 1
    ids = ids.reshape(3, n).T
    number: dict[str, dict[bytes, int]] = {x: {} for x in langs.to_pylist()}
    at = np.searchsorted(known, np.arange(len(langs) + 1) * len(words)).tolist()
    for x, lo, hi in zip(number, at, at[1:], strict=False):
        number[x] = {w.encode(): v for v, w in enumerate(words.take(pa.array(known[lo:hi] % len(words))).to_pylist(), lo + 1)}
    digits = max(1, -(-(len(known) + 1).bit_length() // 9))
    parent, symbol, made = [np.zeros(1, dtype=np.int64)], [np.zeros(1, dtype=np.int64)], 1
    rows, node = np.arange(n), np.zeros(n, dtype=np.int64)
    for k in range(3):
        live = ids[rows, k] > 0
        rows = rows[live]
        for d in reversed(range(digits)):
            key = node[rows] * _DIGIT + (ids[rows, k] >> (9 * d)) % _DIGIT
            new, of_row = np.unique(key, return_inverse=True)
            parent.append(new // _DIGIT)
            symbol.append(new % _DIGIT)
            node[rows] = made + of_row
            made += len(new)
    base, check, slot = double_array(np.concatenate(parent), np.concatenate(symbol))
    phrase = np.full(len(base), -1, dtype=np.int32)
    phrase[slot[node]] = np.arange(n)
    return {"base": base, "check": check, "phrase": phrase, "pid": phrases.column("pid").to_numpy().astype(np.int64), "digits": digits, "number": number}


def tries(found: DataFrame, shards: int) -> DataFrame:
    """shard, name, label, data: one trie per shard, as byte strings, each built in one task."""
    dealt = found.select(shard_column(shards).alias("shard"), "pid", "lang", "w1", "w2", "w3")

    def build(t: pa.Table) -> pa.Table:
        trie = build_trie(t)
        rows = [(n, "", trie[n].tobytes()) for n in ("base", "check", "phrase", "pid")]
        rows.append(("digits", str(trie["digits"]), b""))
        for label, words in trie["number"].items():  # ids run on within a language in the order of this text
            rows.append(("words", label, _BREAK.join(words)))
            rows.append(("ids", label, np.array(list(words.values()), dtype=np.int32).tobytes()))
        shard = t.column("shard")[0].as_py()
        return pa.table(
            [pa.array([shard] * len(rows), pa.int32()), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.binary()), strict=True))],
            names=["shard", "name", "label", "data"],
        )

    return dealt.groupBy("shard").applyInArrow(build, "shard int, name string, label string, data binary")


class Trie:
    """A shard's trie as a task uses it."""

    def __init__(self, rows: list[tuple[str, str, bytes]]) -> None:
        data = {(name, label): d for name, label, d in rows}
        self.base, self.check, self.phrase = (np.frombuffer(data[n, ""], dtype=np.int32) for n in ("base", "check", "phrase"))
        self.pid = np.frombuffer(data["pid", ""], dtype=np.int64)
        self.digits = int(next(label for name, label in data if name == "digits"))
        self.number = {
            label: dict(zip(d.split(_BREAK), np.frombuffer(data["ids", label], dtype=np.int32).tolist(), strict=True))
            for (name, label), d in data.items()
            if name == "words"
        }

    def word_numbers(self, lang: str, text: bytes) -> list[int]:
        """The number of each word (0: in no candidate), and a 0 after each piece."""
        get = self.number.get(lang, {}).get
        return [*[get(w, 0) for w in text.replace(_BREAK, _BREAK_WORD).split()], 0]

    def accepted(self, numbers: np.ndarray) -> list[np.ndarray]:
        """The accepting states that all positions reach, per level."""
        out = []
        at = np.flatnonzero(numbers)
        state = np.zeros(len(at), dtype=np.int64)
        padded = np.concatenate([numbers, [0, 0]])
        for k in range(3):
            number = padded[at + k]
            live = number > 0
            at, state, number = at[live], state[live], number[live]
            for d in reversed(range(self.digits)):
                base = self.base[state]
                to = base + ((number >> (9 * d)) & (_DIGIT - 1))
                ok = (base > 0) & (self.check[to] == state)
                at, state, number = at[ok], to[ok], number[ok]
            if k:
                out.append(state[self.phrase[state] >= 0])
        return out


_tries: dict[int, Trie] = {}


def count_shard(docs: DataFrame, shared: Broadcast, key: str) -> DataFrame:
    """pid, n: how often each phrase of one trie occurs, per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _tries:
            _tries.clear()
            _tries[key] = Trie(shared.value)
        trie = _tries[key]
        total = np.zeros(len(trie.pid), dtype=np.int64)
        states: list[np.ndarray] = []
        held = 0
        for batch in batches:
            rows = [(x, s) for x, t in _rows(batch) for s in _segments(t)]
            for lo, hi in sub_batches([len(s) for _, s in rows]):
                numbers = [trie.word_numbers(x, s) for x, s in rows[lo:hi]]
                new = trie.accepted(np.array([n for part in numbers for n in part], dtype=np.int64))
                states += new
                held += sum(map(len, new))
                if held > len(total):
                    total += np.bincount(trie.phrase[np.concatenate(states)], minlength=len(total))
                    states, held = [], 0
        if states:
            total += np.bincount(trie.phrase[np.concatenate(states)], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(trie.pid[seen]), pa.array(total[seen])], ["pid", "n"])

    return docs.select("lang", "text").mapInArrow(run, "pid long, n long")


def frequencies(
    docs: DataFrame, found: DataFrame, shard_phrases: int = SHARD_PHRASES, least: int = LEAST_COUNT, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """lang, w1, w2, w3, a: the frequent phrases and their exact counts."""
    spark = docs.sparkSession
    shards = max(1, -(-found.count() // shard_phrases))
    drop_shuffles(spark)
    built = materialize(tries(found, shards), "colloc-tries")
    dealt = deal(docs, found, shards, filter_bits) if shards > 1 else None
    counts = []
    for shard in range(shards):
        rows = [(r["name"], r["label"], bytes(r["data"])) for r in built.where(F.col("shard") == shard).collect()]  # one shard: bounded
        if not rows:
            continue
        shared = spark.sparkContext.broadcast(rows)
        del rows  # the next shard's come before this name is used again
        texts = docs if dealt is None else dealt.where(F.col("shard") == shard)
        counted = count_shard(texts, shared, f"{built.scratch_path}/{shard}")
        counts.append(materialize(counted.groupBy("pid").agg(F.sum("n").alias("a")).where(F.col("a") >= least), "colloc-counts"))
        shared.destroy()
    discard(built)
    if dealt is not None:
        discard(dealt)
    if not counts:
        return found.select("lang", "w1", "w2", "w3", F.lit(0).cast("long").alias("a"))
    total = counts[0]
    for c in counts[1:]:
        total = total.unionByName(c)
    return found.join(total, "pid").select("lang", "w1", "w2", "w3", "a")


def ranked(words: DataFrame, phrases: DataFrame, top: int = TOP, covered_percent: int = COVERED_PERCENT) -> DataFrame:
    """The collocations of each language: lang, rank, phrase, a, l, r, n, score."""
    single = words.where("word IS NOT NULL")
    pairs, triples = phrases.where("w3 IS NULL").drop("w3"), phrases.where("w3 IS NOT NULL")

    def with_count(df: DataFrame, *of: str, name: str) -> DataFrame:
        """``df`` with the frequency of the words in the columns ``of``."""
        source = single.select("lang", F.col("word").alias(of[0]), F.col("n").alias(name)) if len(of) == 1 else pairs.select(
            "lang", F.col("w1").alias(of[0]), F.col("w2").alias(of[1]), F.col("a").alias(name)
        )
        return df.join(source, ["lang", *of])

    def score(left: str, right: str) -> Column:
        wide = "CAST({} AS DECIMAL(38, 0))".format
        return F.expr(f"({wide(1000000)} * a * a) div ({wide(left)} * {right})")

    inside = triples.select("lang", "w1", "w2", "a").union(triples.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    inside = inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    two = with_count(with_count(pairs, "w1", name="l"), "w2", name="r").join(inside, ["lang", "w1", "w2"], "left")
    two = two.where(f"longer IS NULL OR 100 * longer < {covered_percent} * a")
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", score("l", "r").alias("score"))

    three = with_count(with_count(triples, "w1", name="l1"), "w2", "w3", name="r1")
    three = with_count(with_count(three, "w1", "w2", name="l2"), "w3", name="r2")
    three = three.withColumns({"s1": score("l1", "r1"), "s2": score("l2", "r2")})
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )

    best = (F.desc("score"), F.desc("a"), F.col("phrase"))
    slice_ = F.pmod(F.xxhash64("phrase"), F.lit(SLICES))
    rows = two.unionByName(three).withColumn("slice", slice_)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*best))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    totals = words.where("word IS NULL").select("lang", "n")
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP, shard_phrases: int = SHARD_PHRASES, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The best collocations of each language; see the module's docstring."""
    prepare(docs.sparkSession)
    words = materialize(word_counts(docs, least), "colloc-words")
    found = candidates(docs, words, least, filter_bits)
    phrases = materialize(frequencies(docs, found, shard_phrases, least, filter_bits), "colloc-phrases")
    return ranked(words, phrases, top)
