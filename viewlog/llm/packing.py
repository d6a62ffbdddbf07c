"""Operator 10, packing by concatenating and cutting.

Pass 1 tokenises every document once and writes its ids, with the document's
place among the tokens of its input partition. The totals of the partitions
then give each partition's global offset (a prefix sum over one row per
partition), and pass 2 cuts the one stream of tokens every ``window`` ids. A
document that crosses a cut gives one boundary record per window.

Both passes read the written ids, so a task that runs again after a lost
executor sees the same order and the same offsets.

Defined results: a null or empty text is the end id alone; repeated rows are
each packed; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_shuffles, materialize, prepare, sub_batches

WINDOW = 2048
END_ID = 1
#: Pieces and words that a task keeps (about 200 bytes each), and those that a worker keeps for its next task.
_CACHE_PIECES, _KEEP_PIECES = 480_000, 120_000
_CACHE_WORDS, _KEEP_WORDS = 160_000, 60_000
_CACHE_CHARS = 48
_LINE_WORDS = 48
_CLOSING = string.punctuation
#: Last characters after which closing marks are split off; lower-casing takes U+0130 apart.
_LATIN = frozenset(c for c in map(chr, range(0x250)) if c.isalnum() and c != "\u0130")
#: Characters of text encoded at a time.
_STEP_CHARS = 1 << 20
#: Words whose ids are put together at a time.
_STEP_WORDS = 1 << 17
#: Arrow's split also splits at these; to the tokenizer they are no white space.
_ODD_SPACE = re.compile(r"[\x1c-\x1f]")
_WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _oldest(known: dict[str, bytes], n: int) -> dict[str, bytes]:
    """The first ``n`` entries: frequent words come early."""
    return dict(itertools.islice(known.items(), n))


class _Encoder:
    """Ids of whole texts, encoding each distinct piece once while it stays in a bounded cache.

    This vocabulary's pre-tokenizer drops white space and never joins across it,
    so the ids of a text are those of its words in order; nor does it join a
    Latin letter or digit with a mark after it, so ASCII marks after one are a
    piece of their own. Other words are left whole: normalisation takes some
    letters apart, and the last part may be a mark. Ids are below 2^16.
    """

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        tokens = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(1 << 16, dtype=bool)
        self.ends_word[[i for token, i in tokens.items() if token.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _encode_pieces(self, pieces: set[str]) -> dict[str, bytes]:
        known = self.pieces
        new = list(pieces.difference(known))
        if len(known) + len(new) > _CACHE_PIECES:
            known = self.pieces = _oldest(known, _KEEP_PIECES) | {p: known[p] for p in pieces if p in known}
        once: dict[str, bytes] = {}
        plain = [p for p in new if p.isalpha() and len(p) <= _CACHE_CHARS]
        known.update(zip(plain, self._encode_letters(plain), strict=True))
        other = [p for p in new if p not in known]
        for i in range(0, len(other), 4096):
            part = other[i : i + 4096]
            for p, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                (known if len(p) <= _CACHE_CHARS else once)[p] = array("H", e.ids).tobytes()
        return {p: known[p] if p in known else once[p] for p in pieces}

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only, some dozens in one call: each ends at its one end-of-word id."""
        lines = [words[i : i + _LINE_WORDS] for i in range(0, len(words), _LINE_WORDS)]
        out: list[bytes] = []
        for line, e in zip(lines, self.tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype=np.uint16)
            ends = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
            if len(ends) == len(line):
                data = ids.tobytes()
                out += [data[2 * i : 2 * j] for i, j in zip([0, *ends], ends, strict=False)]
            else:  # letters that normalisation takes apart
                out += [array("H", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(line, add_special_tokens=False)]
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of each of these distinct words."""
        out = list(map(self.words.get, words))
        missing = [i for i, x in enumerate(out) if x is None]
        if not missing:
            return out
        parts = []
        for i in missing:
            w = words[i]
            stem = w.rstrip(_CLOSING)
            parts.append((stem, w[len(stem) :]) if len(stem) < len(w) and stem[-1:] in _LATIN else (w, ""))
        ids = self._encode_pieces({p for pair in parts for p in pair if p})
        ids[""] = b""
        if len(self.words) + len(missing) > _CACHE_WORDS:
            self.words = _oldest(self.words, _KEEP_WORDS) | {w: x for w, x in zip(words, out, strict=True) if x is not None}
        for i, (stem, marks) in zip(missing, parts, strict=True):
            out[i] = ids[stem] + ids[marks]
            if len(words[i]) <= _CACHE_CHARS:
                self.words[words[i]] = out[i]
        return out

    def _encode_split(self, split: pa.ListArray) -> list[bytes]:
        """The ids of texts given as lists of words; each distinct word is looked up once."""
        coded = split.flatten().dictionary_encode()
        ids = self._words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        joined = np.frombuffer(b"".join(ids), dtype=np.uint16)
        sizes = np.array([len(x) // 2 for x in ids], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        done = [b""]
        before = np.zeros(len(at) + 1, dtype=np.int64)
        for lo in range(0, len(at), _STEP_WORDS):
            part = at[lo : lo + _STEP_WORDS]
            n = sizes[part]
            ends = np.cumsum(n)
            done.append(joined[np.arange(n.sum()) + np.repeat(starts[part] - ends + n, n)].tobytes())
            before[lo + 1 : lo + 1 + len(part)] = before[lo] + ends
        data = b"".join(done)
        bounds = (2 * before[split.offsets.to_numpy()]).tolist()
        return [data[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def rest(self) -> None:
        """Give back memory at a task's end: the worker goes on with tasks of other stages, beside the executor's heap."""
        self.pieces, self.words = _oldest(self.pieces, _KEEP_PIECES), _oldest(self.words, _KEEP_WORDS)
        pa.default_memory_pool().release_unused()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 16-bit integers of this machine's order."""
        odd = [i for i, t in enumerate(texts) if _ODD_SPACE.search(t)]
        if not odd:
            return self._encode_split(pc.utf8_split_whitespace(pa.array(texts, pa.string())))
        ids = self.encode([t if not _ODD_SPACE.search(t) else "" for t in texts])
        split = pa.array([_WHITE.split(texts[i]) for i in odd], pa.list_(pa.string()))
        for i, x in zip(odd, self._encode_split(split), strict=True):
            ids[i] = x
        return ids


_encoders: dict[str, _Encoder] = {}


def _encoder(vocabulary: str) -> _Encoder:
    """One encoder per worker process: what it keeps serves later tasks too."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = _Encoder(vocabulary)
    return _encoders[vocabulary]


def tokenize(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """part, place (tokens before it in its part), doc_id, n (with the end id), ids (16-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = None
        part, place = TaskContext.get().partitionId(), 0
        end = array("H", [end_id]).tobytes()
        for batch in batches:
            encoder = encoder or _encoder(vocabulary)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for i, j in sub_batches([len(t) for t in texts], _STEP_CHARS):
                ids = [x + end for x in encoder.encode(texts[i:j])]
                sizes = np.array([len(x) // 2 for x in ids], dtype=np.int64)
                places = place + np.cumsum(sizes) - sizes
                place += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(ids), pa.int32()),
                        pa.array(places),
                        batch.column("doc_id").slice(i, j - i),
                        pa.array(sizes),
                        pa.array(ids, pa.binary()),
                    ],
                    ["part", "place", "doc_id", "n", "ids"],
                )
        if encoder:
            encoder.rest()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"part int, place long, doc_id {id_type}, n long, ids binary")


def cut(tokens: DataFrame, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """Pieces of the stream's windows; ``tokens`` has the columns that ``tokenize`` gives."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per input partition, not per document.
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_offset"))
    at = tokens.join(F.broadcast(offsets), "part").select("doc_id", "n", "ids", (F.col("place") + F.col("part_offset")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, at_ = batch.column("n").to_numpy(), batch.column("at").to_numpy()
            first, last = at_ // window, (at_ + n - 1) // window
            pieces = last - first + 1
            row = np.repeat(np.arange(len(n)), pieces)
            k = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = first[row] + k
            lo = np.maximum(at_[row], sequence * window)
            hi = np.minimum(at_[row] + n[row], (sequence + 1) * window)
            start = lo - at_[row]
            length = hi - lo
            ids = [np.frombuffer(x, dtype=np.uint16).astype("<u4") for x in batch.column("ids").to_pylist()]
            parts = [ids[r][s : s + m].tobytes() for r, s, m in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
            columns = [
                batch.column("doc_id").take(pa.array(row)),
                pa.array(start),
                pa.array(length),
                pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                pa.array(n[row]),
                pa.array(sequence),
                pa.array(lo - sequence * window),
            ]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array(parts, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    id_type = tokens.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return at.mapInArrow(run, schema + (", ids binary" if with_ids else ""))


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """One row per piece of a document; ``ids`` holds its ids as little-endian 32-bit integers."""
    prepare(docs.sparkSession)
    tokens = materialize(tokenize(docs, vocabulary or default_vocabulary()), "packing")
    drop_shuffles(docs.sparkSession)
    return cut(tokens, window, with_ids)
