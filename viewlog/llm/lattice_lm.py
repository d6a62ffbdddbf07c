"""Operator 8, language-model scoring by subword lattice likelihood.

The pieces are those of an existing subword vocabulary; its scores give the
first weights (a piece's chance falls with its rank), and ``EM_ROUNDS`` rounds
of expectation-maximisation over all training words, of any length, turn them
into unigram probabilities. A word's probability is the sum over all of its segmentations
into pieces (single bytes included, so every word has one), by a forward
recursion in log space. No piece crosses a word border, so a document's
probability is the product of its words' and of the end piece's.

Tasks turn runs of documents into blocks: the block's distinct words, and each
document's words as numbers into them. Counts and scores are computed once per
distinct word of the corpus, joined back to the blocks' words, and summed up
per document within its block. What moves are block vocabularies, never
(document, word) pairs.

Defined results: a null or empty text is the end token alone; repeated rows are
each a document; with no training documents all counts are 0 and the weights
stay the first ones; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bytes_of, discard, drop_shuffles, fold, materialize, prepare, sub_batches, word_hashes, word_spans

FOLDS, HELD_OUT = 7, 2
BLOCK_BYTES = 16 << 20
EM_ROUNDS = 2
#: Weight of the first probabilities in each round, in pieces.
PRIOR = 1000.0
#: Words of more bytes are not grouped by length, but laid one after the other: so many bytes of them, and so many positions in one step.
_LONG_WORD = 96
_LONG_BYTES = 1 << 20
_LONG_STEP = 1 << 14
_MARK = "▁".encode()
_P = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 18


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Lattice:
    """Pieces as byte strings, found by hash; ``logp`` (natural) by piece number.

    Numbers: 0-255 are the single bytes, 256 the end of a document, then pieces.
    """

    END = 256

    def __init__(self, pieces: list[bytes]) -> None:
        self.pieces = pieces
        self.number = {p: i + 257 for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        self.keys = np.zeros((2, 1 << _SLOT_BITS), dtype=np.uint64)
        self.values = np.full((2, 1 << _SLOT_BITS), -1, dtype=np.int32)
        hashes = {p: self._hash(p) for p in pieces}
        if len(set(hashes.values())) != len(pieces):
            raise ValueError("piece hashes collide")
        for p in pieces:  # two-choice hashing: a moved-out entry goes to its other place
            h, v, side = hashes[p], self.number[p], 0
            for _ in range(500):
                slot = self._slot(h, side)
                if self.values[side, slot] < 0:
                    self.keys[side, slot], self.values[side, slot] = h, v
                    break
                old_h, old_v = int(self.keys[side, slot]), int(self.values[side, slot])
                self.keys[side, slot], self.values[side, slot] = h, v
                h, v, side = old_h, old_v, 1 - side
            else:
                raise ValueError("piece table is full")

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_P) + b + 1) & (2**64 - 1)
        return h

    @staticmethod
    def _slot(h: int, side: int) -> int:
        m = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)[side]
        return ((h * m) & (2**64 - 1)) >> (64 - _SLOT_BITS)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece number of each hash, -1 for none."""
        shift = np.uint64(64 - _SLOT_BITS)
        a = (h * np.uint64(0xC2B2AE3D27D4EB4F)) >> shift
        b = (h * np.uint64(0x165667B19E3779F9)) >> shift
        first = np.where(self.keys[0][a] == h, self.values[0][a], -1)
        return np.where((first < 0) & (self.keys[1][b] == h), self.values[1][b], first)

    def edges(self, words: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        """(start, length, piece number per word) for words of one length, where any word has a piece."""
        n = words.shape[1]
        out = []
        h = np.zeros((len(words), n), dtype=np.uint64)
        for size in range(1, min(n, self.longest) + 1):
            h = h[:, : n - size + 1] * _P + words[:, size - 1 :].astype(np.uint64) + np.uint64(1)
            found = self.find(h)
            out += [(i, size, found[:, i]) for i in np.flatnonzero((found >= 0).any(axis=0)).tolist()]
        return out

    def forward(self, words: np.ndarray, logp: np.ndarray, edges: list) -> np.ndarray:
        """log of the summed probability of all ways to each position."""
        n = words.shape[1]
        alpha = np.full((n + 1, len(words)), -np.inf)
        alpha[0] = 0
        by_end: list[list] = [[] for _ in range(n + 1)]
        for i, size, found in edges:
            by_end[i + size].append((i, found))
        padded = np.append(logp, -np.inf)
        for j in range(1, n + 1):
            a = alpha[j - 1] + logp[words[:, j - 1]]
            for i, found in by_end[j]:
                a = np.logaddexp(a, alpha[i] + padded[found])
            alpha[j] = a
        return alpha

    def expected(self, words: np.ndarray, weight: np.ndarray, logp: np.ndarray, out: np.ndarray) -> None:
        """Add each piece's expected count, ``weight`` occurrences of each word, to ``out``."""
        edges = self.edges(words)
        alpha = self.forward(words, logp, edges)
        n = words.shape[1]
        beta = np.full((n + 1, len(words)), -np.inf)
        beta[n] = 0
        by_start: list[list] = [[] for _ in range(n + 1)]
        for i, size, found in edges:
            by_start[i].append((i + size, found))
        padded = np.append(logp, -np.inf)
        scale = np.log(np.maximum(weight, 1e-300)) - alpha[n]
        for i in range(n - 1, -1, -1):
            byte = words[:, i].astype(np.int64)
            b = logp[byte] + beta[i + 1]
            out += np.bincount(byte, weights=np.exp(alpha[i] + b + scale), minlength=len(out))
            for j, found in by_start[i]:
                e = padded[found] + beta[j]
                b = np.logaddexp(b, e)
                has = found >= 0
                out += np.bincount(found[has], weights=np.exp((alpha[i] + e + scale)[has]), minlength=len(out))
            beta[i] = b

    def long_edges(self, buf: np.ndarray, inside: np.ndarray, a: int, b: int) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
        """(first edge of each end, starts, ends, pieces) of the edges that end in a+1 .. b, by end.

        ``buf`` holds words with one byte between them, which is not ``inside``: no edge crosses it.
        """
        lo = max(0, a + 1 - self.longest)
        codes = np.where(inside[lo:b], buf[lo:b].astype(np.uint64) + np.uint64(1), _P)
        byte = np.arange(a, b)[inside[a:b]]
        starts, sizes, pieces = [byte], [np.ones(len(byte), dtype=np.int64)], [buf[byte].astype(np.int64)]
        h = np.zeros(len(codes), dtype=np.uint64)
        for size in range(1, min(len(codes), self.longest) + 1):
            h = h[: len(codes) - size + 1] * _P + codes[size - 1 :]
            first = max(0, a + 1 - size - lo)
            found = self.find(h[first:])
            at = np.flatnonzero(found >= 0)
            starts.append(at + first + lo)
            sizes.append(np.full(len(at), size))
            pieces.append(found[at].astype(np.int64))
        start, piece = np.concatenate(starts), np.concatenate(pieces)
        end = start + np.concatenate(sizes)
        order = np.argsort(end, kind="stable")
        return np.searchsorted(end[order], np.arange(a + 1, b + 2)).tolist(), start[order], end[order], piece[order]

    def forward_long(self, words: list[bytes], logp: np.ndarray) -> tuple[np.ndarray, np.ndarray, array, np.ndarray]:
        """The same forward recursion for long words of any lengths, laid one after the other.

        Gives their bytes, which of them are in a word, alpha at each position, and the words' ends.
        """
        buf = np.frombuffer(b" ".join(words), dtype=np.uint8)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        inside = np.ones(len(buf), dtype=bool)
        inside[ends[:-1]] = False
        alpha = array("d", bytes(8 * (len(buf) + 1)))
        for a in range(0, len(buf), _LONG_STEP):
            b = min(a + _LONG_STEP, len(buf))
            first, start, _, piece = self.long_edges(buf, inside, a, b)
            start, lp = start.tolist(), logp[piece].tolist()
            for j in range(a + 1, b + 1):
                lo, hi = first[j - a - 1], first[j - a]
                if lo == hi:  # the first position of a word
                    continue
                terms = [alpha[i] + x for i, x in zip(start[lo:hi], lp[lo:hi], strict=True)]
                top = max(terms)
                alpha[j] = top + math.log(sum([math.exp(t - top) for t in terms]))
        return buf, inside, alpha, ends

    def score_long(self, word: bytes, logp: np.ndarray) -> float:
        """The same forward recursion for one long word."""
        return self.forward_long([word], logp)[2][-1]

    def expected_long(self, words: list[bytes], weight: np.ndarray, logp: np.ndarray, out: np.ndarray) -> None:
        """``expected`` for long words of any lengths; time and memory are linear in their bytes."""
        buf, inside, alpha, ends = self.forward_long(words, logp)
        at = np.frombuffer(alpha)
        beta = array("d", [-math.inf]) * len(alpha)
        for j, x in zip(ends.tolist(), (np.log(np.maximum(weight, 1e-300)) - at[ends]).tolist(), strict=True):
            beta[j] = x
        for a in reversed(range(0, len(buf), _LONG_STEP)):
            b = min(a + _LONG_STEP, len(buf))
            first, start, end, piece = self.long_edges(buf, inside, a, b)
            starts, lp = start.tolist(), logp[piece].tolist()
            for j in range(b, a, -1):
                after = beta[j]
                for k in range(first[j - a - 1], first[j - a]):
                    x, y = after + lp[k], beta[starts[k]]
                    if x < y:
                        x, y = y, x
                    beta[starts[k]] = x + math.log1p(math.exp(y - x))
            out += np.bincount(piece, weights=np.exp(at[start] + logp[piece] + np.frombuffer(beta)[end]), minlength=len(out))


def by_length(words: list[bytes], limit: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions in the list, words x bytes) of the words of each length, some at a time."""
    sizes = np.array([len(w) for w in words])
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        for a in range(0, len(at), limit):
            part = at[a : a + limit]
            yield part, np.frombuffer(b"".join([words[i] for i in part]), dtype=np.uint8).reshape(len(part), n)


def by_size(words: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions in the list of the short words, and of the long ones in runs of some bytes (one word at least)."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    long = np.flatnonzero(sizes > _LONG_WORD)
    return np.flatnonzero(sizes <= _LONG_WORD), [long[a:b] for a, b in sub_batches(sizes[long].tolist(), _LONG_BYTES)]


def load_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """The vocabulary's pieces that can lie within a word, and the first log probabilities.

    The score of a piece falls by 1 with each rank; a piece's first chance is
    1 / (rank + 10). Bytes, last resorts in the vocabulary, start like its rarest pieces.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores = [], []
    for i in range(model.get_piece_size()):
        p = model.id_to_piece(i)
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or "▁" in p[1:]):
            pieces.append(p.encode())
            scores.append(model.get_score(i))
    chance = 1.0 / (10.0 - np.array(scores))
    first = np.concatenate([np.full(256, chance.min()), [chance.max()], chance])
    return pieces, np.log(first / first.sum())


def packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, their four byte planes one after the other, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per block: its documents, their words as numbers, and its distinct words with training counts."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["block", "doc_ids", "held_out", "sizes", "numbers", "words"]

    def build(block: int, ids: list, held: list, texts: list[bytes]) -> pa.RecordBatch:
        buf, starts, ends, bounds = word_spans(texts)
        h = word_hashes(buf, starts, ends, lower=True)
        _, first, number, total = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        # Common words get small numbers, which pack well.
        common = np.argsort(-total, kind="stable")
        place = np.empty(len(common), dtype=np.int64)
        place[common] = np.arange(len(common))
        first, number = first[common], place[number]
        sizes = np.diff(bounds)
        train = np.repeat(~np.array(held, dtype=bool), sizes)
        counts = np.bincount(number, weights=train, minlength=len(first)).astype(np.int64)
        data = buf.tobytes()
        words = [data[a:b].lower() for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        flat = pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(counts)], ["word", "n"])
        columns = [
            pa.array([block], pa.int64()),
            pa.array([ids], pa.list_(id_arrow)),
            pa.array([held], pa.list_(pa.bool_())),
            pa.array([sizes.tolist()], pa.list_(pa.int64())),
            pa.array([packed(number)], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), flat),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    from pyspark.sql.pandas.types import to_arrow_type

    id_arrow = to_arrow_type(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, held, texts, size = [], [], [], 0
        for batch in batches:
            for i, out, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), bytes_of(batch.column("text")), strict=True):
                if texts and size + len(text) > block_bytes:
                    yield build(block, ids, held, texts)
                    block, ids, held, texts, size = block + 1, [], [], [], 0
                ids.append(i)
                held.append(out)
                texts.append(text)
                size += len(text)
        if texts:
            yield build(block, ids, held, texts)

    source = docs.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("binary").alias("text")
    )
    schema = f"block long, doc_ids array<{id_type}>, held_out array<boolean>, sizes array<long>, numbers binary, words array<struct<word: binary, n: long>>"
    return source.mapInArrow(run, schema)


def fit_weights(spark: SparkSession, counts: DataFrame, pieces: list[bytes], first: np.ndarray, end_count: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Log probabilities of the pieces after some rounds of EM; each round sums one number per piece."""
    logp = first
    sc = spark.sparkContext
    for _ in range(rounds):
        shared = sc.broadcast((pieces, logp))  # the vocabulary: a fixed size

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice, total = None, None
            for batch in batches:
                if lattice is None:
                    lattice = _lattice(shared.value[0])
                    total = np.zeros(len(shared.value[1]))
                given = [_MARK + w for w in batch.column("word").to_pylist()]
                weight = batch.column("n").to_numpy().astype(np.float64)
                short, long = by_size(given)
                for at, words in by_length([given[i] for i in short.tolist()]):
                    lattice.expected(words, weight[short[at]], shared.value[1], total)
                for at in long:
                    lattice.expected_long([given[i] for i in at.tolist()], weight[at], shared.value[1], total)
            if total is not None:
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["piece", "n"])

        sums = counts.where("n > 0").select("word", "n").mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        expected = np.exp(first) * PRIOR
        for r in sums.collect():
            expected[r["piece"]] += r["n"]
        expected[Lattice.END] += end_count
        logp = np.log(expected / expected.sum())
    return logp


_lattices: dict[int, Lattice] = {}


def _lattice(pieces: list[bytes]) -> Lattice:
    key = hash(tuple(pieces))
    if key not in _lattices:
        _lattices.clear()
        _lattices[key] = Lattice(pieces)
    return _lattices[key]


def score_words(spark: SparkSession, counts: DataFrame, pieces: list[bytes], logp: np.ndarray) -> DataFrame:
    """word, n, and lp (log10 of the word's probability)."""
    shared = spark.sparkContext.broadcast((pieces, logp))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = None
        for batch in batches:
            lattice = lattice or _lattice(shared.value[0])
            given = [_MARK + w for w in batch.column("word").to_pylist()]
            lp = np.empty(len(given))
            short, long = by_size(given)
            for at in long:
                _, _, alpha, ends = lattice.forward_long([given[i] for i in at.tolist()], shared.value[1])
                lp[at] = np.frombuffer(alpha)[ends]
            for at, words in by_length([given[i] for i in short.tolist()]):
                lp[short[at]] = lattice.forward(words, shared.value[1], lattice.edges(words))[-1]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(lp / math.log(10))], ["word", "n", "lp"])

    return counts.mapInArrow(run, "word binary, n long, lp double")


def score(docs: DataFrame, pieces_path: str | None = None, rounds: int = EM_ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    prepare(spark)
    # Words are short: larger batches fill the words of each length.
    built = materialize(blocks(docs), "lm-blocks")
    vocabulary = built.select("block", F.posexplode("words").alias("number", "w")).select("block", "number", "w.word", "w.n")
    counts = materialize(vocabulary.groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    drop_shuffles(spark)
    trained = built.select(F.explode("held_out").alias("out")).where("not out").count()
    known = counts.where("n > 0").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).first()
    train_tokens, distinct = (known["n"] or 0) + trained, known["v"] + (trained > 0)
    pieces, first = load_pieces(pieces_path or default_pieces())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16384")
    try:
        logp = fit_weights(spark, counts, pieces, first, trained, rounds)
        words = materialize(score_words(spark, counts, pieces, logp), "lm-words")
    finally:
        prepare(spark)
    discard(counts)
    drop_shuffles(spark)
    of_block = vocabulary.select(F.col("block").alias("in_block"), "number", "word").join(words, "word").select("in_block", "number", "n", "lp")
    whole = train_tokens + distinct + 1
    end = (trained, math.log10((trained + 1) / whole), float(logp[Lattice.END]) / math.log(10))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        size = len(found)
        n, lp = np.zeros(size), np.zeros(size)
        at = found.column("number").to_numpy()
        n[at], lp[at] = found.column("n").to_numpy(), found.column("lp").to_numpy()
        ends = np.cumsum([0, *row["sizes"]])
        numbers = unpacked(row["numbers"], int(ends[-1]))

        def total(x: np.ndarray) -> np.ndarray:
            out = np.zeros(len(ends) - 1)
            has = np.flatnonzero(np.diff(ends))
            if len(has):
                out[has] = np.add.reduceat(x[numbers], ends[has])
            return out

        return pa.table(
            [
                pa.array(row["doc_ids"], block.schema.field("doc_ids").type.value_type),
                pa.array(row["held_out"], pa.bool_()),
                pa.array(np.diff(ends) + 1),
                pa.array((total((n > 0).astype(np.float64)) + (end[0] > 0)).astype(np.int64)),
                pa.array(np.full(len(ends) - 1, train_tokens, dtype=np.int64)),
                pa.array(total(np.log10((n + 1) / whole)) + end[1]),
                pa.array(total(lp) + end[2]),
            ],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    documents = built.select("block", "doc_ids", "held_out", "sizes", "numbers")
    schema = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return documents.groupBy("block").cogroup(of_block.groupBy("in_block")).applyInArrow(run, schema)
