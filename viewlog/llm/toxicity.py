"""Operator 1, toxicity: subword bags, averaged embeddings and a linear softmax.

A word is a run of letters and digits, lower-cased; its vector is the mean of
the embeddings of its character n-grams (3 to 6, with one border on each side),
hashed into a fixed number of buckets. A segment is ``SEGMENT_WORDS``
consecutive words; its vector is the mean of its words' vectors, and a linear
softmax over it gives the segment's probability. A document's score is that of
its most toxic segment, so long documents do not water down a short insult, and
unseen spellings share the n-grams of those seen.

Embeddings and softmax are trained jointly in numpy on a bounded sample of
labelled documents of all lengths (``PER_CLASS`` of each label, by hash order;
sampled texts are used whole). Every fifth of the sample is kept back: tasks
score these texts, again whole, and their scores place the threshold. Should
the others of a class have over ``CLASS_CHARS`` characters in all, those that
come first by hash are trained on and the rest helps to place the threshold.
Since both steps are linear, a trained model reduces to one number per bucket,
which is what tasks receive.

Defined results: a null or empty text, or one without letters and digits, has
the score of an empty bag (the bias alone), kept below 0.5; repeated rows get
equal scores; without any usable label every score is 0; an empty table gives
an empty result; other columns are ignored, or kept as they are by ``accepted``.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, materialize, prepare, sub_batches

BUCKETS = 1 << 18
DIM = 4
SIZES = (3, 4, 5, 6)
SEGMENT_WORDS = 4
PER_CLASS = 1500
#: Characters of each class that the driver trains on (one text at least).
CLASS_CHARS = 4_000_000
EPOCHS = 40
MIN_TEXTS = 4
RATE = 1.0
_WORD = re.compile(r"[^\W_]+")
FOLDS = 5
#: Characters that one numpy step handles; longer texts are cut where a segment ends.
CHUNK_CHARS = 1 << 19
#: N-grams or words that one numpy step of the training handles, and characters of words cut into n-grams at a time.
STEP = 1 << 18

_cache: dict[str, np.ndarray] = {}


def _alnum() -> np.ndarray:
    if "alnum" not in _cache:
        _cache["alnum"] = np.fromiter((chr(c).isalnum() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _cache["alnum"]


@dataclass
class Bags:
    """N-gram buckets with their words; first word of each segment; first segment of each text."""

    buckets: np.ndarray
    words: np.ndarray
    n_words: int
    segments: np.ndarray
    texts: np.ndarray
    n_segments: np.ndarray


def segment_starts(words_per_text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut each text's words into segments of ``size``; a rest under half a segment joins the one before."""
    n_segments = np.maximum((words_per_text + size // 2) // size, (words_per_text > 0).astype(np.int64))
    total = int(n_segments.sum())
    text = np.repeat(np.arange(len(n_segments)), n_segments)
    k = np.arange(total) - np.repeat(np.cumsum(n_segments) - n_segments, n_segments)
    first_word = np.cumsum(words_per_text) - words_per_text
    return first_word[text] + k * size, n_segments


def bags(texts: list[str], buckets: int = BUCKETS, size: int = SEGMENT_WORDS, sizes: Sequence[int] = SIZES) -> Bags:
    joined = " ".join(["", *(t.lower() for t in texts), ""]) + " "
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lengths = np.array([len(t.lower()) + 1 for t in texts], dtype=np.int64)
    inside = _alnum()[codes]
    codes = np.where(inside, codes, np.uint32(32)).astype(np.uint64)
    starts_here = inside.copy()
    starts_here[1:] &= ~inside[:-1]
    starts = np.flatnonzero(starts_here)
    word_at = np.cumsum(starts_here) - 1
    sums = np.concatenate([[0], np.cumsum(inside)])
    found, owners = [], []
    h = codes * np.uint64(0x9E3779B97F4A7C15)
    for n in range(2, max(sizes) + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        h = (h[:m] ^ (h[:m] >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + codes[n - 1 :]
        if n in sizes:
            p = np.flatnonzero(sums[n - 1 : m + n - 1] - sums[1 : m + 1] == n - 2)
            x = (h[p] + np.uint64(n)) * np.uint64(0x94D049BB133111EB)
            found.append((x >> np.uint64(40)).astype(np.int64) % buckets)
            owners.append(word_at[p + 1])
    at = 1 + np.cumsum(np.concatenate([[0], lengths]))[:-1]
    bounds = np.searchsorted(starts, np.append(at, len(codes)))
    segments, n_segments = segment_starts(np.diff(bounds), size)
    return Bags(
        np.concatenate(found) if found else np.empty(0, np.int64),
        np.concatenate(owners) if owners else np.empty(0, np.int64),
        len(starts),
        segments,
        np.cumsum(n_segments) - n_segments,
        n_segments,
    )


def parts_of(text: str, chars: int | None = None, size: int = SEGMENT_WORDS) -> Iterator[str]:
    """The text in parts of about ``chars`` characters that hold the same segments as the whole.

    Every part but the last ends where a segment ends, and the last holds a
    segment's words at least, so that a short rest joins the segment before it.
    """
    chars = chars or CHUNK_CHARS
    if len(text) <= chars:
        yield text
        return
    text = text.lower()  # as words are found in it
    start, end, words, since = 0, None, 0, 0
    for m in _WORD.finditer(text):
        if end is not None and since == size:
            yield text[start:end]
            start, end = end, None
        if end is None and words % size == 0 and m.start() - start >= chars:
            end, since = m.start(), 0
        words += 1
        since += 1
    if end is not None and since >= size:
        yield text[start:end]
        start = end
    yield text[start:]


def _segment_means(word_values: np.ndarray, segments: np.ndarray) -> np.ndarray:
    if not len(segments):
        return np.empty(0)
    counts = np.diff(np.append(segments, len(word_values)))
    return np.add.reduceat(word_values, segments) / counts


@dataclass
class Model:
    """logit(segment) = mean over words of mean over n-grams of ``weights`` + ``bias``."""

    weights: np.ndarray
    bias: float

    def logits(self, texts: list[str]) -> np.ndarray:
        """The largest segment logit of each text; for a text without words the bias, below 0."""
        out = np.full(len(texts), -np.inf)
        cut = [(i, part) for i, t in enumerate(texts) for part in parts_of(t)]
        for lo, hi in sub_batches([len(t) for _, t in cut], CHUNK_CHARS):
            b = bags([t for _, t in cut[lo:hi]], len(self.weights))
            if not len(b.segments):
                continue
            total = np.bincount(b.words, weights=self.weights[b.buckets], minlength=b.n_words)
            count = np.bincount(b.words, minlength=b.n_words)
            means = _segment_means(total / np.maximum(count, 1), b.segments) + self.bias
            has = np.flatnonzero(b.n_segments)
            owner = np.array([i for i, _ in cut[lo:hi]])[has]
            np.maximum.at(out, owner, np.maximum.reduceat(means, b.texts[has]))
        return np.where(np.isneginf(out), min(self.bias, -1.0), out)


def _words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the word numbers of all texts in order, and the words of each text."""
    number: dict[str, int] = {}
    flat, sizes = array("i"), []
    for t in texts:
        before = len(flat)
        flat.extend(number.setdefault(m.group(), len(number)) for m in _WORD.finditer(t.lower()))
        sizes.append(len(flat) - before)
    return list(number), np.array(flat, dtype=np.int32), np.array(sizes, dtype=np.int64)


def _ngrams(vocabulary: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and word numbers of the words' n-grams, the short ones of all words first; few words at a time."""
    found, owners = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
    for n in SIZES:
        for lo, hi in sub_batches([len(w) for w in vocabulary], STEP):
            b = bags(vocabulary[lo:hi], buckets, sizes=(n,))
            found.append(b.buckets.astype(np.int32))
            owners.append((b.words + lo).astype(np.int32))
    return np.concatenate(found), np.concatenate(owners)


def _sums(into: np.ndarray, values: np.ndarray, source: np.ndarray, size: int) -> np.ndarray:
    """``bincount(into, values[source])``: the same additions in the same order, without arrays as long as ``into``."""
    out = np.zeros(size)
    for i in range(0, len(into), STEP):
        np.add.at(out, into[i : i + STEP].astype(np.intp), values[source[i : i + STEP]])
    return out


def train(texts: list[str], labels: np.ndarray, buckets: int = BUCKETS, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Joint full-batch Adam on embeddings and softmax; ``placed`` has yet to set the threshold.

    N-grams that fewer than ``MIN_TEXTS`` sampled texts hold keep a zero vector:
    they could only be learnt by heart. The driver trains beside its JVM, so
    what is as long as all words or n-grams is held in 32 bits and worked on in
    steps of ``STEP``.
    """
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(buckets, dtype=np.float32), -100.0)
    rng = np.random.default_rng(seed)
    vocabulary, flat, sizes = _words(texts)
    starts, n_segments = segment_starts(sizes, SEGMENT_WORDS)
    if not len(starts):
        return Model(np.zeros(buckets, dtype=np.float32), -100.0)
    has = np.flatnonzero(n_segments)
    y = labels.astype(np.float64)[has]
    seg_words = np.diff(np.append(starts, len(flat)))
    doc_of_seg = np.repeat(np.arange(len(has)), n_segments[has])
    seg_of_word = np.repeat(np.arange(len(starts), dtype=np.int32), seg_words)

    # N-grams of the distinct words, without the rare ones.
    grams, words = _ngrams(vocabulary, buckets)
    per_word = np.maximum(np.bincount(words, minlength=len(vocabulary)), 1)
    pair = np.unique(flat.astype(np.int64) * len(has) + doc_of_seg[seg_of_word])
    texts_with_word = np.bincount(pair // len(has), minlength=len(vocabulary))
    del pair
    heard = _sums(grams, texts_with_word, words, buckets)
    often = heard >= MIN_TEXTS
    used = np.flatnonzero(often)
    frequent = often[grams]
    ids, words = (np.cumsum(often, dtype=np.int32) - 1)[grams[frequent]], words[frequent]
    del grams, frequent
    # A step of sqrt(frequency): neither the commonest n-grams nor those of a few texts take over.
    scale = 1 / np.sqrt(heard[used])

    emb = rng.normal(0, 0.01, (DIM, len(used)))
    soft = rng.normal(0, 1.0, (2, DIM))
    bias = np.zeros(2)
    speed = np.zeros_like(emb)
    class_weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    share = 1.0 / np.bincount(doc_of_seg)[doc_of_seg]
    for epoch in range(epochs):
        seg = np.empty((DIM, len(starts)))
        for d in range(DIM):
            word = _sums(words, emb[d], ids, len(vocabulary)) / per_word
            seg[d] = np.add.reduceat(word[flat], starts) / seg_words
        z = soft @ seg + bias[:, None]
        margin = z[1] - z[0]
        if epoch < epochs // 4:  # at first every segment stands for its text, then the most toxic one does
            picked, weight = np.arange(len(margin)), share
        else:
            best = np.lexsort((-margin, doc_of_seg))
            picked = best[np.searchsorted(doc_of_seg[best], np.arange(len(has)))]
            weight = np.ones(len(picked))
        d = doc_of_seg[picked]
        p = 1 / (1 + np.exp(-np.clip(margin[picked], -50, 50)))
        g = (p - y[d]) * class_weight[d] * weight / len(has)
        dz = np.zeros((2, len(margin)))
        dz[1, picked], dz[0, picked] = g, -g
        seg_grad = soft.T @ dz / seg_words
        grads = [np.empty_like(emb), dz @ seg.T, dz.sum(axis=1)]
        for k in range(DIM):
            word_grad = _sums(flat, seg_grad[k], seg_of_word, len(vocabulary)) / per_word
            grads[0][k] = _sums(ids, word_grad, words, len(used))
        rate = RATE * (1 - epoch / epochs)
        step = scale * grads[0]
        speed = 0.8 * speed + step
        emb -= rate * speed / max(np.abs(speed).max(), 1e-12)
        for q, gr in ((soft, grads[1]), (bias, grads[2])):
            q -= rate * gr / max(np.abs(gr).max(), 1e-3)
    weights = np.zeros(buckets, dtype=np.float32)
    weights[used] = (soft[1] - soft[0]) @ emb
    return Model(weights, float(bias[1] - bias[0]))


def placed(model: Model, z: np.ndarray, labels: np.ndarray) -> Model:
    """Shift the bias so that 0 is the cut with the fewest errors of either class, in the middle of equals.

    ``z`` are the model's logits of whole texts that it was not trained on.
    """
    if len(set(labels.tolist())) < 2:
        return model
    cuts = np.sort(z)
    cuts = np.concatenate([[cuts[0] - 1], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1]])
    pos, neg = np.sort(z[labels == 1]), np.sort(z[labels == 0])
    miss = np.searchsorted(pos, cuts) / max(len(pos), 1)
    alarm = 1 - np.searchsorted(neg, cuts) / max(len(neg), 1)
    cost = miss + 2 * alarm
    best = cuts[np.abs(cost - cost.min()) < 1e-12]
    return Model(model.weights, model.bias - float((best[0] + best[-1]) / 2))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame | None:
    """doc_id, toxic, order and whole text of up to ``per_class`` labelled documents of each class.

    They come from the learning folds, by hash order of their ids. First the
    ids are chosen, from the labels alone.
    """
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != 0))
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("order", F.xxhash64("doc_id"))
    present = docs.where("text IS NOT NULL").select("doc_id").distinct()
    usable = marked.join(present, "doc_id", "left_semi")
    chosen = []
    for label in (0, 1):
        chosen += [(r["doc_id"], r["toxic"], r["order"]) for r in usable.where(F.col("toxic") == label).orderBy("order", "doc_id").limit(per_class).collect()]
    if not chosen:
        return None
    spark = docs.sparkSession
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("toxic", T.IntegerType()), T.StructField("order", T.LongType())])
    wanted = F.broadcast(spark.createDataFrame(chosen, schema))  # at most 2 x per_class rows
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(wanted, "doc_id")
    # A repeated id may bring several texts; the least by hash stands for it, so the bound holds.
    rows = rows.groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.first("order").alias("order"), F.min_by("text", F.xxhash64("text")).alias("text"))
    return materialize(rows, "toxic-sample")


def trained_on(labels: np.ndarray, chars: np.ndarray, class_chars: int = CLASS_CHARS) -> np.ndarray:
    """Which of the sampled texts, in hash order, are trained on; the others place the threshold."""
    fifth = np.arange(len(labels)) % 5 == 4
    if len(set(labels[~fifth].tolist())) < 2 or len(set(labels[fifth].tolist())) < 2:
        fifth[:] = False
    out = ~fifth
    for label in (0, 1):
        at = np.flatnonzero(out & (labels == label))
        over = np.cumsum(chars[at]) > class_chars
        over[:1] = False
        out[at[over]] = False
    return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    prepare(docs.sparkSession)
    sampled = sample(docs, labels, per_class)
    if sampled is None:
        return train([], np.empty(0, dtype=np.int64))
    found = sorted(sampled.select("order", "doc_id", "toxic", F.length("text").alias("chars")).collect(), key=lambda r: (r["order"], r["doc_id"]))
    trained = trained_on(np.array([r["toxic"] for r in found]), np.array([r["chars"] for r in found]))
    of_id = {r["doc_id"]: bool(t) for r, t in zip(found, trained, strict=True)}
    schema = T.StructType([sampled.schema["doc_id"], T.StructField("trained", T.BooleanType())])
    split = sampled.join(F.broadcast(docs.sparkSession.createDataFrame(list(of_id.items()), schema)), "doc_id")
    got = sorted(split.where("trained").select("order", "doc_id", "toxic", "text").collect(), key=lambda r: (r["order"], r["doc_id"]))
    model = train([r["text"] for r in got], np.array([r["toxic"] for r in got], dtype=np.int64))
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(own.logits(batch.column("text").to_pylist()))], ["toxic", "z"])

    held = split.where("NOT trained").select("toxic", "text").mapInArrow(run, "toxic int, z double").collect()
    return placed(model, np.array([r["z"] for r in held]), np.array([r["toxic"] for r in held]))


def _probability(model: Model, texts: list[str | None]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.logits([t or "" for t in texts]), -700, 700)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted of every document; reads whole texts."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            p = _probability(own, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double, predicted int")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            yield batch.filter(pa.array(_probability(own, batch.column("text").to_pylist()) < 0.5))

    return docs.mapInArrow(run, docs.schema)
