"""Operator 7, quality classifier: a weak-label model and a hashed linear scorer.

Heuristic labellers vote on every document: 1 (good), 0 (bad) or abstain. They
overlap and disagree. Votes are counted by pattern over all documents (at most
3^labellers patterns), and expectation-maximisation over those counts estimates
each labeller's accuracy on each class and the share of good documents, without
any given label. The posterior of a pattern labels its documents. A linear
scorer over hashed features is fitted to a bounded sample (``SAMPLE`` documents
of all lengths, by hash order) with these posteriors and then scores every
document. Tasks compute features and posteriors of the sample, so the driver
gets at most ``BUCKETS`` numbers a document and no text.

Features are hashed character-class 4-grams, hashed word shapes and hashed bins
of the document statistics, so the scorer also judges documents on which most
labellers abstain.

Defined results: a null, empty or blank text is bad by the labellers and has
score 0; repeated rows get equal scores; an empty table gives an empty result;
other columns are ignored, or kept as they are by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, mix, prepare, sub_batches, word_hashes, word_spans

BUCKETS = 1 << 14
SAMPLE = 6000
EM_ROUNDS = 60
EPOCHS = 200
#: Documents that score below this are rejected.
ACCEPT = 0.5

GOOD, BAD, ABSTAIN = 1, 0, -1

#: The share of distinct words falls with length; it is taken within spans of so many words.
SPAN_WORDS = 1000

_LETTER, _UPPER, _DIGIT, _WHITE, _LINE, _HIGH = range(1, 7)


def _classes() -> np.ndarray:
    """Byte -> class: lower, upper, digit, space, line end, high byte; other punctuation has its own."""
    out = np.arange(256, dtype=np.uint64) + np.uint64(16)
    out[ord("a") : ord("z") + 1] = _LETTER
    out[ord("A") : ord("Z") + 1] = _UPPER
    out[ord("0") : ord("9") + 1] = _DIGIT
    out[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = _WHITE
    out[0x0A] = _LINE
    out[128:] = _HIGH
    return out


_CLASS = _classes()
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>{}[]\\^~=@_", dtype=np.uint8)] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[np.frombuffer(b".!?:;\"')", dtype=np.uint8)] = True
_INNER = np.zeros(256, dtype=bool)
_INNER[np.frombuffer(b".,", dtype=np.uint8)] = True

#: name, statistic, votes good below, votes bad from, or the other way round (reverse).
LABELLERS = (
    ("symbols", "symbols_per_word", 0.05, 0.2, False),
    ("symbol_runs", "runs_per_word", 0.05, 0.2, False),
    ("capitals", "upper_share", 0.15, 0.5, False),
    ("exclaiming", "marks_per_word", 0.05, 0.3, False),
    ("repetition", "repeat_share", 0.25, 0.8, False),
    ("variety", "distinct_share", 0.35, 0.12, True),
    ("length", "n_words", 40, 2, True),
    ("word_size", "mean_word", 9.0, 16.0, False),
    ("tables", "bars_per_word", 0.02, 0.15, False),
    ("punctuation", "plain_per_word", 0.02, 0.004, True),
)


def statistics(texts: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Per-text statistics, and (buffer, word starts, words before each text)."""
    buf, starts, ends, bounds = word_spans(texts)
    at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    n = np.diff(bounds)
    some = np.maximum(n, 1)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[at[1:]] - sums[at[:-1]]).astype(np.float64)

    cls = _CLASS[buf]
    symbol = _SYMBOL[buf]
    run = symbol.copy()  # a symbol right after the same one
    run[1:] &= buf[1:] == buf[:-1]
    run[:1] = False
    upper = per_text(cls == _UPPER)
    letters = upper + per_text(cls == _LETTER) + per_text(cls == _HIGH)
    text = np.repeat(np.arange(len(texts)), n)
    h = word_hashes(buf, starts, ends, lower=True)
    key = mix(h ^ (text.astype(np.uint64) << np.uint64(32)))
    span = (np.arange(len(text)) - bounds[text]) // SPAN_WORDS
    _, first = np.unique(mix(key + span.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    distinct = np.bincount(text[first], minlength=len(texts))
    pair = mix(key[:-1] * np.uint64(3) + key[1:]) if len(key) > 1 else np.empty(0, np.uint64)
    same = text[:-1] == text[1:] if len(text) > 1 else np.empty(0, bool)
    pair, pair_text = pair[same], text[:-1][same] if len(text) > 1 else text[:0]
    _, inverse, counts = np.unique(pair, return_inverse=True, return_counts=True)
    repeated = np.bincount(pair_text, weights=(counts[inverse] > 1) if len(pair) else None, minlength=len(texts)) if len(pair) else np.zeros(len(texts))
    stats = {
        "n_words": n.astype(np.float64),
        "symbols_per_word": per_text(symbol) / some,
        "runs_per_word": per_text(run) / some,
        "upper_share": upper / np.maximum(letters, 1),
        "marks_per_word": per_text(buf == ord("!")) / some,
        "repeat_share": repeated / np.maximum(n - 1, 1),
        "distinct_share": distinct / some,
        "mean_word": np.bincount(text, weights=ends - starts, minlength=len(texts)) / some,
        "bars_per_word": per_text(buf == ord("|")) / some,
        "plain_per_word": per_text(_INNER[buf]) / some,
    }
    return stats, buf, starts, bounds


def votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    """texts x labellers of GOOD, BAD or ABSTAIN."""
    columns = []
    for _, name, good, bad, reverse in LABELLERS:
        x = stats[name]
        is_good, is_bad = (x >= good, x <= bad) if reverse else (x <= good, x >= bad)
        vote = np.where(is_bad, BAD, np.where(is_good, GOOD, ABSTAIN))
        if name == "distinct_share":  # says little on short texts, whose words rarely repeat
            vote = np.where(stats["n_words"] < 20, ABSTAIN, vote)
        columns.append(np.where(stats["n_words"] == 0, BAD, vote))
    return np.stack(columns, axis=1)


def patterns(docs: DataFrame) -> DataFrame:
    """``n`` documents of each pattern of votes ('g', 'b' or '-' per labeller)."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = np.array(["b", "g", "-"])
        for batch in batches:
            texts = bytes_of(batch.column("text"))
            counts: dict[str, int] = {}
            for lo, hi in sub_batches([len(t) for t in texts]):
                for row in letters[votes(statistics(texts[lo:hi])[0])]:
                    key = "".join(row)
                    counts[key] = counts.get(key, 0) + 1
            yield pa.RecordBatch.from_pydict({"pattern": list(counts), "n": pa.array(counts.values(), pa.int64())})

    voted = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "pattern string, n long")
    return voted.groupBy("pattern").agg(F.sum("n").alias("n"))


@dataclass
class LabelModel:
    """Share of good documents; accuracy[c, j]: labeller j's chance to vote c on a document of class c."""

    good: float
    accuracy: np.ndarray

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Chance that a document with these votes is good; abstaining says nothing."""
        a = np.clip(self.accuracy, 1e-6, 1 - 1e-6)
        z = np.full(len(v), np.log(max(self.good, 1e-9) / max(1 - self.good, 1e-9)))
        z += np.where(v == GOOD, np.log(a[1] / (1 - a[0])), 0).sum(axis=1)
        z += np.where(v == BAD, np.log((1 - a[1]) / a[0]), 0).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def fit_labels(counts: dict[str, int], rounds: int = EM_ROUNDS) -> LabelModel:
    """Expectation-maximisation from pattern counts.

    It starts from labellers that seldom fault a good document and see only one
    of several kinds of bad ones.
    """
    m = len(LABELLERS)
    model = LabelModel(0.8, np.stack([np.full(m, 0.3), np.full(m, 0.998)]))
    if not counts:
        return model
    code = {"g": GOOD, "b": BAD, "-": ABSTAIN}
    v = np.array([[code[c] for c in p] for p in counts])
    n = np.array(list(counts.values()), dtype=np.float64)
    for _ in range(rounds):
        p = model.posterior(v)
        accuracy = np.empty((2, m))
        for c, weight in ((1, p * n), (0, (1 - p) * n)):
            spoke = (weight[:, None] * (v != ABSTAIN)).sum(axis=0)
            right = (weight[:, None] * (v == c)).sum(axis=0)
            accuracy[c] = (right + model.accuracy[c]) / (spoke + 1.0)
        # A labeller that faults good documents more often than bad ones says nothing.
        accuracy[0] = np.maximum(accuracy[0], 1 - accuracy[1])
        model = LabelModel(float((p * n).sum() / n.sum()), accuracy)
    return model


def features(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value) of the hashed features; each family's values of a text add up to 1."""
    stats, buf, starts, bounds = statistics(texts)
    at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    rows, cols, vals = [], [], []

    def add(text: np.ndarray, x: np.ndarray, family: int) -> None:
        bucket = (mix(x + np.uint64(family << 56)) >> np.uint64(20)).astype(np.int64) % buckets
        key, n = np.unique(text * buckets + bucket, return_counts=True)
        rows.append(key // buckets)
        cols.append(key % buckets)
        total = np.bincount(key // buckets, weights=n, minlength=len(texts))
        vals.append(n / total[key // buckets])

    cls = _CLASS[buf]
    if len(cls) >= 4:
        grams = ((cls[:-3] * np.uint64(512) + cls[1:-2]) * np.uint64(512) + cls[2:-1]) * np.uint64(512) + cls[3:]
        owner = np.searchsorted(at, np.arange(len(grams)), side="right") - 1
        inside = np.arange(len(grams)) + 4 <= at[owner + 1]
        if inside.any():
            add(owner[inside], grams[inside], 1)
    if len(starts):
        text = np.repeat(np.arange(len(texts)), np.diff(bounds))
        _, s, e, _ = word_spans(texts)
        shape = (cls[s] * np.uint64(512) + cls[np.minimum(s + 1, len(cls) - 1)]) * np.uint64(512) + cls[e - 1]
        add(text, shape * np.uint64(64) + np.minimum(e - s, 20).astype(np.uint64), 2)
    for j, (name, x) in enumerate(stats.items()):
        bins = np.floor(np.log2(x + 2.0**-8) * 2).astype(np.int64) + 64
        add(np.arange(len(texts)), bins.astype(np.uint64), 3 + j)
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        out = np.empty(len(texts))
        for lo, hi in sub_batches([len(t) for t in texts]):
            r, c, v = features(texts[lo:hi], len(self.weights))
            z = np.bincount(r, weights=v * self.weights[c], minlength=hi - lo) + self.bias
            blank = np.array([not t.strip() for t in texts[lo:hi]])
            out[lo:hi] = np.where(blank, 0.0, 1 / (1 + np.exp(-np.clip(z, -700, 700))))
        return out


def fit_scorer(r: np.ndarray, c: np.ndarray, v: np.ndarray, good: np.ndarray, buckets: int = BUCKETS, epochs: int = EPOCHS) -> Scorer:
    """Logistic regression on posterior labels by full-batch Adam, with a small L2 term.

    ``r``, ``c`` and ``v`` are the features of the texts, as ``features`` gives them.
    """
    weights, bias = np.zeros(buckets), 0.0
    if not len(good):
        return Scorer(weights, 4.0)
    m, s = np.zeros(buckets + 1), np.zeros(buckets + 1)
    for epoch in range(epochs):
        z = np.bincount(r, weights=v * weights[c], minlength=len(good)) + bias
        g = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - good) / len(good)
        grad = np.append(np.bincount(c, weights=v * g[r], minlength=buckets) + 1e-6 * weights, g.sum())
        m += 0.1 * (grad - m)
        s += 0.01 * (grad * grad - s)
        step = 0.2 * (m / (1 - 0.9 ** (epoch + 1))) / (np.sqrt(s / (1 - 0.99 ** (epoch + 1))) + 1e-8)
        weights, bias = weights - step[:-1], bias - step[-1]
    return Scorer(weights, bias)


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[Scorer, LabelModel]:
    """Label model from all documents; scorer from ``sample`` of them, by hash order of the id."""
    counts = {r["pattern"]: r["n"] for r in patterns(docs).collect()}  # at most 3^labellers rows
    model = fit_labels(counts)
    # The first ids by hash, without their texts; then features and posteriors of just those texts.
    order = F.xxhash64("doc_id")
    last = docs.select(order.alias("h")).orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if last is None:
        return fit_scorer(*np.empty((3, 0)), np.empty(0)), model
    rows = docs.where(order <= last).select(order.alias("h"), F.xxhash64("text").alias("t"), F.col("text").cast("binary").alias("text"))
    over = rows.count() - sample
    if over > 0:  # many rows repeat the last id: of these, the first by hash of the text
        repeats = rows.where(F.col("h") == last)
        text = repeats.select("t").orderBy("t").limit(repeats.count() - over).agg(F.max("t")).first()[0]
        rows = rows.where((F.col("h") < last) | (F.col("t") <= text))
    shared = docs.sparkSession.sparkContext.broadcast((model.good, model.accuracy))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = LabelModel(*shared.value)
        for batch in batches:
            texts = bytes_of(batch.column("text"))
            for lo, hi in sub_batches([len(t) for t in texts]):
                r, c, v = features(texts[lo:hi])
                by_text = np.argsort(r, kind="stable")
                ends = np.cumsum(np.bincount(r, minlength=hi - lo))[:-1]
                columns = [
                    pa.array(labels.posterior(votes(statistics(texts[lo:hi])[0]))),
                    pa.array([x.tobytes() for x in np.split(c[by_text].astype("<u2"), ends)], pa.binary()),
                    pa.array([x.tobytes() for x in np.split(v[by_text].astype("<f4"), ends)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([batch.column("h")[lo:hi], batch.column("t")[lo:hi], *columns], ["h", "t", "good", "c", "v"])

    drawn = rows.mapInArrow(run, "h long, t long, good double, c binary, v binary")
    got = sorted((drawn.orderBy("h", "t").limit(sample) if over > 0 else drawn).collect(), key=lambda x: (x["h"], x["t"], x["good"]))
    c, v = (np.frombuffer(b"".join([bytes(x[k]) for x in got]), dtype=kind) for k, kind in (("c", "<u2"), ("v", "<f4")))
    r = np.repeat(np.arange(len(got)), [len(x["c"]) // 2 for x in got])
    return fit_scorer(r, c.astype(np.int64), v, np.array([x["good"] for x in got])), model


def score(docs: DataFrame, scorer: Scorer, label_model: LabelModel) -> DataFrame:
    """doc_id, score, posterior, n_votes and kept of every document; reads whole texts."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((scorer.weights, scorer.bias, label_model.good, label_model.accuracy))  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, good, accuracy = shared.value
        own, labels = Scorer(weights, bias), LabelModel(good, accuracy)
        for batch in batches:
            texts = bytes_of(batch.column("text"))
            s = own.score(texts)
            parts = [votes(statistics(texts[lo:hi])[0]) for lo, hi in sub_batches([len(t) for t in texts])]
            v = np.concatenate(parts) if parts else np.empty((0, len(LABELLERS)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(s, pa.float64()),
                    pa.array(labels.posterior(v), pa.float64()),
                    pa.array((v != ABSTAIN).sum(axis=1).astype(np.int32)),
                    pa.array(s >= ACCEPT),
                ],
                ["doc_id", "score", "posterior", "n_votes", "kept"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, f"doc_id {id_type}, score double, posterior double, n_votes int, kept boolean")


def accepted(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """The documents that score at least ACCEPT, with all their columns."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((scorer.weights, scorer.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(*shared.value)
        for batch in batches:
            yield batch.filter(pa.array(own.score(bytes_of(batch.column("text").cast(pa.binary()))) >= ACCEPT))

    return docs.mapInArrow(run, docs.schema)
