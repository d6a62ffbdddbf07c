"""Operator 12, spelling variants by permuterm rotations.

Words are counted over all texts. Each word, closed by a terminator, gives all
its rotations. The rotation that starts after a code point ends in that code
point, so without its last one it is a prefix that skips the edited place: two
words that differ there alone share it, and it is a whole rotation of the word
that lacks it. Rotations are sorted, and one scan over each prefix range finds

* replacements: two words with the prefix;
* insertions and deletions: a word with the prefix, and the word whose whole
  rotation it is.

A range holds one word per code point at most, so its size is bounded by the
alphabet. For each of its words the scan emits how many others there are and the
most frequent of them, never the pairs. A deletion within a run of equal code
points meets in several ranges and is counted in that of the run's first one.

Forms point to words of at least ``ratio`` times the count, so a chain has at
most log2(largest count) steps and pointers are doubled a few times.

Defined results: null and empty texts have no words; a null id counts as the
empty string in the checksum of a run; repeated rows count each; among words of
equal count the first in code-point order is the form; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, prepare

#: The contract's values: least length and count of a word, and how much more frequent a form is.
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
#: One run in so many loses a code point.
NOISE = 97
#: Words that a task counts before it hands them on.
TASK_WORDS = 300_000
_TERMINATOR = "\0"


def _runs(least: int) -> re.Pattern[str]:
    """Runs of letters (A-Z lower-cased before) of at least ``least`` code points; greedy, so maximal."""
    return re.compile(rf"[a-zÀ-ÿ]{{{least},}}")


def observed(run: str, checksum: int, noise: int) -> str:
    """The run, or what is left of it where ``noise`` divides its checksum."""
    if noise and checksum % noise == 0:
        k = checksum % len(run)
        return run[:k] + run[k + 1 :]
    return run


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, noise: int = NOISE) -> DataFrame:
    """word, n: the words of all texts that are long and frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = _runs(least_length)
        total: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                prefix = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
                for word, n in Counter(pattern.findall(text.encode().lower().decode())).items():
                    checksum = zlib.crc32(word.encode(), prefix)
                    if noise and checksum % noise == 0:
                        word = observed(word, checksum, noise)
                        if len(word) < least_length:
                            continue
                    total[word] += n
            if len(total) > TASK_WORDS:
                yield _counted(total)
                total = Counter()
        if total:
            yield _counted(total)

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _counted(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])


def rotations(words: DataFrame) -> DataFrame:
    """prefix, word, n, whole, first: every rotation of each word.

    ``whole`` marks whole rotations; the others lack their last code point, and
    ``first`` tells that it does not repeat the one before it in the word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes: list[str] = []
            first: list[bool] = []
            sizes = []
            for word in batch.column("word").to_pylist():
                closed = word + _TERMINATOR
                turned = [closed[i:] + closed[:i] for i in range(len(closed))]
                prefixes += turned
                prefixes += [r[:-1] for r in turned[1:]]
                first += [False] * len(closed)
                first += [i == 0 or word[i] != word[i - 1] for i in range(len(word))]
                sizes.append(len(word))
            n = np.array(sizes, dtype=np.int64)
            rows = np.repeat(np.arange(len(n)), 2 * n + 1)
            within = np.arange(len(rows)) - np.repeat(np.cumsum(2 * n + 1) - (2 * n + 1), 2 * n + 1)
            whole = within <= np.repeat(n, 2 * n + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prefixes, pa.string()), batch.column("word").take(pa.array(rows)), batch.column("n").take(pa.array(rows)), pa.array(whole), pa.array(first, pa.bool_())],
                ["prefix", "word", "n", "whole", "first"],
            )

    return words.select("word", "n").mapInArrow(run, "prefix string, word string, n long, whole boolean, first boolean")


def scan(sorted_rotations: DataFrame) -> DataFrame:
    """word, near, best_n, best: per prefix range and word, its neighbours' number and the first of them.

    The input is sorted within its partitions by prefix, then by descending n and
    by word, and no range crosses partitions. A range that crosses batches is
    carried over; it is no longer than the alphabet.
    """

    def found(t: pa.Table) -> pa.RecordBatch:
        prefix = t.column("prefix").combine_chunks()
        starts = np.concatenate([[True], pc.not_equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False)])
        start = np.flatnonzero(starts)
        size = np.diff(np.append(start, len(starts)))
        group = np.repeat(np.arange(len(start)), size)
        whole, first = (t.column(c).to_numpy() for c in ("whole", "first"))
        holes = np.bincount(group, weights=~whole, minlength=len(start)).astype(np.int64)
        firsts = np.bincount(group, weights=first, minlength=len(start)).astype(np.int64)
        has_whole = holes < size
        near = np.where(whole, firsts[group], holes[group] - 1 + (has_whole[group] & first))
        keep = np.flatnonzero(size[group] > 1)
        best = start[group[keep]]
        best = np.where(best == keep, best + 1, best)
        at = pa.array(keep), pa.array(best)
        return pa.RecordBatch.from_arrays(
            [t.column("word").take(at[0]).combine_chunks(), pa.array(near[keep]), t.column("n").take(at[1]).combine_chunks(), t.column("word").take(at[1]).combine_chunks()],
            ["word", "near", "best_n", "best"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            if carried is not None:
                t = pa.concat_tables([carried, t])
            prefix = t.column("prefix")
            at = t.num_rows - 1
            while at > 0 and prefix[at - 1].as_py() == prefix[at].as_py():
                at -= 1
            if at:
                yield found(t.slice(0, at).combine_chunks())
            carried = t.slice(at)
        if carried is not None:
            yield found(carried.combine_chunks())

    return sorted_rotations.mapInArrow(run, "word string, near long, best_n long, best string")


def neighbours(words: DataFrame) -> DataFrame:
    """word, n, n_near, near_n, near: the number of near words of each word, and the most frequent of them (null if none)."""
    sorted_ = rotations(words).repartition("prefix").sortWithinPartitions("prefix", F.desc("n"), "word")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best")))
    near = scan(sorted_).groupBy(F.col("word").alias("__word")).agg(F.sum("near").alias("n_near"), best.alias("b"))
    joined = words.join(near, F.col("word") == F.col("__word"), "left")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), (-F.col("b.less")).alias("near_n"), F.col("b.best").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word that the forms (columns word, form) lead to; for words with a form.

    Each round doubles the steps that a pointer spans, and is written before the next.
    """
    links = materialize(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        doubled = links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        doubled = materialize(doubled, "spelling-roots")
        moved = doubled.where("moved").limit(1).count()
        discard(links)
        links = doubled
        if not moved:
            return links.select("word", "root")


def variants(docs: DataFrame, ratio: int = RATIO, **counting: int) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word; see the module's docstring."""
    prepare(docs.sparkSession)
    words = materialize(word_counts(docs, **counting), "spelling-words")
    is_form = F.col("near_n") >= ratio * F.col("n")
    forms = neighbours(words).select(
        "word", F.when(is_form, F.col("near")).alias("form"), "n", "n_near", F.when(is_form, F.col("near_n")).alias("form_n")
    )
    forms = materialize(forms, "spelling-forms")
    last = roots(forms).select(F.col("word").alias("__word"), "root")
    out = forms.join(last, F.col("word") == F.col("__word"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
