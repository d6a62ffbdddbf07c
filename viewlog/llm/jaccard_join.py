"""Operator 6, n-gram Jaccard join by token-combination prefixes.

A document is the set of its distinct word shingles (64-bit hashes). Documents
with equal sets are one node. A node of n shingles that links with another lacks
at most e = n - ceil(t n) of them there.

First, nodes that cannot link are set aside. Every node shows its shingles under
a hash bound that falls with its size class; a shown shingle that no other node
shows is missing in any partner, so a node with more than e of those is alone.

The others order their shingles alike, rare ones first (by the number of these
nodes that hold them, then by hash); of any e + 1 of its first shingles a node
shares one with each partner. Rare shingles are indexed alone. Frequent ones are
dealt into groups by hash and indexed by combinations of ``COMBINE`` of a group;
a group only guarantees a shared combination if more of it survive, so the
prefix is extended until singles + sum over groups of (size - COMBINE + 1)
>= e + 1. The number of groups depends on the size class; a node also indexes
for the class below where its partners can be in it.

Nodes with a common signature are candidates, if their sizes, and the shingles
that only one of them has, allow a link. In every signature's bucket, some
pivots (those with most links first) are compared with the members of other
components by their full sets. Found links merge components, so that members of one component are not compared
again; a pivot leaves its bucket, and the number of pivots grows until a bucket
is one component. Once buckets have many pivots, a pair that meets in several
buckets is left to a lower one of them (see ``LOWER``), so that it is not
proposed once by each. So no link between different components is lost,
and no bucket's pairs are listed as a whole where its members are linked.

Defined results: a null, empty or blank text has 0 shingles and its own id as
component; of texts under ``words`` words the whole sequence is the one
shingle; rows of one id are judged each by its text; a row without an id links
like others but names no component; an empty table gives an empty result; other
columns are ignored. Sets are compared by 64-bit hashes of their shingles.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bytes_of, discard, drop_shuffles, materialize, mix, prepare, sub_batches, word_hashes, word_spans

WORDS = 4
PERCENT = 85
#: A shingle that at most so many nodes hold is indexed alone.
RARE = 2
COMBINE = 3
#: Pivots per bucket in the first rounds; later rounds take so many times more each.
FIRST_SLICES = (1, 1)
GROWTH = 64
#: In later rounds a member knows so many of its lower signatures; a pair that shares one of them is left to that bucket.
LOWER = 16


def _sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    buf, starts, ends, bounds = word_spans(texts)
    h = word_hashes(buf, starts, ends, lower=True)
    rolled = np.zeros(max(len(h) - words + 1, 0), dtype=np.uint64)
    for j in range(words):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[j : j + len(rolled)]
    rolled = mix(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            out.append(np.frombuffer(xxhash.xxh3_64_digest(h[a:b].tobytes()), dtype=">u8").astype(np.uint64))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def errors(n: int, percent: int) -> int:
    """Shingles of a set of n that a partner may lack."""
    return n + (-percent * n) // 100


def overlap(n: int, m: int, percent: int) -> int:
    """Common shingles that sets of n and m need to link."""
    return -(-percent * (n + m) // (100 + percent))


class SizeClasses:
    """Sizes in classes so wide that a partner is in the same class or the one beside it."""

    def __init__(self, percent: int) -> None:
        self.percent, self.bounds = percent, [1]

    def of(self, n: int) -> int:
        while self.bounds[-1] <= n:
            self.bounds.append(self.bounds[-1] * 10000 // self.percent**2 + 1)
        return int(np.searchsorted(self.bounds, n, side="right")) - 1

    def groups(self, c: int) -> int:
        self.of(2)
        while len(self.bounds) <= c:
            self.of(self.bounds[-1])
        return max(1, (errors(self.bounds[c], self.percent) + 1) // 4)

    def emitted(self, n: int) -> list[int]:
        """Own class, and the one below if a smaller partner can be in it."""
        own, least = self.of(n), self.of(max(1, -(-self.percent * n // 100)))
        return [own] if own == least else [own, own - 1]

    def shown(self, c: int) -> np.uint64:
        """Nodes of class c show their shingles up to this hash: about 2 e of them, more of small sets."""
        self.groups(c)
        share = 2 * (1 - self.percent / 100) + 12 / self.bounds[c]
        return np.uint64(min(2**64 - 1, int(share * 2**64)))


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n and digest (null for none) of each document's set."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = bytes_of(batch.column("text"))
            for lo, hi in sub_batches([len(t) for t in texts]):
                sets = _sets(texts[lo:hi], words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc_id", "n", "digest"],
                )

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {id_type}, n long, digest binary")


def _digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def nodes_of(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """node, digest, n, shown: one row per distinct set, with the shingles it shows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = SizeClasses(percent)
        for batch in batches:
            texts = bytes_of(batch.column("text"))
            for lo, hi in sub_batches([len(t) for t in texts]):
                sets = [s for s in _sets(texts[lo:hi], words) if len(s)]
                shown = [s[: np.searchsorted(s, classes.shown(classes.of(len(s))), side="right")].tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array(shown, pa.binary())],
                    ["digest", "n", "shown"],
                )

    found = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "digest binary, n long, shown binary")
    # Copies of a set meet in a partial aggregate before the shuffle.
    once = found.groupBy("digest").agg(F.first("n").alias("n"), F.first("shown").alias("shown"))
    return once.withColumn("node", F.monotonically_increasing_id())


def linkable(nodes: DataFrame, percent: int) -> DataFrame:
    """node, digest, n of the nodes that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = SizeClasses(percent)
        for batch in batches:
            shown = [np.frombuffer(x, dtype=np.uint64) for x in batch.column("shown").to_pylist()]
            if shown:
                sizes = [len(x) for x in shown]
                # A larger partner shows less; what it may not show proves nothing.
                sure = [np.searchsorted(x, classes.shown(classes.of(n) + 1), side="right") for x, n in zip(shown, batch.column("n").to_pylist(), strict=True)]
                place = np.arange(sum(sizes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(batch.column("node").to_numpy(), sizes)),
                        pa.array(np.concatenate(shown).view(np.int64)),
                        pa.array((place < np.repeat(sure, sizes)).astype(np.int64)),
                    ],
                    ["node", "h", "sure"],
                )

    # Sets without errors whose partners could only have their size link with nothing else.
    possible = nodes.where(f"(100 - {percent}) * n >= 100 OR 100 * n div {percent} > n")
    rows = possible.select("node", "n", "shown").mapInArrow(run, "node long, h long, sure long")
    alone = rows.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.max("node").alias("node"), F.max("sure").alias("sure"))
    missing = alone.where("c = 1").groupBy("node").agg(F.sum("sure").alias("missing"))
    kept = possible.select("node", "digest", "n").join(missing, "node", "left")
    return kept.where(f"coalesce(missing, 0) <= n - ({percent} * n + 99) div 100").select("node", "digest", "n")


def signatures_of(tokens: np.ndarray, n: int, held_by: dict[int, int], classes: SizeClasses) -> list[int]:
    """The signatures of one node; ``held_by`` has the nodes that hold a shingle (as a signed number), where two or more do."""
    out: list[int] = []
    need = errors(n, classes.percent) + 1
    counts = np.array([held_by.get(t, 1) for t in tokens.view(np.int64).tolist()])
    order = np.lexsort((tokens, counts))
    tokens, counts = tokens[order], counts[order].tolist()
    if need <= len(counts) and counts[need - 1] == 1:
        return out  # more shingles of its own than a partner may lack
    for c in classes.emitted(n):
        m = classes.groups(c)
        group = (mix(tokens ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(m)).tolist()
        found, singles, sure = {}, [], 0
        for t, g, count in zip(tokens.tolist(), group, counts, strict=True):
            if count <= RARE:
                sure += 1
                if count > 1:
                    singles.append((t,))
            else:
                have = found.setdefault(g, [])
                have.append(t)
                sure += len(have) >= COMBINE
            if sure >= need:
                break
        combined = (x for have in found.values() for x in itertools.combinations(sorted(have), COMBINE))
        keys = np.array([(*x, *(0,) * (COMBINE - len(x))) for x in itertools.chain(singles, combined)], dtype=np.uint64)
        if len(keys):
            h = np.full(len(keys), ((c + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1), dtype=np.uint64)
            for j in range(COMBINE):
                h = mix(h * np.uint64(0xD6E8FEB86659FD93) + keys[:, j])
            out += h.view(np.int64).tolist()
    return out


def largest_partner(n: int, own: int, percent: int) -> int:
    """The most shingles that a partner of a set of n can have, if ``own`` of the n are in no other set."""
    return (100 + percent) * (n - own) // percent - n


def possible(members: DataFrame) -> DataFrame:
    """The members of each bucket (sig, n, cap) that another one's size allows to link, where two or more are left."""
    bounds = members.groupBy("sig").agg(F.min("n").alias("_least"), F.max("cap").alias("_cap"))
    kept = members.join(bounds, "sig").where("cap >= _least AND n <= _cap").drop("_least", "_cap")
    several = kept.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("sig")
    return kept.join(several, "sig")


def signatures(sets: DataFrame, percent: int) -> DataFrame:
    """sig, node, n, cap (``largest_partner``) of the signatures that two nodes or more have; ``sets`` has node, n, tokens."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [np.frombuffer(x, dtype=np.int64) for x in batch.column("tokens").to_pylist()]
            if tokens:
                node = np.repeat(batch.column("node").to_numpy(), [len(x) for x in tokens])
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.concatenate(tokens))], ["node", "h"])

    rows = sets.select("node", "tokens").mapInArrow(explode, "node long, h long")
    held = rows.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = rows.join(held, "h").groupBy("node").agg(F.collect_list("h").alias("hs"), F.collect_list("c").alias("cs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = SizeClasses(percent)
        for batch in batches:
            out: list[list[int]] = [[], [], [], []]
            for i, n, tokens, hs, cs in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "tokens", "hs", "cs")), strict=True):
                found = signatures_of(np.frombuffer(tokens, dtype=np.uint64), n, dict(zip(hs, cs, strict=True)), classes)
                cap = largest_partner(n, n - len(hs), percent)
                for column, values in zip(out, (found, [i] * len(found), [n] * len(found), [cap] * len(found)), strict=True):
                    column += values
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["sig", "node", "n", "cap"])

    shared = sets.join(shared, "node").select("node", "n", "tokens", "hs", "cs")
    signed = materialize(shared.mapInArrow(run, "sig long, node long, n long, cap long"), "jaccard-signed")
    return possible(signed)


def connected(edges: DataFrame) -> DataFrame:
    """node, comp: every node of the edges (u, v) with the least node of its component.

    Alternating large-star and small-star steps; each writes its edges, so a
    lost executor costs one step.
    """
    def directed(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = materialize(directed(edges).distinct(), "components")
    before = None
    while (seen := state(now)) != before:
        before = seen
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = directed(large)  # repeats go with those of the small-star step
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        now = materialize(directed(small).distinct(), "components")
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp"))


def _decide(n: int, a: np.ndarray, m: int, b: np.ndarray, percent: int) -> bool:
    return len(np.intersect1d(a, b, assume_unique=True)) >= overlap(n, m, percent)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their full sets."""
    sides = pairs.join(sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("xa")), "a")
    sides = sides.join(sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("xb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xa, xb = ([np.frombuffer(x, dtype=np.uint64) for x in batch.column(c).to_pylist()] for c in ("xa", "xb"))
            linked = [_decide(len(a), a, len(b), b, percent) for a, b in zip(xa, xb, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    # Sizes alone rule many pairs out.
    sides = sides.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    return sides.select("a", "b", "xa", "xb").mapInArrow(run, "a long, b long")


def full_sets(docs: DataFrame, sets: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node, n, tokens of the wanted nodes (node, digest, n), from the text of one document each."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = bytes_of(batch.column("text"))
            for lo, hi in sub_batches([len(t) for t in texts]):
                digests = [_digest(s) for s in _sets(texts[lo:hi], words)]
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), batch.column("text").slice(lo, hi - lo)], ["digest", "text"])

    one = sets.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    one = wanted.join(one, "digest").select("doc_id", "node", "n", "digest")
    text = F.col("text").cast("binary").alias("text")
    named = docs.select("doc_id", text).join(one.where("doc_id IS NOT NULL"), "doc_id").select("node", "n", "digest", "text")
    # Sets that only rows without an id hold are found by their digest.
    bare = docs.where("doc_id IS NULL").select(text).mapInArrow(digested, "digest binary, text binary")
    bare = bare.join(one.where("doc_id IS NULL"), "digest").select("node", "n", "digest", "text").dropDuplicates(["node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = bytes_of(batch.column("text"))
            for lo, hi in sub_batches([len(t) for t in texts]):
                found = _sets(texts[lo:hi], words)
                digests = batch.column("digest").slice(lo, hi - lo).to_pylist()
                # Of rows that repeat the id, those with another text are not meant.
                keep = [i for i, (s, d) in enumerate(zip(found, digests, strict=True)) if len(s) and _digest(s) == d]
                at = pa.array(keep, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node").slice(lo, hi - lo).take(at),
                        batch.column("n").slice(lo, hi - lo).take(at),
                        pa.array([found[i].tobytes() for i in keep], pa.binary()),
                    ],
                    ["node", "n", "tokens"],
                )

    return named.unionByName(bare).mapInArrow(run, "node long, n long, tokens binary").dropDuplicates(["node"])


def link(spark: SparkSession, tokens: DataFrame, percent: int) -> DataFrame:
    """node, comp of the nodes that link with others; ``tokens`` has node, n, tokens."""
    buckets = materialize(signatures(tokens, percent), "jaccard-buckets")
    drop_shuffles(spark)
    none = spark.createDataFrame([], "a long, b long")
    comp = spark.createDataFrame([], "node long, comp long")
    links, tested = none, none
    for slices in itertools.chain(FIRST_SLICES, (GROWTH**k for k in itertools.count(1))):
        degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("d"))
        known = buckets.join(comp, "node", "left").join(degree, "node", "left")
        known = known.select("sig", "node", "n", "cap", F.coalesce("comp", "node").alias("comp"), F.coalesce("d", F.lit(0)).alias("d"))
        open_ = known.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("sig")
        members = known.join(open_, "sig")
        if slices > 1:
            below = Window.partitionBy("node").orderBy("sig").rowsBetween(-LOWER, -1)
            members = members.withColumn("lower", F.collect_list("sig").over(below))
        else:
            members = members.withColumn("lower", F.array().cast("array<long>"))
        members = materialize(members, "jaccard-members")
        # Pivots: one member of each slice of a bucket that holds several components, those with most links first.
        best = F.min(F.struct((-F.col("d")).alias("d"), "node", "comp", "n", "cap", "lower")).alias("p")
        chosen = members.groupBy("sig", F.pmod(F.xxhash64("node"), F.lit(slices)).alias("part")).agg(best)
        pivot = [F.col(f"p.{c}").alias(f"p_{c}") for c in ("node", "comp", "n", "cap", "lower")]
        chosen = materialize(chosen.select("sig", *pivot), "jaccard-pivots")
        if chosen.isEmpty():
            return comp
        pairs = members.join(chosen, "sig").where("comp != p_comp AND n <= p_cap AND p_n <= cap AND NOT arrays_overlap(lower, p_lower)")
        pairs = pairs.select(F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b")).distinct()
        pairs = materialize(pairs.join(tested, ["a", "b"], "left_anti"), "jaccard-pairs")
        found = materialize(verified(pairs, tokens, percent), "jaccard-links")
        drop_shuffles(spark)
        links, tested = links.union(found), tested.union(pairs)
        if not found.isEmpty():
            edges = found.select(F.col("a").alias("u"), F.col("b").alias("v")).union(comp.select("node", "comp"))
            comp = connected(edges)
        # A pivot has met its whole bucket, but for pairs left to a lower bucket that both are still in, as
        # their components differ and their sizes fit there too: the pairs left to compare are among the others.
        met = chosen.select("sig", F.col("p_node").alias("node"))
        buckets = possible(members.select("sig", "node", "n", "cap").join(met, ["sig", "node"], "left_anti"))


def components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the least id reachable by links) of every document."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select("doc_id", "text")
    sets = materialize(shingle_sets(docs, words), "jaccard-sets")
    nodes = materialize(nodes_of(docs, words, percent), "jaccard-nodes")
    drop_shuffles(spark)
    wanted = materialize(linkable(nodes, percent), "jaccard-linkable")
    named = materialize(nodes.select("node", "digest"), "jaccard-names")
    discard(nodes)
    drop_shuffles(spark)
    tokens = materialize(full_sets(docs, sets, wanted, words), "jaccard-tokens")
    drop_shuffles(spark)
    comp = link(spark, tokens, percent)
    member = sets
    # Least id of each set, then of each component; both sums are partial before they shuffle.
    least = member.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    of_node = least.join(named, "digest").join(comp, "node", "left")
    of_node = of_node.select("digest", "doc_id", F.coalesce("comp", "node").alias("comp"))
    first = of_node.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = of_node.join(first, "comp").select("digest", "component_id")
    return member.join(named, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )
