"""Each operator against a brute-force version on small rows with every odd case."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewlog.llm import (
    bpe,
    jaccard_join,
    lattice_lm,
    line_rules,
    packing,
    quality,
    sharding,
    substring_dedup,
    topk,
    toxicity,
)

from .conftest import docs_frame, edge_texts, words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall((text or "").encode())


def rows(df):
    return [r.asDict() for r in df.collect()]


def key(i):
    return (i is None, i or 0)


# --- 1 -----------------------------------------------------------------------


def toxic_rows(n=400):
    out, labels = [], []
    for i in range(n):
        text = words(60, 1000 + i)
        if i % 4 == 0:
            text[30] = ("zyzzvyk", "zyzzvyka", "zyzzvykor", "zyzzvykum")[i // 4 % 4]
        out.append((i, " ".join(text), "s"))
        labels.append((i, int(i % 4 == 0)))
    return out, labels


def test_toxicity_learns_and_ignores_fold_zero(spark):
    rows_, labels = toxic_rows()
    docs = docs_frame(spark, rows_ + [(1000, " ".join([*words(38, 9), "zyzzvyke", "ab"]), "s"), (1001, "", "s"), (1002, None, "s")])
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in rows(toxicity.score(docs, toxicity.fit(docs, marks)))}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    truth = dict(labels)
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) >= 0.95
    assert got[1000]["predicted"] == 1, "an unseen ending of a known stem"
    assert got[1001]["predicted"] == got[1002]["predicted"] == 0
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    flipped = spark.createDataFrame([(i, 1 - y if i in held else y) for i, y in labels], "doc_id long, toxic int")
    again = {r["doc_id"]: r["score"] for r in rows(toxicity.score(docs, toxicity.fit(docs, flipped)))}
    assert again == {i: r["score"] for i, r in got.items()}


def test_toxicity_edge_rows(spark, edge, empty):
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(edge, no_labels)
    got = rows(toxicity.score(edge, model))
    assert len(got) == len(edge_texts()) and all(r["predicted"] == 0 for r in got)
    assert rows(toxicity.score(empty, model)) == []
    kept = toxicity.accepted(edge, model)
    assert kept.schema == edge.schema and kept.count() == len(edge_texts())
    marks = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (6, None), (9, 0), (10, 0)], "doc_id long, toxic int")
    assert toxicity.score(edge, toxicity.fit(edge, marks)).count() == len(edge_texts())


# --- 2 -----------------------------------------------------------------------


def test_toxicity_long_texts(spark, monkeypatch):
    """Nine in ten labelled texts are long, all toxic ones among them; a few of their words make them toxic."""
    bad = ["vilefoo", "scumbar", "trashqux"]
    rows_, labels = [], []
    for i in range(100):
        w = words(13_000 if i % 10 else 60, 1_000 + i)
        if i % 2:
            for at in range(20, len(w), 300):
                w[at] = bad[(i + at) % 3]
        rows_.append((i, " ".join(w), "s"))
        labels.append((i, i % 2))
    docs = docs_frame(spark, rows_)
    assert sum(len(t) >= 50_000 for _, t, _ in rows_) == 90
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    for class_chars in (toxicity.CLASS_CHARS, 1_000_000):
        monkeypatch.setattr(toxicity.trained_on, "__defaults__", (class_chars,))
        got = {r["doc_id"]: r["predicted"] for r in rows(toxicity.score(docs, toxicity.fit(docs, marks)))}
        assert np.mean([got[i] == y for i, y in labels]) >= 0.95
    used = toxicity.trained_on(np.array([0, 1] * 10), np.full(20, 60_000), 200_000)
    assert used.tolist() == [True] * 4 + [False] + [True, True] + [False] * 13
    assert toxicity.trained_on(np.array([0, 1] * 10), np.full(20, 60_000), 1).sum() == 2


def brute_dedup(texts, window):
    """[(id, text)] in order -> kept words of each."""
    seen, out = set(), []
    for _, text in texts:
        w = tokens(text)
        cut = np.zeros(len(w) + 1, dtype=int)
        mine = []
        for k in range(len(w) - window + 1):
            x = tuple(w[k : k + window])
            if x in seen:
                cut[k] += 1
                cut[k + window] -= 1
            else:
                seen.add(x)
            mine.append(x)
        keep = np.cumsum(cut[:-1]) == 0
        out.append([x for x, y in zip(w, keep, strict=True) if y])
    return out


@pytest.mark.parametrize("hot", [substring_dedup.HOT, 1])
def test_substring_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    rows_ = [r for r in edge_texts() if r[0] not in (5, 15, None)]
    rows_ += [(100 + i, " ".join(words(10, 50 + i) + words(60, 2)[: 20 + i] + words(10, 90 + i)), "s") for i in range(12)]
    rows_.sort(key=lambda r: key(r[0]))
    docs = docs_frame(spark, rows_)
    got = {r["doc_id"]: r for r in rows(substring_dedup.digests(docs))}
    want = brute_dedup([(i, t) for i, t, _ in rows_], 20)
    for (i, t, _), kept in zip(rows_, want, strict=True):
        n = len(tokens(t))
        assert (got[i]["n_words"], got[i]["n_removed"]) == (n, n - len(kept)), i
        assert got[i]["kept_sha256"] == hashlib.sha256(b" ".join(kept)).hexdigest(), i


def test_substring_dedup_edge_rows(spark, edge, empty):
    got = rows(substring_dedup.digests(edge))
    assert len(got) == len(edge_texts())
    assert [r["n_removed"] for r in got if r["doc_id"] == 5] == [0, 0]
    nulls = [r for r in got if r["doc_id"] is None]
    assert sorted(r["n_words"] for r in nulls) == [0, 25]
    assert substring_dedup.digests(empty).count() == 0
    cleaned = substring_dedup.dedup(edge)
    assert cleaned.schema.names == edge.schema.names and cleaned.count() == len(edge_texts())
    one = cleaned.where("doc_id = 1").first()
    assert one["text"] == edge_texts()[0][1] and one["__text"] == "x"
    assert cleaned.where("doc_id = 6").first()["text"] == ""


def test_suffix_automaton_matching_statistics():
    automaton = substring_dedup.SuffixAutomaton()
    reference = [words(30, 1, "ab"), words(30, 2, "ab")]
    for r in reference:
        automaton.add(r)
    query = words(40, 3, "ab")

    def longest(end):
        return max(
            n for n in range(end + 1) if n == 0 or any(r[k : k + n] == query[end - n : end] for r in reference for k in range(len(r) - n + 1))
        )

    assert automaton.matches(query) == [longest(e) for e in range(1, 41)]


# --- 3 -----------------------------------------------------------------------


def test_bpe_equals_the_library(spark, edge, empty):
    import base64

    import public_tokenizers
    import tiktoken

    with open(bpe.default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert public_tokenizers.PATTERN == bpe.PUBLISHED_PATTERN
    extra = [(50 + i, t, "s") for i, t in enumerate(["'s 'll it's\n\n  x \t", "aaaaaaaaaaaaaaab" * 20, "½²٣日 _a_ \x1c", "it’s"])]
    docs = docs_frame(spark, edge_texts() + extra)
    want = Counter()
    for i, t, _ in edge_texts() + extra:
        ids = np.array(library.encode_ordinary(t or ""), dtype="<u4")
        want[i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    got = Counter(tuple(r) for r in bpe.encode(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert got == want
    assert bpe.encode(empty).count() == 0
    full = bpe.encode(docs_frame(spark, [(1, "a b", "s")]), outputs="ids").first()
    assert bytes(full["decoded"]) == b"a b" and len(full["ids"]) == 4 * full["n_tokens"]


def test_every_entry_encodes_to_itself():
    """What lets a step of the long form contract all equal pairs."""
    import public_tokenizers

    codec = bpe.Codec(bpe.default_ranks(), public_tokenizers.PATTERN)
    found = codec.db.sql("SELECT hex, t FROM vocabulary WHERE length(hex) <= 32 USING SAMPLE reservoir(3000 ROWS) REPEATABLE (1)").fetchall()
    data = [bytes.fromhex(h) for h, _ in found]
    short = codec._run(bpe.SHORT_SQL, data)
    long = codec._run(bpe.LONG_SQL, data)
    assert short == long == [np.array([t], dtype="<u4").tobytes() for _, t in found]


# --- 4 -----------------------------------------------------------------------


def test_line_rules_base_statistics(edge, empty):
    got = Counter(tuple(r) for r in line_rules.rule_verdicts(edge).drop("kept", "removed_words").collect())
    want = Counter()
    for i, t, _ in edge_texts():
        w = [x.decode() for x in tokens(t)]
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        twice = {k + j for g, c in Counter(grams).items() if c > 1 for k, x in enumerate(grams) if x == g for j in range(3)} if len(w) < 1000 else set()
        if len(w) >= 1000:
            count = Counter(grams)
            twice = {k + j for k, x in enumerate(grams) if count[x] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if tokens(x)]
        failed = len(w) < 50 or 100 * len(twice) > 50 * len(w)
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(twice), failed] += 1
    assert got == want
    assert line_rules.rule_verdicts(empty).count() == 0


def test_line_rules_remove_frequent_lines_per_host(spark, monkeypatch):
    monkeypatch.setattr(line_rules, "MAX_DOCS", 5)
    common = " ".join(words(60, 1))
    rows_ = [(i, "\n".join([common.upper() if i % 2 else common, " ".join(words(10, 100 + i))]), "host") for i in range(10)]
    rows_ += [(100 + i, "\n".join([common, " ".join(words(80, 300 + i))]), "host") for i in range(4)]
    rows_ += [(200, common + "\n" + " ".join(words(10, 7)), "elsewhere"), (201, common, None)]
    rows_ += [(300 + i, " ".join(words(60, 2)), "copies") for i in range(20)]
    docs = docs_frame(spark, rows_)
    base = line_rules.analyse(docs)
    frequent = line_rules.frequent_lines(base, max_docs=5)
    got = {r["doc_id"]: r for r in rows(line_rules.judge(base, frequent))}
    assert all(got[i]["removed_words"] == 60 and not got[i]["kept"] and not got[i]["base_failed"] for i in range(10))
    assert all(got[100 + i]["removed_words"] == 60 and got[100 + i]["kept"] for i in range(4))
    assert got[200]["kept"] and got[200]["removed_words"] == 0 and got[201]["kept"]
    assert all(got[300 + i]["kept"] for i in range(20)), "copies of one text count once"


def test_line_rules_clean_texts(spark):
    common = " ".join(words(30, 1))
    rows_ = [(i, common + "\n" + " ".join(words(90, 400 + i)), "host") for i in range(30)]
    got = {r["doc_id"]: r["text"] for r in rows(line_rules.clean(docs_frame(spark, rows_)))}
    assert got == {i: t.split("\n")[1] for i, t, _ in rows_}


# --- 5 -----------------------------------------------------------------------


def test_sharding(spark, fresh_dir, edge, empty):
    rows_ = [(i, " ".join(words(5 + i % 40, i)), "s") for i in range(2000)] + [(1, None, "s"), (None, "x", "s"), (None, None, None)] + [(7, "same", "s")] * 5
    docs = docs_frame(spark, rows_)
    got = rows(sharding.shard(docs, f"{fresh_dir}/map"))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows_)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    by_shard = {k: [r for r in got if r["shard"] == k] for k in range(8)}
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by_shard.values())
    loads = [sum(r["size"] for r in v) for v in by_shard.values()]
    assert max(loads) - min(loads) < 200
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    # The stored map is what places records, and both versions stay readable.
    placed = {r["vslot"]: r["shard"] for r in sharding.load_map(spark, f"{fresh_dir}/map").collect()}
    assert all(placed[r["virtual_slot"]] == r["shard"] for r in got) and len(placed) == sharding.SLOTS
    assert sharding.load_map(spark, f"{fresh_dir}/map", 1).where("shard != vslot % 8").count() == 0
    assert sharding.shard(empty, f"{fresh_dir}/none").count() == 0
    assert sharding.shard(edge, f"{fresh_dir}/edge").count() == len(edge_texts())


def test_sharding_uses_no_python(spark, fresh_dir, edge):
    plan = sharding.shard(edge, f"{fresh_dir}/plan")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- 6 -----------------------------------------------------------------------


def brute_components(texts, k, percent):
    sets = []
    for _, t in texts:
        w = [x.lower() for x in tokens(t)]
        sets.append({tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(texts):
        if i is not None:
            least[root(a)] = min(i, least.get(root(a), i))
    return Counter((i, len(sets[a]), (i if not sets[a] else least.get(root(a)))) for a, (i, _) in enumerate(texts))


def near_rows():
    """Groups of near copies, some linked only through a chain, beside unrelated texts that share a passage."""
    rows_ = []
    passage = words(30, 77)
    for g in range(6):
        base = words(60 + 40 * g, 500 + g)
        for c in range(12):
            copy = list(base)
            for e in range(c % 4):
                copy[(7 * c + 13 * e) % len(copy)] = f"edit{g}{c}{e}"
            rows_.append((1000 * g + c, " ".join(copy), "s"))
    for c in range(40):
        rows_.append((9000 + c, " ".join(words(20 + c, 700 + c) + passage), "s"))
    for c in range(10):  # a drifting chain: neighbours link, the ends do not
        base = words(120, 888)
        for e in range(c + 1):
            base[3 + 11 * e] = f"drift{e}"
        rows_.append((9500 + c, " ".join(base), "s"))
    return rows_


@pytest.mark.parametrize(("k", "percent", "rare"), [(4, 85, 2), (5, 80, 2), (4, 85, 0)])
def test_jaccard_components(spark, monkeypatch, k, percent, rare):
    monkeypatch.setattr(jaccard_join, "RARE", rare)
    rows_ = edge_texts() + near_rows()
    docs = docs_frame(spark, rows_)
    got = Counter(tuple(r) for r in jaccard_join.components(docs, k, percent).collect())
    assert got == brute_components([(i, t) for i, t, _ in rows_], k, percent)


def test_jaccard_empty(empty):
    assert jaccard_join.components(empty).count() == 0


def test_signatures_meet_whenever_sets_link():
    """The prefix guarantee itself, for random sets and any frequencies."""
    rng = np.random.default_rng(3)
    for _ in range(150):
        n = int(rng.integers(6, 400))
        tokens_ = rng.integers(1, 1 << 62, n * 2).astype(np.uint64)
        miss = jaccard_join.errors(n, 85)
        a = np.unique(tokens_[:n])
        b = np.unique(np.concatenate([rng.permutation(a)[: len(a) - int(rng.integers(0, miss + 1))], tokens_[n : n + int(rng.integers(0, max(1, n // 15)))]]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * (len(a) + len(b) - both):
            continue
        held = {int(t): int(rng.integers(2, 9)) for t in np.union1d(a, b).view(np.int64)[:: int(rng.integers(1, 3))]}
        held |= {int(t): max(2, held.get(int(t), 2)) for t in np.intersect1d(a, b).view(np.int64)}
        classes = jaccard_join.SizeClasses(85)
        found = [set(jaccard_join.signatures_of(x, len(x), held, classes)) for x in (a, b)]
        assert found[0] & found[1]


# --- 7 -----------------------------------------------------------------------


def test_quality_finds_junk_without_labels(spark, empty, edge):
    rng = np.random.default_rng(1)
    rows_, bad = [], set()
    for i in range(600):
        w = words(80, i, "abcdefghijklmnop")
        text = ", ".join(" ".join(w[a : a + 9]) for a in range(0, 80, 9)) + "."
        if i % 12 == 1:
            text = " ".join(x + "%%%" for x in w)
        elif i % 12 == 5:
            text = " ".join(w).upper().replace(" ", "!! ")
        elif i % 12 == 9:
            text = (w[0] + " ") * int(rng.integers(60, 200))
        if i % 4 == 1:
            bad.add(i)
        rows_.append((i, text, "s"))
    docs = docs_frame(spark, rows_)
    scorer, labels = quality.fit(docs)
    got = {r["doc_id"]: r for r in rows(quality.score(docs, scorer, labels))}
    assert np.mean([not got[i]["kept"] for i in bad]) >= 0.9
    assert np.mean([got[i]["kept"] for i in range(600) if i not in bad]) >= 0.99
    assert 0.6 < labels.good < 0.9
    kept = quality.accepted(docs, scorer)
    assert kept.schema == docs.schema and kept.count() == sum(r["kept"] for r in got.values())
    edge_rows = rows(quality.score(edge, scorer, labels))
    assert len(edge_rows) == len(edge_texts())
    assert not any(r["kept"] for r in edge_rows if r["doc_id"] in (2, 3, 4))
    assert quality.score(empty, *quality.fit(empty)).count() == 0


def test_quality_of_long_texts_only(spark):
    """Every text has over 20,000 characters; clean ones repeat words over their length, as texts do."""
    rng = np.random.default_rng(3)
    vocabulary = sorted(set(words(3_000, 40, "abcdefghijklmnop")))
    rows_, junk = [], set()
    for i in range(60):
        n = 60_000 if i % 6 == 1 else 6_000
        w = [*rng.choice(vocabulary, n)]
        if i % 5 == 0:
            junk.add(i)
            w = [*rng.choice(["#", "$$$", "|||", "BUY", "NOW!!!", "***"], n)]
        else:
            w[9::12] = [x + "." for x in w[9::12]]
        rows_.append((i, " ".join(w), "s"))
    assert min(len(t) for _, t, _ in rows_) > 20_000
    docs = docs_frame(spark, rows_)
    got = rows(quality.score(docs, *quality.fit(docs)))
    assert {r["doc_id"] for r in got if not r["kept"]} == junk
    clean = [t.encode() for i, t, _ in rows_ if i not in junk]
    variety = [x[0] for x in quality.LABELLERS].index("variety")
    assert (quality.votes(quality.statistics(clean)[0])[:, variety] == quality.GOOD).all()
    without_id = docs.withColumn("doc_id", F.lit(None).cast("long"))
    scorer, labels = quality.fit(without_id, 40)  # all rows repeat one id
    assert sum(r["kept"] for r in rows(quality.score(without_id, scorer, labels))) == len(clean)
    short = [" ".join(words(300, 41)).encode(), b"a b a"]
    assert quality.statistics(short)[0]["distinct_share"].tolist() == [len(set(t.split())) / len(t.split()) for t in short]


# --- 8 -----------------------------------------------------------------------


def test_lattice_scores_equal_enumeration():
    pieces = [b"a", b"ab", b"bc", b"abc", b"c"]
    lattice = lattice_lm.Lattice(pieces)
    rng = np.random.default_rng(1)
    logp = np.log(rng.dirichlet(np.ones(257 + len(pieces))))

    def ways(s):
        if not s:
            return [[]]
        return [[s[0], *w] for w in ways(s[1:])] + [[257 + pieces.index(s[:n]), *w] for n in range(1, min(3, len(s)) + 1) if s[:n] in pieces for w in ways(s[n:])]

    texts = [b"abcabc", b"cabbca", b"abcabd"]
    m = np.stack([np.frombuffer(t, dtype=np.uint8) for t in texts])
    got = lattice.forward(m, logp, lattice.edges(m))[-1]
    chances = [[np.exp(logp[w].sum()) for w in map(np.array, ways(t))] for t in texts]
    assert np.allclose(got, [np.log(sum(c)) for c in chances])
    assert np.allclose(got, [lattice.score_long(t, logp) for t in texts])
    out = np.zeros(len(logp))
    lattice.expected(m, np.array([1.0, 2.0, 3.0]), logp, out)
    want = np.zeros(len(logp))
    for t, weight, c in zip(texts, (1, 2, 3), chances, strict=True):
        for w, p in zip(ways(t), c, strict=True):
            np.add.at(want, w, weight * p / sum(c))
    assert np.allclose(out, want)


def test_lattice_lm_base_scores(spark, edge, empty):
    got = rows(lattice_lm.score(edge))
    counts, train = Counter(), 0
    for i, t, _ in edge_texts():
        fold = zlib.crc32(str(i).encode()) % 7 if i is not None else 0
        if fold != 2:
            counts.update([*(x.lower() for x in tokens(t)), None])
    train = sum(counts.values())
    whole = train + len(counts) + 1
    want = sorted(
        (
            key(i),
            len(tokens(t)) + 1,
            sum(counts[x] > 0 for x in [*(y.lower() for y in tokens(t)), None]),
            sum(np.log10((counts[x] + 1) / whole) for x in [*(y.lower() for y in tokens(t)), None]),
        )
        for i, t, _ in edge_texts()
    )
    have = sorted((key(r["doc_id"]), r["n_tokens"], r["n_known"], r["base_score"]) for r in got)
    assert [x[:3] for x in have] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in have], [x[3] for x in want])
    assert {r["train_tokens"] for r in got} == {train}
    assert all(r["score"] < 0 and np.isfinite(r["score"]) for r in got)
    assert lattice_lm.score(empty).count() == 0


def test_lattice_learns_from_long_words(spark, monkeypatch):
    """Most training words exceed 96 bytes, as sentences do that are written without spaces."""
    rng = np.random.default_rng(2)
    parts = ["日本", "語の", "文章", "abc", "ab", "東", "c"]
    texts = ["".join(rng.choice(parts, n)).encode() for n in (3, 5, 60, 90, 90, 400, 2000)]
    texts = texts[:3] + sorted(set(texts[3:]))
    pieces = [p.encode() for p in [*parts, "日本語", "文", "章ab", "▁日本", "本語"]]
    weight = np.arange(1.0, len(texts) + 1)
    lattice = lattice_lm.Lattice(pieces)
    logp = first = np.log(rng.dirichlet(np.ones(257 + len(pieces))))
    monkeypatch.setattr(lattice_lm, "_LONG_STEP", 64)
    got = np.zeros(len(first))
    lattice.expected_long(texts, weight, first, got)
    for _ in range(2):
        sums = np.zeros(len(first))
        marked = np.zeros(len(first))
        for t, n in zip(texts, weight, strict=True):
            lattice.expected(np.frombuffer(t, dtype=np.uint8)[None], np.array([n]), logp, sums)
            lattice.expected(np.frombuffer("▁".encode() + t, dtype=np.uint8)[None], np.array([n]), logp, marked)
        if logp is first:
            assert np.allclose(got, sums)
        expected = np.exp(first) * lattice_lm.PRIOR + marked
        expected[lattice_lm.Lattice.END] += 4
        logp = np.log(expected / expected.sum())
    counts = spark.createDataFrame([(bytearray(t), int(n)) for t, n in zip(texts, weight, strict=True)], "word binary, n long")
    assert np.allclose(lattice_lm.fit_weights(spark, counts, pieces, first, 4), logp)
    scored = {bytes(r["word"]): r["lp"] for r in rows(lattice_lm.score_words(spark, counts, pieces, logp))}
    for t in texts:
        m = np.frombuffer("▁".encode() + t, dtype=np.uint8)[None]
        assert np.isclose(scored[t], lattice.forward(m, logp, lattice.edges(m))[-1][0] / np.log(10))


# --- 9 -----------------------------------------------------------------------


def test_topk_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROW_BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(5)
    data = [(int(i), (rng.normal(0, 0.1, 16)).astype(np.float32).tolist()) for i in range(300)]
    data += [(300 + i, data[20][1]) for i in range(60)]  # ties
    odd = [(1000, None), (1001, [0.5, None]), (1002, [float("nan")] * 16), (1003, [float("inf")] * 16), (None, [0.1] * 16)]
    odd += [(1020, []), (1040, [0.0] * 16), (1060, [1.0, 2.0]), (40, data[40][1])]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.StringType())])
    frame = spark.createDataFrame([(i, v, "x") for i, v in data + odd], schema)
    ok = {i: np.floor(64 * np.array(v, dtype=np.float32).astype(np.float64)).astype(int) for i, v in data + odd if i is not None and i not in (1000, 1001, 1002, 1003)}
    vectors = topk.integer_vectors(frame)
    got = topk.top_k(vectors, vectors.where("vec_id % 20 = 0")).collect()
    want = []
    for q in ok:
        if q % 20 == 0:
            best = sorted((-int(sum(a * b for a, b in zip(ok[q].tolist(), v.tolist(), strict=False))), i) for i, v in ok.items() if i != q)
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best[:20])]
    assert sorted(map(tuple, got)) == sorted(want)
    none = topk.integer_vectors(frame.where("false"))
    assert topk.top_k(none, none).count() == 0
    huge = topk.integer_vectors(spark.createDataFrame([(0, [3e38, 1.0]), (20, [3e38, -1.0])], "vec_id long, embedding array<float>"))
    assert {r["score"] for r in topk.top_k(huge, huge).collect()} == {2**63 - 1}


# --- 10 ----------------------------------------------------------------------


def test_packing(spark, edge, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    extra = [(60 + i, t, "s") for i, t in enumerate(["Don't STOP!! <|endoftext|>a", "ΣΑΣ x\x1cy\x85z", "é, é. ½; a.b,c", "..a,, b!"])]
    docs = docs_frame(spark, edge_texts() + extra)
    got = rows(packing.pack(docs, window=512))
    want = Counter()
    for i, t, _ in edge_texts() + extra:
        want[i, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])] += 1
    stream = sorted(got, key=lambda r: (r["sequence_id"], r["offset"]))
    place = 0
    pieces: list = []
    have = Counter()
    for r in stream:
        assert (r["sequence_id"] * 512 + r["offset"]) == place
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] > 0
        place += r["length"]
        assert r["start"] == len(pieces)
        pieces += np.frombuffer(r["ids"], dtype="<u4").tolist()
        if len(pieces) == r["doc_tokens"]:
            have[r["doc_id"], tuple(pieces)] += 1
            pieces = []
    assert have == want
    assert packing.pack(empty).count() == 0


def test_all_results_on_all_columns_null(spark):
    docs = docs_frame(spark, [(None, None, None)])
    assert substring_dedup.digests(docs).first()["n_words"] == 0
    assert bpe.encode(docs).first()["n_tokens"] == 0
    assert line_rules.rule_verdicts(docs).first()["kept"] is False
    assert jaccard_join.components(docs).first()["component_id"] is None
    assert lattice_lm.score(docs).first()["n_tokens"] == 1
    assert packing.pack(docs).first()["length"] == 1
    assert quality.score(docs, *quality.fit(docs)).first()["kept"] is False
    assert docs.where(F.col("doc_id").isNotNull()).count() == 0


def test_packing_ids_equal_the_library_on_every_letter_before_closing_marks():
    from tokenizers import Tokenizer

    encoder, library = packing._Encoder(packing.default_vocabulary()), Tokenizer.from_file(packing.default_vocabulary())
    letters = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000 and chr(c).isalnum()]
    texts = [c + m for m in (".", "!?") for c in letters] + ["हक़.", "İ, x!", "é.a", "Σ."]
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, np.uint16).tolist() for x in encoder.encode(texts)] == [w.ids for w in want]


def test_packing_ids_stay_the_same_when_caches_overflow(monkeypatch):
    for name, n in (("_CACHE_PIECES", 40), ("_KEEP_PIECES", 10), ("_CACHE_WORDS", 30), ("_KEEP_WORDS", 8)):
        monkeypatch.setattr(packing, name, n)
    texts = [" ".join(w + m for w, m in zip(words(25, i % 7), ["", ".", "!?"] * 9, strict=False)) + f" n{i} é{i}." for i in range(40)]
    encoder = packing._Encoder(packing.default_vocabulary())
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for i in range(0, 40, 4):
        assert [np.frombuffer(x, np.uint16).tolist() for x in encoder.encode(texts[i : i + 4])] == [w.ids for w in want[i : i + 4]]
        if i % 3 == 0:
            encoder.rest()
            assert len(encoder.pieces) <= 10 and len(encoder.words) <= 8


def test_packing_worker_keeps_little_for_tasks_of_other_stages(spark):
    """A worker goes on with other stages beside the executor's heap; it used to keep all it had met."""
    distinct = [a + b + c for a in words(60, 1) for b in words(60, 2) for c in words(60, 3)]
    docs = docs_frame(spark, [(i, " ".join(distinct[i::20]), "s") for i in range(20)]).coalesce(1)
    assert docs.select(F.explode(F.split("text", " ")).alias("w")).distinct().count() > 150_000
    packing.tokenize(docs, packing.default_vocabulary()).agg(F.sum("n")).collect()

    def kept(batches):
        import pyarrow as pa

        from viewlog.llm import packing as own

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [max([0, *(max(len(e.pieces), len(e.words)) for e in own._encoders.values())])]})

    assert spark.range(0, 64, 1, 64).mapInArrow(kept, "n long").agg(F.max("n")).first()[0] <= 120_000


def test_jaccard_links_through_a_row_without_an_id(spark):
    base = words(60, 77)
    left, right = [*base], [*base]
    left[2], right[57] = "left", "right"
    rows_ = [(1, " ".join(left), "s"), (None, " ".join(base), "s"), (3, " ".join(right), "s"), (None, " ".join(words(40, 78)), "s")]
    got = rows(jaccard_join.components(docs_frame(spark, rows_)))
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [(0, 0), (0, 1), (1, 1), (3, 1)]


def test_toxicity_scores_long_texts_as_a_whole(monkeypatch):
    """Cut into parts of any length, a text has the segments, and so the score, of the whole."""
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.normal(0, 1, 1 << 12).astype(np.float32), 0.1)
    texts = [" ".join(words(n, n)) + tail for n in (1, 3, 4, 5, 6, 41, 400) for tail in ("", ". é İx_y  ", "--")] + ["x" * 500, " " * 300 + "ab cd"]
    whole = model.logits(texts)
    for chars in (1, 7, 30, 100):
        monkeypatch.setattr(toxicity, "CHUNK_CHARS", chars)
        assert all("".join(toxicity.parts_of(t)) in (t, t.lower()) for t in texts)
        assert np.allclose(model.logits(texts), whole), chars


def test_toxicity_trains_in_little_memory():
    """The driver's arrays of all words and n-grams are short ones; their sums are those of one step over all."""
    import tracemalloc

    rng = np.random.default_rng(3)
    into, source, values = rng.integers(0, 50, 700_000), rng.integers(0, 90, 700_000), rng.normal(0, 1, 90)
    assert np.array_equal(toxicity._sums(into, values, source, 60), np.bincount(into, weights=values[source], minlength=60))
    vocabulary = words(2000, 8)
    grams, owners = toxicity._ngrams(vocabulary, 1 << 12)
    whole = toxicity.bags(vocabulary, 1 << 12)
    assert np.array_equal(grams, whole.buckets) and np.array_equal(owners, whole.words)
    letters = np.array(list("abcdefghijklmnop"))
    texts = [" ".join(map("".join, rng.choice(letters, (200, 9)))) for _ in range(400)]
    tracemalloc.start()
    try:
        toxicity.train(texts, np.arange(400) % 2, epochs=2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100 << 20, peak  # 80,000 words of 30 n-grams each
