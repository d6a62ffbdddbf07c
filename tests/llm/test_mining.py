"""Operators 11 to 13 against brute force and the tokenizer library, with every odd row."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from viewlog.llm import collocations, prefix_bpe, spelling

from .conftest import docs_frame, edge_texts, words


def rows(df):
    return [r.asDict() for r in df.collect()]


# --- 11 ----------------------------------------------------------------------


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def brute_collocations(docs, least=10, top=2000):
    """docs: (lang, text)."""
    f = defaultdict(Counter)
    n = Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in (1, 2, 3):
                f[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, c in f.items():
        longer = Counter()
        for p, a in c.items():
            if len(p) == 3 and a >= least:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], a)
        found = []
        for p, a in c.items():
            if len(p) < 2 or a < least or (len(p) == 2 and 100 * longer[p] >= 50 * a):
                continue
            cuts = [(1000000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def phrase_docs(seed=3):
    rng = random.Random(seed)
    vocabulary = words(30, seed) + ["é", "New", "York", "x" * 300, "日本", "\x00", "\x1c"]
    docs = []
    for i in range(300):
        text = " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", ", ", "\n", "\t", " "]) for _ in range(rng.randrange(60)))
        docs.append((rng.choice(["en", "de", None, "", "und"]), text + " new york city " * (i % 5)))
    return docs + [("en", None), (None, None), ("fr", ""), ("fr", " \t\n..,"), ("en", "the of " * 4000)] + docs[:20]


def lang_frame(spark, docs):
    schema = "lang string, text string, w1 string, n long, h long, doc_id long"
    return spark.createDataFrame([(x, t, "w", 1, 2, i) for i, (x, t) in enumerate(docs)], schema).repartition(3)


@pytest.mark.parametrize(("shard_phrases", "filter_bits"), [(1_000_000, 1 << 20), (150, 64)])
def test_collocations_equal_brute_force(spark, shard_phrases, filter_bits):
    """One trie or many, and also where the filters let everything through."""
    docs = phrase_docs()
    got = rows(collocations.collocations(lang_frame(spark, docs), least=4, top=50, shard_phrases=shard_phrases, filter_bits=filter_bits))
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got) == brute_collocations(docs, 4, 50)


def test_collocations_edge_rows(spark, edge, empty):
    docs = [("en", t) for _, t, _ in edge_texts()]
    got = rows(collocations.collocations(edge))
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got) == brute_collocations(docs)
    assert rows(collocations.collocations(empty)) == []


def test_texts_are_cut_at_piece_borders_only(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 40)
    text = collocations.normal("A b. " + "c" * 100 + " d! " + "e f," * 50)
    parts = list(collocations._segments(text))
    assert len(parts) > 3 and b"\n".join(parts) == text


def test_each_position_goes_through_one_trie(spark, monkeypatch):
    """More tries do not mean more passes over the texts, also where dealt rows are small."""
    docs = phrase_docs(5)
    met = []
    count_shard = collocations.count_shard

    def counted(texts, *args):
        met.append(sum(len(collocations.normal(r["text"] or "").split()) for r in rows(texts.select("text"))))
        return count_shard(texts, *args)

    monkeypatch.setattr(collocations, "count_shard", counted)
    monkeypatch.setattr(collocations, "DEALT_BYTES", 64, raising=False)
    monkeypatch.setattr(collocations, "TASK_BYTES", 600, raising=False)
    got = rows(collocations.collocations(lang_frame(spark, docs), least=4, top=50, shard_phrases=50))
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got) == brute_collocations(docs, 4, 50)
    assert len(met) > 4 and sum(met) <= 3 * sum(len(collocations.normal(t or "").split()) for _, t in docs)


def test_double_array_holds_exactly_its_words():
    rng = np.random.default_rng(5)
    child = {(0, int(c)) for c in rng.choice(512, 400, replace=False)}
    parent, symbol = [0], [0]
    level = [0]
    for size in (400, 2000, 3000):
        keys = sorted({(int(rng.choice(level[: 20 if rng.random() < 0.5 else None])), int(rng.integers(512))) for _ in range(size)})
        start = len(parent)
        parent += [p for p, _ in keys]
        symbol += [c for _, c in keys]
        level = list(range(start, len(parent)))
    base, check, slot = collocations.double_array(np.array(parent), np.array(symbol))
    assert len(set(slot.tolist())) == len(parent) and child
    edges = {(p, c): i for i, (p, c) in enumerate(zip(parent, symbol, strict=True)) if i}
    for p in rng.choice(len(parent), 300):
        for c in range(512):
            to = base[slot[p]] + c
            reached = base[slot[p]] > 0 and check[to] == slot[p]
            assert reached == ((int(p), c) in edges)
            if reached:
                assert to == slot[edges[int(p), c]]


# --- 12 ----------------------------------------------------------------------


def brute_spelling(docs):
    """docs: (doc_id, text)."""
    count = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out, form = {}, {}
    for w in n:
        others = [x for x in n if x != w and near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
        out[w] = (len(others), n.get(form[w]))
    result = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        result.append((w, form[w], root, n[w], *out[w]))
    return sorted(result)


def variant_docs(seed=8):
    rng = random.Random(seed)
    stems = ["letter", "aaaaaa", "aaaaa", "aaaaaaa", "spelling", "Élançon", "variant", "abcde"]
    docs = []
    for i in range(250):
        text = []
        for _ in range(40):
            w = list(rng.choice(stems[: 1 + rng.randrange(len(stems))]))
            if rng.random() < 0.4:
                k = rng.randrange(len(w))
                w[k : k + rng.randrange(2)] = rng.choice(["", "a", "e", "ç", "×"])
            text.append("".join(w))
        docs.append((i if i % 50 else None, rng.choice([" ", "-", "1"]).join(text)))
    return docs + [(1000, None), (1001, ""), (1002, "..."), (1003, "x" * 20_000 + " " + "letter " * 5000), (None, "abcdf abcdf abcdf"), (None, "abcdf abcdf abcdf")]


def test_spelling_equals_brute_force(spark):
    docs = variant_docs()
    got = rows(spelling.variants(docs_frame(spark, [(i, t, "s") for i, t in docs])))
    assert sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in got) == brute_spelling(docs)


def test_spelling_edge_rows(spark, edge, empty):
    want = brute_spelling([(i, t) for i, t, _ in edge_texts()])
    got = rows(spelling.variants(edge))
    assert sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in got) == want
    assert rows(spelling.variants(empty)) == []


def test_long_chains_of_forms_reach_their_root(spark):
    chain = ["abcde" + "f" * k for k in range(12)]
    words_ = spark.createDataFrame([(w, chain[k + 1] if k < 11 else None) for k, w in enumerate(chain)], "word string, form string")
    assert {r["word"]: r["root"] for r in rows(spelling.roots(words_))} == {w: chain[-1] for w in chain[:-1]}


def test_ranges_that_cross_batches_are_whole(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        letters = "abcdefghijklmnopqrstuvwxyz"
        words_ = spark.createDataFrame([(f"abc{x}ef", i + 3) for i, x in enumerate(letters)] + [("abcef", 50)], "word string, n long")
        got = {r["word"]: r for r in rows(spelling.neighbours(words_))}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert all(got[f"abc{x}ef"]["n_near"] == 26 and got[f"abc{x}ef"]["near"] == "abcef" for x in letters)
    assert got["abcef"]["n_near"] == 26 and got["abcef"]["near"] == "abczef"


# --- 13 ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(prefix_bpe.default_vocabulary())


@pytest.fixture(scope="module")
def encoder():
    return prefix_bpe.Encoder(prefix_bpe.load(prefix_bpe.default_vocabulary()), prefix_bpe.default_vocabulary())


def same(encoder, library, texts):
    for text, (ids, decoded) in zip(texts, encoder.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text[:80]
        assert decoded.decode() == library.decode(want, skip_special_tokens=False), text[:80]


def test_prefix_bpe_equals_the_library_on_odd_texts(encoder, library):
    same(encoder, library, [t or "" for _, t, _ in edge_texts()])
    same(encoder, library, ["<|endoftext|>", "a<|startoftext|>B<|endoftext|> <|endoftext|", "İstanbul ΣΣ. don'T", "हक़.", "a\x1cb\x85c", "é ́", "a" * 3000])


def test_prefix_bpe_equals_the_library_on_random_texts(encoder, library):
    rng = random.Random(4)
    alphabets = ["abcdeinrst'. ", "aab", "0123456789 ab", "".join(map(chr, [*range(32, 127), *range(0xA0, 0x250), *range(0x900, 0xA00), *range(0x4E00, 0x4E80), *range(0x1F600, 0x1F640)]))]
    same(encoder, library, ["".join(rng.choice(a) for _ in range(rng.randrange(1, 60))) for a in alphabets for _ in range(700)])
    tokens = [t.replace("</w>", "") for t in library.get_vocab()]
    same(encoder, library, ["".join(rng.choice(tokens) for _ in range(rng.randrange(2, 6))) for _ in range(4000)])


def test_prefix_bpe_equals_the_library_on_every_letter_before_a_mark(encoder, library):
    same(encoder, library, [chr(c) + m for c in range(0x3100) if chr(c).isalnum() for m in (".", "'S")])


def test_one_long_word_takes_the_same_steps(encoder, library):
    rng = random.Random(6)
    pieces = ["".join(rng.choice("abcdeinrst") for _ in range(n)).encode() for n in (5, 390, 410, 5000)]
    side = prefix_bpe.encode_side_by_side(encoder.t, pieces)
    assert all(np.array_equal(x, encoder.encode_long(p)) for p, x in zip(pieces, side, strict=True))
    same(encoder, library, [p.decode() for p in pieces])


def test_caches_stay_bounded(monkeypatch, library):
    monkeypatch.setattr(prefix_bpe, "CACHE_WORDS", 50)
    monkeypatch.setattr(prefix_bpe, "CACHE_PIECES", 50)
    monkeypatch.setattr(prefix_bpe, "STEP_CHARS", 300)
    small = prefix_bpe.Encoder(prefix_bpe.load(prefix_bpe.default_vocabulary()), prefix_bpe.default_vocabulary())
    same(small, library, [" ".join(words(60, s)) for s in range(20)] * 2)
    assert max(map(len, (small.words, small.old_words, small.pieces, small.old_pieces))) <= 50 + 300


def test_prefix_bpe_on_spark(spark, edge, empty, library):
    got = rows(prefix_bpe.encode(edge))
    want = []
    for i, t, _ in edge_texts():
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r.values()) for r in got), key=key) == sorted(want, key=key)
    assert rows(prefix_bpe.encode(empty)) == []
    assert rows(prefix_bpe.encode(docs_frame(spark, [(1, "hi", "s")]), outputs="ids"))[0]["decoded"] == "hi</w>"


def test_a_vocabulary_with_other_parts_is_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="does not follow"):
        prefix_bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
