"""Operator 13, BPE encoding and decoding by dynamic programming over prefixes.

For a vocabulary of merges, every prefix of a word has one last token: the only
token that ends there, encodes to itself, and is compatible with the last token
of the prefix before it. Two tokens are compatible if the merges, applied to
their joined symbols, leave exactly these two. So a word is encoded in one pass:

1. A suffix automaton of all tokens, streamed over the word, gives at each place
   the tokens that end there, longest first.
2. Each is tested against the last token of the prefix that it leaves; the one
   that passes is stored for this prefix.
3. Back-pointers (token lengths) from the end of the word give its ids.

A word's symbols are its bytes and an end mark; a token with the end-of-word
suffix ends in that mark. Compatibility undoes the merges of both tokens along
their boundary, latest first, and fails if a merge across it would have come
first. Many words advance side by side in numpy; words over ``LONG_WORD`` bytes
take the same steps one by one, in time linear in their length. Text becomes
words by the library's own normaliser and pre-tokeniser, run once per distinct
word that is not plain Latin text. Each worker keeps recent words and pieces in
bounded caches; the automaton (a fixed size, given by the vocabulary) is built
once on the driver and broadcast.

Special tokens in a text get their ids, as in the library. Decoding joins the
vocabulary's strings of the ids with one space, which is what the library does
for a vocabulary without a decoder.

Defined results: a null or empty text has no ids and decodes to the empty
string; repeated rows get equal results; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from .common import prepare, sub_batches

#: Bytes above which a word is encoded on its own.
LONG_WORD = 400
#: Words and pieces that one generation of a worker's caches holds; two generations live.
CACHE_WORDS, CACHE_PIECES = 150_000, 150_000
#: Longer words and pieces are not kept.
CACHE_CHARS = 64
#: Pieces that advance side by side, and characters of text handled at a time.
SIDE_BY_SIDE, STEP_CHARS = 16_384, 1 << 20

#: White space of the library's normaliser; ``str.split`` also splits at ODD.
WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
ODD = re.compile(r"[\x1c-\x1f]")
#: Words that neither normalisation nor lower-casing changes in length, and the published pattern for them.
PLAIN = re.compile(r"[!-~\xc0-\xff]*")
PLAIN_PATTERN = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-z\xe0-\xf6\xf8-\xff\xdf]+|[0-9]|[^a-z0-9\xe0-\xf6\xf8-\xff\xdf]+")
#: Fixed value: the pattern that the vocabulary was published with; PLAIN_PATTERN stands in for this one only.
PUBLISHED_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_END = 256
_SYMBOLS = 257
_NEVER = np.int32(2**31 - 1)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Automaton:
    """Suffix automaton of a set of symbol strings: longest length, suffix link and transitions of each state."""

    def __init__(self) -> None:
        self.length, self.link = [0], [-1]
        self.next: list[dict[int, int]] = [{}]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        return len(self.length) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """A copy of ``q`` for the strings reached from ``p`` by ``c``, where ``q`` also holds longer ones."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def add(self, symbols: tuple[int, ...]) -> int:
        """Add one string; the state that holds it whole."""
        last = 0
        for c in symbols:
            q = self.next[last].get(c)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
                continue
            new, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
            last = new
        return last

    def state_of(self, symbols: tuple[int, ...]) -> int:
        s = 0
        for c in symbols:
            s = self.next[s][c]
        return s


@dataclass
class Tables:
    """What tasks need of a vocabulary; a size given by the vocabulary alone."""

    hash_keys: np.ndarray  # automaton moves, open addressing: state * 257 + symbol
    hash_states: np.ndarray
    hash_probes: int
    length: np.ndarray  # of a state's longest string
    link: np.ndarray
    top: np.ndarray  # longest token that is a suffix of the state's longest string, or -1
    size: np.ndarray  # symbols of a token
    chain: np.ndarray  # the next shorter token that is a suffix of a token, or -1
    rank: np.ndarray  # of the merge that makes a token; -1 for symbols
    left: np.ndarray
    right: np.ndarray
    merge_keys: np.ndarray  # left * 2^16 + right, open addressing
    merge_ranks: np.ndarray
    merge_probes: int
    ids: np.ndarray  # vocabulary id of a token
    strings: list[bytes]  # by vocabulary id
    special: dict[str, int]
    pattern: str


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * _MULTIPLIER) >> np.uint64(64 - bits)).astype(np.int64)


def _hash_table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys and values by linear probing, at most half full, and the longest probe."""
    bits = max(4, int(2 * len(keys)).bit_length())
    size = 1 << bits
    table, out = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int32)
    at, open_, probes = _slots(keys, bits), np.arange(len(keys)), 0
    while len(open_):
        free = open_[table[at[open_]] < 0]
        table[at[free]] = keys[free]
        won = open_[table[at[open_]] == keys[open_]]
        out[at[won]] = values[won]
        open_ = open_[table[at[open_]] != keys[open_]]
        at[open_] = (at[open_] + 1) & (size - 1)
        probes += 1
    return table, out, probes


def _look_up(table: np.ndarray, values: np.ndarray, probes: int, keys: np.ndarray) -> np.ndarray:
    """The value of each key, -1 where it is missing."""
    bits = len(table).bit_length() - 1
    at = _slots(keys, bits)
    found = table[at]
    out = np.where(found == keys, values[at], np.int32(-1))
    open_ = np.flatnonzero((found != keys) & (found >= 0))
    for step in range(1, probes):
        if not len(open_):
            break
        at_ = (at[open_] + step) & (len(table) - 1)
        found = table[at_]
        hit = found == keys[open_]
        out[open_[hit]] = values[at_[hit]]
        open_ = open_[~hit & (found >= 0)]
    return out


def _pair_stays(pairs: dict[int, int], rank: list[int], left: list[int], right: list[int], a: int, b: int, limit: int) -> bool:
    """Whether the merges before ``limit`` leave the boundary between tokens ``a`` and ``b`` as it is."""
    a_until = b_until = limit
    while True:
        m = pairs.get(a * 65536 + b, limit)
        if m < a_until and m <= b_until and m < limit:
            return False
        if rank[a] < 0 and rank[b] < 0:
            return True
        if rank[a] > rank[b]:
            a_until, a = rank[a], right[a]
        else:  # of equal ranks the right one came last
            b_until, b = rank[b], left[b]


def load(path: str) -> Tables:
    """The tables of a BPE vocabulary file with byte-level symbols and an end-of-word suffix.

    Files with other parts than those that this operator follows are refused.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, alphabet = spec["model"], byte_alphabet()
    parts = [p["type"] for k, inner in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")) for p in (spec[k] or {}).get(inner, ())]
    suffix = model.get("end_of_word_suffix")
    fits = (
        model["type"] == "BPE" and not model["dropout"] and not model["continuing_subword_prefix"] and suffix and not model.get("ignore_merges")
        and spec["decoder"] is None and parts == ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]
        and all(not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]) for t in spec["added_tokens"])
    )
    vocab = model["vocab"]
    fits = fits and all(c in vocab and c + suffix in vocab for c in alphabet)  # so every prefix has a last token
    if not fits or len(vocab) > 1 << 16:
        raise ValueError("this vocabulary file has parts that the prefix encoder does not follow")

    def symbols(token: str) -> tuple[int, ...]:
        ends = token.endswith(suffix)
        return (*(alphabet[c] for c in (token[: -len(suffix)] if ends else token)), *((_END,) if ends else ()))

    # Tokens that merges can make, in the order of merges: first the symbols, with and without the end mark.
    base = [c for c in vocab if len(c) == 1 and c in alphabet]
    base += [c + suffix for c in base if c + suffix in vocab]
    number = {t: i for i, t in enumerate(base)}
    rank, left, right = [-1] * len(base), list(range(len(base))), list(range(len(base)))
    pairs: dict[int, int] = {}
    for r, merge in enumerate(model["merges"]):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        if a + b in number:
            raise ValueError("two merges make one token")
        number[a + b] = len(rank)
        pairs[number[a] * 65536 + number[b]] = r
        rank.append(r)
        left.append(number[a])
        right.append(number[b])
    tokens = list(number)

    # A token that merges never make is no candidate.
    made = [True] * len(base)
    for t in range(len(base), len(rank)):
        made.append(made[left[t]] and made[right[t]] and _pair_stays(pairs, rank, left, right, left[t], right[t], rank[t]))
    automaton = _Automaton()
    whole = [symbols(t) for t in tokens]
    for t, s in enumerate(whole):
        if made[t]:
            automaton.add(s)
    of_string = {s: t for t, s in enumerate(whole) if made[t]}
    size = [len(s) for s in whole]
    chain = [-1] * len(whole)
    longest_in: dict[int, list[int]] = {}
    for s, t in of_string.items():
        chain[t] = next((of_string[s[k:]] for k in range(1, len(s)) if s[k:] in of_string), -1)
        longest_in.setdefault(automaton.state_of(s), []).append(t)
    top = [-1] * len(automaton.length)
    for s in sorted(range(1, len(top)), key=automaton.length.__getitem__):
        here = longest_in.get(s)
        top[s] = max(here, key=size.__getitem__) if here else top[automaton.link[s]]
    moves = [(s * _SYMBOLS + c, q) for s, m in enumerate(automaton.next) for c, q in m.items()]
    keys, states = (np.array(x, dtype=np.int64) for x in zip(*moves, strict=True))
    merge_keys = np.array(list(pairs), dtype=np.int64)
    narrow = lambda x: np.array(x, dtype=np.int32)
    hash_keys, hash_states, hash_probes = _hash_table(keys, states.astype(np.int32))
    m_keys, m_ranks, m_probes = _hash_table(merge_keys, narrow(list(pairs.values())))
    strings = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
    for t, i in [*vocab.items(), *((t["content"], t["id"]) for t in spec["added_tokens"])]:
        strings[i] = t.encode()
    return Tables(
        hash_keys, hash_states, hash_probes, narrow(automaton.length), narrow(automaton.link), narrow(top), narrow(size), narrow(chain),
        narrow(rank), narrow(left), narrow(right), m_keys, m_ranks, m_probes, narrow([vocab[t] for t in tokens]), strings,
        {t["content"]: t["id"] for t in spec["added_tokens"]}, spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"],
    )


def compatible(t: Tables, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each pair of tokens, side by side, is what the merges leave of their joined symbols."""
    out = np.ones(len(a), dtype=bool)
    rows, a, b = np.arange(len(a)), a.copy(), b.copy()
    a_until, b_until = np.full(len(a), _NEVER), np.full(len(a), _NEVER)
    while len(rows):
        m = _look_up(t.merge_keys, t.merge_ranks, t.merge_probes, a.astype(np.int64) * 65536 + b)
        crossed = (m >= 0) & (m < a_until) & (m <= b_until)
        out[rows[crossed]] = False
        ra, rb = t.rank[a], t.rank[b]
        live = ~crossed & ((ra >= 0) | (rb >= 0))
        rows, a, b, ra, rb, a_until, b_until = (x[live] for x in (rows, a, b, ra, rb, a_until, b_until))
        undo = ra > rb  # the later merge first; of equal ones the right, as the left came first
        a_until, a = np.where(undo, ra, a_until), np.where(undo, t.right[a], a)
        b_until, b = np.where(undo, b_until, rb), np.where(undo, b, t.left[b])
    return out


def encode_side_by_side(t: Tables, pieces: list[bytes]) -> list[np.ndarray]:
    """The token numbers of each piece; all pieces advance by one symbol at a time."""
    order = np.argsort([-len(p) for p in pieces], kind="stable")
    n = np.array([len(pieces[i]) for i in order])
    wide = int(n[0]) + 1
    symbols = np.full((len(order), wide), _END, dtype=np.int64)
    flat = np.frombuffer(b"".join([pieces[i] for i in order]), dtype=np.uint8)
    symbols[np.arange(wide)[None, :] < n[:, None]] = flat
    last = np.full((len(order), wide + 1), -1, dtype=np.int32)  # last token of each prefix
    state, matched = np.zeros(len(order), dtype=np.int32), np.zeros(len(order), dtype=np.int32)
    for i in range(wide):
        live = int(np.searchsorted(-n, -i, side="right"))  # pieces of at least i bytes, the end mark included
        s, l, c = state[:live], matched[:live], symbols[:live, i]
        rows = np.arange(live)
        while len(rows):
            to = _look_up(t.hash_keys, t.hash_states, t.hash_probes, s[rows].astype(np.int64) * _SYMBOLS + c[rows])
            hit = to >= 0
            s[rows[hit]] = to[hit]
            l[rows[hit]] += 1
            rows = rows[~hit]
            s[rows] = t.link[s[rows]]
            l[rows] = t.length[s[rows]]
        token = t.top[s]
        while (long := t.size[token] > l).any():
            token = np.where(long, t.chain[token], token)
        rows = np.arange(live)
        while len(rows):
            size = t.size[token]
            before = last[rows, i + 1 - size]
            ok = size == i + 1
            rest = np.flatnonzero(~ok & (before >= 0))
            ok[rest] = compatible(t, before[rest], token[rest])
            last[rows[ok], i + 1] = token[ok]
            rows, token = rows[~ok], t.chain[token[~ok]]
    out: list[np.ndarray] = [np.empty(0, dtype=np.int32)] * len(pieces)
    at, rows = n + 1, np.arange(len(order))
    back = np.full((len(order), wide), -1, dtype=np.int32)
    k = 0
    while len(rows):
        token = last[rows, at[rows]]
        back[rows, wide - 1 - k] = token
        at[rows] -= t.size[token]
        rows = rows[at[rows] > 0]
        k += 1
    counts = (back >= 0).sum(axis=1)
    for row, (i, m) in enumerate(zip(order.tolist(), counts.tolist(), strict=True)):
        out[i] = back[row, wide - m :]
    return out


class Encoder:
    """Encoder and decoder of texts for one worker, with bounded caches of words and pieces."""

    def __init__(self, tables: Tables, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self.t = tables
        library = Tokenizer.from_file(vocabulary)
        self.normalise, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.alphabet = byte_alphabet()
        self.plain = tables.pattern == PUBLISHED_PATTERN
        self.specials = re.compile("|".join(map(re.escape, sorted(tables.special, key=len, reverse=True))) or r"(?!)")
        self.words: dict[str, tuple[bytes, bytes]] = {}
        self.old_words: dict[str, tuple[bytes, bytes]] = {}
        self.pieces: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self._lists: tuple | None = None

    def encode_long(self, piece: bytes) -> np.ndarray:
        """The same steps for one piece, symbol by symbol."""
        t = self.t
        if self._lists is None:
            dicts = (
                dict(zip(keys[keys >= 0].tolist(), values[keys >= 0].tolist(), strict=True))
                for keys, values in ((t.hash_keys, t.hash_states), (t.merge_keys, t.merge_ranks))
            )
            self._lists = (*dicts, *(x.tolist() for x in (t.length, t.link, t.top, t.size, t.chain, t.rank, t.left, t.right)))
        moves, pairs, length, link, top, size, chain, rank, left, right = self._lists
        tested: dict[int, bool] = {}
        last, s, matched = [-1], 0, 0
        for i, c in enumerate([*piece, _END], 1):
            while (to := moves.get(s * _SYMBOLS + c)) is None:
                s = link[s]
                matched = length[s]
            s, matched = to, matched + 1
            token = top[s]
            while size[token] > matched:
                token = chain[token]
            while token >= 0 and size[token] < i:
                before = last[i - size[token]]
                if before >= 0:
                    pair = before * 65536 + token
                    if pair not in tested:
                        if len(tested) > CACHE_PIECES:
                            tested.clear()
                        tested[pair] = _pair_stays(pairs, rank, left, right, before, token, 1 << 31)
                    if tested[pair]:
                        break
                token = chain[token]
            last.append(token)
        out, i = [], len(piece) + 1
        while i > 0:
            out.append(last[i])
            i -= size[last[i]]
        return np.array(out[::-1], dtype=np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian 32-bit integers."""
        out = [b""] * len(pieces)
        short = sorted((i for i, p in enumerate(pieces) if len(p) <= LONG_WORD), key=lambda i: len(pieces[i]))
        for a in range(0, len(short), SIDE_BY_SIDE):
            part = short[a : a + SIDE_BY_SIDE]
            found = encode_side_by_side(self.t, [pieces[i] for i in part])
            ids = self.t.ids[np.concatenate(found)].astype("<u4").tobytes()
            ends = (4 * np.cumsum([0, *map(len, found)])).tolist()
            for i, x, y in zip(part, ends[:-1], ends[1:], strict=True):
                out[i] = ids[x:y]
        for i, p in enumerate(pieces):
            if len(p) > LONG_WORD:
                out[i] = self.t.ids[self.encode_long(p)].astype("<u4").tobytes()
        return out

    def pieces_of(self, word: str) -> list[str]:
        """The pieces of a word without white space, in byte-level or plain characters (see ``bytes_of``)."""
        if self.plain and PLAIN.fullmatch(word):
            return PLAIN_PATTERN.findall(word.lower())
        return ["\0" + p for p, _ in self.cut(self.normalise(word))]  # "\0": in byte-level characters

    def bytes_of(self, piece: str) -> bytes:
        return bytes([self.alphabet[c] for c in piece[1:]]) if piece[:1] == "\0" else piece.encode()

    def decode(self, ids: bytes) -> bytes:
        strings = self.t.strings
        return b" ".join([strings[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])

    def _known(self, young: dict, old: dict, need: set[str]) -> tuple[dict, list[str]]:
        found, new = {}, []
        for x in need:
            v = young.get(x)
            if v is None and (v := old.get(x)) is not None:
                young[x] = v
            if v is None:
                new.append(x)
            else:
                found[x] = v
        return found, new

    def _learn(self, need: set[str]) -> dict[str, tuple[bytes, bytes]]:
        """Ids and decoded bytes of each word."""
        found, new = self._known(self.words, self.old_words, need)
        if new:
            cut = [self.pieces_of(w) for w in new]
            ids, unseen = self._known(self.pieces, self.old_pieces, set().union(*cut))
            fresh = dict(zip(unseen, self.encode_pieces([self.bytes_of(p) for p in unseen]), strict=True))
            ids |= fresh
            self.pieces.update((p, x) for p, x in fresh.items() if len(p) <= CACHE_CHARS)
            for w, pieces in zip(new, cut, strict=True):
                whole = b"".join([ids[p] for p in pieces])
                found[w] = (whole, self.decode(whole))
            self.words.update((w, found[w]) for w in new if len(w) <= CACHE_CHARS)
            if len(self.pieces) > CACHE_PIECES:
                self.old_pieces, self.pieces = self.pieces, {}
            if len(self.words) > CACHE_WORDS:
                self.old_words, self.words = self.words, {}
        return found

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its ids (little-endian 32-bit integers) and the bytes of the decoded string."""
        out = []
        for lo, hi in sub_batches([len(t) for t in texts], STEP_CHARS):
            split = [self._words(t) for t in texts[lo:hi]]
            known = self._learn({w for ws in split for w in ws})
            for ws in split:
                found = [x for w in ws if (x := known[w])[0]]
                out.append((b"".join([x[0] for x in found]), b" ".join([x[1] for x in found])))
        return out

    def _words(self, text: str) -> list[str]:
        white = (lambda x: [w for w in WHITE.split(x) if w]) if ODD.search(text) else str.split
        if not self.specials.search(text):
            return white(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [*white(text[at : m.start()]), m.group()]
            at = m.end()
        out += white(text[at:])
        for s, i in self.t.special.items():
            self.words[s] = (int(i).to_bytes(4, "little"), self.t.strings[i])
        return out


_encoders: dict[str, Encoder] = {}


def _encoder(tables: Broadcast, vocabulary: str) -> Encoder:
    """One encoder per worker process: its caches serve later tasks too."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(tables.value, vocabulary)
    return _encoders[vocabulary]


def encode(docs: DataFrame, vocabulary: str | None = None, outputs: str = "digest") -> DataFrame:
    """doc_id, n_tokens, and the digests of ids and decoded text; with ``outputs="ids"`` the ids and the text themselves."""
    vocabulary = vocabulary or default_vocabulary()
    prepare(docs.sparkSession)
    tables = docs.sparkSession.sparkContext.broadcast(load(vocabulary))
    digest = outputs == "digest"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _encoder(tables, vocabulary).encode([t or "" for t in batch.column("text").to_pylist()])
            show = (lambda b: hashlib.sha256(b).hexdigest()) if digest else (lambda b: b)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(i) // 4 for i, _ in rows], pa.int64()),
                    pa.array([show(i) for i, _ in rows], pa.string() if digest else pa.binary()),
                    pa.array([show(d) if digest else d.decode() for _, d in rows], pa.string()),
                ],
                names,
            )

    names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded"))]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kind = "string" if digest else "binary"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_tokens long, {names[2]} {kind}, {names[3]} string")
