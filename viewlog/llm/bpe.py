"""Operator 3, byte-level BPE by recursive SQL inside each task.

A text is cut into pieces by the vocabulary's pattern. New pieces go to an
in-process DuckDB database; in each step of a recursive query their token
positions, as rows, join the merge table, and the leftmost pair of least rank of
each piece is contracted, until no pair of it is left. An ordered aggregate over
the ids joined with the vocabulary decodes them; a text's bytes are those of its
pieces in order.

Pieces recur, so a task keeps the results of recent ones (a bounded cache).
Pieces longer than ``LONG_PIECE`` bytes contract all non-overlapping pairs of the
least rank in a step (the same result: a merge of that rank cannot create a pair
of lower rank, as every vocabulary entry encodes to itself), so that the steps
do not grow with the length of a piece.

Defined results: a null or empty text has no ids; repeated rows get equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare, sub_batches

#: New pieces in one recursive query, and bytes of them.
QUERY_PIECES = 30_000
QUERY_BYTES = 1 << 20
LONG_PIECE = 64
#: Fixed value: the pattern that the vocabulary was published with.
PUBLISHED_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_ENTRIES = 400_000

#: The published pattern, for texts of the characters in ``PLAIN``, in the terms of Python's faster
#: module: there [^\\W\\d_] are exactly the letters, \\d the numbers, and WHITE the white space.
WHITE = r"\t-\r \x85\xa0"
PLAIN = re.compile(r"[\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]*")
PLAIN_PATTERN = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\w{WHITE}]|_)+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)

#: One row per piece and step: t holds the ids. Its positions join the merges; the least (rank, position) is contracted.
SHORT_SQL = """
WITH RECURSIVE step(it, w, t) AS (
  SELECT 0, w, t FROM pieces
  UNION ALL
  SELECT s.it + 1, s.w, s.t[:b.p - 1] || [b.m] || s.t[b.p + 2:]
  FROM step s
  JOIN (
    SELECT w, (best // 4294967296)::INT AS m, (best % 4294967296)::INT AS p
    FROM (
      SELECT a.w, min(g.m::BIGINT * 4294967296 + a.p) AS best
      FROM (SELECT w, unnest(t[:-2]) AS l, unnest(t[2:]) AS r, generate_subscripts(t[2:], 1) AS p FROM step) a
      JOIN merges g ON g.k = a.l::BIGINT * 65536 + a.r
      GROUP BY a.w
    )
  ) b ON b.w = s.w
)
SELECT w, arg_max(t, it) AS ids FROM step GROUP BY w ORDER BY w
"""

#: Of a run of overlapping equal pairs, every second one is contracted, from the left.
LONG_SQL = """
WITH RECURSIVE step(it, w, p, t) AS (
  SELECT 0, w, generate_subscripts(t, 1), unnest(t) FROM pieces
  UNION ALL
  SELECT it + 1, w, p, CASE WHEN hit THEN m ELSE t END
  FROM (
    SELECT *, coalesce(lag(hit) OVER (PARTITION BY w ORDER BY p), false) AS eaten
    FROM (
      SELECT *, least_here AND row_number() OVER (PARTITION BY w, least_here, run ORDER BY p) % 2 = 1 AS hit
      FROM (
        SELECT *, r - row_number() OVER (PARTITION BY w, least_here ORDER BY p) AS run
        FROM (
          SELECT *, m IS NOT NULL AND m = min(m) OVER (PARTITION BY w) AS least_here, min(m) OVER (PARTITION BY w) AS best
          FROM (
            SELECT a.*, g.m
            FROM (
              SELECT *, row_number() OVER (PARTITION BY w ORDER BY p) AS r,
                     t::BIGINT * 65536 + lead(t) OVER (PARTITION BY w ORDER BY p) AS pair
              FROM step
            ) a LEFT JOIN merges g ON g.k = a.pair
          )
        )
        WHERE best IS NOT NULL
      )
    )
  )
  WHERE NOT eaten
)
SELECT s.w, list(s.t ORDER BY s.p) AS ids
FROM step s JOIN (SELECT w, max(it) AS it FROM step GROUP BY w) l ON l.w = s.w AND l.it = s.it
GROUP BY s.w ORDER BY s.w
"""

DECODE_SQL = """
SELECT i.w, string_agg(v.hex, '' ORDER BY i.p) AS hex
FROM ids i JOIN vocabulary v ON v.t = i.t GROUP BY i.w ORDER BY i.w
"""


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Codec:
    """Encoder and decoder of one vocabulary (fewer than 2^16 ranks) on an in-process database."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import duckdb
        import regex

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ranks do not fit 16 bits")
        self.pattern = regex.compile(pattern)
        self.plain = pattern == PUBLISHED_PATTERN
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        merges = [
            (ranks[token[:i]] * 65536 + ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self.db = duckdb.connect()
        self.db.execute("SET threads = 1")
        self.db.execute("SET memory_limit = '300MB'")
        self.db.execute("SET enable_progress_bar = false")
        self.table("given", k=np.array([k for k, _ in merges], dtype=np.int64), m=np.array([m for _, m in merges], dtype=np.int32))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.db.register("given", pa.table({"t": pa.array(list(ranks.values()), pa.int32()), "hex": pa.array([t.hex() for t in ranks])}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self.cache: dict[str, tuple[bytes, bytes]] = {}

    def table(self, name: str, **columns: np.ndarray) -> None:
        self.db.register(name, pa.table(columns))

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, as little-endian 32-bit integers."""
        data = [p.encode("utf-8", "surrogatepass") for p in pieces]
        out: list[bytes] = [b""] * len(data)
        short = [i for i, d in enumerate(data) if len(d) <= LONG_PIECE]
        long = [i for i, d in enumerate(data) if len(d) > LONG_PIECE]
        for at, sql in ((short, SHORT_SQL), (long, LONG_SQL)):
            for lo, hi in sub_batches([len(data[i]) for i in at], QUERY_BYTES):
                for a in range(lo, hi, QUERY_PIECES):
                    part = at[a : min(a + QUERY_PIECES, hi)]
                    for i, ids in zip(part, self._run(sql, [data[i] for i in part]), strict=True):
                        out[i] = ids
        return out

    def _run(self, sql: str, data: list[bytes]) -> list[bytes]:
        ends = np.cumsum([0, *(len(d) for d in data)], dtype=np.int32)
        flat = pa.array(self.byte_ids[np.frombuffer(b"".join(data), dtype=np.uint8)])
        self.db.register(
            "pieces", pa.table({"w": np.arange(len(data), dtype=np.int32), "t": pa.ListArray.from_arrays(pa.array(ends), flat)})
        )
        ids = self.db.sql(sql).to_arrow_table().column("ids").combine_chunks()
        whole = ids.values.to_numpy().astype("<u4").tobytes()
        ends = (ids.offsets.to_numpy() * 4).tolist()
        return [whole[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each list of ids."""
        out: list[bytes] = [b""] * len(ids)
        for lo, hi in sub_batches([len(x) for x in ids], 4 * QUERY_BYTES):
            sizes = np.array([len(x) // 4 for x in ids[lo:hi]])
            t = np.frombuffer(b"".join(ids[lo:hi]), dtype="<u4").astype(np.int32)
            self.table("ids", w=np.repeat(np.arange(lo, hi, dtype=np.int32), sizes), p=np.arange(len(t), dtype=np.int32), t=t)
            got = self.db.sql(DECODE_SQL).to_arrow_table()
            for w, text in zip(got.column("w").to_pylist(), got.column("hex").to_pylist(), strict=True):
                out[w] = bytes.fromhex(text)
        return out

    def pieces_of(self, text: str) -> list[str]:
        return PLAIN_PATTERN.findall(text) if self.plain and PLAIN.fullmatch(text) else self.pattern.findall(text)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its ids (little-endian 32-bit integers) and the bytes that the ids decode to."""
        out = []
        for lo, hi in sub_batches([len(t) for t in texts], 2 * QUERY_BYTES):
            cut = [self.pieces_of(t) for t in texts[lo:hi]]
            need = set().union(*cut)
            new = [p for p in need if p not in self.cache]
            if len(self.cache) + len(new) > CACHE_ENTRIES:
                self.cache = {p: self.cache[p] for p in need if p in self.cache}
            ids = self.encode_pieces(new)
            self.cache.update(zip(new, zip(ids, self.decode(ids), strict=True), strict=True))
            for pieces in cut:
                found = [self.cache[p] for p in pieces]
                out.append((b"".join([x[0] for x in found]), b"".join([x[1] for x in found])))
            if len(self.cache) > CACHE_ENTRIES:  # one long text of ever new pieces
                self.cache = {}
        return out


def encode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, outputs: str = "digest") -> DataFrame:
    """doc_id, n_tokens, and the digests of ids and decoded bytes; with ``outputs="ids"`` the ids and bytes themselves."""
    if ranks_path is None or pattern is None:
        import public_tokenizers

        ranks_path, pattern = ranks_path or default_ranks(), pattern or public_tokenizers.PATTERN
    prepare(docs.sparkSession)
    digest = outputs == "digest"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or _codec(ranks_path, pattern)
            rows = codec.encode([t or "" for t in batch.column("text").to_pylist()])
            sha = (lambda b: hashlib.sha256(b).hexdigest()) if digest else (lambda b: b)
            kind = pa.string() if digest else pa.binary()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(i) // 4 for i, _ in rows], pa.int64()),
                    pa.array([sha(i) for i, _ in rows], kind),
                    pa.array([sha(d) for _, d in rows], kind),
                ],
                names,
            )

    names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded"))]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kind = "string" if digest else "binary"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_tokens long, {names[2]} {kind}, {names[3]} {kind}")


_codecs: dict[tuple[str, str], Codec] = {}


def _codec(ranks_path: str, pattern: str) -> Codec:
    """One codec per worker process: its tables and cache serve later tasks too."""
    key = (ranks_path, pattern)
    if key not in _codecs:
        _codecs[key] = Codec(ranks_path, pattern)
    return _codecs[key]
