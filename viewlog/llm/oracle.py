"""DuckDB SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

SUBSTRING = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, w FROM d WHERE len(w) >= 20
), grams AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS g FROM windows
), later AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS r FROM grams) WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM later
), words AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d
), kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS text, count(*) AS n
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p
  WHERE gone.p IS NULL GROUP BY words.doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

JACCARD = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[s:s + 3], ' ')) AS g
  FROM (SELECT doc_id, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s, w FROM d WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20
"""


LINE_RULES = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS host,
         md5(coalesce(text, '')) AS digest, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w
  FROM documents
), words AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d
), triples AS (
  SELECT doc_id, p AS s, x, lead(x, 1) OVER t AS y, lead(x, 2) OVER t AS z FROM words WINDOW t AS (PARTITION BY doc_id ORDER BY p)
), grams AS (
  SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, x, y, z) AS n FROM triples WHERE z IS NOT NULL
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([s, s + 1, s + 2]) AS p FROM grams WHERE n > 1) GROUP BY doc_id
), lines AS (
  SELECT doc_id, host, digest, line, regexp_extract_all(
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS lw
  FROM (SELECT doc_id, host, digest, unnest(string_split(text, chr(10))) AS line FROM d)
), normal AS (
  SELECT doc_id, host, digest, line, array_to_string(lw, ' ') AS norm, len(lw) AS n FROM lines WHERE len(lw) > 0
), dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM normal GROUP BY doc_id
), hosts AS (
  SELECT host, count(DISTINCT digest) AS n FROM d GROUP BY host
), frequent AS (
  SELECT l.host, l.norm FROM normal l JOIN hosts h ON h.host = l.host
  GROUP BY l.host, l.norm, h.n
  HAVING count(DISTINCT l.digest) > 20 AND count(DISTINCT l.digest) > CAST(0.01 AS DOUBLE) * h.n
), removed AS (
  SELECT l.doc_id, sum(l.n) AS n FROM normal l JOIN frequent f ON f.host = l.host AND f.norm = l.norm GROUP BY l.doc_id
), stats AS (
  SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(length(array_to_string(d.w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(d.text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(u.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(x.n, 0) AS BIGINT) AS removed_words
  FROM d LEFT JOIN dups u ON u.doc_id = d.doc_id LEFT JOIN repeated r ON r.doc_id = d.doc_id
  LEFT JOIN removed x ON x.doc_id = d.doc_id
)
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND removed_words <= n_words * CAST(0.7 AS DOUBLE) AS kept
FROM stats
"""


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
  )
), words AS (
  SELECT p, lang, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM pieces
), runs AS (
  SELECT lang, x, lead(x, 1) OVER t AS y, lead(x, 2) OVER t AS z FROM words WINDOW t AS (PARTITION BY p ORDER BY i)
), f1 AS (
  SELECT lang, x, CAST(count(*) AS BIGINT) AS f FROM runs GROUP BY ALL
), f2 AS (
  SELECT lang, x, y, CAST(count(*) AS BIGINT) AS f FROM runs WHERE y IS NOT NULL GROUP BY ALL
), f3 AS (
  SELECT lang, x, y, z, CAST(count(*) AS BIGINT) AS f FROM runs WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang
), covered AS (
  SELECT lang, x, y, max(f) AS longer
  FROM (SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.x || ' ' || c.y AS phrase, c.f AS a, l.f AS l, r.f AS r, 1 AS k
  FROM f2 c JOIN f1 l ON l.lang = c.lang AND l.x = c.x JOIN f1 r ON r.lang = c.lang AND r.x = c.y
  LEFT JOIN covered o ON o.lang = c.lang AND o.x = c.x AND o.y = c.y
  WHERE c.f >= 10 AND (o.longer IS NULL OR 100 * o.longer < 50 * c.f)
  UNION ALL
  SELECT c.lang, concat_ws(' ', c.x, c.y, c.z), c.f, l.f, r.f, 1
  FROM f3 c JOIN f1 l ON l.lang = c.lang AND l.x = c.x JOIN f2 r ON r.lang = c.lang AND r.x = c.y AND r.y = c.z
  UNION ALL
  SELECT c.lang, concat_ws(' ', c.x, c.y, c.z), c.f, l.f, r.f, 2
  FROM f3 c JOIN f2 l ON l.lang = c.lang AND l.x = c.x AND l.y = c.y JOIN f1 r ON r.lang = c.lang AND r.x = c.z
), scored AS (
  SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts
), worst AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

#: The CRC-32 of bytes as a fold over them: each step divides the low byte of the register by the polynomial.
SPELLING = rf"""
WITH RECURSIVE steps AS (
  SELECT list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v, i
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)
), crc AS (
  SELECT list(v ORDER BY i) AS t FROM steps
), runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL
), coded AS (
  SELECT run, n, list_transform(range(1, 2 * octet_length(b), 2), lambda i: CAST('0x' || substr(hex(b), i, 2) AS BIGINT)) AS bytes
  FROM (SELECT run, n, encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS b FROM runs)
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM coded, crc
), seen AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM seen WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), gaps AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), masked AS (
  SELECT word, n, word[:i - 1] || '*' || word[i + 1:] AS g, word[:i - 1] || word[i + 1:] AS shorter FROM gaps
), near AS (
  SELECT a.word, b.word AS other, b.n FROM masked a JOIN masked b ON a.g = b.g AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM masked a JOIN words b ON b.word = a.shorter
  UNION
  SELECT b.word, a.word, a.n FROM masked a JOIN words b ON b.word = a.shorter
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS near_n, min_by(other, (-n, other)) AS other FROM near GROUP BY word
), forms AS (
  SELECT w.word, CASE WHEN near_n >= 2 * w.n THEN other END AS form, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
         CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), chain AS (
  SELECT word, word AS at FROM words
  UNION
  SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.at AND e.form IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_substring": SUBSTRING, "op4_line_rules": LINE_RULES, "op6_jaccard": JACCARD, "op9_topk": TOP_K, "op11_collocations": COLLOCATIONS, "op12_spelling": SPELLING}
