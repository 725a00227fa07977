"""SQL counterparts of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

#: Words of the decontamination and similarity rules; white space of the word rules.
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_RUN = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


DECONTAMINATION = f"""
WITH item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_lowered("text")}, '{_WORD}') AS w
  FROM benchmark
),
win AS (
  SELECT item, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win, least(10, len(w)) AS size
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)
),
doc AS (
  SELECT doc_id, regexp_extract_all({_lowered("text")}, '{_WORD}') AS w FROM documents
),
place AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM doc, (SELECT DISTINCT size FROM win) WHERE len(w) >= size
  )
),
hit AS (SELECT DISTINCT doc_id, i, size, item FROM place JOIN win USING (win, size)),
hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hit) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)"""

QUALITY_RULES = f"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_RUN}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_RUN}')) AS lines
  FROM documents
),
gram AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM doc)
),
twice AS (SELECT doc_id, g FROM gram GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT k) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 3)) AS k FROM gram JOIN twice USING (doc_id, g)) GROUP BY doc_id
),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM doc LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM measured"""

JACCARD_JOIN = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({_lowered("text")}, '{_WORD}') AS w FROM documents
),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM doc WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2
),
link AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 5 * pairs.n >= 4 * (x.n + y.n - pairs.n)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
)
SELECT doc_id, class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM link GROUP BY a) USING (doc_id)"""

SUFFIX_DEDUP = """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
piece AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM doc WHERE len(h) >= 200)
),
again AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS n FROM piece) WHERE n > 1
),
run AS (
  SELECT doc_id, min(p) AS a, max(p) + 100 AS b
  FROM (
    SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS r
    FROM (
      SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS fresh FROM again
    )
  ) GROUP BY doc_id, r
),
cut AS (
  SELECT doc_id, sum(b - a) AS removed, count(*) AS n, list([a, b] ORDER BY a) AS runs FROM run GROUP BY doc_id
),
kept AS (
  SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(removed, 0) AS removed, coalesce(n, 0) AS n,
    CASE WHEN n IS NULL THEN h ELSE array_to_string(list_transform(range(0, n + 1), lambda k: substr(h,
      2 * (CASE WHEN k = 0 THEN 0 ELSE runs[k][2] END) + 1,
      2 * ((CASE WHEN k = n THEN len(h) // 2 ELSE runs[k + 1][1] END) - (CASE WHEN k = 0 THEN 0 ELSE runs[k][2] END)))), '')
    END AS left_over
  FROM doc LEFT JOIN cut USING (doc_id)
)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(removed AS BIGINT) AS n_removed, CAST(n AS BIGINT) AS n_spans,
  sha256(unhex(left_over)) AS kept_sha256
FROM kept"""

LEXICAL_SEARCH = f"""
WITH term AS (
  SELECT doc_id, t, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all({_lowered("text")}, '{_WORD}')) AS t FROM documents) GROUP BY ALL
),
doc AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM term GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM doc),
spread AS (SELECT doc_id, 100 - 75 + (75 * n * n_docs) // n_terms AS m FROM doc, total),
wanted AS (
  SELECT item_id, t, count(*) AS q
  FROM (SELECT item_id, unnest(regexp_extract_all({_lowered("text")}, '{_WORD}')) AS t FROM benchmark) GROUP BY ALL
),
weight AS (
  SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM term GROUP BY t), total
),
scored AS (
  SELECT item_id, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM wanted JOIN weight USING (t) JOIN term USING (t) JOIN spread USING (doc_id) GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10"""

#: crc32, bit by bit, as a table of 256 numbers and a fold over a word's bytes.
_STEP = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
_CRC = f"""
crc AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: {_STEP}) AS c
    FROM (SELECT unnest(range(256))::BIGINT AS b)
  )
),
bucket AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i:
    CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM word)), crc
)"""

IMPORTANCE_RESAMPLING = f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_lowered("text")}, '{_WORD}') AS ws FROM documents
),
word AS (
  SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS w FROM doc) GROUP BY ALL
  UNION ALL
  SELECT NULL, w, count(*) FROM (SELECT unnest(regexp_extract_all({_lowered("text")}, '{_WORD}')) AS w FROM benchmark) GROUP BY ALL
),{_CRC},
counted AS (SELECT doc_id, bucket, n FROM word JOIN bucket USING (w)),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS g
  FROM (
    SELECT bucket, CAST(coalesce(sum(n) FILTER (doc_id IS NOT NULL), 0) AS DOUBLE) AS s,
      CAST(coalesce(sum(n) FILTER (doc_id IS NULL), 0) AS DOUBLE) AS t
    FROM counted GROUP BY bucket
  )
),
summed AS (
  SELECT doc_id, CAST(sum(n * g) AS BIGINT) AS total FROM counted JOIN gain USING (bucket) WHERE doc_id IS NOT NULL GROUP BY doc_id
),
scored AS (
  SELECT doc_id, len(ws) AS n, CASE WHEN len(ws) = 0 THEN 0 ELSE (total - ((total % len(ws)) + len(ws)) % len(ws)) // len(ws) END AS weight,
    CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM doc LEFT JOIN summed USING (doc_id)
),
noised AS (
  SELECT doc_id, n, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM scored
)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CAST(CASE WHEN n >= 20 AND place <= (10 * (SELECT count(*) FROM scored WHERE n >= 20)) // 100 THEN place END AS BIGINT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) AS place FROM noised)"""

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": DECONTAMINATION,
    "op4_jaccard_join": JACCARD_JOIN,
    "op9_suffix_dedup": SUFFIX_DEDUP,
    "op10_quality_rules": QUALITY_RULES,
    "op11_lexical_search": LEXICAL_SEARCH,
    "op13_importance_resampling": IMPORTANCE_RESAMPLING,
}
