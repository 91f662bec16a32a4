"""DuckDB texts of the queries that SQL can express; they run over the same whole tables."""

from __future__ import annotations

OP1 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS body FROM documents
), w AS (
  SELECT row_id, doc_id, body, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT row_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS seen
  FROM (SELECT row_id, words, unnest(range(1, greatest(len(words) - 1, 1))) AS i FROM w)
), twice AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, seen) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT row_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row_id
), m AS (
  SELECT doc_id,
         CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(regexp_replace(body, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_capitals,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines
  FROM w LEFT JOIN covered USING (row_id)
), f AS (
  SELECT *,
         n_words < 50 AS f0,
         100 * n_repeat_words > 50 * n_words AS f1,
         100 * n_symbols > 30 * n_words AS f2,
         100 * n_dup_lines > 60 * n_lines AS f3,
         100 * n_capitals > 60 * word_chars AS f4,
         word_chars < 2 * n_words OR word_chars > 25 * n_words AS f5
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_capitals, n_repeat_words, n_lines, n_dup_lines,
       CAST(f0::INT + 2 * f1::INT + 4 * f2::INT + 8 * f3::INT + 16 * f4::INT + 32 * f5::INT AS BIGINT) AS failed_bits,
       f0 OR f1 AS base_failed,
       NOT (f0 OR f1 OR f2 OR f3 OR f4 OR f5) AS kept
FROM f
"""

OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS own
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_sum(list_transform(range(1, len(v.own) + 1), lambda i: v.own[i] * q.own[i])) AS BIGINT) AS score
  FROM v JOIN v AS q ON q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

TEXTS = {"op1_quality_rules": OP1, "op8_topk": OP8}
