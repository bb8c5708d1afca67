"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

OP5 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t,
         list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c
  FROM (SELECT rid, i, list_slice(ws, i, i + 2) AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3))
), rep AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM win WHERE c >= 2) GROUP BY rid
), m AS (
  SELECT w.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(ls) AS BIGINT) AS n_lines,
         len(list_filter(ws, lambda x: regexp_matches(x, '\p{L}'))) AS n_alpha,
         len(list_filter(ws, lambda x: regexp_matches(
             x, '^\P{Ll}*\p{Lu}\P{Ll}*\p{Lu}\P{Ll}*$'))) AS n_upper
  FROM w LEFT JOIN rep ON w.rid = rep.rid
), b AS (
  SELECT *, CAST(
      CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 4 ELSE 0 END
    + CASE WHEN word_chars > 15 * n_words THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_alpha < 80 * n_words THEN 64 ELSE 0 END
    + CASE WHEN 100 * n_upper > 50 * n_words THEN 128 ELSE 0 END AS BIGINT) AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       fail_bits = 0 AS kept, fail_bits,
       CASE fail_bits WHEN 1 THEN 'too_few_words' WHEN 2 THEN 'repeated_windows'
         WHEN 4 THEN 'short_words' WHEN 8 THEN 'long_words' WHEN 16 THEN 'symbols'
         WHEN 32 THEN 'duplicate_lines' WHEN 64 THEN 'few_letter_words' WHEN 128 THEN 'shouting'
       END AS sole_rule,
       CASE WHEN bit_count(fail_bits) = 1 THEN count(*) OVER (PARTITION BY fail_bits)
       END AS sole_rule_docs
FROM b
"""

OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), sizes AS (SELECT unnest(range(1, 5)) AS m
), grams AS (
  SELECT lang, m, gram, count(*) AS f
  FROM (SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS gram
        FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, sizes
              WHERE len(w) >= m))
  GROUP BY lang, m, gram HAVING count(*) >= 30
), cuts AS (
  SELECT lang, gram, m, f, k, string_split(gram, ' ') AS w
  FROM (SELECT *, unnest(range(1, m)) AS k FROM grams WHERE m > 1)
), scored AS (
  SELECT c.lang, c.gram, c.f AS a, k, l.f AS l, r.f AS r,
         CAST(CAST(2000000 AS HUGEINT) * c.f // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM cuts c
  JOIN grams l ON l.lang = c.lang AND l.gram = array_to_string(list_slice(c.w, 1, k), ' ')
  JOIN grams r ON r.lang = c.lang AND r.gram = array_to_string(list_slice(c.w, k + 1, c.m), ' ')
), weakest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1
), longer AS (
  SELECT lang, part, max(f) AS f
  FROM (SELECT lang, f, array_to_string(list_slice(w, i, i + p - 1), ' ') AS part
        FROM (SELECT *, unnest(range(1, m - p + 2)) AS i
              FROM (SELECT lang, f, m, string_split(gram, ' ') AS w, unnest(range(2, m)) AS p
                    FROM grams WHERE m > 2)))
  GROUP BY lang, part
), ranked AS (
  SELECT w.lang, w.gram AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, encode(w.gram)) AS rank
  FROM weakest w LEFT JOIN longer o ON o.lang = w.lang AND o.part = w.gram
  WHERE o.f IS NULL OR 100 * CAST(o.f AS HUGEINT) < 80 * CAST(a AS HUGEINT)
)
SELECT t.lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN totals t ON t.lang = ranked.lang WHERE rank <= 2000
"""

ORACLE_SQL = {
    "op5_quality_rules": OP5,
    "op13_phrases": OP13,
}
