"""DuckDB SQL for the corpus queries that SQL can express.

DuckDB's regular expressions are RE2's; where a rule needs every match with
its place, texts are cut at the matches and lengths are summed."""

ORACLES: dict[str, str] = {}

ORACLES["op1_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
p AS (SELECT r, i, ws[i] AS word, CASE WHEN i + 7 <= len(ws) THEN ws[i:i+7] END AS win
      FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
q AS (SELECT r, i, CASE WHEN win IS NOT NULL AND count(*) OVER (PARTITION BY r, win) > 1 THEN 1 ELSE 0 END AS twice FROM p),
s AS (SELECT r, max(twice) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS inside FROM q),
rep AS (SELECT r, sum(inside) AS n_repeat_words FROM s GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) AS n_word_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT d.r, doc_id, source, len(ws)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_word_lines, 0)::BIGINT AS n_word_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN dup USING (r)),
f AS (SELECT *, n_words < 20 AS r1, 100 * n_repeat_words > 30 * n_words AS r2, n_symbols > n_words AS r3, n_dup_lines > 0.5 * n_word_lines AS r4 FROM m),
h AS (SELECT source, rule, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM (
        SELECT source, unnest([1, 2, 3, 4]) AS rule, unnest([r1::INT, r2::INT, r3::INT, r4::INT]) AS bad FROM f) GROUP BY source, rule),
g AS (SELECT rule, count(*) AS hosts, sum(bad) / sum(n) AS mean, sum((bad / n) * (bad / n)) / count(*) - (sum(bad / n) / count(*)) ** 2 AS seen,
        sum(1 / n) / count(*) AS inv FROM h GROUP BY rule),
k AS (SELECT rule, mean, CASE WHEN greatest(seen, 0) - mean * (1 - mean) * inv <= 0 THEN 1e6
        ELSE least(greatest(mean * (1 - mean) / (greatest(seen, 0) - mean * (1 - mean) * inv) - 1, 1), 1e6) END AS strength FROM g),
v AS (SELECT source, bool_or((bad + mean * strength) / (n + strength) > 0.5) AS host_rejected FROM h JOIN k USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (r1 OR r2) AS base_failed,
       NOT (r1 OR r2) AND NOT host_rejected AS kept, host_rejected
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""

ORACLES["op4_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(doc_id, 9223372036854775807) AS id, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT r, id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM (SELECT r, id, string_split(t, chr(10)) AS ls FROM d)),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT id) > 1),
m AS (SELECT r, i, line, s.key IS NOT NULL AND s.first <> k.id AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m JOIN d USING (r) GROUP BY r, doc_id
"""

ORACLES["op12_pivot_search"] = r"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.r <> b.r)
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
QUALIFY rank <= 20
"""
