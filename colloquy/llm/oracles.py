"""The same as the registered queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

import math

OP2 = r"""
WITH texts AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM texts WINDOW same AS (PARTITION BY text_sha256)
"""

OP9 = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
rest AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
hosts AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM rest
),
parts AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM hosts),
met AS (
    SELECT page_id, host, path, arg_max(struct_pack(rule := rule_host || rule_path, verdict := rule_verdict), length(rule_host || rule_path)) AS win
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id, host, path
)
SELECT p.page_id, p.host, p.path, win.rule AS rule, coalesce(win.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN met m ON p.page_id = m.page_id
"""

OP3 = r"""
WITH texts AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
),
windows AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 7)) AS i FROM texts WHERE len(words) >= 8),
twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS gram FROM windows)
    QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
),
covered AS (
    SELECT doc_id, sum(least(8, coalesce(next - i, 8))) AS n
    FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM twice) GROUP BY doc_id
),
counted AS (
    SELECT t.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
    FROM texts t LEFT JOIN covered c ON c.doc_id = t.doc_id
),
judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           CASE WHEN word_chars > 0 THEN n_symbols::DOUBLE / word_chars ELSE 0 END AS symbol_share,
           CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END AS dup_line_share,
           CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END AS repeat_share,
           CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END AS mean_word
    FROM counted
),
measured AS (
    SELECT lang, source, unnest(['symbol_share', 'dup_line_share', 'repeat_share', 'mean_word']) AS metric,
           unnest([symbol_share, dup_line_share, repeat_share, mean_word]) AS value
    FROM judged WHERE NOT base_failed
),
fine AS (
    SELECT lang, source, metric, CASE WHEN value > 1e-4::DOUBLE THEN CAST(ceil(ln(value) / @GAMMA@::DOUBLE) AS BIGINT) END AS bucket, count(*) AS n
    FROM measured GROUP BY ALL
),
scopes AS (
    SELECT 'source' AS scope, lang, source, metric, bucket, n FROM fine
    UNION ALL SELECT 'lang', lang, NULL, metric, bucket, sum(n) FROM fine GROUP BY lang, metric, bucket
    UNION ALL SELECT 'all', NULL, NULL, metric, bucket, sum(n) FROM fine GROUP BY metric, bucket
),
summed AS (
    SELECT *, sum(n) OVER (PARTITION BY scope, lang, source, metric ORDER BY bucket NULLS FIRST) AS upto,
           sum(n) OVER (PARTITION BY scope, lang, source, metric) AS total,
           CASE WHEN bucket IS NULL THEN 0 ELSE exp(bucket * @GAMMA@::DOUBLE) * 0.99::DOUBLE END AS value
    FROM scopes
),
quartiles AS (
    SELECT scope, lang, source, metric, max(total) AS n, min(value) FILTER (4 * upto >= total) AS low, min(value) FILTER (2 * upto >= total) AS mid,
           min(value) FILTER (4 * upto >= 3 * total) AS high
    FROM summed GROUP BY scope, lang, source, metric
),
rules(name, metric, sign, margin) AS (
    VALUES ('symbols', 'symbol_share', 1, 0.02::DOUBLE), ('dup_lines', 'dup_line_share', 1, 0.1::DOUBLE), ('repeats', 'repeat_share', 1, 0.075::DOUBLE),
           ('longest', 'mean_word', 1, 0.4::DOUBLE), ('shortest', 'mean_word', -1, 0.25::DOUBLE)
),
placed AS (
    SELECT scope, lang, source, name, n, sign, margin, mid + sign * 4 * greatest(CASE WHEN sign = 1 THEN mid - low ELSE high - mid END, margin) AS fence
    FROM quartiles JOIN rules USING (metric)
),
wide AS (
    SELECT l.lang, l.name, CASE WHEN l.n >= 200 THEN l.fence ELSE a.fence END AS fence
    FROM placed l JOIN placed a ON a.scope = 'all' AND a.name = l.name WHERE l.scope = 'lang'
),
own AS (
    SELECT s.lang, s.source, s.name,
           CASE WHEN s.sign = 1 THEN least(CASE WHEN s.n >= 200 THEN s.fence ELSE w.fence END, w.fence + 4 * s.margin)
                ELSE greatest(CASE WHEN s.n >= 200 THEN s.fence ELSE w.fence END, w.fence - 4 * s.margin) END AS fence
    FROM placed s JOIN wide w ON w.lang IS NOT DISTINCT FROM s.lang AND w.name = s.name WHERE s.scope = 'source'
),
fences AS (
    SELECT lang, source, max(fence) FILTER (name = 'symbols') AS symbols, max(fence) FILTER (name = 'dup_lines') AS dup_lines,
           max(fence) FILTER (name = 'repeats') AS repeats, max(fence) FILTER (name = 'longest') AS longest, max(fence) FILTER (name = 'shortest') AS shortest
    FROM own GROUP BY lang, source
)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(symbol_share <= symbols AND dup_line_share <= dup_lines AND repeat_share <= repeats
                                    AND mean_word <= longest AND mean_word >= shortest, true) AS kept
FROM judged j LEFT JOIN fences f ON f.lang IS NOT DISTINCT FROM j.lang AND f.source IS NOT DISTINCT FROM j.source
""".replace("@GAMMA@", repr(math.log(1.01 / 0.99)))

ORACLES: dict[str, str] = {"op2_exact_dedup": OP2, "op3_quality_rules": OP3, "op9_url_filter": OP9}
