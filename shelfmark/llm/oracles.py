"""SQL for the corpus queries that SQL can express over whole tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

#: The inner product of every query with every vector; sizes where that is quick are checked so.
TOP_K = """
WITH v AS (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.rid AS query_rid, q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS score
    FROM v q JOIN v c ON c.rid <> q.rid AND len(c.v) = len(q.v)
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_rid ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM ranked WHERE r <= 5
"""

WARC = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
           sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), f AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < first THEN 'revisit' ELSE 'response' END
           AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < first THEN first END AS refers_to
FROM f
"""

_RULES = ("short", "repeats", "symbols", "dup_lines")

HOST_RULES = rf"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(source, chr(1)) AS host,
           coalesce(text, '') AS text FROM documents
), w AS (
    SELECT *, regexp_extract_all(text, '{_WORD}') AS words,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
    FROM d
), three AS (
    SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS t
    FROM w, unnest(generate_series(1, len(words) - 2)) AS g(i)
), twice AS (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, t) AS n FROM three
), covered AS (
    SELECT rid, count(DISTINCT i + k) AS n_repeat_words
    FROM twice, unnest([0, 1, 2]) AS o(k) WHERE n > 1 GROUP BY rid
), counts AS (
    SELECT w.rid, doc_id, host, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
           len(lines) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN covered USING (rid)
), judged AS (
    SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repeats,
           100 * n_symbols > 10 * word_chars AS symbols, 100 * n_dup_lines > 30 * n_lines AS dup_lines
    FROM counts
), hosts AS (
    SELECT host, count(*) AS n, {", ".join(f"sum(CAST({r} AS INTEGER)) AS {r}" for r in _RULES)}
    FROM judged GROUP BY host
), means AS (
    SELECT sum(n) AS total, count(*) - 1 AS chance,
           sum(n) - sum(CAST(n AS DOUBLE) * n) / sum(n) - (count(*) - 1) AS most,
           {", ".join(f"sum({r}) / sum(n) AS m_{r}" for r in _RULES)} FROM hosts
), spreads AS (
    SELECT {", ".join(f"sum(n * (({r} / n) - m_{r}) ** 2) AS v_{r}" for r in _RULES)}
    FROM hosts, means
), correlations AS (
    SELECT *, {", ".join(
        f"CASE WHEN m_{r} * (1 - m_{r}) > 0 AND most > 1e-9"
        f" THEN (v_{r} - m_{r} * (1 - m_{r}) * chance) / (m_{r} * (1 - m_{r}) * most) ELSE 0 END AS c_{r}"
        for r in _RULES)}
    FROM means, spreads
), strengths AS (
    SELECT {", ".join(
        f"CASE WHEN c_{r} > 0 THEN least(greatest(1 / c_{r} - 1, 1.0), 1e6) ELSE 1e6 END AS s_{r}" for r in _RULES)}
    FROM correlations
), verdicts AS (
    SELECT host, greatest({", ".join(f"({r} + m_{r} * s_{r}) / (n + s_{r})" for r in _RULES)}) > 0.5
        AS host_rejected
    FROM hosts, means, strengths
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       short OR repeats AS base_failed, host_rejected,
       NOT (short OR repeats) AND NOT host_rejected AS kept
FROM judged JOIN verdicts USING (host)
"""

SQL = {
    "op3_maxscore_top_k": TOP_K,
    "op6_warc_bundles": WARC,
    "op8_host_rules": HOST_RULES,
}
