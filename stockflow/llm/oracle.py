"""SQL twins of the operators that SQL can express."""

from __future__ import annotations

from stockflow.llm import host_rules as H
from stockflow.llm import site_lines as L

_BLANK = "[\\x20\\x09-\\x0D]+"
_WORD = "[^\\x20\\x09-\\x0D]+"

HOST_RULES = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
    FROM documents),
grams AS (
    SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (
    SELECT r, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS s(k) GROUP BY r),
m AS (
    SELECT d.r, doc_id, source, len(w) AS n_words,
           CAST(coalesce(list_sum([length(x) for x in w]), 0) AS BIGINT) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len([x for x in string_split(t, chr(10)) if regexp_matches(x, '{_WORD}')])
             - len(list_distinct([x for x in string_split(t, chr(10))
                                  if regexp_matches(x, '{_WORD}')])) AS n_dup_lines,
           coalesce(c.n, 0) AS n_repeat_words
    FROM d LEFT JOIN covered c ON c.r = d.r),
j AS (
    SELECT *, n_words < {H.MIN_WORDS}
              OR 100 * n_repeat_words > {H.MAX_REPEAT_PERCENT} * n_words AS base_failed
    FROM m),
hosts AS (
    SELECT source, CAST(count(*) AS DOUBLE) AS n,
           CAST(count(*) FILTER (WHERE base_failed
               OR 100 * n_symbols > {H.MAX_SYMBOL_PERCENT} * word_chars
               OR n_dup_lines > {H.MAX_DUP_LINES}) AS DOUBLE) AS bad
    FROM j GROUP BY source),
total AS (SELECT sum(n) AS n, sum(bad) / sum(n) AS mean, count(*) AS k, sum(n * n) AS squares FROM hosts),
spread AS (
    SELECT any_value(t.mean) AS mean, any_value(t.k) AS k,
           any_value(t.mean * (1 - t.mean)) AS chance,
           greatest(0.0, (sum(h.n * pow(h.bad / h.n - t.mean, 2))
                          - any_value((t.k - 1) * t.mean * (1 - t.mean)))
                         / greatest(any_value(t.n - t.squares / t.n), 1.0)) AS between_hosts
    FROM hosts h, total t),
prior AS (
    SELECT mean, CASE
        WHEN k < 2 OR mean <= 0 OR mean >= 1 THEN {H.PRIOR_WEIGHT[0]}
        WHEN between_hosts = 0 THEN {H.PRIOR_WEIGHT[1]}
        ELSE least(greatest(chance / between_hosts - 1, {H.PRIOR_WEIGHT[0]}), {H.PRIOR_WEIGHT[1]})
        END AS weight
    FROM spread)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (h.bad + p.weight * p.mean) / (h.n + p.weight) <= {H.MAX_HOST_RATE} AS kept
FROM j JOIN hosts h ON h.source IS NOT DISTINCT FROM j.source, prior p"""

SITE_LINES = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents),
l AS (
    SELECT r, doc_id, source, len(lines) AS n_lines, unnest(lines) AS line,
           unnest(range(1, len(lines) + 1)) AS pos
    FROM d),
k AS (SELECT *, trim(regexp_replace(line, '{_BLANK}', ' ', 'g')) AS key FROM l),
pages AS (SELECT source, count(*) AS n FROM d GROUP BY source),
common AS (
    SELECT c.source, c.key
    FROM (SELECT source, key, count(DISTINCT r) AS n FROM k WHERE key <> '' GROUP BY ALL) c
    JOIN pages p ON p.source IS NOT DISTINCT FROM c.source
    WHERE c.n >= {L.MIN_PAGES} AND c.n > {L.MAX_RATIO} * p.n)
SELECT any_value(k.doc_id) AS doc_id,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '') AS text,
       CAST(any_value(n_lines) AS BIGINT) AS n_lines,
       count(*) FILTER (WHERE c.key IS NOT NULL) AS n_dropped
FROM k LEFT JOIN common c ON c.source IS NOT DISTINCT FROM k.source AND c.key = k.key
GROUP BY r"""


_WHOLE = """
    SELECT row_number() OVER () AS r, vec_id, {label} AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"""

TOP_PRODUCTS = f"""
WITH e AS ({_WHOLE.format(label="NULL")})
SELECT q.vec_id AS query_id,
       CAST(row_number() OVER (PARTITION BY q.r ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id)
            AS INTEGER) AS rank,
       c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.r <> q.r
QUALIFY rank <= 5"""

_LABEL = "CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END"

HARD_NEGATIVES = f"""
WITH e AS (SELECT * FROM ({_WHOLE.format(label=_LABEL)}) WHERE label IS NOT NULL),
s AS (
    SELECT a.r AS anchor, a.vec_id AS anchor_id, c.r, c.vec_id, a.label = c.label AS same,
           CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
    FROM e a JOIN e c ON a.vec_id % 100 = 0 AND c.r <> a.r),
p AS (
    SELECT * FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id)
            AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor = p.anchor AND NOT n.same
     AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10"""
