"""DuckDB SQL for the operators that SQL can express, on whole tables."""

from __future__ import annotations

from touchline.llm.neardup import PERCENT, SHINGLE
from touchline.llm.quality_rules import MAX_REPEATED_PERCENT, MIN_WORDS, RULES, SYMBOLS
from touchline.llm.substrings import WINDOW

GAP = r"[\x20\x09-\x0D]+"

QUALITY_RULES = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '{GAP}'), lambda x: x <> '') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), repeated AS (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, x) AS n FROM windows) WHERE n > 1
), covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM repeated GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '{SYMBOLS}'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(t, '[A-Z]')) AS n_upper,
         len(regexp_extract_all(t, '!')) AS n_bangs, len(string_split(t, chr(10))) AS n_lines
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
), b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR {" OR ".join(f"({r})" for r in RULES.values())}) AS kept
FROM b
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '{GAP}'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - {SHINGLE - 2}))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b USING (x) JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= {PERCENT} * (na.n + nb.n - count(*))
), reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(least.component_id, d.doc_id) AS component_id,
       coalesce(least.component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""

SUBSTRINGS = rf"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{GAP}'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)
), hit AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY x) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN covered USING (doc_id)
"""


def _clustering(dims: int = 64, k: int = 40, rounds: int = 5, scale: int = 256, seed: int = 2) -> str:
    """The rounds written out one by one."""

    def assigned(name: str, centroids: str) -> str:
        apart = "list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT"
        return f"""{name} AS MATERIALIZED (
  SELECT row, vec_id, x, least.d AS distance, least.c AS cluster FROM (
    SELECT v.row, v.vec_id, v.x, min({{'d': {apart}, 'c': c.c}}) AS least FROM vectors v, {centroids} c GROUP BY ALL))"""

    parts = []
    for i in range(rounds):
        parts.append(assigned(f"a{i}", f"c{i}"))
        parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(m.x, c{i}.x) AS x FROM c{i} LEFT JOIN (
    SELECT cluster AS c, list((s - ((s % n) + n) % n) // n ORDER BY p) AS x FROM (
      SELECT cluster, p, sum(y)::BIGINT AS s, count(*) AS n
      FROM (SELECT cluster, unnest(x) AS y, unnest(range(len(x))) AS p FROM a{i}) GROUP BY ALL)
    GROUP BY cluster) m USING (c))""")
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h, x) - 1)::INTEGER AS c, x
  FROM (SELECT sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM vectors ORDER BY h, x LIMIT {k})
), {", ".join(parts)}, {assigned("final", f"c{rounds}")}
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM final JOIN c{rounds} ON cluster = c
"""


CLUSTERING = _clustering()

INFILL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), cut AS (
  SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS u, ('0x' || h[9:16])::BIGINT % (n + 1) AS v,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), parts AS (
  SELECT *, substr(t, 1, least(u, v)) AS p, substr(t, least(u, v) + 1, abs(u - v)) AS m, substr(t, greatest(u, v) + 1) AS s
  FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS x,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, octet_length(encode(t))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(x, (i // 4) * 5 + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM p
"""
