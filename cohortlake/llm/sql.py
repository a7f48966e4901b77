"""SQL that says in another engine what the operators on whole numbers and sets have to give."""

from __future__ import annotations

FILTER_AUDIT = r"""
WITH flags AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), texts AS (
  SELECT d.doc_id, coalesce(d.lang, '') AS part, coalesce(d.text, '') AS text, coalesce(f.good, 0) AS good, coalesce(f.toxic, 0) AS toxic FROM documents d LEFT JOIN flags f USING (doc_id)
), worded AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS lowest FROM texts
), failing AS (
  SELECT part, good, toxic, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
    regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > lowest, FALSE)] AS fails FROM worded
), cells AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY ALL
), letter(f) AS (VALUES (1), (2), (3), (4), (5)),
orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM letter a, letter b, letter c, letter d, letter e
  WHERE b.f <> a.f AND c.f NOT IN (a.f, b.f) AND d.f NOT IN (a.f, b.f, c.f) AND e.f NOT IN (a.f, b.f, c.f, d.f)
), steps AS (
  SELECT o, s.f AS step, o[s.f] AS filter, list_aggregate(list_transform(o, lambda x: substr('ABCDE', x, 1)), 'string_agg', '') AS filter_order FROM orders, letter s
), counted AS (
  SELECT c.part, s.filter_order, s.step, s.filter, c.n, c.good, c.toxic, c.fails[s.filter] AS own, len(list_filter(s.o[1 : s.step - 1], lambda x: c.fails[x])) > 0 AS gone,
    len(list_filter(c.fails, lambda x: x)) = 1 AS single FROM cells c, steps s
), summed AS (
  SELECT part, filter_order, step, filter, sum(CASE WHEN NOT gone AND NOT own THEN n ELSE 0 END) AS kept, sum(CASE WHEN own AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN own AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN own AND single THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN own AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN own AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM counted GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM summed
"""


def centroid_clustering(dimensions: int = 64, clusters: int = 8, rounds: int = 10, seed: str = "3") -> str:
    """Every distance from scratch in every round; the same floors, ties and empty clusters."""
    floor = "(s - ((s % n) + n) % n) // n"
    out = [f"""WITH vecs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (SELECT r, generate_subscripts(v, 1) AS d, unnest(v) AS x FROM vecs),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)), v) - 1 AS INT) AS k, v FROM vecs ORDER BY k LIMIT {clusters}
)"""]
    distance = "list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for i in range(rounds + 1):
        out.append(f"""a{i} AS MATERIALIZED (
  SELECT r, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT v.r, c.k, CAST({distance} AS BIGINT) AS d FROM vecs v, c{i} c) GROUP BY r
)""")
        if i < rounds:
            out.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT k, list({floor} ORDER BY d) AS v FROM (SELECT a.k, p.d, CAST(sum(p.x) AS BIGINT) AS s, count(*) AS n FROM a{i} a JOIN parts p USING (r) GROUP BY a.k, p.d) GROUP BY k
  ) m USING (k)
)""")
    last = f"""SELECT v.vec_id, a.k AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN vecs v USING (r) JOIN c{rounds} c USING (k)"""
    return ",\n".join(out) + "\n" + last

SUBSTRING_DEDUP = r"""
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT r, unnest(list_transform(range(1, len(w) - 33), lambda i: array_to_string(w[i : i + 34], ' '))) AS x, unnest(range(1, len(w) - 33)) AS i FROM texts WHERE len(w) >= 35
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY x) AS n FROM places
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM windows WHERE n > 1
), words AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts
), left_over AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(len(t.w) - coalesce(l.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(l.kept, '')) AS kept_sha256 FROM texts t LEFT JOIN left_over l USING (r)
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE texts AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s FROM texts
), named AS MATERIALIZED (
  SELECT min(doc_id) AS node, list_sort(s) AS s FROM sets GROUP BY 2
), items AS MATERIALIZED (SELECT node, len(s) AS n, unnest(s) AS x FROM named),
met AS (SELECT a.node AS a, b.node AS b, a.n AS na, b.n AS nb, count(*) AS met FROM items a JOIN items b ON a.x = b.x AND a.node < b.node GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM met WHERE 100 * met >= 75 * (na + nb - met) UNION ALL SELECT b, a FROM met WHERE 100 * met >= 75 * (na + nb - met)),
reach(node, other) AS (SELECT node, node FROM named UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
lowest AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE l.component_id END AS component_id,
  len(s.s) = 0 OR s.doc_id = l.component_id AS kept
FROM sets s JOIN named n ON list_sort(s.s) = n.s JOIN lowest l USING (node)
"""
