"""DuckDB SQL for those queries of :mod:`rankspark.llm.queries` that SQL can express."""

NEAREST = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    sqrt(list_sum(list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0) q JOIN v c
    ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

ARCHIVE = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS digest FROM pages
), g AS (
  SELECT digest, max(page_id) AS leader FROM p WHERE octet_length(payload) >= 1000
  GROUP BY digest HAVING count(*) > 1
)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN leader IS NULL OR page_id IS NOT DISTINCT FROM leader THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN leader IS NOT NULL AND page_id IS DISTINCT FROM leader THEN leader END AS refers_to
FROM p LEFT JOIN g ON p.digest = g.digest
"""

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w
), n AS (SELECT doc_id, len(s) AS n FROM s),
g AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM n
  UNION
  SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
)
SELECT n.doc_id, n.n AS n_shingles, c.component_id
FROM n JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON n.doc_id = c.a
"""



def _centroids(rounds: int = 10) -> str:
    """Lloyd's rounds written out one after the other."""
    square = "lambda p: (p[1] - p[2]) * (p[1] - p[2])"
    out = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(x * 1024) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, x) - 1 AS c, x FROM v QUALIFY c < 8
)"""
    for i in range(rounds + 1):
        out += f""", a{i} AS MATERIALIZED (
  SELECT r, min({{'d': d, 'c': c}}) AS best FROM (
    SELECT r, c, CAST(list_sum(list_transform(list_zip(v.x, c{i}.x), {square})) AS BIGINT) AS d FROM v CROSS JOIN c{i}
  ) GROUP BY r
)"""
        if i < rounds:
            out += f""", s{i} AS (
  SELECT best.c AS c, d, sum(x) AS s, count(*) AS n
  FROM (SELECT best, unnest(x) AS x, unnest(range(1, 65)) AS d FROM a{i} JOIN v USING (r)) GROUP BY 1, 2
), m{i} AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS x FROM s{i} GROUP BY c
), c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(m{i}.x, c{i}.x) AS x FROM c{i} LEFT JOIN m{i} ON c{i}.c = m{i}.c
)"""
    return out + f"""
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} ON c{rounds}.c = best.c
"""


AUDIT = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false) THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
), m AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM d GROUP BY ALL
), f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS o FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), s AS (
  SELECT o, step, 1 << (ascii(o[step]) - 65) AS bit,
    list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(o[i]) - 65))) AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step)
), r AS (
  SELECT part, o, step,
    sum(CASE WHEN mask & bit = 0 AND mask & coalesce(before, 0)::INT = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & coalesce(before, 0)::INT = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & coalesce(before, 0)::INT <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit <> 0 AND mask & coalesce(before, 0)::INT = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit <> 0 AND mask & coalesce(before, 0)::INT = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM m, s GROUP BY ALL
)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley
FROM r
"""

ORACLE: dict[str, str] = {
    "op5_block_nearest": NEAREST,
    "op7_warc_dictionary": ARCHIVE,
    "op9_jaccard_join": JACCARD,
    "op12_threshold_centroids": _centroids(),
    "op13_filter_audit": AUDIT,
}
