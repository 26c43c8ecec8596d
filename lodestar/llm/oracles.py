"""DuckDB SQL of the llm queries that SQL can express.

Not among them: tokenizers, XXH64 fingerprints, trained models and greedy tiling; their
queries are tested against brute force.
"""

from __future__ import annotations

OP6 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.vec_id, l.y FROM reach r JOIN links l ON r.other = l.x
), component AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT c.vec_id, coalesce(d.n, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM component c LEFT JOIN degree d ON d.x = c.vec_id
"""

OP3 = """
WITH bare AS (
  SELECT page_id, url, html, md5(html) AS m, length(url) AS n, length(html) AS size,
         regexp_replace(regexp_replace(url, '^[^:/?#]*://', ''), '(?s)#.*$', '') AS b FROM pages
), parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(b, '^[^/?]*')), '^(www|m)[.]', ''), ':(80|443)$', '') AS host,
         regexp_replace(regexp_extract(b, '(?s)^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         list_sort([x for x in string_split(regexp_extract(b, '(?s)^[^?]*[?](.*)$', 1), '&') if x <> '' AND NOT starts_with(x, 'utm_')]) AS params FROM bare
), pages2 AS (
  SELECT page_id, m, n, host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS url,
         '"' || substr(m, 1, 16) || '"' AS tag, 'day ' || size AS modified,
         10 * page_id + CASE WHEN n % 11 = 0 THEN -5 ELSE 10 * (n * 97 % 500) + 5 END AS later FROM parts
), responses AS (SELECT 2 * page_id AS rid, url, 10 * page_id AS ts, m, tag, modified FROM pages2
), revisits AS (
  SELECT 2 * page_id + 1 AS rid, url, later AS ts, CASE WHEN n % 5 > 1 THEN 'W/' || tag END AS tag, CASE WHEN n % 5 = 0 THEN modified END AS modified FROM pages2
), found AS (
  SELECT v.rid AS record_id, v.url, v.ts, v.tag AS vtag, v.modified AS vmod, r.rid, r.ts AS rts, r.m, r.tag AS rtag, r.modified AS rmod,
         CASE WHEN r.rid IS NULL THEN 'orphan' WHEN v.tag IS NOT NULL THEN CASE WHEN v.tag = 'W/' || r.tag THEN 'resolved' ELSE 'mismatch' END
              WHEN v.modified IS NOT NULL THEN CASE WHEN v.modified = r.modified THEN 'resolved' ELSE 'mismatch' END ELSE 'unverified' END AS status
  FROM revisits v ASOF LEFT JOIN responses r ON v.url = r.url AND v.ts > r.ts
)
SELECT record_id, url, ts, status, rid AS response_id, rts AS response_ts, CASE WHEN status IN ('resolved', 'unverified') THEN m END AS digest,
  CASE WHEN status IN ('resolved', 'unverified') THEN concat_ws(chr(10), 'cache-control: max-age=60', 'content-type: text/html', 'date: ' || ts,
    'etag: ' || coalesce(vtag, rtag), 'expires: t' || ts, 'last-modified: ' || coalesce(vmod, rmod))
  ELSE concat_ws(chr(10), 'content-length: 0', 'date: ' || ts, 'etag: ' || vtag, 'expires: t' || ts, 'last-modified: ' || vmod) END AS headers
FROM found
"""

OP11 = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, total GROUP BY term, docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (doc_id), total GROUP BY item_id, doc_id
), ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def _op12(k: int = 8, rounds: int = 10) -> str:
    """Rounds unrolled: a<i> assigns to the centroids c<i> in long form (cluster, dimension, value)."""
    parts = ["""v AS MATERIALIZED (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(1024 * x) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: isfinite(x))) = 64
)""", """cells AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS d, unnest(e) AS x FROM v)""",
             f"""first AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS cluster, e FROM v QUALIFY cluster < {k})""",
             """c0 AS MATERIALIZED (SELECT cluster, unnest(range(64)) AS d, unnest(e) AS x FROM first)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, cluster, distance FROM (
    SELECT vec_id, c.cluster, CAST(sum((t.x - c.x) * (t.x - c.x)) AS BIGINT) AS distance FROM cells t JOIN c{i} c USING (d) GROUP BY vec_id, c.cluster)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1
)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, c.d, CASE WHEN s.n > 0 THEN CAST((s.t - ((s.t % s.n) + s.n) % s.n) // s.n AS BIGINT) ELSE c.x END AS x
  FROM c{i} c LEFT JOIN (SELECT cluster, d, sum(x) AS t, count(*) AS n FROM a{i} JOIN cells USING (vec_id) GROUP BY cluster, d) s USING (cluster, d)
)""")
    parts.append(f"digest AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN digest USING (cluster)
"""


SQL: dict[str, str] = {"op3_warc_revisits": OP3, "op6_product_quantisation": OP6, "op11_pipelined_terms": OP11, "op12_lookup_kmeans": _op12()}
