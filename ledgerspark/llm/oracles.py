"""DuckDB SQL of the similarity queries: every pair compared, components by recursion."""

NGRAM_JOIN = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')] ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s), u AS (SELECT doc_id, unnest(sh) AS t FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM u a JOIN u b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(min(r.b), n.doc_id)) AS component_id FROM n LEFT JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n
"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
g AS (SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda i: i IS NULL OR NOT isfinite(i))) = 0 AND len(list_filter(x, lambda i: i <> 0)) > 0),
e AS (SELECT p.vec_id AS a, q.vec_id AS b FROM g p JOIN g q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.x) = len(q.x) WHERE list_cosine_similarity(p.x, q.x) >= 0.93),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a), k AS (SELECT a, count(*) AS n FROM e GROUP BY a), m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT v.vec_id, coalesce(k.n, 0) AS n_links, least(v.vec_id, coalesce(m.b, v.vec_id)) AS component_id, v.vec_id = least(v.vec_id, coalesce(m.b, v.vec_id)) AS kept
FROM v LEFT JOIN k ON k.a = v.vec_id LEFT JOIN m ON m.a = v.vec_id
"""
