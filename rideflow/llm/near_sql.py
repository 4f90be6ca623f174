"""Oracle SQL of the similarity joins."""


def _connected(links: str, nodes: str, node: str) -> str:
    """CTE tail: (node, component) over `links` (a, b), both directions."""
    return f"""
reach(n, m) AS (SELECT {node}, {node} FROM {nodes} UNION SELECT r.n, l.b FROM reach r JOIN both_ways l ON l.a = r.m),
component AS (SELECT n, min(m) AS component_id FROM reach GROUP BY n)""".replace("both_ways", links)


NGRAM_JOIN = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) END AS s FROM split),
items AS (SELECT doc_id, unnest(s) AS t FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM items x JOIN items y ON x.t = y.t AND x.doc_id < y.doc_id
  GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 90 * (p.n + q.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),""" + _connected("both_ways", "sizes", "doc_id") + """
SELECT doc_id, CAST(s.n AS BIGINT) AS n_shingles, component_id FROM sizes s JOIN component c ON c.n = s.doc_id"""

CAP_LINKS = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
  ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.98),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
degree AS (SELECT a, count(*) AS k FROM both_ways GROUP BY a),""" + _connected("both_ways", "embeddings", "vec_id") + """
SELECT e.vec_id, CAST(coalesce(k, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN component c ON c.n = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id"""

HAMMING_TOPK = """
WITH codes AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
near AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, 65),
    lambda i: abs(q.bits[i] - c.bits[i]))) AS INTEGER) AS distance
  FROM codes q JOIN codes c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank,
  vec_id, distance FROM near QUALIFY rank <= 10"""

URL_RULES = r"""
WITH parsed AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM parsed),
rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT u.page_id, u.host, u.path, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.host || r.path) DESC) AS nth
  FROM urls u LEFT JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best WHERE nth = 1"""
