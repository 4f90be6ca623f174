"""Oracle SQL of the audits. The filter audit goes through every order; it knows nothing of the lattice."""

FILTER_AUDIT = r"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT doc_id, part, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM docs),
marked AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS failed
  FROM words w LEFT JOIN marked m ON m.doc_id = w.doc_id),
counts AS (SELECT part, failed, good, toxic, count(*) AS n FROM judged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
all_orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM all_orders),
met AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS filter, failed, good, toxic, n,
    contains(failed, substr(filter_order, step, 1)) AS fails,
    translate(failed, substr(filter_order, 1, step - 1), '') <> failed AS gone
  FROM counts, steps),
rows AS (
  SELECT part, filter_order, step, filter, sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed, sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = filter THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND fails AND good THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT gone AND fails AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM met GROUP BY ALL)
SELECT part, filter_order, step, filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM rows"""

SOURCE_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
tokens AS (SELECT d, lang, source, unnest(ts) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT d) AS k FROM tokens GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS total FROM counts GROUP BY ALL HAVING sum(k) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(total) AS size FROM kept GROUP BY lang),
all_groups AS (SELECT DISTINCT lang, source FROM docs),
matrix AS (
  SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n FROM all_groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
likely AS (
  SELECT m.lang, m.source, m.term, m.n,
    1 + (1000000000::HUGEINT * (m.n + 5)) // (sum(m.n) OVER (PARTITION BY m.lang, m.source) + 5 * l.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (m.total + 5)) // (l.size + 5 * l.v)::HUGEINT AS q
  FROM matrix m JOIN langs l ON l.lang = m.lang),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM likely a JOIN likely b
  ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM all_groups a JOIN all_groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM likely WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found
QUALIFY part = 'pair' OR rank <= 50"""
