"""SQL twins of the queries that SQL can express, for DuckDB on the same tables."""

OP10 = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), placed AS (
  SELECT source, source_size, 2 * source_size AS lim,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sizes
), levels AS (
  SELECT *, CAST(lim AS DOUBLE) / w AS ratio,
    (CAST(1.5 AS DOUBLE) * (SELECT sum(source_size) FROM sizes)
      - coalesce(sum(lim) OVER b, 0))
    / (CAST((SELECT sum(w) FROM placed) AS DOUBLE) - coalesce(sum(w) OVER b, 0)) AS lvl
  FROM placed
  WINDOW b AS (ORDER BY CAST(lim AS DOUBLE) / w, place
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
  SELECT arg_min(lvl, place) AS lev FROM levels
  WHERE (ratio, place) = (SELECT min((ratio, place)) FROM levels WHERE lvl <= ratio)
), planned AS (
  SELECT source, source_size, least(CAST(lim AS DOUBLE), (SELECT lev FROM water) * w) AS target
  FROM levels
), budgets AS (
  SELECT *, CASE WHEN source_size > 0
                 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS passes
  FROM planned
), sums AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.passes,
         CAST(floor(p.target) AS BIGINT) - p.passes * p.source_size AS rest,
         count(*) OVER (PARTITION BY s.source, k, doc_id, size) AS copies,
         sum(size) OVER (PARTITION BY s.source ORDER BY k, CAST(doc_id AS VARCHAR) NULLS FIRST,
                         size RANGE UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN budgets p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(passes * size + CASE
         WHEN upto <= rest THEN size
         WHEN upto - copies * size > rest THEN 0
         ELSE (rest - upto + copies * size) // copies END AS BIGINT) AS taken
FROM sums
"""

OP6 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), item_starts AS (
  SELECT item_id, w, least(len(w), 10) AS n,
         unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
  FROM items WHERE len(w) > 0
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS win FROM item_starts
), doc_starts AS (
  SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n
), doc_windows AS (
  SELECT row, n, i, array_to_string(w[i : i + n - 1], ' ') AS win FROM doc_starts
), found AS (
  SELECT row, i, n, item_id FROM doc_windows JOIN item_windows USING (n, win)
), hit AS (
  SELECT row, count(DISTINCT p) AS n_hit
  FROM (SELECT row, unnest(range(i, i + n)) AS p FROM found) GROUP BY row
), named AS (
  SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT row, item_id FROM found) GROUP BY row
)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words,
       coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""

OP5 = """
WITH rows AS (
  SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha256(coalesce(html, '')) AS digest
  FROM pages
), marked AS (
  SELECT *, CASE WHEN bytes >= 100
                 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS original
  FROM rows
)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM original THEN 'response' ELSE 'revisit' END
         AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM original THEN NULL ELSE original END AS refers_to
FROM marked
"""

OP3 = r"""
WITH captures AS (
  SELECT row_number() OVER () AS capture, page_id, url, 1704067200 + (page_id * 7919) % 31622400 AS fetched_at,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    list_filter(string_split(
      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'),
      lambda s: s <> '') AS steps
  FROM pages
), hosts AS (
  SELECT DISTINCT host, strlen(host) AS n,
         list_extract(string_split(host, '.'), -2) || '.' || list_extract(string_split(host, '.'), -1)
           AS domain
  FROM captures WHERE host <> ''
), entries AS (
  SELECT 'hosts' AS list, 'host:' || host AS pattern, 'add' AS action,
         1704067200 + (n * 11 % 200) * 86400 AS moment FROM hosts WHERE n % 2 = 0
  UNION ALL SELECT 'hosts', 'host:' || host, 'remove', 1704067200 + (n * 11 % 200 + 60) * 86400
  FROM hosts WHERE n % 2 = 0
  UNION ALL SELECT 'hosts', 'host:' || host, 'add', 1704067200 + (n * 11 % 200 + 120) * 86400
  FROM hosts WHERE n % 4 = 0
  UNION ALL SELECT DISTINCT 'domains', 'domain:' || domain, 'add',
         1704067200 + (strlen(domain) * 17 % 150) * 86400 FROM hosts
  UNION ALL SELECT DISTINCT 'domains', 'domain:' || domain, 'remove',
         1704067200 + (strlen(domain) * 17 % 150 + 45) * 86400 FROM hosts
  UNION ALL SELECT 'paths', 'prefix:' || host || '/en', 'add',
         1704067200 + (n * 29 % 300) * 86400 FROM hosts WHERE n % 3 = 0
), states AS (
  SELECT DISTINCT list, pattern, moment, action = 'add' AS active FROM entries
), spans AS (
  SELECT list, pattern, moment AS since, active,
         lead(moment, 1, 9000000000) OVER (PARTITION BY list, pattern ORDER BY moment) AS until
  FROM (SELECT list, pattern, moment, bool_or(active) AS active FROM states GROUP BY ALL)
), matched AS (
  SELECT capture, list || ' ' || pattern AS entry
  FROM captures JOIN spans ON active AND since <= fetched_at AND fetched_at < until AND (
    pattern = 'host:' || host
    OR (starts_with(pattern, 'domain:')
        AND (substr(pattern, 8) = host OR ends_with(host, '.' || substr(pattern, 8))))
    OR (starts_with(pattern, 'prefix:') AND len(steps) > 0
        AND pattern = 'prefix:' || host || '/' || steps[1]))
)
SELECT page_id, fetched_at, count(entry) > 0 AS blocked, count(entry) AS n_active,
       coalesce(string_agg(entry, ', ' ORDER BY entry), '') AS active
FROM captures LEFT JOIN matched USING (capture) GROUP BY capture, page_id, fetched_at
"""

OP11 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0)
              AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND len(q.v) = len(c.v)
    AND c.vec_id IS DISTINCT FROM q.vec_id
)
SELECT query_id, CAST(row_number() OVER (
         PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 5
"""

OP12 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs
), flagged AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM split
), marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good,
         bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id
), counts AS (
  SELECT part, mask, count(*) AS n, count_if(coalesce(good, false)) AS good,
         count_if(coalesce(toxic, false)) AS toxic
  FROM flagged LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a JOIN letters b ON b.bit <> a.bit
  JOIN letters c ON c.bit NOT IN (a.bit, b.bit)
  JOIN letters d ON d.bit NOT IN (a.bit, b.bit, c.bit)
  JOIN letters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[: step - 1]), 0) AS before
  FROM (SELECT *, unnest(range(1, 6)) AS step FROM orders)
), told AS (
  SELECT part, filter_order, step, bit,
         sum(n) FILTER (mask & bit = 0 AND mask & before = 0) AS kept,
         sum(n) FILTER (mask & bit <> 0 AND mask & before = 0) AS removed,
         sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0) AS redundant,
         sum(n) FILTER (mask = bit) AS unique_fails,
         sum(good) FILTER (mask & bit <> 0 AND mask & before = 0) AS good_lost,
         sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0) AS toxic_lost
  FROM counts CROSS JOIN (SELECT filter_order, step, CAST(bit AS BIGINT) AS bit,
                                 CAST(before AS BIGINT) AS before FROM steps)
  GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, bit), 0) AS BIGINT) AS shapley
FROM told
"""

ORACLES = {
    "op11_top_k": OP11,
    "op12_filter_audit": OP12,
    "op3_url_lists": OP3,
    "op5_warc": OP5,
    "op6_decontaminate": OP6,
    "op10_mixing": OP10,
}
