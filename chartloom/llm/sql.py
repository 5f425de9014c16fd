"""SQL (DuckDB) for the rows of the queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x20\x09-\x0D]+'"
_PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
win AS (
  SELECT doc_id, unnest(range(1, len(ws) - 48)) AS k,
         unnest(list_transform(range(1, len(ws) - 48), lambda k: array_to_string(ws[k:k + 49], ' '))) AS s
  FROM d WHERE len(ws) >= 50),
least AS (SELECT s, min(doc_id) AS low FROM win GROUP BY s),
hit AS (SELECT doc_id, k FROM win JOIN least USING (s) WHERE low < doc_id),
word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS w FROM d WHERE len(ws) > 0),
marked AS (
  SELECT word.doc_id, j, w, coalesce(max(hit.k) OVER (PARTITION BY word.doc_id ORDER BY j), -100) > j - 50 AS gone
  FROM word LEFT JOIN hit ON word.doc_id = hit.doc_id AND word.j = hit.k)
SELECT d.doc_id, len(any_value(ws)) AS n_words, count(j) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(w, ' ' ORDER BY j) FILTER (NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN marked ON d.doc_id = marked.doc_id GROUP BY d.doc_id
"""

JACCARD_JOIN = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 2, 1) + 1), lambda k: array_to_string(ws[k:k + 2], ' '))) AS g
  FROM d WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.id, edge.b FROM reach JOIN edge ON reach.other = edge.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.other) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN reach ON reach.id = d.doc_id GROUP BY ALL
"""

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_PLAIN}) AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, {_PLAIN}) AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS n,
         unnest(list_transform(range(1, greatest(len(ws) - 12, 1) + 1), lambda k: array_to_string(ws[k:k + 12], ' '))) AS s
  FROM b WHERE len(ws) > 0),
dw AS (
  SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS k,
         unnest(list_transform(range(1, len(ws) - n + 2), lambda k: array_to_string(ws[k:k + n - 1], ' '))) AS s
  FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n),
hit AS (SELECT doc_id, k, n, item_id FROM dw JOIN bw USING (n, s)),
last AS (SELECT doc_id, k, max(k + n - 1) AS e FROM hit GROUP BY doc_id, k),
word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS j FROM d WHERE len(ws) > 0),
marked AS (
  SELECT word.doc_id, j, coalesce(max(e) OVER (PARTITION BY word.doc_id ORDER BY j), 0) >= j AS h
  FROM word LEFT JOIN last ON word.doc_id = last.doc_id AND word.j = last.k),
words AS (SELECT doc_id, count(*) FILTER (h) AS n_hit FROM marked GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

LINE_DEDUP = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, len(ls) AS n, unnest(range(1, len(ls) + 1)) AS j, unnest(ls) AS line FROM d),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM l),
c AS (SELECT *, (coalesce(lag(h) OVER w, 0) * 1000003 + h) % 2147483647 % 3 = 0 AS c FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY j)),
b AS (
  SELECT *, CASE WHEN j = n OR (c AND NOT coalesce(lag(c) OVER w, false)) THEN 1 ELSE 0 END AS b FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY j)),
k AS (
  SELECT *, coalesce(sum(b) OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM b),
chunk AS (SELECT doc_id, chunk, count(*) AS n, string_agg(line, chr(10) ORDER BY j) AS body FROM k GROUP BY doc_id, chunk),
marked AS (
  SELECT *, n >= 2 AND regexp_matches(body, '[^\x20\x09-\x0D]')
            AND row_number() OVER (PARTITION BY n >= 2, body ORDER BY doc_id, chunk) > 1 AS gone FROM chunk)
SELECT documents.doc_id, coalesce(sum(n), 0)::BIGINT AS n_lines, coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (NOT gone), '')) AS kept_sha256
FROM documents LEFT JOIN marked ON documents.doc_id = marked.doc_id GROUP BY documents.doc_id
"""

WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest, payload_bytes, max(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM p LEFT JOIN k USING (payload_digest, payload_bytes)
"""

_ASSIGN = """
d{r} AS (SELECT q.r, c, sum((x - y) * (x - y))::BIGINT AS distance FROM q JOIN c{r} USING (j) GROUP BY ALL),
a{r} AS (SELECT r, min(distance) AS distance, min_by(c, (distance, c)) AS c FROM d{r} GROUP BY r),
"""
_MOVE = """
m{r} AS (SELECT a.c, j, (sum(x)::HUGEINT) AS s, count(*) AS n FROM a{r} a JOIN q USING (r) GROUP BY ALL),
c{next} AS (
  SELECT c, j, coalesce(CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END, y)::BIGINT AS y FROM c{r} LEFT JOIN m{r} USING (c, j)),
"""
_ROUNDS = "".join(_ASSIGN.format(r=r) + (_MOVE.format(r=r, next=r + 1) if r < 3 else "") for r in range(4))

CENTROIDS = f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), e) AS r, vec_id, e
  FROM (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)),
q AS (SELECT r, unnest(range(1, 65)) AS j, unnest(e)::BIGINT AS x FROM v),
c0 AS (SELECT r - 1 AS c, j, x AS y FROM q WHERE r <= 16),
{_ROUNDS}
names AS (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c3 GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a3 JOIN v USING (r) JOIN names USING (c)
"""
