"""SQL of another engine for queries whose result can be said plainly: every window, pair or payload."""

# Equal payloads of 1000 bytes or more: the one with the largest page_id is written.
WARC_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS last FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND last <> page_id THEN last END AS refers_to
FROM w
"""

# All pairs that share a shingle, and everything that links reach.
NEAR_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, concat_ws(' ', w[i], w[i + 1]) AS sh
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS k FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.k + b.k - c)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON b.x = r.y),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.k, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(l.y, d.doc_id)) AS component_id,
  least(d.doc_id, coalesce(l.y, d.doc_id)) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least l ON l.x = d.doc_id
"""

# Every window of 50 words, and the least document it starts in.
REPEATS_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT rid, doc_id, s, md5(array_to_string(w[s : s + 49], ' ')) AS x
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
first_in AS (SELECT x, min(doc_id) AS m FROM win GROUP BY x),
gone AS (SELECT DISTINCT rid, p FROM (SELECT rid, unnest(range(s, s + 50)) AS p FROM win JOIN first_in USING (x) WHERE doc_id > m)),
word AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (
  SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
