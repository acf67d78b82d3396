"""SQL counterparts, where SQL can express a query."""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, strlen(payload) AS payload_bytes, max(page_id) OVER (PARTITION BY payload) AS first,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(hex, 1 + (5 * i) // 4, 2) AS BIGINT) >> (3 - (5 * i) % 4)) & 31 AS BIGINT), 1)), '')
           AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN first END AS refers_to,
       CAST(NULL AS VARCHAR) AS error
FROM d
"""

TOPK = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS rid,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.rid AS query_rid, a.vec_id AS query_id, b.vec_id, b.rid,
         CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.rid <> b.rid AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_rid ORDER BY score DESC, vec_id, rid) AS rank FROM s
) WHERE rank <= 5
"""

MIXING = r"""
WITH w AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 2.0 ELSE 0.5 END) AS weight
  FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         -ln((CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 1)
             / CAST(4503599627370497 AS DOUBLE)) / coalesce(weight, 1.0) AS key
  FROM documents LEFT JOIN w USING (doc_id)
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
         2 * source_size AS most
  FROM s
), o AS (
  SELECT *, 3 * sum(source_size) OVER () - 2 * coalesce(sum(most) OVER p, 0) AS rest,
         sum(weight) OVER () - coalesce(sum(weight) OVER p, 0) AS rest_weight,
         row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS place
  FROM r
  WINDOW p AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT rest, rest_weight FROM o WHERE 2 * most * rest_weight >= rest * weight ORDER BY place LIMIT 1
), t AS (
  SELECT r.source, r.source_size,
         CASE WHEN f.rest IS NULL THEN CAST(most AS DOUBLE)
              ELSE least(CAST(most AS DOUBLE), weight * (CAST(f.rest AS DOUBLE) / 2.0) / CAST(f.rest_weight AS DOUBLE)) END AS target
  FROM r LEFT JOIN f ON true
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t
), x AS (
  SELECT d.doc_id, size, source_size, target, epochs,
         sum(size) OVER (PARTITION BY d.source ORDER BY key, d.doc_id ROWS UNBOUNDED PRECEDING) - size / 2 AS middle
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (epochs + CASE WHEN middle <= target - source_size * epochs THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM x
"""

EXACT_DEDUP = """
WITH h AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM h WINDOW g AS (PARTITION BY text_sha256)
"""

COLLOCATIONS = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(string_split(replace(piece, chr(9), ' '), ' '), lambda x: x <> '') AS words FROM t
), n AS (
  SELECT lang, sum(len(words)) AS n FROM w GROUP BY lang
), p AS (
  SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS start
  FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS size)
), f AS (
  SELECT lang, list_slice(words, start, start + size - 1) AS phrase, count(*) AS a FROM p
  GROUP BY ALL HAVING count(*) >= 100
), c AS (
  SELECT lang, phrase, a, unnest(range(1, len(phrase))) AS k FROM f WHERE len(phrase) > 1
), s AS (
  SELECT c.lang, c.phrase, c.a, n.n, k, x.a AS l, y.a AS r,
         (1000::HUGEINT * c.a * n.n) // (x.a::HUGEINT * y.a) AS score
  FROM c JOIN n ON n.lang = c.lang
  JOIN f x ON x.lang = c.lang AND x.phrase = c.phrase[:k]
  JOIN f y ON y.lang = c.lang AND y.phrase = c.phrase[k + 1:]
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), i AS (
  SELECT lang, list_slice(phrase, start, start + size - 1) AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, len(phrase) - size + 2)) AS start
        FROM f, (SELECT unnest([2, 3, 4]) AS size) WHERE size < len(phrase))
  GROUP BY ALL
), o AS (
  SELECT b.*, array_to_string(b.phrase, ' ') AS words FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE longer IS NULL OR 100 * longer < 100 * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, words) AS rank, words AS phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM o QUALIFY rank <= 2000
"""

ORACLE = {
    "op1_warc": WARC,
    "op4_exact_topk": TOPK,
    "op5_mixing": MIXING,
    "op10_exact_dedup": EXACT_DEDUP,
    "op13_collocations": COLLOCATIONS,
}
