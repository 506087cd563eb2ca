"""DuckDB SQL of the queries that SQL can express, written from their
contracts rather than from the Spark code."""

HOST_QUALITY = r"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), spots AS (
  SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM split WHERE len(ws) >= 5
), runs AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i+1], ws[i+2], ws[i+3], ws[i+4]) AS times FROM spots
), repeated AS (
  SELECT rid, count(DISTINCT i + k) AS n
  FROM runs, (SELECT unnest(range(0, 5)) AS k) WHERE times >= 2 GROUP BY rid
), counted AS (
  SELECT s.doc_id, s.source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(body) - length(translate(body, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN repeated r USING (rid)
), ruled AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         10 * n_symbols >= 3 * n_words OR (n_dup_lines > 0 AND 100 * n_dup_lines >= 60 * n_lines) AS severe,
         10 * n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines
           OR word_chars < 2 * n_words OR word_chars > 12 * n_words AS mild
  FROM counted
), by_host AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (base_failed OR mild) AS DOUBLE) AS f
  FROM ruled GROUP BY source
), total AS (
  SELECT count(*) AS k, sum(n) AS nn, sum(f) AS ff, sum(f) / sum(n) AS p, sum(n * n) AS n2, sum(f * f / n) AS f2n
  FROM by_host
), spread AS (
  SELECT p, CASE WHEN (nn - n2 / nn - (k - 1)) * p * (1 - p) > 0
                 THEN (f2n - ff * p - (k - 1) * p * (1 - p)) / ((nn - n2 / nn - (k - 1)) * p * (1 - p))
                 ELSE 0.0001 END AS rho FROM total
), prior AS (
  SELECT p, (1 - least(greatest(rho, 0.0001), 0.999)) / least(greatest(rho, 0.0001), 0.999) AS strength FROM spread
), verdict AS (
  SELECT source, round((f + p * strength) / (n + strength), 9) >= 0.25 AS host_flagged FROM by_host, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT severe AND NOT (mild AND host_flagged) AS kept, host_flagged
FROM ruled JOIN verdict ON ruled.source IS NOT DISTINCT FROM verdict.source
"""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS rnd
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM sized GROUP BY source
), filling AS (
  SELECT *, 2.0::DOUBLE * source_size AS full_at,
         sum(2.0::DOUBLE * source_size) OVER o AS full_upto, sum(w) OVER o AS w_upto,
         1.5::DOUBLE * sum(source_size) OVER () AS wanted, sum(w) OVER () AS w_all
  FROM totals WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), targets AS (
  SELECT source, source_size, least(full_at, w * max((wanted - (full_upto - full_at)) / (w_all - (w_upto - w))) OVER ()) AS target
  FROM filling
), budget AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM targets
), placed AS (
  SELECT s.*, b.source_size, b.target, b.epochs,
         sum(size) OVER (PARTITION BY s.source ORDER BY rnd, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN budget b ON s.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN upto - size / 2.0::DOUBLE <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

WARC = r"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
grouped AS (
  SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
         CASE WHEN strlen(body) >= 1000 THEN max(page_id) OVER (PARTITION BY body) ELSE page_id END AS holder
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN holder IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM grouped
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

LEXICAL_SEARCH = f"""
WITH d AS (
  SELECT row_number() OVER () AS place, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS terms
  FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term
  FROM benchmark),
totals AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
counts AS (
  SELECT place, doc_id, n, term, count(*) AS tf
  FROM (SELECT place, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts CROSS JOIN totals GROUP BY term, n_docs),
scores AS (
  SELECT q.item_id, c.place, c.doc_id,
         sum(w * ((1000000000 * c.tf) // (1000 * c.tf + 20 * (50 + (50 * c.n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN counts c USING (term) JOIN weights USING (term) CROSS JOIN totals GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, place)::INT AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 50
"""
