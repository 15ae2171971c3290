"""DuckDB SQL of the dealt queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op4_warc_archives"] = """
WITH pages_of AS (
    SELECT page_id, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS payload_digest FROM pages
), grouped AS (
    SELECT *, strlen(payload) AS payload_bytes,
           min(page_id) OVER (PARTITION BY payload_digest) AS least,
           count(*) OVER (PARTITION BY payload_digest) AS n
    FROM pages_of
), marked AS (
    SELECT *, n > 1 AND payload_bytes >= 100 AND page_id > least AS revisit FROM grouped
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN least END AS refers_to
FROM marked
"""

_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE["op10_benchmark_overlap"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
phrases AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(list_slice(w, pos, pos + least(len(w), 10) - 1), ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM i WHERE len(w) > 0)
),
places AS (
    SELECT doc_id, m, pos, array_to_string(list_slice(w, pos, pos + m - 1), ' ') AS gram
    FROM (
        SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS pos
        FROM d, (SELECT DISTINCT m FROM phrases) WHERE len(w) >= m
    )
),
found AS (SELECT DISTINCT doc_id, pos, m, item_id FROM places JOIN phrases USING (m, gram)),
hit AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(pos, pos + m)) AS word FROM found) GROUP BY doc_id
),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op7_repeated_substrings"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
    SELECT doc_id, pos, substr(h, 2 * pos + 1, 100) AS gram
    FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS pos FROM d WHERE len(h) >= 100)
),
least AS (SELECT gram, min(doc_id) AS owner FROM windows GROUP BY gram),
marked AS (SELECT doc_id, pos FROM windows JOIN least USING (gram) WHERE owner < doc_id),
runs AS (
    SELECT doc_id, pos, sum(CASE WHEN pos - before <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run
    FROM (SELECT doc_id, pos, coalesce(lag(pos) OVER (PARTITION BY doc_id ORDER BY pos), -1000) AS before FROM marked)
),
spans AS (SELECT doc_id, min(pos) AS first, max(pos) + 50 AS stop FROM runs GROUP BY doc_id, run),
kept_parts AS (
    SELECT doc_id, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY first), 0) AS a, first AS b FROM spans
    UNION ALL
    SELECT doc_id, coalesce(max(stop), 0), max(len(h) // 2) FROM d LEFT JOIN spans USING (doc_id) GROUP BY doc_id
),
kept AS (
    SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k
    FROM kept_parts JOIN d USING (doc_id) GROUP BY doc_id
),
counts AS (SELECT doc_id, sum(stop - first) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""

ORACLE["op13_source_divergence"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
),
words AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT DISTINCT lang, source FROM d),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
shares AS (
    SELECT lang, source, term, coalesce(n, 0) AS n,
           1 + (1000000000 * (coalesce(n, 0) + 5)) // (coalesce(total, 0) + 5 * v) AS p,
           1 + (1000000000 * (lang_n + 5)) // (lang_total + 5 * v) AS q
    FROM groups JOIN langs USING (lang) JOIN kept USING (lang)
    LEFT JOIN totals USING (lang, source) LEFT JOIN counts USING (lang, source, term)
),
differences AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
),
parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN differences x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= 50
"""
