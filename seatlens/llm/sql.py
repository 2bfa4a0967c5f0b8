"""What queries of this package must return, as SQL for DuckDB on the same tables."""

from __future__ import annotations

#: Words: runs of characters other than space and 0x09-0x0D.
WORD = r"[^ \t\n\x0B\f\r]+"


def jaccard_sql(source: str, shingle: int, percent: int) -> str:
    """CTEs ``sized`` (doc_id, n) and ``reach`` (doc_id, other) over a relation of doc_id and text."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    worded AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD}') AS w
        FROM {source}
    ),
    members AS (
        SELECT DISTINCT doc_id, unnest(
            CASE WHEN len(w) = 0 THEN []
                 WHEN len(w) < {shingle} THEN [array_to_string(w, ' ')]
                 ELSE [array_to_string(w[i : i + {shingle - 1}], ' ') FOR i IN range(1, len(w) - {shingle - 2})] END
        ) AS s
        FROM worded
    ),
    sized AS (
        SELECT d.doc_id, count(m.s) AS n FROM {source} d LEFT JOIN members m ON m.doc_id = d.doc_id GROUP BY d.doc_id
    ),
    links AS (
        SELECT a.doc_id AS u, b.doc_id AS v
        FROM members a JOIN members b ON a.s = b.s AND a.doc_id <> b.doc_id
        JOIN sized x ON x.doc_id = a.doc_id JOIN sized y ON y.doc_id = b.doc_id
        WHERE 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)
        GROUP BY a.doc_id, b.doc_id, x.n, y.n
        HAVING 100 * count(*) >= {percent} * (x.n + y.n - count(*))
    ),
    reach AS (
        SELECT doc_id, doc_id AS other FROM {source}
        UNION
        SELECT r.doc_id, l.v AS other FROM reach r JOIN links l ON l.u = r.other
    )"""


_OP1 = f"""
WITH RECURSIVE {jaccard_sql("documents", 3, 90)}
SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id
FROM sized s JOIN reach r ON r.doc_id = s.doc_id
GROUP BY s.doc_id, s.n
"""


_OP6 = """
WITH coded AS (
    SELECT vec_id AS id,
           array_to_string([CASE WHEN x > 0 THEN '1' ELSE '0' END FOR x IN embedding[1:64]], '')::BIT AS code
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
),
ranked AS (
    SELECT q.id AS query_id, b.id, bit_count(xor(q.code, b.code)) AS distance,
           row_number() OVER (PARTITION BY q.id ORDER BY bit_count(xor(q.code, b.code)), b.id) AS rank
    FROM coded q CROSS JOIN coded b WHERE q.id % 100 = 0
)
SELECT * FROM ranked WHERE rank <= 10
"""

_OP8 = r"""
WITH captures AS (
    SELECT page_id * 4 + n AS record_id, n, page_id, md5(html) AS digest, (page_id % 100000 + n * 200000) AS at,
           CASE n WHEN 1 THEN url || '#again' WHEN 2 THEN regexp_replace(url, '^https?', 'HTTP') ELSE url END AS url
    FROM pages, range(4) t(n)
),
plain AS (SELECT *, regexp_replace(trim(url), '#.*$', '') AS p FROM captures),
parts AS (
    SELECT *,
        regexp_replace(lower(regexp_extract(p, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]+)', 1)), ':(80|443)$', '') AS host,
        regexp_replace(regexp_extract(p, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]+([^?]*)', 1), '/+$', '') AS path,
        list_sort(list_filter(string_split(regexp_extract(p, '^[^?]*\?(.*)$', 1), '&'),
            lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]*|fbclid|gclid)(=|$)'))) AS query
    FROM plain
),
records AS (
    SELECT *, CASE WHEN host <> '' THEN
            host || path || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END END AS canonical_url,
        CASE WHEN n = 0 THEN '"' || digest || '"' WHEN n = 1 THEN 'W/"' || digest || '"'
             WHEN n = 3 AND page_id % 3 = 0 THEN '"changed"' END AS etag,
        CASE WHEN n = 2 AND page_id % 5 = 0 THEN 'day 9' WHEN n IN (0, 2) THEN 'day ' || (page_id % 7) END AS modified
    FROM parts
),
matched AS (
    SELECT r.*, f.record_id AS full_id, f.digest AS full_digest, f.etag AS full_etag, f.modified AS full_modified
    FROM records r LEFT JOIN records f
      ON r.n > 0 AND f.n = 0 AND f.canonical_url = r.canonical_url AND f.at < r.at
    QUALIFY row_number() OVER (PARTITION BY r.record_id ORDER BY f.at DESC NULLS LAST, f.record_id DESC NULLS LAST) = 1
),
judged AS (
    SELECT *, CASE WHEN n = 0 THEN 'full' WHEN full_id IS NULL THEN 'no response'
        WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = full_etag THEN 'resolved' ELSE 'mismatch' END
        WHEN modified IS NOT NULL THEN CASE WHEN modified = full_modified THEN 'resolved' ELSE 'mismatch' END
        ELSE 'no validator' END AS status
    FROM matched
)
SELECT record_id, canonical_url, CASE WHEN n = 0 THEN 'response' ELSE 'revisit' END AS record_type, status,
    CASE WHEN status = 'full' THEN record_id WHEN status = 'resolved' THEN full_id END AS target_id,
    array_to_string(list_filter([
        'content-type: ' || CASE WHEN n = 0 OR status = 'resolved' THEN 'text/html' ELSE 'x/y' END,
        'date: visit ' || n,
        'etag: ' || CASE WHEN status = 'resolved' THEN coalesce(etag, full_etag) ELSE etag END,
        'last-modified: ' || CASE WHEN status = 'resolved' THEN coalesce(modified, full_modified) ELSE modified END
    ], lambda x: x IS NOT NULL), chr(10)) AS headers,
    CASE WHEN status = 'full' THEN digest WHEN status = 'resolved' THEN full_digest END AS payload_digest
FROM judged
"""


def prefix_trie_sql(source: str) -> str:
    """The trie of a relation of conv_id, turn, role and text; h comes from the checksum, bit by bit."""
    bits = "list_prepend(4294967295::BIGINT, flatten([[ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(conv_id::VARCHAR, '')]))"
    step = "CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END"
    return f"""
WITH turns AS (
    SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS k,
           length(coalesce(text, '')) AS points
    FROM {source} WHERE conv_id IS NOT NULL
),
own AS (
    SELECT conv_id, list({{'k': k, 'points': points}} ORDER BY turn NULLS FIRST, k) AS t,
           xor(list_reduce({bits}, lambda c, x: {step}), 4294967295) % 6 AS h
    FROM turns GROUP BY conv_id
),
rebuilt AS (
    SELECT o.conv_id, list_concat(coalesce(f.t[1 : o.h], []), o.t[o.h + 1 :]) AS t
    FROM own o LEFT JOIN own f ON f.conv_id = o.conv_id - o.conv_id % 100
),
member AS (
    SELECT conv_id, d, [e.k FOR e IN t[1 : d]] AS p, t[d].points AS points, len(t) = d AS ends
    FROM (SELECT conv_id, t, unnest(range(len(t) + 1)) AS d FROM rebuilt)
),
node AS (
    SELECT p, d, min(conv_id) AS conv_id, count(*) AS n, coalesce(max(points), 0) AS points,
           sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM member GROUP BY p, d
),
child AS (SELECT p[1 : d - 1] AS p, count(*) AS c FROM node WHERE d > 0 GROUP BY 1),
whole AS (SELECT v.*, coalesce(c, 0) AS c FROM node v LEFT JOIN child ON child.p = v.p),
subtree AS (
    SELECT p[1 : k] AS p, count(*) FILTER (c = 0) AS leaves, sum((n - 1) * points)::BIGINT AS saved
    FROM (SELECT *, unnest(range(d + 1)) AS k FROM whole) GROUP BY 1
)
SELECT v.conv_id, v.d AS depth, up.conv_id AS parent_conv_id, v.n AS n_convs, v.c AS n_children, s.leaves AS n_leaves,
       s.saved AS saved_tokens, v.ends_sha256
FROM whole v JOIN subtree s ON s.p = v.p LEFT JOIN node up ON v.d > 0 AND up.p = v.p[1 : v.d - 1]
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_jaccard_join": _OP1, "op6_hamming_top_k": _OP6, "op8_revisits": _OP8, "op13_prefix_trie": prefix_trie_sql("conversations")}
