"""DuckDB SQL for the corpus queries that SQL can express, over the test tables."""

from __future__ import annotations

# CRC-32 of zlib: reflected polynomial, all bits inverted before and behind (fixed values)
_CRC = """
crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_of
)"""


def _crc32(text: str) -> str:
    byte = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {byte}), lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295)"


OP11 = f"""
WITH {_CRC},
sized AS (
    SELECT doc_id, coalesce(text, '') AS t, octet_length(encode(coalesce(text, ''))) + 1 AS size FROM documents
),
placed AS (
    SELECT *, row_number() OVER w AS place, sum(size) OVER w AS upto, sum(size) OVER () AS total
    FROM sized WINDOW w AS (ORDER BY md5(t), doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)
),
dealt AS (SELECT *, least(7, (2 * upto - size) * 8 // (2 * total))::INTEGER AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, {_crc32('t')}::BIGINT AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM dealt, crc_table
"""


def _integers(scale: int) -> str:
    return f"""
kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
           list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)"""


_FLOOR_MEAN = "((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT"


def _op12() -> str:
    """Rounds unrolled: books0, near0, books1, near1, books2, near2."""
    parts, entries, rounds = 16, 64, 2
    ctes = [
        _integers(256),
        f"""
cells AS (
    SELECT r, (i - 1) // (len(v) // {parts}) AS p, (i - 1) % (len(v) // {parts}) AS i, v[i] AS x
    FROM (SELECT r, v, unnest(range(1, len(v) + 1)) AS i FROM kept)
),
books0 AS (SELECT p, r - 1 AS e, i, x FROM cells WHERE r <= {entries})""",
    ]
    for k in range(rounds + 1):
        ctes.append(f"""
near{k} AS (
    SELECT r, p, e, d FROM (
        SELECT r, p, b.e, sum((c.x - b.x) * (c.x - b.x)) AS d FROM cells c JOIN books{k} b USING (p, i) GROUP BY r, p, b.e
    ) QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1
)""")
        if k < rounds:
            ctes.append(f"""
books{k + 1} AS (
    SELECT b.p, b.e, b.i, coalesce(m.x, b.x) AS x FROM books{k} b LEFT JOIN (
        SELECT p, e, i, {_FLOOR_MEAN} AS x FROM near{k} JOIN cells USING (r, p) GROUP BY p, e, i
    ) m USING (p, e, i)
)""")
    ctes.append(f"""
coded AS (
    SELECT r, string_agg(lpad(lower(hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY r
),
digest AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM books{rounds})""")
    return f"""
WITH {",".join(ctes)}
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""


def _op13() -> str:
    centroids, rounds = 16, 3
    ctes = [
        _integers(64),
        f"""
cells AS (SELECT r, i, v[i] AS x FROM (SELECT r, v, unnest(range(1, 65)) AS i FROM kept WHERE len(v) = 64)),
seeds AS (
    SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR)) - 1 AS c FROM kept WHERE len(v) = 64
    QUALIFY c < {centroids}
),
means0 AS (SELECT c, i, x FROM seeds JOIN cells USING (r))""",
    ]
    for k in range(rounds + 1):
        ctes.append(f"""
near{k} AS (
    SELECT r, c, d FROM (
        SELECT r, m.c, sum((a.x - m.x) * (a.x - m.x)) AS d FROM cells a JOIN means{k} m USING (i) GROUP BY r, m.c
    ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
)""")
        if k < rounds:
            ctes.append(f"""
means{k + 1} AS (
    SELECT o.c, o.i, coalesce(n.x, o.x) AS x FROM means{k} o LEFT JOIN (
        SELECT c, i, {_FLOOR_MEAN} AS x FROM near{k} JOIN cells USING (r) GROUP BY c, i
    ) n USING (c, i)
)""")
    ctes.append(f"""
digests AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM means{rounds} GROUP BY c)""")
    return f"""
WITH {",".join(ctes)}
SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM near{rounds} JOIN kept USING (r) JOIN digests USING (c)
"""


OP12, OP13 = _op12(), _op13()


def _reached(nodes: str) -> str:
    """Recursive table reach (u, w): every w that a node reaches by links, itself included."""
    return f"reach(u, w) AS ({nodes} UNION SELECT r.u, l.w FROM reach r JOIN links l ON r.w = l.u)"


OP7 = f"""
WITH RECURSIVE kept AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS MATERIALIZED (
    SELECT a.vec_id AS u, b.vec_id AS w FROM kept a JOIN kept b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95
),
{_reached("SELECT vec_id, vec_id FROM embeddings")},
counts AS (SELECT u, COUNT(*) AS n FROM links GROUP BY u)
SELECT r.u AS vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, MIN(r.w) AS component_id, r.u = MIN(r.w) AS kept
FROM reach r LEFT JOIN counts c ON c.u = r.u GROUP BY r.u
"""

OP10 = f"""
WITH RECURSIVE cut AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM cut
),
grams AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS MATERIALIZED (
    SELECT a.doc_id AS u, b.doc_id AS w FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 80 * (a.n + b.n - COUNT(*))
),
{_reached("SELECT doc_id, doc_id FROM documents")},
least AS (SELECT u, MIN(w) AS component_id FROM reach GROUP BY u)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets JOIN least ON u = doc_id
"""
