"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from tillmart.llm.secret_index import BASE, MORE

OP7 = r"""
WITH texts AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body
    FROM documents
)
SELECT
    doc_id,
    first_value(doc_id) OVER best AS keep_id,
    count(*) OVER (PARTITION BY body) AS group_size,
    doc_id IS NOT DISTINCT FROM first_value(doc_id) OVER best AS kept,
    sha256(body) AS text_sha256
FROM texts
WINDOW best AS (PARTITION BY body ORDER BY n_chars DESC, doc_id NULLS LAST)
"""

OP3 = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT source, source_size, 3.0::DOUBLE * source_size AS cap,
        ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
    FROM totals
),
levels AS (
    SELECT *,
        (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
),
sources AS (
    SELECT source, source_size,
        least(cap, weight * coalesce(max(level) FILTER (WHERE level <= cap / weight) OVER (), cap / weight)) AS target
    FROM levels
),
blocked AS (
    SELECT *, greatest(1, round(source_size / 64.0::DOUBLE))::BIGINT AS blocks FROM sources WHERE source_size > 0
),
due AS (SELECT *, target * blocks / source_size AS due FROM blocked),
ends AS (
    SELECT *, ceil(sum(due) OVER ())::BIGINT AS slots,
        round(sum(due) OVER (ORDER BY source NULLS LAST) / sum(due) OVER () * 2147483648)::BIGINT AS high
    FROM due
),
plan AS (SELECT *, coalesce(lag(high) OVER (ORDER BY source NULLS LAST), 0) AS low FROM ends),
points AS (
    SELECT i AS slot, (i % 2147483648 * 1327217885) % 2147483648 AS point
    FROM range((SELECT coalesce(max(slots), 0) FROM plan)) AS t(i)
),
ranked AS (
    SELECT source, blocks, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank
    FROM points JOIN plan ON point >= low AND point < high
),
drawn AS (SELECT source, rank % blocks AS block, count(*) AS times FROM ranked WHERE rank < 3 * blocks GROUP BY 1, 2),
placed AS (
    SELECT *, row_number() OVER () AS row, sum(size) OVER (
        PARTITION BY source ORDER BY md5('42:' || coalesce(doc_id::VARCHAR, '')), size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
    ) - size AS start
    FROM sized
),
met AS (
    SELECT p.*, s.source_size, s.blocks,
        unnest(range(((start * blocks) // source_size)::BIGINT, least(blocks, ((start + size) * blocks) // source_size + 1)::BIGINT)) AS block
    FROM placed p JOIN plan s ON p.source IS NOT DISTINCT FROM s.source
    WHERE size > 0
),
taken AS (
    SELECT row, sum(times * (least(start + size, ((m.block + 1) * source_size) // blocks) - greatest(start, (m.block * source_size) // blocks))) AS taken
    FROM met m JOIN drawn d ON m.source IS NOT DISTINCT FROM d.source AND m.block = d.block
    WHERE least(start + size, ((m.block + 1) * source_size) // blocks) > greatest(start, (m.block * source_size) // blocks)
    GROUP BY row
)
SELECT p.doc_id, p.size, s.source_size, s.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM placed p
JOIN sources s ON p.source IS NOT DISTINCT FROM s.source
LEFT JOIN taken t ON p.row = t.row
"""



def _matches(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
    SELECT row, {number} AS number, '{kind}' AS kind, {least} AS least, regexp_split_to_array(text, '{pattern}') AS parts,
        regexp_extract_all(text, '{pattern}', 0) AS wholes, regexp_extract_all(text, '{pattern}', {group}) AS owns
    FROM docs WHERE regexp_matches(text, '{pattern}')"""


OP10 = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({" UNION ALL ".join(_matches(n, *rule) for n, rule in enumerate(BASE + MORE))}),
each AS (SELECT *, unnest(range(1, len(wholes) + 1)) AS i FROM matches),
spans AS (
    SELECT row, number, kind, length(array_to_string(parts[1:i], '')) + coalesce(length(array_to_string(wholes[1:i - 1], '')), 0) AS start,
        length(wholes[i]) AS size
    FROM each WHERE length(owns[i]) >= least
),
told AS (
    SELECT row, count(*) FILTER (WHERE number = 0) AS n_assign, count(*) FILTER (WHERE number = 1) AS n_access, count(*) FILTER (WHERE number = 2) AS n_hex,
        string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, number) FILTER (WHERE number < {len(BASE)}) AS base,
        string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, number) AS spans
    FROM spans GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN told ON docs.row = told.row
"""

OP12 = """
WITH records AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
placed AS (SELECT *, first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS first FROM records)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM placed
"""


def _round(turn: int) -> str:
    """Every part's nearest entry of the codebooks ``turn``, and the codebooks after it."""
    return f"""
near{turn} AS MATERIALIZED (
    SELECT row, p, arg_min(e, (apart, e)) AS e, min(apart) AS apart FROM (
        SELECT x.row, x.p, c.e, (x.norm - 2 * list_inner_product(x.part, c.part) + list_inner_product(c.part, c.part))::BIGINT AS apart
        FROM parts x JOIN book{turn} c ON x.p = c.p
    ) GROUP BY row, p
),
sums{turn} AS (
    SELECT p, e, place, count(*) AS n, sum(value::HUGEINT) AS total FROM (
        SELECT x.p, near.e, unnest(x.part) AS value, unnest(range(len(x.part))) AS place
        FROM parts x JOIN near{turn} near ON x.row = near.row AND x.p = near.p
    ) GROUP BY p, e, place
),
book{turn + 1} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.part, b.part) AS part FROM book{turn} b LEFT JOIN (
        SELECT p, e, list(((total - ((total % n) + n) % n) // n)::DOUBLE ORDER BY place) AS part FROM sums{turn} GROUP BY p, e
    ) m ON b.p = m.p AND b.e = m.e
)"""


# The distances are sums of products of whole numbers far below 2^53, so doubles hold them exactly.
OP13 = f"""
WITH usable AS (
    SELECT row_number() OVER () AS row, vec_id, label, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS whole FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
parts AS MATERIALIZED (
    SELECT *, list_inner_product(part, part) AS norm FROM (
        SELECT row, p, whole[p * (len(whole) // 4) + 1:(p + 1) * (len(whole) // 4)] AS part FROM usable, range(4) AS t(p)
    )
),
first AS (SELECT row, row_number() OVER (ORDER BY vec_id NULLS LAST, whole) - 1 AS e FROM usable QUALIFY e < 256),
book0 AS MATERIALIZED (SELECT p, e, part FROM parts JOIN first ON parts.row = first.row),
{",".join(_round(turn) for turn in range(5))},
coded AS (SELECT row, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, sum(apart)::BIGINT AS error FROM near4 GROUP BY row),
books AS (
    SELECT sha256(string_agg(component, ',' ORDER BY p, e, place)) AS codebooks_sha256
    FROM (SELECT p, e, unnest(part)::BIGINT::VARCHAR AS component, unnest(range(len(part))) AS place FROM book4)
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM usable JOIN coded ON usable.row = coded.row, books
"""

ORACLES: dict[str, str] = {"op3_source_mix": OP3, "op7_exact_dedup": OP7, "op10_secrets": OP10, "op12_arc_convert": OP12, "op13_vector_codes": OP13}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
