"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations


def _shingles(table: str, key: str) -> str:
    return f"""
    SELECT DISTINCT {key}, array_to_string(w[i:i + n - 1], ' ') AS run
    FROM (SELECT {key}, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM (SELECT {key}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS w FROM {table}), lengths)
    """


DECONTAMINATION = f"""
WITH words AS (
    SELECT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS w FROM benchmark
), lengths AS (
    SELECT DISTINCT least(len(w), 5) AS n FROM words WHERE len(w) > 0
), item_runs AS (
    SELECT DISTINCT item_id, n, run FROM (
        SELECT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS run
        FROM (SELECT item_id, w, least(len(w), 5) AS n, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i
              FROM words WHERE len(w) > 0))
), sizes AS (
    SELECT item_id, count(*) AS shingles FROM item_runs GROUP BY item_id
), doc_runs AS (
    {_shingles("documents", "doc_id")}
), shared AS (
    SELECT doc_id, item_id, count(*) AS matched
    FROM doc_runs JOIN item_runs USING (run) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, matched, shingles, matched / shingles AS containment
FROM shared JOIN sizes USING (item_id)
WHERE matched >= 0.8 * shingles
"""

# Base32 of the SHA-1, five bits at a time.
WARC = """
WITH bodies AS (
    SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), firsts AS (
    SELECT body, min(page_id) AS first_id FROM bodies GROUP BY body
), told AS (
    SELECT page_id, body, first_id, first_id IS NOT NULL AND (page_id IS NULL OR page_id > first_id) AS again,
           CAST(CAST(unhex(sha1(body)) AS BIT) AS VARCHAR) AS bits
    FROM bodies JOIN firsts USING (body)
)
SELECT page_id, octet_length(body) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
             + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
             + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to
FROM told
"""

_GRID = """
WITH kept AS (
    SELECT row_number() OVER () AS row, vec_id,
           list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64
), centroids_0 AS (
    SELECT n, x FROM (
        SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, x) - 1 AS n, x FROM kept
    ) WHERE n < 16
)"""


def _assigned(r: int) -> str:
    step = "list_sum(list_transform(list_zip(kept.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    return f"""
assigned_{r} AS (
    SELECT row, vec_id, kept.x, arg_min(c.n, ({step}, c.n)) AS n, min({step}) AS distance
    FROM kept, centroids_{r} c GROUP BY row, vec_id, kept.x
)"""


def _moved(r: int) -> str:
    return f"""
parts_{r} AS (
    SELECT n, i, sum(v) AS s, count(*) AS m
    FROM (SELECT n, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM assigned_{r}) GROUP BY n, i
), means_{r} AS (
    SELECT n, list(CAST((s - ((s % m) + m) % m) // m AS BIGINT) ORDER BY i) AS x FROM parts_{r} GROUP BY n
), centroids_{r + 1} AS (
    SELECT c.n, coalesce(m.x, c.x) AS x FROM centroids_{r} c LEFT JOIN means_{r} m ON c.n = m.n
)"""


CENTROIDS = (
    ",".join([_GRID, *[part(r) for r in range(3) for part in (_assigned, _moved)], _assigned(3)])
    + """
SELECT vec_id, CAST(n AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY n) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM assigned_3 JOIN centroids_3 c USING (n)
"""
)

MIXING = """
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
           CAST('0x' || substr(sha256('13:' || doc_id), 1, 15) AS BIGINT) AS key
    FROM documents
), weighted AS (
    SELECT source, source_size, [5, 2, 1][(number - 1) % 3 + 1] AS weight, number FROM (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number
        FROM sized GROUP BY source)
), totals AS (
    SELECT sum(source_size) AS total FROM weighted
), ordered AS (
    -- A source is stopped if, those of a smaller size for their weight being so, its share is above twice its size.
    SELECT weighted.*, total,
           3 * total - 4 * (sum(source_size) OVER w - source_size) AS rest,
           sum(weight) OVER () - sum(weight) OVER w + weight AS open
    FROM weighted, totals WINDOW w AS (ORDER BY source_size / weight, number ROWS UNBOUNDED PRECEDING)
), marked AS (
    SELECT *, weight * rest > 4 * source_size * open AS stopped FROM ordered
), told AS (
    SELECT *, 3 * total - 4 * coalesce(sum(source_size) FILTER (stopped) OVER (), 0) AS left_words,
           coalesce(sum(weight) FILTER (NOT stopped) OVER (), 0) AS shared
    FROM marked
), targets AS (
    SELECT source, number, source_size,
           CASE WHEN stopped THEN CAST(2 * source_size AS DOUBLE)
                ELSE CAST(weight * left_words AS DOUBLE) / CAST(greatest(2 * shared, 1) AS DOUBLE) END AS target,
           CAST(CASE WHEN stopped THEN 2 * source_size ELSE weight * left_words // greatest(2 * shared, 1) END AS BIGINT) AS quota
    FROM told
), laid AS (
    SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
    FROM sized
), counted AS (
    SELECT number, blocks, sum(blocks) OVER (ORDER BY number ROWS UNBOUNDED PRECEDING) AS upto, sum(blocks) OVER () AS n
    FROM (SELECT number, (quota + 999) // 1000 AS blocks FROM targets) WHERE blocks > 0
), powers AS (
    SELECT n, greatest(1, CAST(ceil(log2(greatest(n, 2))) AS BIGINT)) AS bits FROM (SELECT DISTINCT n FROM counted)
), points AS (
    SELECT slot, n, 2 ** bits AS m,
           list_sum(list_transform(range(bits), lambda b: ((slot >> CAST(b AS BIGINT)) & 1) << CAST(bits - 1 - b AS BIGINT))) AS point
    FROM (SELECT n, bits, unnest(range(CAST(2 ** bits AS BIGINT))) AS slot FROM powers)
), slots AS (
    SELECT number, slot, row_number() OVER (PARTITION BY number ORDER BY slot) - 1 AS rank
    FROM points JOIN counted c ON point * c.n >= (upto - blocks) * m AND point * c.n < upto * m
)
SELECT doc_id, size, source_size, target,
       CAST(greatest(least(start + size, quota) - start, 0)
          + greatest(least(start + source_size + size, quota) - start - source_size, 0) AS BIGINT) AS taken,
       CASE WHEN size > 0 AND start < quota THEN slot END AS first_slot
FROM laid JOIN targets ON laid.source IS NOT DISTINCT FROM targets.source
LEFT JOIN slots ON slots.number = targets.number AND slots.rank = start // 1000
"""

ORACLE_SQL: dict[str, str] = {
    "op4_decontamination": DECONTAMINATION,
    "op6_warc": WARC,
    "op11_centroids": CENTROIDS,
    "op13_mixing": MIXING,
}
