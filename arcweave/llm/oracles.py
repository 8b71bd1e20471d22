"""The queries that SQL can express, as DuckDB SQL over the tables."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from arcweave.llm import centroids

_LOWER = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

# A window is ten words, or all of an item with fewer.
OP3 = f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[place : place + size - 1], ' ') AS run
    FROM (SELECT item_id, words, least(10, len(words)) AS size,
        unnest(range(1, len(words) - least(10, len(words)) + 2)) AS place FROM items WHERE len(words) > 0)),
spots AS (
    SELECT row_no, place, size, array_to_string(words[place : place + size - 1], ' ') AS run
    FROM (SELECT row_no, words, size, unnest(range(1, len(words) - size + 2)) AS place
        FROM docs, (SELECT DISTINCT size FROM windows))),
hits AS (SELECT row_no, place, size, item_id FROM spots JOIN windows USING (size, run)),
covered AS (
    SELECT row_no, count(DISTINCT word) AS n_hit
    FROM (SELECT row_no, unnest(range(place, place + size)) AS word FROM hits) GROUP BY row_no),
found AS (
    SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row_no, item_id::VARCHAR AS item FROM hits) GROUP BY row_no)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (row_no) LEFT JOIN found USING (row_no)"""

OP6 = """
WITH whole AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
bits AS (
    SELECT page_id, strlen(payload) AS payload_bytes, unhex(sha1(payload))::BIT::VARCHAR AS bits,
        min(page_id) OVER (PARTITION BY payload) AS first FROM whole)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + list_sum(list_transform(range(0, 5), lambda b:
            substr(bits, (5 * i + b + 1)::INT, 1)::INT * (16 >> b::INT)))::INT, 1)), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits"""


def _lloyd() -> str:
    """Op 11: every vector against every centroid, round by round."""
    steps = [f"""kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, vec_id,
        list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS p
    FROM embeddings WHERE len(embedding) = {centroids.DIMENSIONS}
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.DIMENSIONS})""",
        f"""c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{centroids.SEED}' || vec_id), p) - 1 AS c, p FROM kept
    ORDER BY c LIMIT {centroids.CENTROIDS})"""]
    for r in range(centroids.ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
    SELECT row_no, min((d, c)) AS best FROM (
        SELECT row_no, c.c, list_sum(list_transform(list_zip(kept.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM kept, c{r} AS c) GROUP BY row_no)""")
        if r < centroids.ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
    SELECT old.c, coalesce(moved.p, old.p) AS p FROM c{r} AS old LEFT JOIN (
        SELECT c, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY i) AS p FROM (
            SELECT c, i, sum(v) AS s, count(*) AS n FROM (
                SELECT best[2] AS c, unnest(p) AS v, generate_subscripts(p, 1) AS i
                FROM kept JOIN a{r} USING (row_no)) GROUP BY c, i) GROUP BY c) AS moved USING (c))""")
    last = centroids.ROUNDS
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, best[2]::INTEGER AS cluster, best[1]::BIGINT AS distance,
    (sum(best[1]) OVER (PARTITION BY best[2]))::BIGINT AS cluster_inertia,
    (sum(best[1]) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{last}.p, ',')) AS centroid_sha256
FROM kept JOIN a{last} USING (row_no) JOIN c{last} ON c{last}.c = best[2]"""


ORACLES = {"op3_decontamination": OP3, "op6_warc": OP6, "op11_centroids": _lloyd()}
