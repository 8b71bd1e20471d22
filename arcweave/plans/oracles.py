"""The same results in plain SQL, for checking."""

from __future__ import annotations

_EDGES = "SELECT 2 * l_orderkey AS src, 2 * l_partkey + 1 AS dst FROM lineitem"

_CHAIN_EDGES = """
    SELECT previous AS src, event_id AS dst FROM (
        SELECT event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id)
            AS previous
        FROM events)
    WHERE previous IS NOT NULL"""


def _with_arcs(body: str, edges: str = _EDGES, recursive: str = "") -> str:
    """``body`` over the tables edges, arcs and degrees."""
    return f"""
    WITH {recursive} edges AS ({edges}),
    arcs AS (SELECT src, dst FROM edges UNION ALL SELECT dst, src FROM edges),
    degrees AS (SELECT src AS vertex_id, count(*) AS degree FROM arcs GROUP BY src)
    {body}"""


def _with_levels(body: str, root: int, edges: str = _EDGES) -> str:
    """``body`` over reached(v, level) and levels(vertex_id, level)."""
    return _with_arcs(
        f""",
    reached(v, level) USING KEY (v) AS (
        SELECT vertex_id, 0::BIGINT FROM degrees WHERE vertex_id = {root}
        UNION
        SELECT a.dst, (min(r.level) + 1)::BIGINT
        FROM reached r JOIN arcs a ON a.src = r.v
        WHERE NOT EXISTS (SELECT 1 FROM recurring.reached x WHERE x.v = a.dst)
        GROUP BY a.dst),
    levels AS (
        SELECT d.vertex_id, d.degree, coalesce(r.level, -1)::BIGINT AS level
        FROM degrees d LEFT JOIN reached r ON r.v = d.vertex_id)
    {body}""",
        edges,
        recursive="RECURSIVE",
    )


def _summary(root: int) -> str:
    return f"""SELECT count(*)::BIGINT AS vertices, sum(degree)::BIGINT AS edges,
        {root}::BIGINT AS root, count(*) FILTER (level <> -1) AS reached,
        coalesce(max(level), -1)::BIGINT AS max_level
    FROM levels"""


_MATRIX = """
    m AS (SELECT l_orderkey AS row_id, l_partkey AS col_id, l_quantity::BIGINT AS value
          FROM lineitem),
    v AS (SELECT p_partkey AS idx, p_size::BIGINT AS value FROM part)"""

_CELLS = """
    cells AS (
        SELECT vec_id AS row_id, (i - 1)::BIGINT AS col_id,
            floor(embedding[i]::DOUBLE * 1000)::BIGINT AS value
        FROM embeddings, LATERAL (SELECT unnest(range(1, len(embedding) + 1)) AS i))"""

_SPARSE = f"""
    WITH {_MATRIX}
    SELECT m.row_id, sum(m.value * v.value)::BIGINT AS value
    FROM m JOIN v ON m.col_id = v.idx GROUP BY m.row_id"""

_DENSE = f"""
    WITH {_CELLS}
    SELECT c.row_id, sum(c.value * f.value)::BIGINT AS value
    FROM cells c JOIN cells f ON f.row_id = 0 AND f.col_id = c.col_id
    GROUP BY c.row_id"""

_EXPANDED = """
    frontier AS (SELECT DISTINCT dst AS v FROM arcs WHERE src = 2),
    expanded AS (SELECT DISTINCT dst AS vertex_id FROM arcs WHERE src IN (SELECT v FROM frontier))"""

ORACLES: dict[str, str] = {
    "arcs_undirected": _with_arcs("SELECT src, dst FROM arcs"),
    "vertex_set": _with_arcs("SELECT DISTINCT src AS vertex_id FROM arcs"),
    "vertex_degree": _with_arcs("SELECT vertex_id, degree FROM degrees"),
    "graph_stats": _with_arcs(
        """SELECT count(DISTINCT src) AS vertices, count(*) AS edges,
            max(src) AS max_vertex_id FROM arcs"""
    ),
    "vertex_lookup": _with_arcs(
        """SELECT 2 * o_orderkey AS vertex_id, degree
        FROM orders LEFT JOIN degrees ON vertex_id = 2 * o_orderkey"""
    ),
    "vertex_visit": _with_arcs(
        """SELECT vertex_id, (vertex_id % 2)::BIGINT AS is_part,
            (degree * 2)::BIGINT AS double_degree FROM degrees"""
    ),
    "vertex_agg": _with_arcs(
        """SELECT min(degree) AS min_degree, max(degree) AS max_degree,
            count(*) FILTER (degree = 1) AS leaves FROM degrees"""
    ),
    "vertex_owner": _with_arcs(
        """SELECT vertex_id, vertex_id % 4 AS owner, vertex_id // 4 AS slot,
            vertex_id AS rebuilt_id FROM degrees"""
    ),
    "adjacency_list": _with_arcs(
        """SELECT src AS vertex_id, block_no,
            array_to_string(list_sort(list(dst)), ',') AS neighbors
        FROM (SELECT src, dst, ((row_number() OVER (
            PARTITION BY src ORDER BY dst) - 1) // 1048576)::BIGINT AS block_no FROM arcs)
        GROUP BY src, block_no"""
    ),
    "csr_row_offsets": _with_arcs(
        """SELECT vertex_id, degree, coalesce(sum(degree) OVER (ORDER BY vertex_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS row_offset
        FROM degrees"""
    ),
    "csr_row_offsets_dense": _with_arcs(
        """, ids AS (
            SELECT unnest(range(0, (SELECT max(vertex_id) + 2 FROM degrees))) AS vertex_id),
        filled AS (
            SELECT i.vertex_id, coalesce(d.degree, 0)::BIGINT AS degree
            FROM ids i LEFT JOIN degrees d ON d.vertex_id = i.vertex_id)
        SELECT vertex_id, degree, coalesce(sum(degree) OVER (ORDER BY vertex_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS row_offset
        FROM filled"""
    ),
    "csr_column_indices": _with_arcs(
        "SELECT row_number() OVER (ORDER BY src, dst) - 1 AS pos, src, dst FROM arcs"
    ),
    "bfs_summary": _with_levels(_summary(2), 2),
    "bfs_report": _with_levels(
        f"""SELECT format('Graph vertices: {{}} with total edges {{}}.  '
            || 'Reached vertices from {{}} is {{}} and max level is {{}}',
            vertices, edges, root, reached, max_level) AS line
        FROM ({_summary(2)})""",
        2,
    ),
    "bfs_levels": _with_levels("SELECT vertex_id, level FROM levels", 2),
    "bfs_level_sizes": _with_levels(
        "SELECT level, count(*) AS vertices FROM reached GROUP BY level", 2
    ),
    "bfs_level_slice": _with_levels(
        "SELECT v AS vertex_id, level FROM reached WHERE level = 2", 2
    ),
    "bfs_absent_root": _with_levels(_summary(-5), -5),
    "bfs_levels_deep": _with_levels("SELECT vertex_id, level FROM levels", 0, _CHAIN_EDGES),
    "bfs_crosscheck": _with_levels(
        """SELECT vertices, 0::BIGINT AS mismatches, reached, reached AS other_reached,
            max_level, max_level AS other_max_level
        FROM (%s)""" % _summary(2),
        2,
    ),
    "bfs_init_state": _with_arcs(
        "SELECT DISTINCT src AS vertex_id, (-1)::BIGINT AS level FROM arcs"
    ),
    "bfs_expand_once": _with_arcs(f", {_EXPANDED} SELECT vertex_id FROM expanded"),
    "bfs_unvisited": _with_arcs(
        f""", {_EXPANDED} SELECT vertex_id FROM expanded
        WHERE vertex_id <> 2 AND vertex_id NOT IN (SELECT v FROM frontier)"""
    ),
    "frontier_merge": _with_arcs(
        """SELECT dst AS vertex_id, max(CASE WHEN src = 2 THEN 1 ELSE 0 END)::BIGINT AS flag
        FROM arcs GROUP BY dst"""
    ),
    "matvec_sparse": _SPARSE,
    "matvec_all_rows": f"""
    WITH {_MATRIX}
    SELECT m.row_id, sum(CASE WHEN v.value > 45 THEN m.value * v.value ELSE 0 END)::BIGINT
        AS value
    FROM m LEFT JOIN v ON m.col_id = v.idx GROUP BY m.row_id""",
    "matvec_broadcast": _SPARSE,
    "matvec_products": f"""
    WITH {_MATRIX}
    SELECT m.row_id, m.col_id, (m.value * v.value)::BIGINT AS product
    FROM m JOIN v ON m.col_id = v.idx""",
    "matvec_sorted": f"{_SPARSE} ORDER BY m.row_id",
    "matvec_dense": _DENSE,
    "matvec_wide": _DENSE,
    "matrix_to_coo": f"WITH {_CELLS} SELECT row_id, col_id, value FROM cells",
    "matrix_transpose": f"""
    WITH {_CELLS} SELECT col_id AS row_id, row_id AS col_id, value FROM cells""",
    "matrix_column_blocks": f"""
    WITH {_CELLS}
    SELECT col_id AS row_id, row_id // 128 AS block_no,
        string_agg(value::VARCHAR, chr(9) ORDER BY row_id) AS line
    FROM cells GROUP BY ALL""",
    "matrix_render": f"""
    WITH {_CELLS}
    SELECT row_id, string_agg(value::VARCHAR, chr(9) ORDER BY col_id) AS line
    FROM cells GROUP BY row_id""",
    "row_chunks": """
    SELECT vec_id AS row_id,
        vec_id // (SELECT ceil(count(*) / 4)::BIGINT FROM embeddings) AS chunk
    FROM embeddings""",
    "row_round_robin": "SELECT vec_id AS row_id, vec_id % 4 AS worker FROM embeddings",
    "edge_file_roundtrip": _EDGES,
    "edge_tsv_roundtrip": _EDGES,
    "matrix_dims": """
    SELECT count(*) AS n_rows, max(len(embedding))::BIGINT AS n_cols FROM embeddings""",
    "matvec_text_roundtrip": _DENSE,
    "event_span_parts": """
    WITH spans AS (
        SELECT user_id, max(epoch_us(ts)) - min(epoch_us(ts)) AS us FROM events GROUP BY user_id)
    SELECT user_id, us, us // 86400000000 AS days, us // 3600000000 % 24 AS hours,
        us // 60000000 % 60 AS minutes, us // 1000000 % 60 AS seconds
    FROM spans""",
}
