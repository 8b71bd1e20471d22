"""One query per operator, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from arcweave.functions.durations import duration_parts, micros_between
from arcweave.operators import bfs, csr, graph, matrix, placement
from arcweave.plans import views
from arcweave.scratch import Scratch
from arcweave.sources import edges_binary, edges_text, matrix_text

Query = Callable[[SparkSession, str], DataFrame]

# Start vertices and worker count used throughout; ORACLES repeats them.
ROOT = 2
ABSENT_ROOT = -5
DEEP_ROOT = 0
WORKERS = 4


def _arcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.arcs(views.order_part_edges(spark, sf_dir))


def _degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.vertex_degree(_arcs(spark, sf_dir))


def _written_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vertex table on disk, for queries that read it more than once."""
    return Scratch(spark).save(_degrees(spark, sf_dir), "vertices")


def _search(spark: SparkSession, sf_dir: str, root: int = ROOT) -> bfs.Search:
    edges = views.order_part_edges(spark, sf_dir)
    return bfs.search(bfs.build_graph(edges, Scratch(spark)), root)


def _root_frontier(arcs: DataFrame) -> DataFrame:
    """The neighbours of the root."""
    return (
        arcs.where(F.col("src") == ROOT).select(F.col("dst").alias("vertex_id")).distinct()
    )


# Graph tables


def arcs_undirected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arcs(spark, sf_dir)


def vertex_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.vertex_set(_arcs(spark, sf_dir))


def vertex_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _degrees(spark, sf_dir)


def graph_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.graph_stats(_degrees(spark, sf_dir))


def vertex_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order looked up as a vertex; those without lines are absent."""
    orders = views.table(spark, sf_dir, "orders")
    probes = orders.select((F.col("o_orderkey") * 2).alias("vertex_id"))
    vertices = graph.bucketed_vertices(_degrees(spark, sf_dir), Scratch(spark))
    return graph.lookup(vertices, probes)


def vertex_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.visit(
        _degrees(spark, sf_dir),
        F.col("vertex_id"),
        (F.col("vertex_id") % 2 == 1).cast("bigint").alias("is_part"),
        (F.col("degree") * 2).alias("double_degree"),
    )


def vertex_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.fold(
        _degrees(spark, sf_dir),
        F.min("degree").alias("min_degree"),
        F.max("degree").alias("max_degree"),
        F.count_if(F.col("degree") == 1).alias("leaves"),
    )


def vertex_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    owner = placement.owner("vertex_id", WORKERS)
    slot = placement.slot("vertex_id", WORKERS)
    return graph.visit(
        _degrees(spark, sf_dir),
        F.col("vertex_id"),
        owner.alias("owner"),
        slot.alias("slot"),
        placement.vertex_at(slot, owner, WORKERS).alias("rebuilt_id"),
    )


def adjacency_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = graph.adjacency(_arcs(spark, sf_dir))
    return lists.select("vertex_id", "block_no", F.array_join("neighbors", ",").alias("neighbors"))


def csr_row_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csr.row_offsets(_degrees(spark, sf_dir))


def csr_row_offsets_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csr.row_offsets(_written_degrees(spark, sf_dir), densify=True)


def csr_column_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csr.column_indices(_arcs(spark, sf_dir), _written_degrees(spark, sf_dir))


# Breadth-first search


def bfs_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir).summary()


def bfs_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir).report()


def bfs_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir).levels()


def bfs_level_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir).level_sizes()


def bfs_level_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir).level_slice(2)


def bfs_absent_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, ABSENT_ROOT).summary()


def bfs_levels_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    edges = views.event_chain_edges(spark, sf_dir, scratch)
    return bfs.search(bfs.build_graph(edges, scratch), DEEP_ROOT).levels()


def bfs_crosscheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _search(spark, sf_dir)
    return bfs.compare_levels(found.levels(), bfs.search_by_scan(found.graph, ROOT))


def bfs_init_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bfs.initial_state(graph.vertex_set(_arcs(spark, sf_dir)))


def bfs_expand_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    arcs = _arcs(spark, sf_dir)
    return bfs.expand_once(arcs, _root_frontier(arcs))


def bfs_unvisited(spark: SparkSession, sf_dir: str) -> DataFrame:
    arcs = _arcs(spark, sf_dir)
    frontier = _root_frontier(arcs)
    seen = frontier.union(arcs.where(F.col("src") == ROOT).select("src").distinct())
    return bfs.unvisited(bfs.expand_once(arcs, frontier), seen)


def frontier_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every worker marks all its far ends 0, or 1 if it has the root as near end."""
    flags = _arcs(spark, sf_dir).select(
        F.col("dst").alias("vertex_id"),
        (F.col("src") == ROOT).cast("bigint").alias("flag"),
    )
    return bfs.merge_frontiers(flags)


# Matrix and vector


def matvec_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.matvec(views.line_matrix(spark, sf_dir), views.part_sizes(spark, sf_dir))


def matvec_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only large parts are in the vector; other rows come out as 0."""
    large = views.part_sizes(spark, sf_dir).where("value > 45")
    return matrix.matvec(views.line_matrix(spark, sf_dir), large, all_rows=True)


def matvec_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.matvec_broadcast(
        views.line_matrix(spark, sf_dir), views.part_sizes(spark, sf_dir)
    )


def matvec_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.products(views.line_matrix(spark, sf_dir), views.part_sizes(spark, sf_dir))


def matvec_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.in_row_order(matvec_sparse(spark, sf_dir))


def matvec_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.matvec_dense(
        views.embedding_rows(spark, sf_dir), views.first_embedding(spark, sf_dir)
    )


def matvec_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense product in blocks of 16 columns, 32 columns of the vector at a time."""
    rows, cells = views.embedding_rows(spark, sf_dir), views.first_embedding_cells(spark, sf_dir)
    return matrix.matvec_wide(rows, cells, width=16, pass_width=32, scratch=Scratch(spark))


def matrix_to_coo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.to_coo(views.embedding_rows(spark, sf_dir))


def matrix_transpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.transpose(matrix_to_coo(spark, sf_dir))


def matrix_column_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transposed matrix in arrays of up to 128 entries."""
    blocks = matrix.row_blocks(matrix_transpose(spark, sf_dir), width=128)
    return blocks.select("row_id", "block_no", matrix.render("values").alias("line"))


def matrix_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.embedding_rows(spark, sf_dir)
    return rows.select("row_id", matrix.render("values").alias("line"))


def row_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.embedding_rows(spark, sf_dir).select("row_id")
    return rows.select("row_id", placement.chunk("row_id", rows.count(), WORKERS).alias("chunk"))


def row_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.embedding_rows(spark, sf_dir)
    return rows.select("row_id", placement.round_robin("row_id", WORKERS).alias("worker"))


# Files


def edge_file_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark).folder("edges")
    edges_binary.write_edges(views.order_part_edges(spark, sf_dir), path)
    return edges_binary.read_edges(spark, path)


def edge_tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark).folder("edges")
    edges_text.write_edges_tsv(views.order_part_edges(spark, sf_dir), path)
    return edges_text.read_edges_tsv(spark, path)


def _written_text(spark: SparkSession, sf_dir: str, scratch: Scratch) -> str:
    path = scratch.folder("text")
    matrix_text.write_matrix_text(
        views.embedding_rows(spark, sf_dir), views.first_embedding_cells(spark, sf_dir), path
    )
    return path


def matrix_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix_text.read_dims(spark, _written_text(spark, sf_dir, Scratch(spark)))


def matvec_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrix text in, product computed, vector text out and read again."""
    scratch = Scratch(spark)
    text = matrix_text.read_matrix_text(spark, _written_text(spark, sf_dir, scratch), scratch)
    product = matrix.matvec_dense(text.rows, matrix.vector_array(text.vector, text.n_cols))
    path = scratch.folder("output")
    matrix_text.write_vector_text(product, path, text.n_rows)
    return matrix_text.read_vector_text(spark, path, scratch)


# Durations


def event_span_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = (
        views.table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(micros_between(F.min("ts"), F.max("ts")).alias("us"))
    )
    return spans.select("user_id", "us", *duration_parts(F.col("us")))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        arcs_undirected,
        vertex_set,
        vertex_degree,
        graph_stats,
        vertex_lookup,
        vertex_visit,
        vertex_agg,
        vertex_owner,
        adjacency_list,
        csr_row_offsets,
        csr_row_offsets_dense,
        csr_column_indices,
        bfs_summary,
        bfs_report,
        bfs_levels,
        bfs_level_sizes,
        bfs_level_slice,
        bfs_absent_root,
        bfs_levels_deep,
        bfs_crosscheck,
        bfs_init_state,
        bfs_expand_once,
        bfs_unvisited,
        frontier_merge,
        matvec_sparse,
        matvec_all_rows,
        matvec_broadcast,
        matvec_products,
        matvec_sorted,
        matvec_dense,
        matvec_wide,
        matrix_to_coo,
        matrix_transpose,
        matrix_column_blocks,
        matrix_render,
        row_chunks,
        row_round_robin,
        edge_file_roundtrip,
        edge_tsv_roundtrip,
        matrix_dims,
        matvec_text_roundtrip,
        event_span_parts,
    )
}
