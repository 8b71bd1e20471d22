"""How rows and vertices are spread over workers, as columns and as layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _whole(dividend: Column, divisor: Column | int) -> Column:
    if isinstance(divisor, int):
        divisor = F.lit(divisor)
    return F.call_function("div", dividend, divisor.cast("bigint"))


def owner(vertex_id: Column | str, workers: int) -> Column:
    """Worker a vertex belongs to: id modulo the number of workers."""
    return F.pmod(_column(vertex_id), F.lit(workers).cast("bigint"))


def slot(vertex_id: Column | str, workers: int) -> Column:
    """Position of a vertex at its worker: id divided by their number."""
    return _whole(_column(vertex_id) - owner(vertex_id, workers), workers)


def vertex_at(slot_no: Column | str, owner_no: Column | str, workers: int) -> Column:
    """The vertex id at a worker's slot: the inverse of ``owner`` and ``slot``."""
    return _column(slot_no) * F.lit(workers).cast("bigint") + _column(owner_no)


def chunk(row_id: Column | str, n_rows: int, workers: int) -> Column:
    """Contiguous chunk of a row when ``n_rows`` are cut into equal runs.

    No more chunks than rows are used; the last may be shorter.
    """
    used = max(1, min(workers, n_rows))
    return _whole(_column(row_id), max(1, -(-n_rows // used)))


def round_robin(row_id: Column | str, workers: int) -> Column:
    """Worker of a row when rows are dealt out in turn."""
    return F.pmod(_column(row_id), F.lit(workers).cast("bigint"))


def in_chunks(rows: DataFrame, workers: int) -> DataFrame:
    """Rows laid out in contiguous partitions by row."""
    return rows.repartitionByRange(workers, "row_id")


def dealt(rows: DataFrame, workers: int) -> DataFrame:
    """Rows laid out evenly over partitions, in no particular order."""
    return rows.repartition(workers)


def by_vertex(arc_table: DataFrame, workers: int) -> DataFrame:
    """Arcs laid out so that all arcs of a vertex share a partition.

    Only for graphs without hubs; ``bfs.build_graph`` treats those apart.
    """
    return arc_table.repartition(workers, "src")
