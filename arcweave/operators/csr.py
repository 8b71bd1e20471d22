"""Compressed sparse rows of a graph, as two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arcweave.operators.graph import ranked_arcs
from arcweave.operators.running import exclusive_running
from arcweave.operators.skew import HEAVY_FLOOR


def row_offsets(degrees: DataFrame, densify: bool = False) -> DataFrame:
    """``(vertex_id, row_offset, degree)``: where each vertex's arcs begin.

    ``degrees`` is the vertex table. Ids must not be negative. With ``densify``
    every id from 0 to the largest has a row (ids of gaps repeat the running
    offset) and one last row, at the largest id + 1, holds the total; its size
    follows the largest id.
    """
    degrees = degrees.withColumn(
        "degree",
        F.when(F.col("vertex_id") >= 0, F.col("degree")).otherwise(
            F.raise_error(F.lit("row offsets need ids >= 0")).cast("bigint")
        ),
    )
    if densify:
        top = degrees.agg(F.max("vertex_id")).first()[0]
        ids = degrees.sparkSession.range(0 if top is None else top + 2)
        degrees = (
            ids.withColumnRenamed("id", "vertex_id")
            .join(degrees, "vertex_id", "left")
            .select("vertex_id", F.coalesce("degree", F.lit(0).cast("bigint")).alias("degree"))
        )
    return exclusive_running(
        degrees, order="vertex_id", value="degree", out="row_offset"
    ).select("vertex_id", "row_offset", "degree")


def column_indices(
    arc_table: DataFrame, degrees: DataFrame, heavy_floor: int = HEAVY_FLOOR
) -> DataFrame:
    """``(pos, src, dst)``: all arcs laid out by vertex, then by neighbour.

    ``degrees`` is the vertex table of the same arcs, best a written one: it is
    read for the hubs and for the row offsets.
    """
    ordinary, hub, hubs = ranked_arcs(arc_table, degrees, heavy_floor)
    starts = row_offsets(degrees).select(F.col("vertex_id").alias("src"), "row_offset")

    def place(ranked: DataFrame, offsets: DataFrame) -> DataFrame:
        return ranked.join(offsets, "src").select(
            (F.col("row_offset") + F.col("rank")).alias("pos"), "src", "dst"
        )

    placed = place(ordinary, starts)
    if hub is None:
        return placed
    hub_ids = F.broadcast(hubs.withColumnRenamed("vertex_id", "src"))
    hub_starts = starts.join(hub_ids, "src", "left_semi")
    return placed.unionByName(place(hub, F.broadcast(hub_starts)))
