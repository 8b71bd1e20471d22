"""Undirected graphs as tables: edges, arcs, vertices, degrees, adjacency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from arcweave.operators.running import exclusive_running
from arcweave.operators.skew import (
    BROADCAST_ROWS,
    HEAVY_FLOOR,
    heavy_keys,
    join_unique,
    key_table,
    sampled_heavy_keys,
)
from arcweave.scratch import Scratch

# Neighbours per adjacency row; a vertex with more gets several rows.
ADJACENCY_BLOCK = 1 << 20

# Probe ids of a look-up that become literals of the scan.
LITERAL_PROBES = 256

# Copies of one arc emitted per row while expanding multi-edges.
COPIES_PER_PIECE = 1 << 18


def as_edges(df: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Any two integer columns as an edge table ``(src, dst)``; a missing end raises."""

    def end(name: str) -> Column:
        problem = F.raise_error(F.lit("an edge has no id at one end")).cast("bigint")
        return F.coalesce(F.col(name).cast("bigint"), problem)

    return df.select(end(src).alias("src"), end(dst).alias("dst"))


def reverse(edges: DataFrame) -> DataFrame:
    """Every edge turned round."""
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def arcs(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, duplicates and self-loops kept.

    The same rows as a union of ``edges`` and ``reverse(edges)``, but emitted
    side by side from a single pass over the input.
    """
    return edges.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")),
                F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
            )
        )
    )


def vertex_set(arc_table: DataFrame) -> DataFrame:
    """Ids that occur in some edge."""
    return arc_table.select(F.col("src").alias("vertex_id")).distinct()


def vertex_degree(arc_table: DataFrame) -> DataFrame:
    """Arcs leaving each vertex; a self-loop counts twice, copies count each."""
    return arc_table.groupBy(F.col("src").alias("vertex_id")).agg(
        F.count("*").alias("degree")
    )


def graph_stats(vertices: DataFrame) -> DataFrame:
    """One row: vertices, edges (both directions) and the largest id."""
    return vertices.agg(
        F.count("*").alias("vertices"),
        F.coalesce(F.sum("degree"), F.lit(0).cast("bigint")).alias("edges"),
        F.max("vertex_id").alias("max_vertex_id"),
    )


def bucketed_vertices(degrees: DataFrame, scratch: Scratch, buckets: int | None = None) -> DataFrame:
    """The vertex table written in hash buckets of the id, for any number of look-ups."""
    spark = degrees.sparkSession
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    buckets = min(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), most)
    laid_out = degrees.repartition(buckets, "vertex_id")
    return scratch.save(laid_out, "vertices", bucket_by="vertex_id", buckets=buckets)


def lookup(
    vertices: DataFrame,
    probes: DataFrame,
    literal: int = LITERAL_PROBES,
    broadcast_rows: int = BROADCAST_ROWS,
    heavy_floor: int = HEAVY_FLOOR,
) -> DataFrame:
    """Find vertices by id: each probe id with its degree, null if absent.

    The distinct probe ids are counted at once and reduce the vertices before
    anything else: a handful are literals, which prune buckets, row groups and
    pages of the scan; up to ``broadcast_rows`` are broadcast and filter it. What
    is found then is at most as much and goes to the probes. The vertices are
    not shuffled either way. More probes are shuffled on the id; a table from
    ``bucketed_vertices`` still stays where it is.
    """
    wanted = probes.select("vertex_id").where("vertex_id is not null").distinct()
    few = wanted.limit(literal + 1).collect()
    if len(few) <= literal:
        found = vertices.where(F.col("vertex_id").isin([r.vertex_id for r in few]))
        return probes.join(F.broadcast(found), "vertex_id", "left")
    if wanted.limit(broadcast_rows + 1).count() <= broadcast_rows:
        found = vertices.join(F.broadcast(wanted), "vertex_id", "left_semi")
        return probes.join(F.broadcast(found), "vertex_id", "left")
    return join_unique(probes, vertices, "vertex_id", "left", heavy_floor, broadcast_rows)


def visit(vertices: DataFrame, *exprs: Column) -> DataFrame:
    """Apply column expressions to every vertex."""
    return vertices.select(*exprs)


def fold(vertices: DataFrame, *aggregates: Column) -> DataFrame:
    """Aggregate over all vertices."""
    return vertices.agg(*aggregates)


def ranked_arcs(
    arc_table: DataFrame, degrees: DataFrame, heavy_floor: int = HEAVY_FLOOR
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Number the arcs of each vertex 0, 1, 2, ... by ascending ``dst``.

    ``degrees`` is the vertex table of the same arcs; its maximum is read at
    once. Returns ``(ordinary, hub, hubs)``. Ordinary vertices are ranked by a
    window per vertex. Hubs, whose arcs would not fit in one task, are first reduced
    to counted ``(src, dst)`` pairs, ranked by blocked running totals, and
    expanded again in bounded pieces. Without hubs the last two are None.
    """
    hubs = heavy_keys(degrees, "vertex_id", "degree", heavy_floor)
    by_dst = Window.partitionBy("src").orderBy("dst")
    rank = (F.row_number().over(by_dst) - 1).cast("bigint").alias("rank")
    if hubs is None:
        return arc_table.select("src", "dst", rank), None, None

    hub_side = F.broadcast(hubs.withColumnRenamed("vertex_id", "src"))
    ordinary = arc_table.join(hub_side, "src", "left_anti").select("src", "dst", rank)
    return ordinary, _ranked_hub_arcs(arc_table.join(hub_side, "src", "left_semi")), hubs


def _ranked_hub_arcs(arc_table: DataFrame) -> DataFrame:
    """The arcs of hubs with their ranks, without a group as large as a hub."""
    pairs = arc_table.groupBy("src", "dst").agg(F.count("*").alias("copies"))
    first = exclusive_running(pairs, order="dst", value="copies", out="first", by=["src"])
    step = F.lit(COPIES_PER_PIECE).cast("bigint")
    zero = F.lit(0).cast("bigint")
    return (
        first.withColumn("piece", F.explode(F.sequence(zero, F.col("copies") - 1, step)))
        .repartition("src", "dst", "piece")
        .withColumn("last", F.least(F.col("piece") + step, F.col("copies")) - 1)
        .withColumn("copy", F.explode(F.sequence(F.col("piece"), F.col("last"))))
        .select("src", "dst", (F.col("first") + F.col("copy")).alias("rank"))
    )


def adjacency(
    arc_table: DataFrame,
    block: int = ADJACENCY_BLOCK,
    heavy_floor: int = HEAVY_FLOOR,
) -> DataFrame:
    """Sorted neighbour lists ``(vertex_id, block_no, neighbors)``.

    A vertex with up to ``block`` neighbours has the single row ``block_no`` 0;
    a larger one continues in blocks 1, 2, ... so that no array outgrows a row.
    Hubs are found in a sample at once; only their arcs are ranked. All others
    take one shuffle, are gathered by vertex, and cut where they are longer than
    ``block``, so the sample decides how a list is made, not what is in it.
    """
    found, _ = sampled_heavy_keys(arc_table, "src", heavy_floor)
    ordinary = arc_table
    if found:
        hubs = F.broadcast(key_table(arc_table.sparkSession, "src", found))
        ordinary = arc_table.join(hubs, "src", "left_anti")
    whole = ordinary.groupBy(F.col("src").alias("vertex_id")).agg(F.array_sort(F.collect_list("dst")).alias("whole"))
    last = F.expr(f"(size(whole) - 1) div {block}")
    cut = F.transform(F.sequence(F.lit(0).cast("bigint"), last), lambda b: F.slice("whole", (b * block + 1).cast("int"), block))
    lists = whole.select("vertex_id", F.posexplode(cut).alias("block_no", "neighbors")).select(
        "vertex_id", F.col("block_no").cast("bigint").alias("block_no"), "neighbors"
    )
    if not found:
        return lists
    ranked = _ranked_hub_arcs(arc_table.join(hubs, "src", "left_semi"))
    of_hubs = (
        ranked.withColumn("block_no", F.expr(f"rank div {block}"))
        .groupBy(F.col("src").alias("vertex_id"), "block_no")
        .agg(F.array_sort(F.collect_list("dst")).alias("neighbors"))
    )
    return lists.unionByName(of_hubs)
