"""Breadth-first levels of an undirected graph.

The graph is written once as tables laid out for repeated neighbour look-ups
(``build_graph``); a search then runs one query per level on the driver's
command and never moves the arcs again.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from arcweave.operators.graph import arcs
from arcweave.operators.skew import HEAVY_FLOOR, join_unique, key_table, sampled_heavy_keys
from arcweave.scratch import Scratch

# Level of a vertex that cannot be reached.
UNREACHED = -1

# Layout: about this many arcs per bucket, as far as Spark's own limit on buckets
# allows. Smaller graphs get a bucket per core of at least the second number.
ARCS_PER_BUCKET = 1 << 22
MIN_ARCS_PER_BUCKET = 1 << 17

# A frontier of up to this many ids is looked up by literal ids, which prunes
# buckets and Parquet pages; its successors come back to the driver.
NARROW = 256

# A frontier of up to this many ids touches so few buckets that its neighbours
# are fetched as they are, in one stage.
HANDFUL = 4

# A frontier of up to this many rows (8 bytes each) is broadcast.
BROADCAST_ROWS = 500_000

# Frontier rows per bucket up to which a hash table per bucket is safe.
HASH_BUILD_ROWS = 4_000_000

# Narrow levels kept on the driver before they are written out.
PENDING_ROWS = 1 << 16

_LEVELS = "vertex_id bigint, level bigint"


@dataclass(frozen=True)
class Graph:
    """Tables of one undirected graph.

    ``arcs(src, dst, copies)`` holds the distinct arcs of ordinary vertices in
    hash buckets of ``src``. ``hub_arcs`` holds those of hubs (too many arcs
    for one bucket), spread evenly and range-sorted; None without hubs.
    ``vertices(vertex_id, degree)`` counts every copy.
    """

    spark: SparkSession
    scratch: Scratch
    vertices: DataFrame
    arcs: DataFrame
    buckets: int
    hub_arcs: DataFrame | None
    hub_ids: frozenset[int]


def build_graph(
    edges: DataFrame,
    scratch: Scratch,
    heavy_floor: int = HEAVY_FLOOR,
) -> Graph:
    """Write the arc layout and the vertex table of an edge table ``(src, dst)``.

    A sampling pass finds the hubs; then all other arcs take one shuffle, into
    their buckets, where copies are counted. Degrees follow from the buckets
    without another shuffle.
    """
    spark = edges.sparkSession
    all_arcs = arcs(edges)
    hub_ids, total = sampled_heavy_keys(all_arcs, "src", heavy_floor)
    copies = F.count("*").alias("copies")

    ordinary, hub_arcs = all_arcs, None
    if hub_ids:
        hubs = F.broadcast(key_table(spark, "src", hub_ids))
        ordinary = all_arcs.join(hubs, "src", "left_anti")
        hub_arcs = scratch.save(
            all_arcs.join(hubs, "src", "left_semi")
            .groupBy("src", "dst")
            .agg(copies)
            .repartitionByRange("src", "dst")
            .sortWithinPartitions("src", "dst"),
            "hub_arcs",
        )

    cores = spark.sparkContext.defaultParallelism
    buckets = max(total // ARCS_PER_BUCKET, min(cores, total // MIN_ARCS_PER_BUCKET))
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    buckets = min(max(buckets, 1), most)
    layout = scratch.save(
        ordinary.repartition(buckets, "src").groupBy("src", "dst").agg(copies),
        "arcs",
        bucket_by="src",
        buckets=buckets,
    )

    def degrees(table: DataFrame) -> DataFrame:
        return table.groupBy(F.col("src").alias("vertex_id")).agg(
            F.sum("copies").alias("degree")
        )

    vertices = degrees(layout)
    if hub_arcs is not None:
        vertices = vertices.unionByName(degrees(hub_arcs))
    vertices = scratch.save(vertices, "vertices", bucket_by="vertex_id", buckets=buckets)
    return Graph(spark, scratch, vertices, layout, buckets, hub_arcs, hub_ids)


def has_vertex(graph: Graph, vertex_id: int) -> bool:
    """Whether the vertex exists; looks into one bucket at most."""
    if vertex_id in graph.hub_ids:
        return True
    return bool(graph.arcs.where(F.col("src") == vertex_id).select("src").take(1))


@dataclass(frozen=True)
class Frontier:
    """Vertices of one level: literal ids if few, else a table of known size."""

    rows: int
    ids: tuple[int, ...] | None = None
    table: DataFrame | None = None


def frontier_of(table: DataFrame, narrow: int = NARROW, rows: int | None = None) -> Frontier:
    """A durable table of distinct vertex ids; it is counted unless ``rows`` is known."""
    rows = table.count() if rows is None else rows
    if rows > narrow:
        return Frontier(rows, table=table)
    return Frontier(rows, ids=tuple(r.vertex_id for r in table.collect()) if rows else ())


def _small_side(frontier: Frontier, buckets: int = 0) -> DataFrame:
    """The frontier as a join side, hinted by its measured size."""
    if frontier.rows <= BROADCAST_ROWS:
        return F.broadcast(frontier.table)
    if frontier.rows <= buckets * HASH_BUILD_ROWS:
        return frontier.table.hint("shuffle_hash")
    return frontier.table


def neighbors(graph: Graph, frontier: Frontier) -> DataFrame:
    """Far ends of all arcs that leave the frontier, as ``vertex_id`` rows.

    A narrow frontier becomes literal ids (bucket and page pruning), a moderate
    one is broadcast, a large one is shuffled to the arcs' buckets. The arcs
    themselves are never shuffled.
    """
    if frontier.ids is not None:
        found = graph.arcs.where(F.col("src").isin(list(frontier.ids)))
        hubs = graph.hub_ids.intersection(frontier.ids)
    else:
        side = _small_side(frontier, graph.buckets)
        found = graph.arcs.join(side, F.col("src") == F.col("vertex_id"), "left_semi")
        hubs = _hubs_in(graph, frontier)
    found = found.select(F.col("dst").alias("vertex_id"))
    if hubs:
        if len(hubs) <= NARROW:
            from_hubs = graph.hub_arcs.where(F.col("src").isin(list(hubs)))
        else:
            some = F.broadcast(key_table(graph.spark, "vertex_id", hubs))
            from_hubs = graph.hub_arcs.join(
                some, F.col("src") == F.col("vertex_id"), "left_semi"
            )
        found = found.unionByName(from_hubs.select(F.col("dst").alias("vertex_id")))
    return found


def _hubs_in(graph: Graph, frontier: Frontier) -> frozenset[int]:
    if not graph.hub_ids:
        return frozenset()
    hubs = F.broadcast(key_table(graph.spark, "vertex_id", graph.hub_ids))
    hit = frontier.table.join(hubs, "vertex_id", "left_semi").collect()
    return frozenset(row.vertex_id for row in hit)


def without(candidates: DataFrame, *seen: Frontier) -> DataFrame:
    """Candidates that are in none of the given frontiers."""
    literal = [i for f in seen if f.ids is not None for i in f.ids]
    if literal:
        candidates = candidates.where(~F.col("vertex_id").isin(literal))
    for frontier in seen:
        if frontier.ids is None:
            candidates = candidates.join(_small_side(frontier), "vertex_id", "left_anti")
    return candidates


def fresh_ids(
    graph: Graph, newest: Frontier, seen: list[Frontier], most: int
) -> list[int] | None:
    """The level after a narrow one as ids, or None if it may exceed ``most``.

    Fetches a bounded number of rows, whatever the degrees.
    """
    found = neighbors(graph, newest)
    if newest.rows <= HANDFUL and all(f.ids is not None for f in seen):
        rows = found.limit(HANDFUL * most + 1).collect()
        if len(rows) > HANDFUL * most:
            return None
        fresh = {r.vertex_id for r in rows}.difference(*(f.ids for f in seen))
    else:
        rows = without(found.distinct(), *seen).limit(most + 1).collect()
        fresh = {r.vertex_id for r in rows}
    return sorted(fresh) if len(fresh) <= most else None


@dataclass(frozen=True)
class Search:
    """The outcome of one search: who was reached, and at which level."""

    graph: Graph
    root: int
    reached: DataFrame

    def levels(self) -> DataFrame:
        """``(vertex_id, level)`` of every vertex, -1 where not reached."""
        return self.graph.vertices.join(self.reached, "vertex_id", "left").select(
            "vertex_id", F.coalesce("level", F.lit(UNREACHED).cast("bigint")).alias("level")
        )

    def level_slice(self, level: int) -> DataFrame:
        """Vertices found at exactly this level."""
        return self.reached.where(F.col("level") == level)

    def level_sizes(self) -> DataFrame:
        """Number of vertices per level."""
        return self.reached.groupBy("level").agg(F.count("*").alias("vertices"))

    def summary(self) -> DataFrame:
        """One row: vertices, edges, root, reached, max_level.

        Vertices and reached rows are aggregated side by side, so no join of
        the two tables is needed.
        """
        zero = F.lit(0).cast("bigint")
        one = F.lit(1).cast("bigint")
        whole = self.graph.vertices.select(
            one.alias("v"), F.col("degree").alias("e"), zero.alias("r"),
            F.lit(UNREACHED).cast("bigint").alias("level"),
        )
        found = self.reached.select(
            zero.alias("v"), zero.alias("e"), one.alias("r"), "level"
        )
        return whole.unionByName(found).agg(
            F.coalesce(F.sum("v"), zero).alias("vertices"),
            F.coalesce(F.sum("e"), zero).alias("edges"),
            F.lit(self.root).cast("bigint").alias("root"),
            F.coalesce(F.sum("r"), zero).alias("reached"),
            F.coalesce(F.max("level"), F.lit(UNREACHED).cast("bigint")).alias("max_level"),
        )

    def report(self) -> DataFrame:
        """The summary as one line of text."""
        return self.summary().select(summary_line())


def summary_line():
    """Text of a summary row."""
    # The wording and the two blanks are the established format.
    text = (
        "Graph vertices: %d with total edges %d.  "
        "Reached vertices from %d is %d and max level is %d"
    )
    return F.format_string(
        text, "vertices", "edges", "root", "reached", "max_level"
    ).alias("line")


def search(graph: Graph, root: int, narrow: int = NARROW) -> Search:
    """Levels of all vertices reachable from ``root``.

    Each round expands the newest level and keeps what is neither in it nor in
    the level before: arcs go both ways, so a neighbour of level k lies in
    level k-1, k or k+1 and older levels need no check. Narrow levels cost one
    pruned query and no write; wide ones are written, which is also what the
    next round reads, so plans do not grow with depth.
    """
    spark = graph.spark
    folder = graph.scratch.folder("levels")
    parts = count()
    pending: list[tuple[int, int]] = []

    def write(df: DataFrame) -> tuple[DataFrame, int]:
        """The written rows and their number, which the write itself counts."""
        path = f"{folder}/part={next(parts)}"
        counted = Observation()
        df.observe(counted, F.count("*").alias("rows")).write.parquet(path)
        return spark.read.schema(_LEVELS).parquet(path), counted.get["rows"]

    def flush() -> None:
        if pending:
            ids, depths = zip(*pending)
            write(spark.createDataFrame(pa.table({"vertex_id": ids, "level": depths})))
            pending.clear()

    if not has_vertex(graph, root):
        return Search(graph, root, initial_state(graph.vertices.limit(0)))

    pending.append((root, 0))
    before: Frontier | None = None
    newest = Frontier(1, ids=(root,))
    for level in count(1):
        seen = [newest] if before is None else [newest, before]
        if newest.ids is not None:
            ids = fresh_ids(graph, newest, seen, narrow)
            if ids is not None:
                if not ids:
                    break
                before, newest = newest, Frontier(len(ids), ids=tuple(ids))
                pending.extend((i, level) for i in ids)
                if len(pending) > PENDING_ROWS:
                    flush()
                continue
        # Dedupe first: broadcast sides still move below it, large ones stay above.
        fresh = without(neighbors(graph, newest).distinct(), *seen)
        table, rows = write(fresh.withColumn("level", F.lit(level).cast("bigint")))
        found = frontier_of(table.select("vertex_id"), narrow, rows)
        if found.rows == 0:
            break
        before, newest = newest, found
    flush()
    reached = spark.read.schema(_LEVELS).option("recursiveFileLookup", "true").parquet(folder)
    return Search(graph, root, reached)


def search_by_scan(graph: Graph, root: int) -> DataFrame:
    """Levels ``(vertex_id, level)`` by rescanning the state of every reached vertex.

    The slower method, to check ``search``: it shares no pruning with it. Each
    round selects the vertices at the current level from the whole state and
    holds all their neighbours against the whole state. The state is a table in
    as many hash buckets as the arcs; new levels are appended to it, and the
    candidates are shuffled to its buckets, so it is neither moved nor rewritten.
    """
    scratch, spark = graph.scratch, graph.spark
    first = spark.createDataFrame([(root, 0)] if has_vertex(graph, root) else [], _LEVELS)
    state = scratch.save(first, "state", bucket_by="vertex_id", buckets=graph.buckets)
    for level in count(0):
        active = frontier_of(state.where(F.col("level") == level).select("vertex_id"), narrow=0)
        if active.rows == 0:
            break
        state = scratch.append(state, untouched(graph, active, state).withColumn("level", F.lit(level + 1).cast("bigint")))
    return graph.vertices.join(state, "vertex_id", "left").select(
        "vertex_id", F.coalesce("level", F.lit(UNREACHED).cast("bigint")).alias("level")
    )


def untouched(graph: Graph, active: Frontier, state: DataFrame) -> DataFrame:
    """Neighbours of the active vertices that the bucketed ``state`` has not, each once."""
    candidates = neighbors(graph, active).repartition(graph.buckets, "vertex_id").distinct()
    return candidates.join(state.select("vertex_id"), "vertex_id", "left_anti")


def initial_state(vertices: DataFrame) -> DataFrame:
    """Every vertex at level -1."""
    return vertices.select("vertex_id", F.lit(UNREACHED).cast("bigint").alias("level"))


def expand_once(arc_table: DataFrame, frontier: DataFrame) -> DataFrame:
    """Distinct neighbours of distinct vertices ``(vertex_id)``, from plain arcs."""
    leaving = join_unique(
        arc_table, frontier.select(F.col("vertex_id").alias("src")), "src", "left_semi"
    )
    return leaving.select(F.col("dst").alias("vertex_id")).distinct()


def unvisited(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    """Candidates that have no level yet."""
    return candidates.join(seen, "vertex_id", "left_anti")


def merge_frontiers(flags: DataFrame) -> DataFrame:
    """Combine 0/1 marks ``(vertex_id, flag)`` of several producers: any 1 wins."""
    return flags.groupBy("vertex_id").agg(F.max("flag").alias("flag"))


def level_mismatches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Vertices on which two level tables disagree, missing rows included."""
    other = right.withColumnRenamed("level", "other_level")
    return left.join(other, "vertex_id", "full_outer").where(
        ~F.col("level").eqNullSafe(F.col("other_level"))
    )


def compare_levels(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: vertices, mismatches, and reached and deepest level of each side."""
    other = right.withColumnRenamed("level", "other_level")
    both = left.join(other, "vertex_id", "full_outer")
    floor = F.lit(UNREACHED).cast("bigint")
    return both.agg(
        F.count("*").alias("vertices"),
        F.count_if(~F.col("level").eqNullSafe(F.col("other_level"))).alias("mismatches"),
        F.count_if(F.col("level") != UNREACHED).alias("reached"),
        F.count_if(F.col("other_level") != UNREACHED).alias("other_reached"),
        F.coalesce(F.max("level"), floor).alias("max_level"),
        F.coalesce(F.max("other_level"), floor).alias("other_max_level"),
    )
