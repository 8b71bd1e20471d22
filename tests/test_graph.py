import random

import pytest
from pyspark.sql import functions as F

import brute
from arcweave.operators import csr, graph, placement
from arcweave.operators.running import exclusive_running, previous_row
from arcweave.operators.skew import heavy_keys, heavy_limit, join_unique, sampled_heavy_keys

G1 = [(1, 2), (2, 3), (3, 4), (7, 8), (5, 5)]


def edges_df(spark, edges):
    return spark.createDataFrame(edges, "src bigint, dst bigint")


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture
def g1(spark):
    return graph.arcs(edges_df(spark, G1))


def test_arcs_are_edges_and_their_reverse(spark):
    edges = edges_df(spark, G1)
    union = edges.unionByName(graph.reverse(edges))
    assert rows(graph.arcs(edges), "src", "dst") == rows(union, "src", "dst")


def test_degrees_and_stats(g1):
    degrees = graph.vertex_degree(g1)
    assert dict(rows(degrees, "vertex_id", "degree")) == {1: 1, 2: 2, 3: 2, 4: 1, 5: 2, 7: 1, 8: 1}
    assert graph.graph_stats(degrees).first().asDict() == {
        "vertices": 7, "edges": 10, "max_vertex_id": 8,
    }
    assert rows(graph.vertex_set(g1), "vertex_id") == [(v,) for v in (1, 2, 3, 4, 5, 7, 8)]


def test_stats_of_empty_graph(spark):
    degrees = graph.vertex_degree(graph.arcs(edges_df(spark, [])))
    assert graph.graph_stats(degrees).first().asDict() == {
        "vertices": 0, "edges": 0, "max_vertex_id": None,
    }


def test_lookup_visit_fold(spark, g1):
    degrees = graph.vertex_degree(g1)
    probes = spark.createDataFrame([(2,), (6,)], "vertex_id bigint")
    assert rows(graph.lookup(degrees, probes), "vertex_id", "degree") == [(2, 2), (6, None)]
    visited = graph.visit(degrees, (F.col("vertex_id") + F.col("degree")).alias("x"))
    assert sorted(r.x for r in visited.collect()) == [2, 4, 5, 5, 7, 8, 9]
    assert graph.fold(degrees, F.max("degree").alias("top")).first().top == 2


def test_lookup_leaves_the_vertices_in_place(spark, scratch):
    degrees = graph.vertex_degree(graph.arcs(edges_df(spark, [(i, i + 1) for i in range(300)])))
    vertices = graph.bucketed_vertices(degrees, scratch, 4)
    probes = spark.createDataFrame([(i,) for i in [*range(0, 600, 3), 3, 3, None]], "vertex_id bigint")
    want = sorted((i, 1 if i in (0, 300) else 2 if i <= 300 else None) for i in [*range(0, 600, 3), 3, 3])

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        literal = graph.lookup(vertices, probes)
        broadcast = graph.lookup(vertices, probes, literal=10)
        many = graph.lookup(vertices, probes, literal=10, broadcast_rows=20)
        plans = [plan(df) for df in (literal, broadcast, many)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for df in (literal, broadcast, many):
        got = [tuple(r) for r in df.select("vertex_id", "degree").collect()]
        assert sorted(r for r in got if r[0] is not None) == want and (None, None) in got
    assert "In(vertex_id" in plans[0] or "vertex_id IN" in plans[0] or "INSET" in plans[0]
    assert "Exchange hashpartitioning" not in plans[0]
    # Only the probes' distinct ids are shuffled; the vertices meet them where they lie.
    scan = plans[1].index("FileScan parquet")
    assert "Exchange hashpartitioning(degree" not in plans[1]
    assert all("Exchange hashpartitioning" not in line for line in plans[1][:scan].splitlines()[-4:])
    assert plans[2].count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("floor", [1 << 20, 20])
def test_adjacency_with_and_without_hubs(spark, floor):
    rng = random.Random(3)
    # Vertex 0 holds a third of all arcs, one pair is repeated many times.
    edges = [(0, rng.randrange(1, 40)) for _ in range(200)] + [(0, 7)] * 150
    edges += [(rng.randrange(1, 40), rng.randrange(1, 40)) for _ in range(60)]
    arcs = graph.arcs(edges_df(spark, edges))
    found = graph.adjacency(arcs, block=16, heavy_floor=floor)
    want = {}
    for a, b in brute.both_ways(edges):
        want.setdefault(a, []).append(b)
    expected = {
        (v, i // 16): sorted(near)[i : i + 16]
        for v, near in want.items()
        for i in range(0, len(near), 16)
    }
    got = {(r.vertex_id, r.block_no): r.neighbors for r in found.collect()}
    assert got == expected


def test_adjacency_takes_one_shuffle(spark):
    arcs = graph.arcs(edges_df(spark, [(i, i % 7) for i in range(100)]))
    plan = graph.adjacency(arcs, block=4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan


@pytest.mark.parametrize("floor", [1 << 20, 40])
def test_previous_row_of_ordinary_and_heavy_groups(spark, scratch, floor):
    rng = random.Random(8)
    events = [(rng.choice([None, 1, 1, 1, 2, 3, *range(4, 30)]), rng.randrange(50), i) for i in range(600)]
    want, last = [], {}
    for user, ts, event in sorted(events, key=lambda e: (e[0] is not None, e[0] or 0, e[1], e[2])):
        want.append((user, event, last.get(user, (None,))[0]))
        last[user] = (event,)
    frame = spark.createDataFrame(events, "user bigint, ts int, event bigint").repartition(5)
    for some, expected in ((frame, want), (frame.where("user is not null"), [w for w in want if w[0] is not None])):
        found = previous_row(some, "user", ["ts", "event"], "event", "previous", scratch, floor)
        got = [(r.user, r.event, r.previous) for r in found.collect()]
        assert sorted(got, key=str) == sorted(expected, key=str)
    ordinary = frame.where("user is not null")
    plan = previous_row(ordinary, "user", ["ts"], "event", "p", scratch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_copies_of_one_arc_are_expanded_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(graph, "COPIES_PER_PIECE", 8)
    edges = [(1, 2)] * 50 + [(1, 3)] * 5
    arcs = graph.arcs(edges_df(spark, edges))
    _, hub, _ = graph.ranked_arcs(arcs, graph.vertex_degree(arcs), heavy_floor=20)
    want = [(1, 2, i) for i in range(50)] + [(1, 3, i) for i in range(50, 55)]
    want += [(2, 1, i) for i in range(50)]
    assert rows(hub, "src", "dst", "rank") == sorted(want)


def test_row_offsets(spark, g1):
    degrees = graph.vertex_degree(g1)
    offsets = dict(rows(csr.row_offsets(degrees), "vertex_id", "row_offset"))
    assert offsets == {1: 0, 2: 1, 3: 3, 4: 5, 5: 6, 7: 8, 8: 9}
    dense = dict(rows(csr.row_offsets(degrees, densify=True), "vertex_id", "row_offset"))
    assert dense == {0: 0, 1: 0, 2: 1, 3: 3, 4: 5, 5: 6, 6: 8, 7: 8, 8: 9, 9: 10}


def test_row_offsets_of_sparse_ids(spark):
    edges = [(0, 1 << 40), (1 << 40, 7), (1 << 61, (1 << 20) + 3), (5, 1 << 21)]
    degrees = graph.vertex_degree(graph.arcs(edges_df(spark, edges)))
    got = rows(csr.row_offsets(degrees), "vertex_id", "row_offset", "degree")
    total = 0
    for vertex_id, offset, degree in got:
        assert offset == total
        total += degree
    assert total == 8


def test_row_offsets_refuse_negative_ids(spark):
    degrees = graph.vertex_degree(graph.arcs(edges_df(spark, [(-1, 2)])))
    with pytest.raises(Exception, match="ids >= 0"):
        csr.row_offsets(degrees).collect()


@pytest.mark.parametrize("floor", [1 << 20, 3])
def test_column_indices(spark, floor):
    edges = G1 + [(2, 9), (2, 9), (2, 1), (2, 2)]
    arcs = graph.arcs(edges_df(spark, edges))
    found = csr.column_indices(arcs, graph.vertex_degree(arcs), heavy_floor=floor)
    want = [(i, a, b) for i, (a, b) in enumerate(sorted(brute.both_ways(edges)))]
    assert rows(found, "pos", "src", "dst") == want


def test_exclusive_running_across_blocks(spark):
    rng = random.Random(5)
    data = []
    for key in ("a", "b"):
        ids = rng.sample(range(-(1 << 45), 1 << 45), 60) + rng.sample(range(1 << 22), 60)
        data += [(key, i, rng.randrange(100)) for i in set(ids)]
    df = spark.createDataFrame(data, "k string, id bigint, v bigint")
    sums = exclusive_running(df, "id", "v", "s", by=["k"])
    tops = exclusive_running(df, "id", "id", "p", by=["k"], fold="max")
    for key in ("a", "b"):
        ordered = sorted((i, v) for k, i, v in data if k == key)
        want_sum, want_top, total, top = [], [], 0, None
        for i, v in ordered:
            want_sum.append((i, total))
            want_top.append((i, top))
            total, top = total + v, i
        assert rows(sums.where(F.col("k") == key), "id", "s") == want_sum
        assert rows(tops.where(F.col("k") == key), "id", "p") == want_top


def test_row_offsets_scan_the_arcs_once(g1):
    offsets = csr.row_offsets(graph.vertex_degree(g1))
    offsets.collect()
    plan = offsets._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_placement(spark):
    ids = spark.range(0, 23).withColumnRenamed("id", "row_id")
    owner, slot = placement.owner("row_id", 4), placement.slot("row_id", 4)
    out = ids.select(
        "row_id", owner.alias("o"), slot.alias("s"), placement.vertex_at(slot, owner, 4).alias("v"),
        placement.chunk("row_id", 23, 4).alias("c"), placement.round_robin("row_id", 4).alias("r"),
    )
    for r in out.collect():
        assert (r.o, r.s, r.v) == (r.row_id % 4, r.row_id // 4, r.row_id)
        assert (r.c, r.r) == (r.row_id // 6, r.row_id % 4)
    # No more chunks than rows.
    few = spark.range(0, 3).select(placement.chunk("id", 3, 8).alias("c"))
    assert [r.c for r in few.collect()] == [0, 1, 2]


def test_layouts(spark):
    rows_df = spark.range(0, 100).withColumnRenamed("id", "row_id")
    ranges = (
        placement.in_chunks(rows_df, 4)
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min("row_id").alias("a"), F.max("row_id").alias("b"))
        .orderBy("a")
        .collect()
    )
    assert all(x.b < y.a for x, y in zip(ranges, ranges[1:]))
    assert placement.dealt(rows_df, 5).rdd.getNumPartitions() == 5
    arcs = graph.arcs(edges_df(spark, G1))
    homes = (
        placement.by_vertex(arcs, 4)
        .select("src", F.spark_partition_id().alias("p"))
        .distinct()
        .groupBy("src")
        .count()
    )
    assert homes.agg(F.max("count")).first()[0] == 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("floor", [1 << 20, 30])
def test_join_to_unique_keys(spark, how, floor):
    """Shuffled, and with a third of the rows on one key."""
    rng = random.Random(2)
    many = [(7, i) for i in range(60)] + [(rng.randrange(30), i) for i in range(120)]
    one = [(k, k * k) for k in range(0, 20)]
    left = spark.createDataFrame(many + [(None, -1)], "k bigint, i bigint")
    right = spark.createDataFrame(one, "k bigint, v bigint")
    joined = join_unique(left, right, "k", how, heavy_floor=floor, broadcast_rows=5)
    got = sorted(map(tuple, joined.collect()), key=str)
    assert got == sorted(map(tuple, left.join(right, "k", how).collect()), key=str)


def test_heavy_keys_are_found_in_a_sample(spark):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    found, total = sampled_heavy_keys(spark.range(600_000).select(key.alias("k")), "k", 100_000)
    assert found == frozenset({7})
    assert 500_000 < total < 700_000


def test_heavy_keys_are_few(spark):
    counts = spark.createDataFrame([(1, 50), (2, 3), (3, 20)], "k bigint, n bigint")
    assert sorted(r.k for r in heavy_keys(counts, "k", "n", 10).collect()) == [1, 3]
    assert heavy_keys(counts, "k", "n", 50) is None
    assert heavy_keys(counts.limit(0), "k", "n", 50) is None
    rows = spark.createDataFrame(
        [(1,)] * 50 + [(2,)] * 3 + [(3,)] * 20 + [(None,)] * 90, "k bigint"
    )
    assert sampled_heavy_keys(rows, "k", 30) == (frozenset({1, 3}), 73)
    assert sampled_heavy_keys(rows, "k", 100) == (frozenset(), 73)
    assert sampled_heavy_keys(rows.limit(0), "k") == (frozenset(), 0)
    # The limit grows with the data, so that under 65536 keys can pass it.
    assert heavy_limit(10**13) * (1 << 16) >= 10**13
