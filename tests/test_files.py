import struct
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import brute
from arcweave.functions.durations import duration_parts, micros_between
from arcweave.operators import bfs, matrix
from arcweave.scratch import Scratch, scratch_root
from arcweave.sources import edges_binary, edges_text, matrix_text

G1 = [(1, 2), (2, 3), (3, 4), (7, 8), (5, 5)]


def write_binary(path, edges, extra=b""):
    path.write_bytes(b"".join(struct.pack("<qq", a, b) for a, b in edges) + extra)
    return str(path)


def test_binary_edges(spark, scratch, tmp_path):
    wide = G1 + [(0, (1 << 63) - 1), (-(1 << 63), 3), (-1, -2)]
    path = write_binary(tmp_path / "graph.bin", wide)
    whole = edges_binary.read_edges(spark, path)
    assert sorted(map(tuple, whole.collect())) == sorted(wide)
    # Ranges of two records (a size in between is rounded down).
    split = edges_binary.read_edges(spark, path, partition_bytes=40)
    assert split.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, split.collect())) == sorted(wide)
    summary = bfs.search(bfs.build_graph(whole, scratch), 1).summary().first()
    assert (summary.vertices, summary.reached, summary.max_level) == (12, 5, 3)


def test_binary_edges_of_an_empty_file(spark, scratch, tmp_path):
    edges = edges_binary.read_edges(spark, write_binary(tmp_path / "none.bin", []))
    summary = bfs.search(bfs.build_graph(edges, scratch), 0).summary().first()
    assert tuple(summary) == (0, 0, 0, 0, -1)


def test_stray_bytes_are_refused(spark, tmp_path):
    path = write_binary(tmp_path / "odd.bin", G1, b"xyz")
    with pytest.raises(ValueError, match="leave 3 after whole 16-byte records"):
        edges_binary.read_edges(spark, path)
    with pytest.raises(FileNotFoundError):
        edges_binary.read_edges(spark, str(tmp_path / "absent"))


def test_binary_edges_are_read_without_python_and_by_hadoop_paths(spark, tmp_path):
    folder = tmp_path / "other program"
    (folder / "deep").mkdir(parents=True)
    write_binary(folder / "a.bin", G1[:2])
    write_binary(folder / "deep" / "b.bin", G1[2:])
    write_binary(folder / "_hidden", [(9, 9)])
    for path in (str(folder), f"file:{folder}", f"file://{folder}/"):
        edges = edges_binary.read_edges(spark, path)
        assert sorted(map(tuple, edges.collect())) == sorted(G1)
    plan = edges._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    # Another scheme goes to the file system that Spark knows for it.
    spark._jsc.hadoopConfiguration().set("fs.elsewhere.impl", "no.such.FileSystem")
    with pytest.raises(Exception, match="no.such.FileSystem"):
        edges_binary.read_edges(spark, "elsewhere://bucket/graph.bin")
    # Appending keeps the files that were there.
    edges_binary.write_edges(spark.createDataFrame([(4, 4)], "src bigint, dst bigint"), str(folder), "append")
    assert sorted(map(tuple, edges_binary.read_edges(spark, str(folder)).collect())) == sorted([*G1, (4, 4)])


def stored(spark, path):
    return sorted(map(tuple, edges_binary.read_edges(spark, path).collect()))


def test_binary_edges_are_written(spark, tmp_path):
    path = str(tmp_path / "out")
    edges = spark.range(1000).select(F.col("id").alias("src"), (F.col("id") * 3).alias("dst"))
    want = [(i, 3 * i) for i in range(1000)]
    edges_binary.write_edges(edges.repartition(3), path)
    assert stored(spark, path) == want
    parts = [f for f in (tmp_path / "out").rglob("part-*")]
    assert sum(f.stat().st_size for f in parts) == 16_000
    raw = b"".join(f.read_bytes() for f in parts)
    assert sorted(struct.iter_unpack("<qq", raw)) == want
    with pytest.raises(FileExistsError):
        edges_binary.write_edges(edges, path)
    edges_binary.write_edges(edges, path, "append")
    assert len(stored(spark, path)) == 2000
    edges_binary.write_edges(edges.where("src < 0"), path, "append")
    assert len(stored(spark, path)) == 2000
    edges_binary.write_edges(edges, path, "overwrite")
    assert stored(spark, path) == want
    assert len([f for f in (tmp_path / "out").iterdir() if f.name.startswith("batch-")]) == 1
    odd = [(a, b) for a in (-1, 0, 10, 1 << 62) for b in (-(1 << 63), -1, 0, 0x0A0D0A0D0A0D0A0D, (1 << 56) - 1, (1 << 63) - 1)]
    edges_binary.write_edges(spark.createDataFrame(odd * 2, "src bigint, dst bigint"), path, "overwrite")
    assert stored(spark, path) == sorted(odd * 2)
    edges_binary.write_edges(edges.where("src < 0"), str(tmp_path / "empty"))
    assert stored(spark, str(tmp_path / "empty")) == []


def test_failed_writes_change_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    first = spark.createDataFrame([(1, 2)], "src bigint, dst bigint")
    second = spark.createDataFrame([(3, 4)], "src bigint, dst bigint")
    edges_binary.write_edges(first, path)

    def lost(*_, **__):
        raise OSError("the driver is gone")

    for mode in ("append", "overwrite"):
        # The data are there, the commit is not.
        with monkeypatch.context() as patch, pytest.raises(OSError, match="driver"):
            patch.setattr(edges_binary._Folder, "publish", lost)
            edges_binary.write_edges(second, path, mode)
        assert stored(spark, path) == [(1, 2)]
    # A task fails.
    broken = second.select(F.raise_error(F.lit("bad row")).cast("bigint").alias("src"), "dst")
    with pytest.raises(PySparkException, match="bad row"):
        edges_binary.write_edges(broken, path, "overwrite")
    assert stored(spark, path) == [(1, 2)]
    # Published, but the old files are still there.
    with monkeypatch.context() as patch, pytest.raises(OSError, match="driver"):
        patch.setattr(edges_binary._Folder, "forget", lost)
        edges_binary.write_edges(second, path, "overwrite")
    assert stored(spark, path) == [(3, 4)]
    edges_binary.write_edges(first, path, "append")
    assert stored(spark, path) == [(1, 2), (3, 4)]


def test_binary_writer_refuses_other_tables(spark, tmp_path):
    with pytest.raises(ValueError, match="src bigint, dst bigint"):
        edges_binary.write_edges(spark.range(3), str(tmp_path / "x"))
    gap = spark.createDataFrame([(1, None)], "src bigint, dst bigint")
    with pytest.raises(PySparkException, match="no id at one end"):
        edges_binary.write_edges(gap, str(tmp_path / "y"))


def test_tsv_edges(spark, tmp_path):
    path = str(tmp_path / "edges")
    edges = spark.createDataFrame(G1, "src bigint, dst bigint")
    edges_text.write_edges_tsv(edges, path)
    assert sorted(map(tuple, edges_text.read_edges_tsv(spark, path).collect())) == sorted(G1)
    assert "7\t8" in "".join(f.read_text() for f in (tmp_path / "edges").glob("part-*"))
    (tmp_path / "bad.tsv").write_text("1\tx\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        edges_text.read_edges_tsv(spark, str(tmp_path / "bad.tsv")).collect()


def matrix_file(path, rows, vector, header=None):
    lines = [header or f"{len(rows)},{len(vector)}"]
    lines += [",".join(map(str, row)) for row in rows] + [str(x) for x in vector]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_matrix_text_over_many_splits(spark, scratch, tmp_path):
    square = [[(r * 5 + c * c) % 31 for c in range(64)] for r in range(64)]
    path = matrix_file(tmp_path / "m.txt", square, range(64))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 8
        text = matrix_text.read_matrix_text(spark, path, scratch)
        assert tuple(matrix_text.read_dims(spark, path).first()) == (64, 64)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert (text.n_rows, text.n_cols) == (64, 64)
    assert {r.row_id: r["values"] for r in text.rows.collect()} == dict(enumerate(square))
    assert {r.idx: r.value for r in text.vector.collect()} == {i: i for i in range(64)}

    product = matrix.matvec(matrix.to_coo(text.rows), text.vector)
    out = tmp_path / "output"
    matrix_text.write_vector_text(product.repartition(5), str(out))
    written = "".join(f.read_text() for f in sorted(out.glob("part-*")))
    want = [sum(i * x for i, x in enumerate(row)) for row in square]
    assert [int(line) for line in written.split()] == want
    again = matrix_text.read_vector_text(spark, str(out), scratch)
    assert {r.row_id: r.value for r in again.collect()} == dict(enumerate(want))


def test_vector_sink_does_not_shift_rows(spark, tmp_path):
    def vector(*rows):
        return spark.createDataFrame(list(rows), "row_id bigint, value bigint")

    def written(df, name, n_rows=None):
        matrix_text.write_vector_text(df, str(tmp_path / name), n_rows)
        return [int(x) for f in sorted((tmp_path / name).glob("part-*")) for x in f.read_text().split()]

    assert written(vector((1, 7), (0, 5), (2, 9)), "whole") == [5, 7, 9]
    assert written(vector((3, 7), (0, 5)), "filled", 5) == [5, 0, 0, 7, 0]
    assert written(vector((0, 1)).where("false"), "empty") == []
    for rows in ([(0, 1), (2, 3)], [(1, 1)], [(-1, 1), (0, 2)], [(0, 1), (0, 2)]):
        with pytest.raises(ValueError, match="ids"):
            written(vector(*rows), "bad")
    with pytest.raises(ValueError, match="expected 0 to 1"):
        written(vector((0, 1), (2, 3)), "bad", 2)


def test_matrix_text_in_part_files(spark, scratch, tmp_path):
    rows = spark.createDataFrame(
        [(i, [i, i + 1, i + 2]) for i in range(50)], "row_id bigint, `values` array<bigint>"
    )
    vector = spark.createDataFrame([(0, 1), (1, 0), (2, -1)], "idx bigint, value bigint")
    path = str(tmp_path / "parts")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        matrix_text.write_matrix_text(rows.repartition(4), vector, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "parts").glob("part-*"))) > 2
    text = matrix_text.read_matrix_text(spark, path, scratch)
    assert {r.row_id: r["values"] for r in text.rows.collect()} == {
        i: [i, i + 1, i + 2] for i in range(50)
    }
    assert tuple(matrix_text.read_dims(spark, path).first()) == (50, 3)


def test_matrix_without_rows(spark, scratch, tmp_path):
    path = matrix_file(tmp_path / "m.txt", [], [1, 2, 3])
    text = matrix_text.read_matrix_text(spark, path, scratch)
    assert (text.n_rows, text.n_cols, text.rows.count(), text.vector.count()) == (0, 3, 0, 3)
    assert matrix.matvec(matrix.to_coo(text.rows), text.vector).count() == 0


@pytest.mark.parametrize(
    "rows, vector, header, message",
    [
        ([[1, 2, 3], [4, 5]], [1, 2, 3], None, "1 matrix rows do not have 3 cells"),
        ([[1, 2]], [1, 2, 3], "1,2", "5 lines, expected 1 \\+ 1 \\+ 2"),
        ([[1, 2]], ["1,2", 3], "1,2", "1 vector lines"),
        ([[1, 2]], [1, 2], "1,2,3", "rows,cols line"),
    ],
)
def test_malformed_matrix_text(spark, scratch, tmp_path, rows, vector, header, message):
    path = matrix_file(tmp_path / "m.txt", rows, vector, header)
    with pytest.raises(ValueError, match=message):
        matrix_text.read_matrix_text(spark, path, scratch)


def test_junk_cells_raise(spark, scratch, tmp_path):
    path = matrix_file(tmp_path / "m.txt", [[1, "x"]], [1, 1])
    with pytest.raises(PySparkException):
        matrix_text.read_matrix_text(spark, path, scratch)


def test_durations(spark):
    us = ((2 * 24 + 3) * 60 + 4) * 60_000_000 + 5_999_999
    out = spark.createDataFrame([(us,), (0,)], "us bigint").select(*duration_parts(F.col("us")))
    assert [tuple(r) for r in out.collect()] == [(2, 3, 4, 5), (0, 0, 0, 0)]


def test_time_spans_ignore_the_session_zone(spark):
    """One of these local days has 23 hours in New York."""
    df = spark.sql(
        "SELECT timestamp_ntz'2024-03-09 12:00:00' a, timestamp_ntz'2024-03-10 12:00:00.000007' b"
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        span = df.select(micros_between(F.col("a"), F.col("b")).alias("us")).first().us
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert span == 24 * 3600 * 1_000_000 + 7


def test_scratch_is_dropped_whole(spark, tmp_path):
    with Scratch(spark, str(tmp_path)) as area:
        table = area.save(spark.range(10), "numbers")
        spark.range(3).write.parquet(area.folder("loose"))
        assert table.count() == 10
        assert len(list((tmp_path / area.name).iterdir())) == 2
    assert not (tmp_path / area.name).exists()
    assert area.name not in [d.name for d in spark.catalog.listDatabases()]


def test_scratch_root_is_the_shared_folder():
    def session(conf, own=None, master="spark://host:7077"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: own)
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert scratch_root(session({"spark.checkpoint.dir": "hdfs:///cut/"})) == "hdfs:///cut"
    assert scratch_root(session({}, own="hdfs:///own")) == "hdfs:///own"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session({}))
    assert "arcweave-" in scratch_root(session({}, master="local[2]"))


def test_replaced_tables_are_dropped(spark, scratch):
    first = scratch.save(spark.range(5), "state")
    second = scratch.save(first.selectExpr("id + 1 AS id"), "state", replaces=first)
    assert sorted(r.id for r in second.collect()) == [1, 2, 3, 4, 5]
    assert len(spark.catalog.listTables(scratch.name)) == 1
