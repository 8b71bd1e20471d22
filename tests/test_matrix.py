import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import brute
from arcweave.operators import matrix


def dense(spark, rows):
    return spark.createDataFrame(
        list(enumerate(rows)), "row_id bigint, `values` array<bigint>"
    )


def vector_df(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "idx bigint, value bigint")


def coo(spark, cells):
    return spark.createDataFrame(cells, "row_id bigint, col_id bigint, value bigint")


def answer(df):
    return {r.row_id: r.value for r in df.collect()}


# Numbers by a rule of our own.
VECTOR_48 = [(i * i * 37 + 11 * i) % 499 for i in range(48)]


def both_products(spark, rows, values):
    """The dense and the sparse product, checked to agree."""
    m, v = dense(spark, rows), vector_df(spark, values)
    by_row = answer(matrix.matvec_dense(m, matrix.vector_array(v, len(values))))
    by_cell = answer(matrix.matvec(matrix.to_coo(m), v))
    assert by_row == by_cell
    return by_row


def test_small_product(spark):
    rows = [[3, 0, 1], [0, -2, 7]]
    assert both_products(spark, rows, [5, 9, 2]) == {0: 17, 1: -4}


def test_square_product(spark):
    square = [[(r * 7 + c * c) % 23 - 5 for c in range(48)] for r in range(48)]
    want = {r: sum(x * y for x, y in zip(row, VECTOR_48, strict=True)) for r, row in enumerate(square)}
    assert both_products(spark, square, VECTOR_48) == want
    tripled = both_products(spark, square, [3 * x for x in VECTOR_48])
    assert tripled == {row: 3 * value for row, value in want.items()}
    m, v = dense(spark, square), vector_df(spark, VECTOR_48)
    for width in (1, 7, 48, 100):
        assert answer(matrix.matvec_wide(m, v, width)) == want
    with pytest.raises(PySparkException):
        matrix.matvec_wide(m, v.where("idx <> 9"), 7).collect()


def test_wide_product_in_passes(spark, scratch):
    rows = [[(r * 7 + c * c) % 23 - 5 for c in range(48)] for r in range(9)]
    want = {r: sum(x * y for x, y in zip(row, VECTOR_48, strict=True)) for r, row in enumerate(rows)}
    m, v = dense(spark, rows), vector_df(spark, VECTOR_48)
    for width, pass_width in ((4, 8), (5, 1), (7, 21), (48, 48)):
        assert answer(matrix.matvec_wide(m, v, width, pass_width, scratch)) == want
    with pytest.raises(ValueError, match="Scratch"):
        matrix.matvec_wide(m, v, 4, 8)
    # A row or vector of another width raises, on a block's edge too, and so do nulls and odd indices.
    for cells in (VECTOR_48[:44], VECTOR_48 + [1] * 4):
        with pytest.raises(PySparkException, match="differ in width"):
            matrix.matvec_wide(m, vector_df(spark, cells), 4, 400).collect()
    for odd in (v.where("idx <> 9").union(spark.sql("SELECT 8L, 1L")), v.selectExpr("idx", "nullif(value, 0) AS value")):
        with pytest.raises(PySparkException, match="nulls"):
            matrix.matvec_wide(m, odd, 7, 700).collect()
    with pytest.raises(PySparkException, match="nulls"):
        matrix.matvec_wide(dense(spark, [[1, None]]), vector_df(spark, [1, 2])).collect()
    assert answer(matrix.matvec_wide(dense(spark, []), v)) == {}
    nothing = spark.createDataFrame([(0, [])], "row_id bigint, `values` array<bigint>")
    assert answer(matrix.matvec_wide(nothing, vector_df(spark, []))) == {0: 0}


def test_wide_product_moves_sums_only(spark):
    m, v = dense(spark, [[1, 2, 3, 4], [5, 6, 7, 8]]), vector_df(spark, [1, 1, 1, 1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = matrix.matvec_wide(m, v, 2)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # The vector is gathered by block, partial sums by row; no row of the matrix is shuffled.
    assert sum("row_id" in line for line in moved) == 1 and len(moved) == 2
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning(row_id")


def test_null_cells_raise(spark):
    m = dense(spark, [[1, None]])
    with pytest.raises(PySparkException):
        matrix.matvec_dense(m, matrix.vector_array(vector_df(spark, [1, 2]))).collect()


def test_wide_row_and_wide_values(spark):
    assert both_products(spark, [list(range(1, 21))], [1] * 20) == {0: 210}
    assert both_products(spark, [[65536]], [65536]) == {0: 4294967296}


def test_overflow_raises(spark):
    big = [[1 << 62, 1 << 62]]
    with pytest.raises(PySparkException):
        matrix.matvec_dense(
            dense(spark, big), matrix.vector_array(vector_df(spark, [1, 1]))
        ).collect()
    with pytest.raises(PySparkException):
        matrix.matvec(matrix.to_coo(dense(spark, big)), vector_df(spark, [2, 1])).collect()


def test_ansi_is_required(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            matrix.matvec(coo(spark, [(0, 0, 1)]), vector_df(spark, [1]))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_width_mismatch_raises(spark):
    rows = dense(spark, [[1, 2, 3], [1, 2]])
    with pytest.raises(PySparkException, match="differ in width"):
        matrix.matvec_dense(rows, matrix.vector_array(vector_df(spark, [1, 2, 3]))).collect()
    with pytest.raises(ValueError, match="expected 3"):
        matrix.vector_array(vector_df(spark, [1, 2]), 3)


def test_sparse_semantics(spark):
    cells = coo(spark, [(0, 0, 2), (0, 2, 3), (1, 5, 9)])
    ones = vector_df(spark, [1, 1, 1])
    assert answer(matrix.matvec(cells, ones)) == {0: 5}
    assert answer(matrix.matvec(cells, ones, all_rows=True)) == {0: 5, 1: 0}
    terms = matrix.products(cells, ones)
    assert sorted(tuple(r) for r in terms.select("row_id", "col_id", "product").collect()) == [
        (0, 0, 2), (0, 2, 3),
    ]


@pytest.mark.parametrize("all_rows", [False, True])
@pytest.mark.parametrize("floor", [1 << 20, 40])
def test_large_vectors_and_heavy_columns(spark, all_rows, floor):
    """A third of all entries share a column, another third share a row."""
    rng = random.Random(7)
    cells = [(rng.randrange(60), 3, rng.randrange(9)) for _ in range(150)]
    cells += [(5, rng.randrange(80), rng.randrange(9)) for _ in range(150)]
    cells += [(rng.randrange(60), rng.randrange(80), rng.randrange(9)) for _ in range(150)]
    values = {c: rng.randrange(-50, 50) for c in range(70)}
    v = spark.createDataFrame(list(values.items()), "idx bigint, value bigint")
    got = answer(
        matrix.matvec(coo(spark, cells), v, all_rows, heavy_floor=floor, broadcast_rows=10)
    )
    want = brute.product(cells, values)
    if all_rows:
        want = {row: want.get(row, 0) for row, _, _ in cells}
    assert got == want


def test_small_vectors_leave_the_matrix_in_place(spark):
    cells = coo(spark, [(0, 0, 2), (0, 2, 3), (1, 5, 9)])
    plan = matrix.matvec(cells, vector_df(spark, [1, 1, 1]))._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan
    # One shuffle only, of partial sums.
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan
    rows = dense(spark, [[1, 2], [3, 4]])
    product = matrix.matvec_dense(rows, matrix.vector_array(vector_df(spark, [1, 2])))
    main = product._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in main and "Join" not in main


def test_large_vectors_are_not_refused(spark, monkeypatch):
    monkeypatch.setattr(matrix, "BROADCAST_ROWS", 2)
    monkeypatch.setattr(matrix, "DENSE_WIDTH", 2)
    v = vector_df(spark, [1, 2, 3])
    assert answer(matrix.matvec_broadcast(coo(spark, [(0, 0, 1)]), v)) == answer(matrix.matvec(coo(spark, [(0, 0, 1)]), v))
    assert answer(matrix.matvec_dense(dense(spark, [[1, 1, 1]]), matrix.vector_array(v))) == {0: 6}


def test_shapes_and_rendering(spark, capsys):
    rows = dense(spark, [[1, 2, 3], [4, 5, 6]])
    assert matrix.dims(rows).first().asDict() == {"n_rows": 2, "n_cols": 3}
    assert matrix.dims(rows.limit(0)).first().asDict() == {"n_rows": 0, "n_cols": 0}
    cells = matrix.to_coo(rows)
    turned = {(r.row_id, r.col_id): r.value for r in matrix.transpose(cells).collect()}
    assert turned == {(0, 0): 1, (1, 0): 2, (2, 0): 3, (0, 1): 4, (1, 1): 5, (2, 1): 6}
    lines = rows.orderBy("row_id").select(matrix.render("values").alias("line")).collect()
    assert [r.line for r in lines] == ["1\t2\t3", "4\t5\t6"]
    matrix.show_matrix(rows, 9)
    matrix.show_vector(matrix.matvec(cells, vector_df(spark, [1, 1, 1])), 9)
    shown = capsys.readouterr().out
    assert "4\\t5\\t6" in shown and "|15" in shown


def test_row_blocks_are_bounded(spark):
    cells = [(0, c, c) for c in range(10)] + [(0, 3, 100), (1, 7, 1)]
    blocks = matrix.row_blocks(coo(spark, cells), width=4).collect()
    got = {(r.row_id, r.block_no): (r.col_ids, r["values"]) for r in blocks}
    assert got == {
        (0, 0): ([0, 1, 2, 3], [0, 1, 2, 103]),
        (0, 1): ([4, 5, 6, 7], [4, 5, 6, 7]),
        (0, 2): ([8, 9], [8, 9]),
        (1, 1): ([7], [1]),
    }


def test_any_columns_become_a_matrix(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert dict(matrix.as_matrix(df, "a", "b", "c").dtypes) == {
        "row_id": "bigint", "col_id": "bigint", "value": "bigint",
    }
    assert dict(matrix.as_vector(df, "a", "c").dtypes) == {"idx": "bigint", "value": "bigint"}
    ordered = matrix.in_row_order(spark.range(5, 0, -1).select(F.col("id").alias("row_id")))
    assert [r.row_id for r in ordered.collect()] == [1, 2, 3, 4, 5]
