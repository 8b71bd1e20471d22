"""Integer matrix × vector products on coordinate and dense-row tables.

Coordinate form: ``matrix(row_id, col_id, value)`` and ``vector(idx, value)``,
each index once. Dense form: ``rows(row_id, values array<bigint>)``. All values
are widened to bigint before they are multiplied; overflow of 64 bits raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from arcweave.operators.skew import BROADCAST_ROWS, HEAVY_FLOOR, join_unique
from arcweave.scratch import Scratch
from arcweave.session import require_ansi

# Columns per block of a wide dense product: 32 MB of the vector.
DENSE_WIDTH = 1 << 22

# Columns whose part of the vector is broadcast at a time, 128 MB.
PASS_WIDTH = 1 << 24

# Entries per dense block when coordinates are gathered into arrays.
ROW_BLOCK = 1 << 16


def as_matrix(df: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """Any three integer columns as a coordinate matrix."""
    return df.select(
        F.col(row).cast("bigint").alias("row_id"),
        F.col(col).cast("bigint").alias("col_id"),
        F.col(value).cast("bigint").alias("value"),
    )


def as_vector(df: DataFrame, idx: str, value: str) -> DataFrame:
    """Any two integer columns as a vector."""
    return df.select(
        F.col(idx).cast("bigint").alias("idx"), F.col(value).cast("bigint").alias("value")
    )


def parse_cells(line: Column) -> Column:
    """Comma-separated integers as ``array<bigint>``; anything else raises."""
    return F.split(line, ",").cast("array<bigint>")


def to_coo(rows: DataFrame) -> DataFrame:
    """Dense rows as coordinates, one output row per element."""
    return rows.select("row_id", F.posexplode("values").alias("col_id", "value")).select(
        "row_id", F.col("col_id").cast("bigint"), F.col("value").cast("bigint")
    )


def transpose(matrix: DataFrame) -> DataFrame:
    """Rows become columns."""
    return matrix.select(
        F.col("col_id").alias("row_id"), F.col("row_id").alias("col_id"), "value"
    )


def row_blocks(matrix: DataFrame, width: int = ROW_BLOCK) -> DataFrame:
    """Coordinates gathered into ``(row_id, block_no, col_ids, values)``.

    Entries at the same position add up first, so an array never holds more
    than ``width`` elements, whatever the row holds.
    """
    cells = matrix.groupBy("row_id", "col_id").agg(F.sum("value").alias("value"))
    blocks = (
        cells.withColumn("block_no", F.expr(f"col_id div {width}"))
        .groupBy("row_id", "block_no")
        .agg(F.array_sort(F.collect_list(F.struct("col_id", "value"))).alias("cells"))
    )
    return blocks.select(
        "row_id",
        "block_no",
        F.col("cells.col_id").alias("col_ids"),
        F.col("cells.value").alias("values"),
    )


def render(values: Column | str) -> Column:
    """An array of integers as one tab-separated line."""
    return F.array_join(F.col(values) if isinstance(values, str) else values, "\t")


def dims(rows: DataFrame) -> DataFrame:
    """One row ``(n_rows, n_cols)`` of a dense matrix."""
    zero = F.lit(0).cast("bigint")
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.max(F.size("values").cast("bigint")), zero).alias("n_cols"),
    )


def products(
    matrix: DataFrame,
    vector: DataFrame,
    keep_unmatched: bool = False,
    heavy_floor: int = HEAVY_FLOOR,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(row_id, col_id, product)`` of every matrix entry and its vector element.

    Entries whose column the vector lacks are dropped, or kept with product 0.
    """
    require_ansi(matrix.sparkSession)
    how = "left" if keep_unmatched else "inner"
    side = vector.select(
        F.col("idx").cast("bigint").alias("col_id"),
        F.col("value").cast("bigint").alias("factor"),
    )
    paired = join_unique(matrix, side, "col_id", how, heavy_floor, broadcast_rows)
    product = F.col("value").cast("bigint") * F.col("factor")
    if keep_unmatched:
        product = F.coalesce(product, F.lit(0).cast("bigint"))
    return paired.select("row_id", "col_id", product.alias("product"))


def matvec(
    matrix: DataFrame,
    vector: DataFrame,
    all_rows: bool = False,
    heavy_floor: int = HEAVY_FLOOR,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(row_id, value)``: the coordinate matrix times the vector.

    Missing entries count as zero. A row none of whose columns is in the vector
    is absent from the result, or 0 with ``all_rows``.
    """
    terms = products(matrix, vector, all_rows, heavy_floor, broadcast_rows)
    return terms.groupBy("row_id").agg(F.sum("product").alias("value"))


def matvec_broadcast(matrix: DataFrame, vector: DataFrame) -> DataFrame:
    """The same as ``matvec``, which replicates a vector of up to ``BROADCAST_ROWS`` rows."""
    return matvec(matrix, vector)


def vector_array(vector: DataFrame, n_cols: int | None = None) -> DataFrame:
    """A vector as one row ``(values array<bigint>)``, ordered by index.

    As large as one dense matrix row, so meant for rows of up to some millions of
    columns; ``matvec_wide`` takes a vector of any length as it is. With ``n_cols``
    the indices must be exactly 0 to ``n_cols`` - 1. A null element raises.
    """
    if n_cols is not None:
        rows = vector.count()
        if rows != n_cols:
            raise ValueError(f"the vector has {rows} elements, expected {n_cols}")
    problem = F.raise_error(F.lit("a matrix cell or vector element is null")).cast("bigint")
    cell = F.struct("idx", F.coalesce(F.col("value").cast("bigint"), problem).alias("value"))
    return vector.agg(F.array_sort(F.collect_list(cell)).alias("cells")).select(
        F.col("cells.value").cast("array<bigint>").alias("values")
    )


def _dot(factor: Column) -> Column:
    terms = F.zip_with("values", factor, lambda a, b: a.cast("bigint") * b)
    return F.aggregate(terms, F.lit(0).cast("bigint"), lambda total, term: total + term)


def matvec_dense(rows: DataFrame, vector: DataFrame) -> DataFrame:
    """``(row_id, value)``: dense rows times a one-row table ``(values array)``.

    The vector is as wide as one matrix row, so it travels as a scalar subquery
    value and every row is multiplied where it lies: no join and no shuffle.
    Rows of another width raise, and so do nulls.
    """
    require_ansi(rows.sparkSession)
    hole = F.raise_error(F.lit("a matrix cell or vector element is null"))
    whole = F.when(F.exists("values", lambda x: x.isNull()), hole.cast("array<bigint>"))
    # The vector's own nulls are looked for once, where it is made.
    factor = vector.select(
        whole.otherwise(F.col("values").cast("array<bigint>")).alias("values")
    ).scalar()
    with_factor = rows.select("row_id", "values", factor.alias("factor"))
    holes = F.exists("values", lambda x: x.isNull())
    dot = F.when(holes, hole.cast("bigint")).otherwise(_dot(F.col("factor")))
    fits = F.size("values") == F.size("factor")
    problem = F.raise_error(F.lit("a matrix row and the vector differ in width"))
    return with_factor.select(
        "row_id", F.when(fits, dot).otherwise(problem.cast("bigint")).alias("value")
    )


def matvec_wide(
    rows: DataFrame,
    vector: DataFrame,
    width: int = DENSE_WIDTH,
    pass_width: int = PASS_WIDTH,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``(row_id, value)``: dense rows of any width times ``(idx, value)``.

    Rows are cut into blocks of ``width`` columns where they lie. The vector's
    blocks are broadcast ``pass_width`` columns at a time, so that what is
    broadcast is bounded for any width: each pass reads the rows once and leaves
    one partial sum for each row. Only these sums are shuffled. A vector of one
    pass, the usual case, is one lazy plan; more passes are run at once and keep
    their sums in ``scratch``. The vector's indices must be 0 to the rows' width
    - 1, each once, and nothing null, else this raises.
    """
    require_ansi(rows.sparkSession)
    n_cols = vector.count()
    step = max(1, pass_width // width)
    starts = range(0, max(1, -(-n_cols // width)), step)
    if len(starts) > 1 and scratch is None:
        raise ValueError(f"a vector of {n_cols} elements takes {len(starts)} passes: give a Scratch")
    wrong = F.raise_error(F.lit("a matrix row and the vector differ in width or have nulls")).cast("bigint")

    def sums(first: int) -> DataFrame:
        last = F.least(F.floor((F.size("values") - 1) / F.lit(width)).cast("int"), F.lit(first + step - 1))
        numbers = F.sequence(F.lit(first), last)
        cut = F.transform(numbers, lambda b: F.struct(b.alias("block_no"), F.slice("values", b * width + 1, width).alias("values")))
        fits = F.size("values") == n_cols
        # Rows of another width, and empty ones, keep one row that shows it.
        odd = F.array(F.struct(F.lit(-1).alias("block_no"), F.array().cast("array<bigint>").alias("values")))
        whole = F.transform("values", lambda x: x.cast("bigint"))
        blocks = rows.select("row_id", whole.alias("values")).select(
            "row_id", fits.alias("fits"), F.inline(F.when(fits & (F.size("values") > 0), cut).otherwise(odd))
        )
        joined = blocks.join(F.broadcast(_vector_blocks(vector, width, first, step)), "block_no", "left")
        right = (F.size("cells") == F.size("values")) & F.col("sound") & F.forall("values", lambda x: x.isNotNull())
        empty = F.col("fits") & (F.col("block_no") < 0)
        part = F.when(empty, F.lit(0).cast("bigint")).when(F.coalesce(right, F.lit(False)), _dot(F.col("cells.value"))).otherwise(wrong)
        return joined.select("row_id", part.alias("part")).groupBy("row_id").agg(F.sum("part").alias("value"))

    parts = [sums(first) for first in starts]
    if len(parts) == 1:
        return parts[0]
    saved = [scratch.save(part, "wide_sums") for part in parts]
    together = saved[0]
    for more in saved[1:]:
        together = together.unionByName(more)
    return together.groupBy("row_id").agg(F.sum("value").alias("value"))


def _vector_blocks(vector: DataFrame, width: int, first: int, step: int) -> DataFrame:
    """``(block_no, cells, sound)`` of ``step`` blocks; sound ones have each index once and no null."""
    cells = F.array_sort(F.collect_list(F.struct("idx", F.col("value").cast("bigint").alias("value"))))
    low, high = first * width, (first + step) * width
    block = F.floor(F.col("idx") / width).cast("int").alias("block_no")
    found = vector.where(F.col("idx").between(low, high - 1)).groupBy(block).agg(cells.alias("cells"))
    placed = F.transform(
        "cells",
        lambda cell, i: (cell["idx"] == F.col("block_no").cast("bigint") * width + i) & cell["value"].isNotNull(),
    )
    return found.select("block_no", "cells", F.forall(placed, lambda right: F.coalesce(right, F.lit(False))).alias("sound"))


def in_row_order(result: DataFrame) -> DataFrame:
    """A result vector sorted by row."""
    return result.orderBy("row_id")


def show_vector(result: DataFrame, n: int) -> None:
    """Preview: print the first ``n`` elements in row order."""
    in_row_order(result).show(n, truncate=False)


def show_matrix(rows: DataFrame, n: int) -> None:
    """Preview: print the first ``n`` dense rows, tab separated, in row order."""
    rows.orderBy("row_id").select("row_id", render("values").alias("line")).show(
        n, truncate=False
    )
