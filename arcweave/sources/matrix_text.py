"""Matrix and vector in one text: a ``rows,cols`` line, the rows, the vector."""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from arcweave.operators.matrix import parse_cells
from arcweave.scratch import Scratch
from arcweave.session import require_ansi

# Input splits up to which their line counts are broadcast.
BROADCAST_SPLITS = 100_000

# The number in the name of a part file.
PART = "part-([0-9]{1,18})[^/]*$"


def file_order(file: str) -> list:
    """Files by folder, then by part number if they have one, then by name.

    Part numbers outgrow their five digits, so names alone are out of order.
    """
    path = F.col(file)
    return [
        F.regexp_extract(path, "^(.*/)", 1),
        F.coalesce(F.nullif(F.regexp_extract(path, PART, 1), F.lit("")).cast("bigint"), F.lit(-1)),
        path,
    ]


def numbered_cells(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """``(line_no, cells array<bigint>)`` of a text of comma-separated integers.

    Lines are numbered from 0 in file order (see ``file_order``). The
    text is parsed once into a table that keeps, per line, its input split and
    a number rising within it; the lines before each split then follow from
    one count per split. Nothing is sorted, and no line goes through Python.
    """
    require_ansi(spark)
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("tick"),
        parse_cells(F.col("value")).alias("cells"),
    )
    lines = scratch.save(raw, "lines")
    splits = lines.groupBy("file", "start").agg(
        F.min("tick").alias("first_tick"), F.count("*").alias("n")
    )
    # One row per input split, so this window sorts a few rows per gigabyte.
    earlier = Window.orderBy(*file_order("file"), "start").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        "file",
        "start",
        "first_tick",
        F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("bigint")).alias("lines_before"),
    )
    if splits.count() <= BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    line_no = F.col("lines_before") + F.col("tick") - F.col("first_tick")
    return lines.join(starts, ["file", "start"]).select(line_no.alias("line_no"), "cells")


@dataclass(frozen=True)
class MatrixText:
    """A parsed matrix and vector: ``rows(row_id, values)``, ``vector(idx, value)``."""

    n_rows: int
    n_cols: int
    rows: DataFrame
    vector: DataFrame


def read_dims(spark: SparkSession, path: str) -> DataFrame:
    """One row ``(n_rows, n_cols)``: the first line of the text, and no more."""
    cells = parse_cells(F.col("value"))

    def order(name: str):
        folder, _, last = name.rpartition("/")
        part = re.search(PART, name)
        return folder + "/", int(part[1]) if part else -1, last

    for name in sorted(spark.read.text(path).inputFiles(), key=order):
        head = spark.read.text(unquote(name)).where("_metadata.file_block_start = 0").limit(1)
        if head.take(1):
            return head.select(cells[0].alias("n_rows"), cells[1].alias("n_cols"))
    raise ValueError(f"{path} does not start with a rows,cols line")


def read_matrix_text(spark: SparkSession, path: str, scratch: Scratch) -> MatrixText:
    """Parse a matrix text and check it against its own header.

    Raises ValueError if the header is not two numbers, a row has a different
    number of cells, a vector line is not one number, or lines are missing or
    left over.
    """
    lines = numbered_cells(spark, path, scratch)
    header = lines.where(F.col("line_no") == 0).first()
    if header is None or len(header.cells) != 2 or min(header.cells) < 0:
        raise ValueError(f"{path} does not start with a rows,cols line")
    n_rows, n_cols = header.cells

    line_no, width = F.col("line_no"), F.size("cells")
    is_row = line_no.between(1, n_rows)
    is_vector = line_no > n_rows
    total, odd_rows, odd_vector = lines.agg(
        F.count("*"),
        F.count_if(is_row & (width != n_cols)),
        F.count_if(is_vector & (width != 1)),
    ).first()
    if odd_rows:
        raise ValueError(f"{odd_rows} matrix rows do not have {n_cols} cells")
    if odd_vector:
        raise ValueError(f"{odd_vector} vector lines are not a single number")
    if total != 1 + n_rows + n_cols:
        raise ValueError(f"{total} lines, expected 1 + {n_rows} + {n_cols}")
    return MatrixText(
        n_rows,
        n_cols,
        lines.where(is_row).select((line_no - 1).alias("row_id"), F.col("cells").alias("values")),
        lines.where(is_vector).select(
            (line_no - n_rows - 1).alias("idx"), F.col("cells")[0].alias("value")
        ),
    )


def write_matrix_text(rows: DataFrame, vector: DataFrame, path: str) -> None:
    """Write dense rows and a vector in the text layout, as ordered part files.

    Rows of different widths raise.
    """
    n_rows, n_cols, least = rows.agg(F.count("*"), F.max(F.size("values")), F.min(F.size("values"))).first()
    if least != n_cols:
        raise ValueError(f"matrix rows have {least} to {n_cols} cells")
    spark = rows.sparkSession
    header = spark.range(1).select(
        F.lit(0).alias("section"), F.col("id").alias("ordinal"),
        F.lit(f"{n_rows},{n_cols or vector.count()}").alias("line"),
    )
    body = rows.select(
        F.lit(1).alias("section"), F.col("row_id").alias("ordinal"),
        F.array_join("values", ",").alias("line"),
    )
    tail = vector.select(
        F.lit(2).alias("section"), F.col("idx").alias("ordinal"),
        F.col("value").cast("string").alias("line"),
    )
    header.unionByName(body).unionByName(tail).orderBy("section", "ordinal").select(
        "line"
    ).write.text(path)


def write_vector_text(result: DataFrame, path: str, n_rows: int | None = None) -> None:
    """Write a result vector, one number per line in row order.

    The part files are in order: read one after the other they are the vector,
    with line k for row k. Row ids must be different and not negative. With
    ``n_rows`` there is a line for each row from 0 to ``n_rows`` - 1, with 0 for
    rows the result lacks, and larger ids raise. Without it the ids must be 0, 1,
    2, ... without a gap: a missing row raises instead of shifting those after it.
    """
    total, least, most, distinct = result.agg(
        F.count("*"), F.min("row_id"), F.max("row_id"), F.count_distinct("row_id")
    ).first()
    if distinct != total:
        raise ValueError(f"{total} rows have {distinct} different ids")
    if total and (least < 0 or n_rows is not None and most >= n_rows):
        raise ValueError(f"row ids from {least} to {most}, expected 0 to {n_rows - 1 if n_rows is not None else total - 1}")
    if n_rows is None and total and most != total - 1:
        raise ValueError(f"{total} rows have ids up to {most}: give n_rows to fill the gaps with 0")
    if n_rows is not None:
        every = result.sparkSession.range(n_rows).withColumnRenamed("id", "row_id")
        result = every.join(result, "row_id", "left").select(
            "row_id", F.coalesce("value", F.lit(0)).alias("value")
        )
    result.orderBy("row_id").select(F.col("value").cast("string")).write.text(path)


def read_vector_text(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """``(row_id, value)`` of a vector text, numbered by line."""
    return numbered_cells(spark, path, scratch).select(
        F.col("line_no").alias("row_id"), F.col("cells")[0].alias("value")
    )
