"""The star-schema and event tables seen as graphs, matrices and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from arcweave.operators.graph import as_edges
from arcweave.operators.running import previous_row
from arcweave.scratch import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_part_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and parts joined by line items; even ids are orders, odd ones parts."""
    lines = table(spark, sf_dir, "lineitem")
    return as_edges(
        lines.select(
            (F.col("l_orderkey") * 2).alias("src"), (F.col("l_partkey") * 2 + 1).alias("dst")
        )
    )


def event_chain_edges(spark: SparkSession, sf_dir: str, scratch: Scratch) -> DataFrame:
    """Each event joined to the same user's event before it, by time and id: one path per user."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    linked = previous_row(events, "user_id", ["ts", "event_id"], "event_id", "previous", scratch)
    return as_edges(linked.where("previous is not null"), "previous", "event_id")


def _whole(name: str) -> Column:
    """A column of whole numbers as bigint; a fraction raises."""
    number = F.col(name).cast("bigint")
    problem = F.raise_error(F.concat(F.lit(f"{name} is not a whole number: "), F.col(name).cast("string")))
    return F.when(F.col(name).isNull() | (number == F.col(name)), number).otherwise(problem.cast("bigint"))


def line_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities by order (row) and part (column)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("row_id"),
        F.col("l_partkey").alias("col_id"),
        _whole("l_quantity").alias("value"),
    )


def part_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes by part."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("idx"), F.col("p_size").cast("bigint").alias("value")
    )


def embedding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings in whole thousandths, one dense row each."""
    thousandths = F.transform(
        "embedding", lambda x: F.floor(x.cast("double") * 1000).cast("bigint")
    )
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), thousandths.alias("values")
    )


def first_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row of embedding 0 as a dense vector, one row ``(values)``."""
    return embedding_rows(spark, sf_dir).where("row_id = 0").select("values")


def first_embedding_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row of embedding 0 as ``(idx, value)``."""
    return first_embedding(spark, sf_dir).select(
        F.posexplode("values").alias("idx", "value")
    ).select(F.col("idx").cast("bigint"), "value")
