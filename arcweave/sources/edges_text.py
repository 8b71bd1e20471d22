"""Edge lists as text: one ``src<TAB>dst`` line per edge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arcweave.operators.graph import as_edges

SCHEMA = "src bigint, dst bigint"


def read_edges_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Edges of a text; a line that lacks an end, or is no edge at all, raises."""
    lines = spark.read.schema(SCHEMA).option("sep", "\t").option("mode", "FAILFAST").csv(path)
    return as_edges(lines)


def write_edges_tsv(edges: DataFrame, path: str) -> None:
    edges.select("src", "dst").write.option("sep", "\t").csv(path)
