"""Session settings this package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the settings the operators are written for.

    Everything else (memory, executors, shuffle partitions, the shared
    ``spark.checkpoint.dir``) belongs to the cluster and is left alone.
    """
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )


def require_ansi(spark: SparkSession) -> None:
    """Refuse to run integer arithmetic that would wrap or turn junk into null."""
    if spark.conf.get("spark.sql.ansi.enabled", "true").lower() != "true":
        raise RuntimeError(
            "spark.sql.ansi.enabled must be true: without it 64-bit sums wrap "
            "silently and unparsable numbers become null"
        )
