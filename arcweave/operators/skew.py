"""Handling of keys that hold a large part of all rows.

A key is heavy beyond ``heavy_limit`` rows: too many for one task. The limit
grows with the data, so there are always few enough heavy keys to broadcast.
Treating a key as heavy or not changes where its rows go, never the result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows a single key may hold before it is treated apart, on small inputs.
HEAVY_FLOOR = 1 << 20

# Fewer than this many keys can each hold more than 1/65536 of all rows.
MAX_HEAVY_KEYS = 1 << 16

# Rows of a just heavy key that a sample should contain.
SAMPLED_ROWS_PER_KEY = 1_000

# A join side of up to this many rows of a few bigints is broadcast.
BROADCAST_ROWS = 1_000_000


def heavy_limit(total_rows: int, floor: int = HEAVY_FLOOR) -> int:
    """Rows per key beyond which a key is heavy; below it a key fits in a task."""
    return max(floor, -(-total_rows // MAX_HEAVY_KEYS))


def heavy_keys(
    counts: DataFrame, key: str, rows: str, floor: int = HEAVY_FLOOR
) -> DataFrame | None:
    """Heavy keys of a table that holds one row count per key.

    Runs one small aggregation. Returns None when no key is heavy, which lets
    the caller keep the plain single-shuffle plan; otherwise a one-column table
    of fewer than ``MAX_HEAVY_KEYS`` rows.
    """
    total, top = counts.agg(F.sum(rows), F.max(rows)).first()
    limit = heavy_limit(total or 0, floor)
    if (top or 0) <= limit:
        return None
    return counts.where(F.col(rows) > limit).select(key)


def sampled_heavy_keys(
    df: DataFrame, key: str, floor: int = HEAVY_FLOOR
) -> tuple[frozenset[int], int]:
    """Heavy bigint keys of any table, found in a sample, and its estimated rows.

    For planning only. One pass over ``key``, of which a thousandth or less is
    shuffled. Keys with half the limit in the sample count as heavy, so a truly
    heavy one is practically never missed, and at most twice
    ``MAX_HEAVY_KEYS`` can qualify.
    """
    fraction = min(1.0, SAMPLED_ROWS_PER_KEY / floor)
    rows = df.select(F.col(key).alias("key")).where("key is not null")
    if fraction < 1.0:
        rows = rows.sample(fraction, seed=1)
    counts = rows.groupBy("key").agg(F.count("*").alias("n"))
    counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sampled, top = counts.agg(F.sum("n"), F.max("n")).first()
        total = int((sampled or 0) / fraction)
        enough = max(1.0, heavy_limit(total, floor) * fraction / 2)
        if (top or 0) <= enough:
            return frozenset(), total
        return frozenset(r.key for r in counts.where(F.col("n") > enough).collect()), total
    finally:
        counts.unpersist()


def key_table(spark: SparkSession, name: str, keys) -> DataFrame:
    """A short list of ids as a table."""
    return spark.createDataFrame(pa.table({name: pa.array(list(keys), pa.int64())}))


def join_unique(
    many: DataFrame,
    one: DataFrame,
    key: str,
    how: str = "inner",
    heavy_floor: int = HEAVY_FLOOR,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join ``many`` rows per bigint key to ``one``, which has each key once.

    ``how`` is inner, left or left_semi. A side ``one`` of checked small size
    is broadcast and ``many`` stays in place. Beyond that both are shuffled on
    the key, except for heavy keys: their few rows of ``one`` are broadcast to
    wherever ``many`` lies.
    """
    if one.count() <= broadcast_rows:
        return many.join(F.broadcast(one), key, how)
    found, _ = sampled_heavy_keys(many, key, heavy_floor)
    if not found:
        return many.join(one, key, how)
    heavy = F.broadcast(key_table(many.sparkSession, key, found))
    spread = many.join(heavy, key, "left_anti").join(one, key, how)
    hot_side = F.broadcast(one.join(heavy, key, "left_semi"))
    hot = many.join(heavy, key, "left_semi").join(hot_side, key, how)
    return spread.unionByName(hot)
