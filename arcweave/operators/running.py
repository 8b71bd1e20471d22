"""Running totals that never put a whole table, or a whole hot key, in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from arcweave.operators.skew import HEAVY_FLOOR, key_table, sampled_heavy_keys
from arcweave.scratch import Scratch

# Ids are cut into blocks of 2**16 neighbouring values, and those blocks into
# super-blocks of 2**24 blocks.
BLOCK_BITS = 16
SUPER_BITS = 24

_FOLDS = {"sum": F.sum, "max": F.max}


def exclusive_running(
    df: DataFrame,
    order: str,
    value: str,
    out: str,
    by: Sequence[str] = (),
    fold: str = "sum",
) -> DataFrame:
    """Add ``out``: the fold of ``value`` over all rows with a smaller ``order``.

    ``order`` must be a bigint column, unique within each ``by`` group. An
    unpartitioned window would sort everything in one task, so the rows are
    first folded inside blocks of 2**16 ids, the block totals inside
    super-blocks, and only the super-block totals in one window. Ids have 64
    bits, so no window group outgrows 2**24 rows, however large the data.

    ``fold`` is "sum" (starting at 0) or "max" (starting at null).
    """
    combine = _FOLDS[fold]
    by = list(by)
    block, upper = "__block", "__super"

    def before(order_col: str, value_col: str, groups: list[str]):
        return combine(value_col).over(
            Window.partitionBy(*groups)
            .orderBy(order_col)
            .rowsBetween(Window.unboundedPreceding, -1)
        )

    def joined(many: DataFrame, one: DataFrame, keys: list[str]):
        # Rows without a group are a group of their own.
        one = one.withColumnsRenamed({k: f"{k}__key" for k in keys})
        same = [many[k].eqNullSafe(one[f"{k}__key"]) if k in by else many[k] == one[f"{k}__key"] for k in keys]
        return many.join(one, same).drop(*(f"{k}__key" for k in keys))

    # Never null, which spares the joins below a null filter that would make
    # their branches differ: they share one evaluation of ``df``'s shuffle.
    number = F.coalesce(F.col(order), F.lit(0).cast("bigint"))
    rows = df.withColumn(block, F.shiftright(number, BLOCK_BITS))
    blocks = (
        rows.groupBy(*by, block)
        .agg(combine(value).alias("__total"))
        .withColumn(upper, F.shiftright(block, SUPER_BITS))
    )
    supers = blocks.groupBy(*by, upper).agg(combine("__total").alias("__total"))

    supers = supers.select(*by, upper, before(upper, "__total", by).alias("__above"))
    blocks = blocks.select(
        *by, block, upper, before(block, "__total", [*by, upper]).alias("__beside")
    )
    bases = joined(blocks, supers, [*by, upper]).select(*by, block, "__beside", "__above")
    inside = rows.withColumn("__inside", before(order, value, [*by, block]))

    parts = ["__inside", "__beside", "__above"]
    if fold == "sum":
        total = sum((F.coalesce(p, F.lit(0).cast("bigint")) for p in parts[1:]),
                    F.coalesce(parts[0], F.lit(0).cast("bigint")))
    else:
        total = F.greatest(*parts)
    return joined(inside, bases, [*by, block]).select(*df.columns, total.alias(out))


def previous_row(
    df: DataFrame,
    by: str,
    order: Sequence[str],
    value: str,
    out: str,
    scratch: Scratch,
    heavy_floor: int = HEAVY_FLOOR,
) -> DataFrame:
    """Add ``out``: the ``value`` of the row before, by ``order``, of the same bigint ``by``.

    Null for the first row; rows without ``by`` are a group of their own. Without
    heavy groups, as a sample finds them at once, this is one window and one
    shuffle. Rows of heavy groups, and those without a group, are sorted across
    tasks and written, so that a window sees one task's part of a group; the
    first row of a part then takes the last one of the part before. ``order``
    should be unique within a group, else equal rows follow each other in any order.
    """
    columns = df.columns
    before = F.lag(value).over(Window.partitionBy(by).orderBy(*order)).alias(out)
    heavy, _ = sampled_heavy_keys(df, by, heavy_floor)
    unnamed = not df.where(F.col(by).isNull()).select(by).isEmpty()
    if not heavy and not unnamed:
        return df.select(*columns, before)
    keys = F.broadcast(key_table(df.sparkSession, by, heavy))
    ordinary = df.where(F.col(by).isNotNull()).join(keys, by, "left_anti").select(*columns, before)
    hot = df.join(keys, by, "left_semi").unionByName(df.where(F.col(by).isNull()))
    part = F.spark_partition_id().alias("__part")
    parts = scratch.save(hot.repartitionByRange(by, *order).select(*columns, part), "parts")
    ends = parts.groupBy(by, "__part").agg(F.max_by(value, F.struct(*order)).alias("__end"), F.count("*").alias("__rows"))
    # A row for each task that has some of a group.
    bases = ends.select(
        F.col(by).alias("__by"), F.col("__part").alias("__of"), F.lag("__end").over(Window.partitionBy(by).orderBy("__part")).alias("__before")
    )
    inside = Window.partitionBy(by, "__part").orderBy(*order)
    marked = parts.withColumn("__inside", F.lag(value).over(inside)).withColumn("__first", F.row_number().over(inside) == 1)
    joined = marked.join(bases, F.col(by).eqNullSafe(F.col("__by")) & (F.col("__part") == F.col("__of")))
    found = F.when(F.col("__first"), F.col("__before")).otherwise(F.col("__inside")).alias(out)
    return ordinary.unionByName(joined.select(*columns, found))
