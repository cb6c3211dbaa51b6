"""Work that depends on row order within a key, without putting a whole key into one task.

A plain window over a key holds all its rows in one task. Here a key's rows are cut into
blocks that follow the order; each block is worked on by itself, and what one block hands to
the next (a row count, a last value) travels in a table with one row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioflow.operators.dedup import best_per_key
from folioflow.session import cut_lineage

DENSE_BLOCK = 65_536


def dense_block(position: Column, width: int = DENSE_BLOCK) -> Column:
    """Block of a position that is unique within its key: never more than ``width`` rows."""
    return F.floor(position / F.lit(width))


def number_rows(df: DataFrame, keys: list[str], order: list, name: str = "row_number") -> DataFrame:
    """1, 2, 3 .. per key in ``order``, which must be total within a key.

    The rows are cut into ranges of keys and order, so that a long key spans many tasks, and put
    down once in that order. What a task hands to the next is one row per key and task.
    """
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    laid = cut_lineage(ranged.select(
        F.struct(*df.columns).alias("__row"), *keys, F.spark_partition_id().alias("__part"),
        F.monotonically_increasing_id().alias("__pos")))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        laid.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__rows"), F.min("__pos").alias("__first"))
        .select(*(F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)), F.col("__part").alias("__of"), "__first",
                F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    )
    same = (F.col("__part") == F.col("__of"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{i}"))
    number = F.col("__offset") + F.col("__pos") - F.col("__first") + 1
    return laid.join(parts, same).select("__row.*", number.cast("int").alias(name))


def fill_forward(
    df: DataFrame, keys: list[str], position: str, value: Column, name: str,
    width: int = DENSE_BLOCK,
) -> DataFrame:
    """Latest non-null ``value`` at or before each row. Positions are unique within a key."""
    by_block = [*keys, "__block"]
    blocked = df.withColumn("__value", value).withColumn(
        "__block", dense_block(F.col(position), width)
    )
    upto = Window.partitionBy(*by_block).orderBy(position).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    before = Window.partitionBy(*keys).orderBy("__block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    lasts = blocked.groupBy(*by_block).agg(
        F.max_by("__value", F.when(F.col("__value").isNotNull(), F.col(position))).alias("__last")
    )
    carried = lasts.select(*by_block, F.last("__last", ignorenulls=True).over(before).alias("__carry"))
    inside = blocked.withColumn("__inside", F.last("__value", ignorenulls=True).over(upto))
    return inside.join(carried, by_block).withColumn(
        name, F.coalesce("__inside", "__carry")
    ).select(*df.columns, name)


def quota_cutoff(
    df: DataFrame, keys: list[str], page: str, accepted: Column, quota: int, name: str = "cutoff",
) -> DataFrame:
    """Per key the page of the ``quota``-th accepted row; keys that stay below have no row.

    A page is taken while fewer than ``quota`` rows were accepted on the pages before it, which
    is the same as: up to and including this page. Only ``quota`` rows per key and task are
    shuffled, however long the key is: ``session.RUNTIME_CONF`` lets that limit apply to any quota.
    """
    if quota < 1:
        raise ValueError("quota must be positive")
    top = best_per_key(df.filter(accepted).select(*keys, page), keys, [page], quota)
    reached = top.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.max(page).alias(name))
    return reached.filter(F.col("__n") >= quota).drop("__n")


def take_pages(
    df: DataFrame, keys: list[str], page: str, accepted: Column, quota: int | None,
) -> DataFrame:
    """All rows of the pages read until the quota is met; the page that crosses it is whole.

    Without a quota all pages are read.
    """
    if quota is None:
        return df
    cutoff = quota_cutoff(df, keys, page, accepted, quota, "__cutoff")
    joined = df.join(cutoff, keys, "left")
    return joined.filter(
        F.col("__cutoff").isNull() | (F.col(page) <= F.col("__cutoff"))
    ).select(*df.columns)
