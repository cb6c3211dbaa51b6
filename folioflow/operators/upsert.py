"""Conflict rules of the tables, as joins between what is stored and what arrives.

No broadcast hints here: the stored side grows with the data, so the choice is left to the
size that adaptive execution measures. Arriving rows are unique per key before any join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioflow.operators.dedup import (
    any_null, first_per_key, first_per_key_nulls_distinct, last_per_key, no_null,
)


def unseen(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored yet. Null keys never match, so they stay."""
    return df.join(existing.select(*keys).distinct(), keys, "left_anti")


def seen(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(existing.select(*keys).distinct(), keys, "left_semi")


def insert_or_ignore(
    existing: DataFrame, arriving: DataFrame, keys: list[str], order: list,
    required: list[str] | None = None, nulls_distinct: bool = False,
) -> DataFrame:
    """The arriving rows that are stored: first one wins, a stored key wins over all.

    Rows with a null in ``required`` (the keys unless given) are skipped.
    """
    if required is None:
        required = [] if nulls_distinct else keys
    usable = arriving.filter(no_null(required)) if required else arriving
    if not nulls_distinct:
        return first_per_key(usable, keys, order).join(existing.select(*keys), keys, "left_anti")
    firsts = first_per_key_nulls_distinct(usable, keys, order)
    # Null-keyed rows can be told apart before the join and skip it.
    fresh = firsts.filter(no_null(keys)).join(existing.select(*keys), keys, "left_anti")
    return fresh.unionByName(firsts.filter(any_null(keys)))


def insert_or_replace(
    existing: DataFrame, arriving: DataFrame, keys: list[str], order: list[str],
) -> DataFrame:
    """The whole table after the batch: the last arriving row replaces the stored one."""
    tagged = existing.withColumn("__late", F.lit(0)).unionByName(
        arriving.filter(no_null(keys)).withColumn("__late", F.lit(1)), allowMissingColumns=True
    )
    return last_per_key(tagged, keys, ["__late", *order]).drop("__late")


def upsert_columns(
    existing: DataFrame, updates: DataFrame, key: str, columns: list[str],
    on_null: str = "overwrite", how: str = "full_outer",
) -> DataFrame:
    """Insert, then update ``columns`` by ``key``; every other column keeps its stored value.

    ``how='right_outer'`` gives only the rows the batch touched.
    """
    if on_null not in ("overwrite", "keep"):
        raise ValueError(f"on_null must be 'overwrite' or 'keep', not {on_null!r}")
    new = updates.select(
        F.col(key).alias("__key"), F.struct(*[c for c in updates.columns if c != key]).alias("__new")
    )
    arrived = F.col("__key").isNotNull()
    out = []
    for name in existing.columns:
        stored = F.col(name)
        if name == key:
            value = F.coalesce(stored, F.col("__key"))
        elif name in columns:
            fresh = F.col("__new")[name]
            if on_null == "keep":
                fresh = F.coalesce(fresh, stored)
            value = F.when(arrived, fresh).otherwise(stored)
        elif name in updates.columns:
            value = F.when(F.col(key).isNull(), F.col("__new")[name]).otherwise(stored)
        else:
            value = stored
        out.append(value.alias(name))
    return existing.join(new, F.col(key) == F.col("__key"), how).select(*out)


def with_latest(
    df: DataFrame, log: DataFrame, keys: list[str], column: str, order: list[str],
) -> DataFrame:
    """``df`` with ``column`` taken from the last log row of its key, where there is one."""
    latest = last_per_key(log, keys, order).select(*keys, F.struct(column).alias("__log"))
    joined = df.join(latest, keys, "left")
    value = F.when(F.col("__log").isNotNull(), F.col("__log")[column]).otherwise(F.col(column))
    return joined.withColumn(column, value).drop("__log").select(*df.columns)
