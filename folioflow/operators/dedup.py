"""One row per key, with the order spelled out.

``row_number() = 1`` directly under a filter is planned with a partial group limit before the
shuffle: each task sends at most one row per key, so a key that holds a third of all rows
costs the shuffle no more than any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return best_per_key(df, keys, order, 1)


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return best_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order], 1)


def best_per_key(df: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """The first ``k`` rows of each key."""
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) <= k).drop(_RANK)


def any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def no_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def first_per_key_nulls_distinct(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """As a unique index sees it: rows with a null in the key never equal each other.

    The null rows do not take part in the shuffle at all.
    """
    complete = first_per_key(df.filter(no_null(keys)), keys, order)
    return complete.unionByName(df.filter(any_null(keys)))
