"""Who is due: pending and finished users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioflow.functions import scalars as sc


def cutoff(as_of, days: int) -> Column:
    return sc.moment(as_of) - F.make_dt_interval(F.lit(days))


def is_due(last_updated: Column, as_of, days: int) -> Column:
    return last_updated.isNull() | (last_updated < cutoff(as_of, days))


def take(df: DataFrame, order: list, limit: int | None) -> DataFrame:
    """The first ``limit`` rows in a stated order; 0 or None takes all."""
    return df.orderBy(*order).limit(limit) if limit else df


def pending_tasks(table: DataFrame, as_of, days: int, limit: int | None = None) -> DataFrame:
    return take(table.filter(is_due(F.col("last_updated"), as_of, days)), ["user_id"], limit)


def finished(users: DataFrame, table_name: str, as_of) -> DataFrame:
    """Status log rows for users whose task is done."""
    return users.select(
        F.lit(table_name).alias("table_name"), "user_id", sc.moment(as_of).alias("last_updated")
    )


def as_pending(profiles: DataFrame) -> DataFrame:
    """A promoted profile starts without a time stamp."""
    return profiles.withColumn("last_updated", F.lit(None).cast("timestamp_ntz"))
