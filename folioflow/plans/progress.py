"""Counts that steer and report a run. Each gives one row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioflow.config import FlowConfig
from folioflow.functions import scalars as sc
from folioflow.plans.classify import PENDING
from folioflow.plans.tasks import is_due


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def backlog(statuses: DataFrame, name: str = "backlog") -> DataFrame:
    return statuses.agg(F.count_if(F.col("is_analyzed") == PENDING).alias(name))


def labelled(comments: DataFrame) -> DataFrame:
    """All labelled comments, and those that are not marked as low value."""
    low = F.col("category").startswith(sc.LOW_VALUE_PREFIX)
    return comments.agg(
        F.count(F.lit(1)).alias("labelled"), F.count_if(~low).alias("valuable")
    )


def progress(users: DataFrame, targets: DataFrame, statuses: DataFrame, comments: DataFrame, cfg: FlowConfig) -> DataFrame:
    """One row: targets and goal, users and cap, backlog, labelled. Scalar subqueries, no join."""
    return labelled(comments).select(
        count_rows(targets).scalar().alias("targets"),
        F.lit(cfg.target_goal).cast("int").alias("target_goal"),
        count_rows(users).scalar().alias("users"),
        F.lit(cfg.user_cap).cast("int").alias("user_cap"),
        backlog(statuses).scalar().alias("backlog"),
        "labelled", "valuable",
    )


def has_at_least(df: DataFrame, n: int) -> DataFrame:
    """Bounded test: stops looking after ``n`` rows."""
    return df.limit(n).agg((F.count(F.lit(1)) >= n).alias("reached"))


def expansion_waits(high_quality_users: DataFrame, cfg: FlowConfig, as_of) -> bool:
    if cfg.batch_size is None:
        return False
    due = high_quality_users.filter(is_due(F.col("last_updated"), as_of, cfg.cache_days))
    return has_at_least(due, cfg.batch_size * cfg.backlog_factor).first()[0]


def accepted_counts(rows: DataFrame, keys: list[str], name: str = "accepted") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def observed(df: DataFrame, observation) -> DataFrame:
    """Count accepted rows while they are written; read ``observation.get['rows']`` afterwards."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))
