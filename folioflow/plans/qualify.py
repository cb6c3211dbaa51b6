"""Step 2, first half: which pending users hold both mainland and foreign stocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioflow.functions import scalars as sc
from folioflow.operators.upsert import seen, unseen
from folioflow.plans.tasks import as_pending


def split_pending(pending: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(already targets, still to check)."""
    return seen(pending, targets, ["user_id"]), unseen(pending, targets, ["user_id"])


def coverage(quotes: DataFrame) -> DataFrame:
    """Per user, which sides of the border the quotes of this batch are on."""
    market = F.col("market")
    return quotes.groupBy("user_id").agg(
        F.bool_or(market == sc.MARKET_MAINLAND).alias("has_mainland"),
        F.bool_or(market.isin(sc.MARKET_HONG_KONG, sc.MARKET_US)).alias("has_foreign"),
    )


def qualified_ids(quotes: DataFrame) -> DataFrame:
    return coverage(quotes).filter("has_mainland AND has_foreign").select("user_id")


def new_targets(to_check: DataFrame, quotes: DataFrame) -> DataFrame:
    return as_pending(to_check.join(qualified_ids(quotes), "user_id", "left_semi"))
