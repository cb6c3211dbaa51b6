"""Step 2, second half: portfolios with positions, trades, comments and followers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioflow.functions import scalars as sc
from folioflow.operators.dedup import first_per_key, last_per_key
from folioflow.operators.upsert import upsert_columns
from folioflow.schemas import columns
from folioflow.sources.payloads import trade_rows

COMBINATION = list(columns("user_combinations"))
UPDATED = [c for c in COMBINATION if c not in ("comb_id", "symbol")]


# --- cache ------------------------------------------------------------------

def is_fresh(last_crawled: Column, as_of, hours: int) -> Column:
    """Crawled within the last ``hours``, bound included; unknown times are not fresh."""
    edge = sc.moment(as_of) - F.make_dt_interval(hours=F.lit(hours))
    return F.coalesce(last_crawled >= edge, F.lit(False))


def with_cache_state(items: DataFrame, stored: DataFrame, as_of, hours: int) -> DataFrame:
    stamps = stored.select("symbol", F.col("portfolio_last_crawled").alias("last_crawled"))
    return items.join(stamps, "symbol", "left").withColumn(
        "skip_detail", is_fresh(F.col("last_crawled"), as_of, hours)
    )


# --- one row per portfolio --------------------------------------------------

def with_detail(items: DataFrame, documents: DataFrame) -> DataFrame:
    """List item with its detail document as ``detail``; null where there is none."""
    doc = documents.select("symbol", F.struct(*[c for c in documents.columns if c != "symbol"]).alias("detail"))
    return items.join(doc, "symbol", "left")


def combination_rows(items: DataFrame, as_of) -> DataFrame:
    """All fields from the detail document if there is one, else all from the list item."""
    has = F.col("detail").isNotNull()

    def pick(detail_field: str, item: Column | None = None) -> Column:
        return F.when(has, F.col("detail")[detail_field]).otherwise(F.lit(None) if item is None else item)

    def figure(detail_field: str, item_field: str) -> Column:
        return sc.loose_number(pick(detail_field, F.col(item_field))).alias(item_field)

    return items.select(
        sc.surrogate_id(F.col("symbol")).alias("comb_id"),
        sc.digits_or_zero(pick("create_user_id")).alias("user_id"),
        "symbol",
        pick("portfolio_name", F.col("name")).alias("name"),
        figure("net_worth", "net_value"),
        figure("total_return_percentage", "total_gain"),
        figure("monthly_return_percentage", "monthly_gain"),
        figure("daily_return_percentage", "daily_gain"),
        pick("create_time").alias("create_time"),
        sc.moment(as_of).alias("updated_at"),
        F.when(has, sc.moment(as_of)).otherwise(F.col("last_crawled")).alias("portfolio_last_crawled"),
        sc.closed_or_zero(pick("close_time", F.col("closed_at"))).alias("close_at_time"),
        pick("portfolio_description").alias("description"),
        F.lit(1).alias("is_public"),
    )


def merge_combinations(stored: DataFrame, rows: DataFrame, on_null: str, how: str = "full_outer") -> DataFrame:
    """``on_null='keep'`` also keeps a known creator when the update carries none."""
    if on_null == "keep":
        rows = rows.withColumn("user_id", F.nullif("user_id", F.lit(0).cast("bigint")))
    return upsert_columns(stored, rows, "symbol", UPDATED, on_null, how)


def attach_ids(rows: DataFrame, combinations: DataFrame) -> DataFrame:
    """Rows whose portfolio has an id, with that id."""
    return rows.join(combinations.select("symbol", "comb_id"), "symbol")


# --- children ---------------------------------------------------------------

def ownership(creator: Column, user: Column) -> Column:
    return F.when(creator == user, 0).otherwise(1)


def follow_rows(items: DataFrame, combinations: DataFrame, as_of) -> DataFrame:
    """0 where the visited user built the portfolio, 1 where they follow it."""
    creators = combinations.select("symbol", F.col("user_id").alias("creator_id"))
    return items.join(creators, "symbol", "left").select(
        "user_id", "symbol",
        ownership(F.col("creator_id"), F.col("user_id")).alias("build_or_collection"),
        sc.moment(as_of).alias("follow_time"), "seq", "pos",
    )


def position_rows(documents: DataFrame, keep: list[str], segments: str = "detailed_position") -> DataFrame:
    """Two levels of arrays to rows; a segment without stocks gives one row of null stock columns."""
    stocks = F.col("seg.stocks")
    no_stock = F.array(F.lit(None).cast("struct<name: string, price: string, weight: string>"))
    listed = F.when(F.coalesce(F.size(stocks), F.lit(0)) <= 0, no_stock).otherwise(
        F.filter(stocks, lambda s: s.isNotNull())
    )
    return (
        documents.select(*keep, F.posexplode(segments).alias("seg_pos", "seg"))
        .filter(F.col("seg").isNotNull())
        .select(
            *keep, "seg_pos",
            F.col("seg.category_name").alias("segment_name"),
            F.col("seg.proportion").alias("segment_weight"),
            F.posexplode(listed).alias("stock_pos", "stock"),
        )
        .select(
            *keep, "seg_pos", "stock_pos", "segment_name", "segment_weight",
            F.col("stock.name").alias("stock_name"), F.col("stock.price").alias("stock_price"),
            F.col("stock.weight").alias("stock_weight"),
        )
    )


COMMENT_ID_FIELDS = ("symbol", "author", "content", "like_count", "reply_count")


def comment_rows(documents: DataFrame, keep: list[str], as_of, id_fields=COMMENT_ID_FIELDS) -> DataFrame:
    """Comments with counts as numbers and an id hashed from ``id_fields``."""
    typed = (
        documents.select(*keep, F.posexplode("comments").alias("pos", "c"))
        .filter(F.col("c").isNotNull())
        .select(
            *keep, "pos", F.coalesce("c.author", F.lit("")).alias("author"),
            F.coalesce("c.text", F.lit("")).alias("content"),
            sc.int_or_zero(F.col("c.likes")).alias("like_count"),
            sc.int_or_zero(F.col("c.comments_count")).alias("reply_count"),
        )
    )
    return typed.select(
        sc.comment_id(*[F.col(f) for f in id_fields]).alias("status_id"), *keep, "pos",
        F.lit(None).cast("bigint").alias("user_id"), "content",
        sc.moment(as_of).alias("publish_time"), "like_count", "reply_count",
        F.lit(0).cast("bigint").alias("forward_count"),
    )


def migrate_follow_keys(follows: DataFrame, combinations: DataFrame, order: list) -> DataFrame:
    """Follow edges keyed by portfolio id become keyed by symbol; the first per key stays."""
    keyed = follows.join(combinations.select("comb_id", "symbol"), "comb_id").drop("comb_id")
    return first_per_key(keyed, ["user_id", "symbol"], order)


def portfolio_json(documents: DataFrame, name: str = "document") -> DataFrame:
    """The whole nested document as one JSON text."""
    return documents.select(
        "symbol", F.to_json(F.struct(*documents.columns), {"ignoreNullFields": "false"}).alias(name)
    )


# --- the batch --------------------------------------------------------------

def ingest(items: DataFrame, documents: DataFrame, stored: DataFrame, as_of, hours: int, on_null: str) -> dict[str, DataFrame]:
    """Everything one batch of portfolio lists and detail captures gives.

    ``items`` come from ``portfolio_items``. The list is cut to one row per portfolio before the
    detail documents join it, so a portfolio everybody follows is no heavier than any other.
    """
    listed = last_per_key(items, ["symbol"], ["user_id", "seq", "pos"])
    state = with_cache_state(listed, stored, as_of, hours)
    used = documents.join(state.filter("NOT skip_detail").select("symbol"), "symbol", "left_semi")
    rows = combination_rows(with_detail(state, used), as_of)
    combinations = merge_combinations(stored, rows, on_null, "right_outer").select(*COMBINATION)
    details = attach_ids(used, rows)
    trades = trade_rows(details, ["comb_id"])
    return {
        "user_combinations": combinations,
        "user_portfolio_follows": follow_rows(items, rows, as_of),
        "portfolio_positions": position_rows(details, ["comb_id"]).withColumn("updated_at", sc.moment(as_of)),
        "portfolio_transactions": trades.filter(F.col("transaction_time").isNotNull()),
        "portfolio_comments": comment_rows(details, ["symbol", "comb_id"], as_of),
        "quarantine": trades.filter(F.col("transaction_time").isNull()).select(
            F.lit("rebalances").alias("source"), F.lit("trade without a time").alias("reason"),
            F.to_json(F.struct("comb_id", "stock_symbol", "price")).alias("payload"),
        ),
    }
