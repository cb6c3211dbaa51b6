"""Landed JSON payloads to rows. One capture row in, any number of typed rows out, no shuffle.

Every list element and every field is read on its own: an element that is no object is passed over,
a number may be written as text, and only text that is no JSON at all is unreadable.
"""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from folioflow import schemas
from folioflow.functions import scalars as sc, variants as vr


# --- reading ----------------------------------------------------------------

def split_readable(captures: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    readable = F.coalesce(vr.is_readable(F.col("payload")), F.lit(False))
    bad = captures.filter(~readable).select(
        F.lit(source).alias("source"), F.lit("payload is no JSON").alias("reason"), "payload"
    )
    return captures.filter(readable), bad


@F.pandas_udf(T.BinaryType())
def _gunzip(bodies: pd.Series) -> pd.Series:
    def one(body):
        try:
            return None if body is None else gzip.decompress(body)
        except (OSError, EOFError):
            return None

    return bodies.map(one)


def body_text(body: Column, content_encoding: Column) -> Column:
    """Text of a captured response body; null where it cannot be unpacked or is no UTF-8."""
    zipped = F.coalesce(F.contains(F.lower(content_encoding), F.lit("gzip")), F.lit(False))
    # Only the zipped bodies cross to Python.
    plain = F.when(zipped, _gunzip(F.when(zipped, body))).otherwise(body)
    return F.try_validate_utf8(plain.cast("string"))


# --- follow lists -----------------------------------------------------------

def objects_under(payload: Column, key: str, fields: str) -> Column:
    """The objects of the list under ``key``, in order; null if there is no such list."""
    texts = F.from_json(F.from_json(payload, f"{key} string")[key], "array<string>")
    return F.transform(F.filter(texts, lambda x: x.startswith("{")), lambda x: F.from_json(x, fields))


def follow_rows(pages: DataFrame, as_of) -> DataFrame:
    """``(src, page, payload)`` to one profile row per followee with an id."""
    zero = F.lit(0).cast("bigint")
    number = lambda name: F.coalesce(sc.whole_number(F.col(f"u.{name}")), zero)
    return (
        pages.select("src", "page", F.posexplode(
            objects_under(F.col("payload"), "users", schemas.FOLLOWEE)).alias("pos", "u"))
        .select(
            "src", "page", "pos",
            sc.whole_number(F.col("u.id")).alias("user_id"),
            F.col("u.screen_name").alias("user_name"),
            number("status_count").alias("comments_count"),
            number("friends_count").alias("friends_count"),
            number("followers_count").alias("followers_count"),
            F.coalesce("u.description", F.lit("")).alias("description"),
            sc.moment(as_of).alias("last_updated"),
        )
        .filter(F.col("user_id").isNotNull())
    )


# --- watchlist quotes -------------------------------------------------------

def carries_portfolios(v: Column) -> Column:
    """An object with a ``net_value`` under any of its values is no quote payload."""
    return F.coalesce(
        F.exists(F.map_values(vr.as_object(v)), lambda x: vr.has_key(x, "net_value")), F.lit(False)
    )


def quote_list(v: Column) -> Column:
    data = F.try_variant_get(v, "$.data", "variant")
    return F.when(vr.has_key(data, "items"), vr.as_list(v, "$.data.items")).otherwise(
        vr.as_list(v, "$.items")
    )


def quote_rows(captures: DataFrame, as_of) -> DataFrame:
    """``(user_id, seq, payload)`` to one row per quoted stock."""
    q = F.col("q")
    return (
        captures.withColumn("v", vr.parse(F.col("payload")))
        .select("user_id", "seq", F.posexplode(
            F.when(~carries_portfolios(F.col("v")), quote_list(F.col("v")))
        ).alias("pos", "it"))
        .select(
            "user_id", "seq", "pos",
            F.when(vr.has_key(F.col("it"), "quote"), F.try_variant_get("it", "$.quote", "variant"))
            .otherwise(F.col("it")).alias("q"),
        )
        .select(
            "user_id", "seq", "pos",
            F.coalesce(vr.text(q, "$.name"), F.lit("")).alias("stock_name"),
            F.coalesce(vr.usable_text(q, "$.symbol"), vr.text(q, "$.code")).alias("stock_symbol"),
            sc.loose_number(vr.text(q, "$.current")).alias("current_price"),
            sc.loose_number(vr.text(q, "$.percent")).alias("percent"),
        )
        .filter(F.col("stock_symbol") != "")
        .withColumn("market", sc.market_class(F.col("stock_symbol")))
        .withColumn("updated_at", sc.moment(as_of))
    )


# --- portfolio lists --------------------------------------------------------

def _looks_like_portfolio(v: Column) -> Column:
    return (
        vr.usable_text(v, "$.symbol").isNotNull()
        | vr.usable_text(v, "$.cube_symbol").isNotNull()
        | vr.has_key(v, "net_value")
    )


def _holds_portfolio(values: Column) -> Column:
    return F.coalesce(F.exists(values, _looks_like_portfolio), F.lit(False))


def portfolio_list(v: Column, payload: Column) -> Column:
    """The list of portfolios wherever the payload keeps it; null if there is none.

    The values of an object come in page order: a variant has its keys sorted, a map has not.
    """
    named = F.coalesce(
        vr.as_list(v, "$.list"), vr.as_list(v, "$.data.stocks"),
        vr.as_list(v, "$.data.items"), vr.as_list(v, "$.items"),
    )
    top = vr.as_list(v)
    values = F.transform(F.map_values(F.from_json(payload, "map<string,string>")), vr.parse)
    return (
        F.when(_holds_portfolio(top), top)
        .when(_holds_portfolio(named), named)
        .when(_holds_portfolio(values), values)
    )


def portfolio_items(captures: DataFrame) -> DataFrame:
    """``(user_id, seq, payload)`` to one row per listed portfolio."""
    it = F.col("it")
    return (
        captures.withColumn("v", vr.parse(F.col("payload")))
        .select("user_id", "seq", F.posexplode(portfolio_list(F.col("v"), F.col("payload"))).alias("pos", "it"))
        .select(
            "user_id", "seq", "pos",
            F.coalesce(vr.usable_text(it, "$.symbol"), vr.text(it, "$.cube_symbol")).alias("symbol"),
            vr.text(it, "$.name").alias("name"),
            vr.text(it, "$.net_value").alias("net_value"),
            vr.text(it, "$.total_gain").alias("total_gain"),
            vr.text(it, "$.monthly_gain").alias("monthly_gain"),
            vr.text(it, "$.daily_gain").alias("daily_gain"),
            vr.text(it, "$.closed_at").alias("closed_at"),
        )
        .filter(F.col("symbol") != "")
    )


# --- rebalancing history ----------------------------------------------------

def rebalance_list(v: Column) -> Column:
    return F.coalesce(
        vr.as_list(v, "$.list"), vr.as_list(v, "$.data.list"),
        vr.as_list(v, "$.data"), vr.as_list(v),
    )


def _history_list(reb: Column) -> Column:
    first = vr.as_list(reb, "$.rebalancing_histories")
    return F.when(F.size(first) > 0, first).otherwise(vr.as_list(reb, "$.rebalancingHistories"))


def trade_rows(documents: DataFrame, keep: list[str], payload: str = "rebalances") -> DataFrame:
    """Trades of each rebalancing; cash, status and time come from the rebalancing itself."""
    r, h = F.col("r"), F.col("h")
    cash = sc.number_or(vr.number(r, "$.cash_value"), vr.number(r, "$.cash"))
    time = F.coalesce(
        vr.usable_text(r, "$.updated_at"), vr.usable_text(r, "$.created_at"),
        vr.text(r, "$.updatedAt"),
    )
    return (
        documents.select(*keep, vr.parse(F.col(payload)).alias("v"))
        .select(*keep, F.posexplode(rebalance_list(F.col("v"))).alias("reb_pos", "r"))
        .select(
            *keep, "reb_pos",
            cash.alias("cash_value"),
            vr.text(r, "$.status").alias("status"),
            sc.readable_time(time).alias("transaction_time"),
            F.posexplode(_history_list(r)).alias("pos", "h"),
        )
        .select(
            *keep, "reb_pos", "pos",
            F.coalesce(vr.usable_text(h, "$.stock_symbol"), vr.text(h, "$.stockSymbol")).alias("stock_symbol"),
            F.coalesce(vr.usable_text(h, "$.stock_name"), vr.text(h, "$.stockName")).alias("stock_name"),
            sc.number_or(vr.number(h, "$.weight"), vr.number(h, "$.prev_weight")).alias("prev_weight"),
            vr.number(h, "$.target_weight").alias("target_weight"),
            vr.number(h, "$.price").alias("price"),
            "cash_value", "status", "transaction_time",
            vr.text_only(h, "$.comment").alias("notes"),
        )
        .filter(F.col("stock_symbol") != "")
    )


# --- timelines --------------------------------------------------------------

def _tags(raw: Column) -> Column:
    """A list of tags as it is, a bare text as its only tag, an empty text as no tag."""
    return (
        F.when(raw.startswith("["), F.coalesce(F.from_json(raw, "array<string>"), F.array(raw)))
        .when(raw == "", F.array().cast("array<string>"))
        .when(raw.isNotNull(), F.array(raw))
    )


def post_rows(pages: DataFrame) -> DataFrame:
    """``(user_id, page, payload)`` to one row per post.

    A readable page without posts keeps one null post: reading ends there, and the visit counts.
    """
    found = objects_under(F.col("payload"), "statuses", schemas.POST)
    none = F.array(F.from_json(F.lit(None).cast("string"), schemas.POST))
    # Through a lambda, so that the posts are read once for both questions asked of them.
    posts = F.flatten(F.transform(F.array(found), lambda p: F.when(F.size(p) > 0, p).when(
        F.from_json("payload", "map<string,string>").isNotNull(), none)))
    s = F.col("s")
    number = lambda name: F.coalesce(sc.whole_number(s[name]), F.lit(0).cast("bigint"))
    return (
        pages.select(F.col("user_id").alias("visited_id"), "page", F.posexplode(posts).alias("pos", "s"))
        .select(
            "visited_id", "page", "pos",
            sc.whole_number(s["id"]).alias("status_id"),
            sc.whole_number(s["user_id"]).alias("user_id"),
            sc.text_or(s["text"], s["description"]).alias("description"),
            sc.readable_time(s["created_at"]).alias("created_text"),
            F.coalesce(s["type"], F.lit("0")).alias("post_type"),
            _tags(s["stockCorrelation"]).alias("stock_tags"),
            number("retweet_count").alias("forward"),
            number("reply_count").alias("comment_count"),
            number("like_count").alias("like_count"),
        )
        .withColumn("created_at", sc.parsed_time(F.col("created_text")))
    )
