"""Portfolios, their positions, trades, comments and followers."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.catalogue.registry import ORACLES, query
from folioflow.catalogue.standins import CFG, Tables
from folioflow.functions import scalars as sc
from folioflow.operators.dedup import first_per_key, first_per_key_nulls_distinct
from folioflow.operators.upsert import insert_or_ignore, upsert_columns
from folioflow.plans import portfolio
from folioflow.sources import html, payloads

SYMBOL = "'ZH' || lpad(CAST({} AS VARCHAR), CAST(greatest(6, length(CAST({} AS VARCHAR))) AS INTEGER), '0')"
ORDER_SYMBOL = SYMBOL.format("o_orderkey", "o_orderkey")
CUSTOMER_SYMBOL = SYMBOL.format("c_custkey", "c_custkey")
LINE_SYMBOL = SYMBOL.format("l_orderkey", "l_orderkey")
AS_OF = "2024-01-31 12:00:00"
TRADES = """
    SELECT l_orderkey % 1000 AS comb, l_partkey % 20 AS stk, CAST(year(l_shipdate) AS INT) AS yr,
        l_linenumber, l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_quantity FROM lineitem"""
TRADE_ORDER = "l_linenumber, l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_quantity"
UPSERT = f"""
    WITH p AS (SELECT o_orderkey AS comb_id, {ORDER_SYMBOL} AS symbol, o_custkey AS creator_id,
        o_totalprice AS net_value, o_orderdate AS updated_at FROM orders),
    b AS (SELECT * FROM p WHERE comb_id % 3 <> 0),
    u AS (SELECT comb_id, symbol, CASE WHEN comb_id % 4 <> 0 THEN creator_id END AS creator_id,
        net_value * 2 AS net_value, updated_at FROM p WHERE comb_id % 2 = 0)
    SELECT coalesce(b.comb_id, u.comb_id) AS comb_id, coalesce(b.symbol, u.symbol) AS symbol,
        CASE WHEN u.symbol IS NULL THEN b.creator_id ELSE {{creator}} END AS creator_id,
        coalesce(u.net_value, b.net_value) AS net_value, coalesce(u.updated_at, b.updated_at) AS updated_at
    FROM b FULL JOIN u ON b.symbol = u.symbol"""


@query(f"""
    SELECT * FROM ({TRADES}) t
    QUALIFY row_number() OVER (PARTITION BY comb, stk, yr ORDER BY {TRADE_ORDER}) = 1""")
def transactions_first(t: Tables):
    return first_per_key(t.trades(), ["comb", "stk", "yr"], t.TRADE_ORDER)


@query(f"""
    SELECT *, l_linenumber <= 2 AS stored FROM ({TRADES}) t
    QUALIFY row_number() OVER (PARTITION BY comb, stk, yr ORDER BY l_linenumber > 2, {TRADE_ORDER}) = 1""")
def insert_ignore(t: Tables):
    """The table after a batch: stored trades stay, arriving ones fill the free keys."""
    keys, trades = ["comb", "stk", "yr"], t.trades()
    stored = first_per_key(trades.filter("l_linenumber <= 2"), keys, t.TRADE_ORDER)
    added = insert_or_ignore(stored, trades.filter("l_linenumber > 2"), keys, t.TRADE_ORDER)
    return stored.withColumn("stored", F.lit(True)).unionByName(added.withColumn("stored", F.lit(False)))


NULL_POSITIONS = """
    SELECT l_orderkey % 50 AS comb, l_returnflag AS seg,
        CASE WHEN l_linenumber % 3 <> 0 THEN l_linestatus END AS stock,
        l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
    FROM lineitem"""
POSITION_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(f"""
    SELECT * FROM ({NULL_POSITIONS}) p WHERE stock IS NULL
    UNION ALL
    (SELECT * FROM ({NULL_POSITIONS}) p WHERE stock IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY comb, seg, stock ORDER BY {', '.join(POSITION_ORDER)}) = 1)""")
def positions_null_distinct(t: Tables):
    """Rows with a null in the key are all kept, the others once."""
    return first_per_key_nulls_distinct(t.null_positions(), ["comb", "seg", "stock"], POSITION_ORDER)


@query("""
    WITH l AS (SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS qty, * FROM lineitem)
    SELECT l_orderkey, l_linenumber, 0 AS seg_pos, 0 AS stock_pos, l_returnflag AS segment_name, '10%' AS segment_weight,
        CAST(l_partkey AS VARCHAR) AS stock_name, qty AS stock_price, CAST(l_linenumber AS VARCHAR) AS stock_weight FROM l
    UNION ALL
    SELECT l_orderkey, l_linenumber, 0, 1, l_returnflag, '10%', CAST(l_suppkey AS VARCHAR), qty,
        CAST(l_linenumber AS VARCHAR) FROM l
    UNION ALL
    SELECT l_orderkey, l_linenumber, 1, 0, l_linestatus, '10%', NULL, NULL, NULL FROM l WHERE l_linenumber % 3 <> 1""")
def positions_explode(t: Tables):
    """Segments and stocks to rows: an empty or missing list gives one null row, null stocks none."""
    return portfolio.position_rows(t.nested_positions(), ["l_orderkey", "l_linenumber"])


@query(UPSERT.format(creator="u.creator_id"))
def portfolio_upsert_overwrite(t: Tables):
    return upsert_columns(t.portfolio_base(), t.portfolio_updates(), "symbol",
                          ["creator_id", "net_value", "updated_at"])


@query(UPSERT.format(creator="coalesce(u.creator_id, b.creator_id)"))
def portfolio_upsert_keep(t: Tables):
    return upsert_columns(t.portfolio_base(), t.portfolio_updates(), "symbol",
                          ["creator_id", "net_value", "updated_at"], on_null="keep")


# Columns of a portfolio by what they are in the table and in an update; nulls in either.
WIDE = {
    "user_id": ("CASE WHEN k % 7 <> 0 THEN o_custkey END", "CASE WHEN k % 4 = 0 THEN 0 ELSE o_custkey + 1 END"),
    "name": ("o_orderpriority", "CASE WHEN k % 5 <> 0 THEN 'new ' || o_orderpriority END"),
    "net_value": ("o_totalprice", "CASE WHEN k % 5 <> 1 THEN o_totalprice * 2 END"),
    "total_gain": ("CAST(k % 11 AS DOUBLE)", "CASE WHEN k % 5 <> 2 THEN CAST(k % 13 AS DOUBLE) END"),
    "monthly_gain": ("CAST(k % 3 AS DOUBLE)", "CASE WHEN k % 5 <> 3 THEN CAST(k % 17 AS DOUBLE) END"),
    "daily_gain": ("CAST(NULL AS DOUBLE)", "CASE WHEN k % 5 <> 4 THEN CAST(k % 19 AS DOUBLE) END"),
    "create_time": ("'2019-01-01'", "CASE WHEN k % 3 = 0 THEN '2020-02-02' END"),
    "updated_at": ("o_orderdate", "TIMESTAMP_NTZ '2024-01-31 12:00:00'"),
    "portfolio_last_crawled": ("o_orderdate", "CASE WHEN k % 2 = 0 THEN TIMESTAMP_NTZ '2024-01-31 12:00:00' END"),
    "close_at_time": ("'0'", "CASE WHEN k % 9 = 0 THEN '2023-03-03' END"),
    "description": ("o_orderstatus", "CASE WHEN k % 10 <> 0 THEN 'about ' || o_orderstatus END"),
    "is_public": ("CAST(0 AS INT)", "CAST(1 AS INT)"),
}


def _wide_sql(on_null: str) -> str:
    side = lambda i: ", ".join(f"{pair[i].replace('TIMESTAMP_NTZ', 'TIMESTAMP')} AS {name}" for name, pair in WIDE.items())
    fresh = {name: f"u.{name}" for name in WIDE}
    if on_null == "keep":
        fresh = {name: f"coalesce({'nullif(u.user_id, 0)' if name == 'user_id' else f'u.{name}'}, s.{name})" for name in WIDE}
    picked = ", ".join(f"CASE WHEN u.symbol IS NULL THEN s.{name} ELSE {fresh[name]} END AS {name}" for name in WIDE)
    return f"""
    WITH o AS (SELECT *, o_orderkey AS k, {ORDER_SYMBOL} AS symbol FROM orders),
    s AS (SELECT k AS comb_id, symbol, {side(0)} FROM o WHERE k % 3 <> 0),
    u AS (SELECT k + 1 AS comb_id, symbol, {side(1)} FROM o WHERE k % 2 = 0)
    SELECT coalesce(s.comb_id, u.comb_id) AS comb_id, coalesce(s.symbol, u.symbol) AS symbol, {picked}
    FROM s FULL JOIN u ON s.symbol = u.symbol"""


def _wide(t: Tables, on_null: str):
    rows = t.orders.withColumns({"k": F.col("o_orderkey"), "symbol": t.symbol_of("o_orderkey")})
    side = lambda i: [F.expr(pair[i]).alias(name) for name, pair in WIDE.items()]
    stored = rows.filter("k % 3 <> 0").select(F.col("k").alias("comb_id"), "symbol", *side(0))
    updates = rows.filter("k % 2 = 0").select((F.col("k") + 1).alias("comb_id"), "symbol", *side(1))
    return portfolio.merge_combinations(stored, updates, on_null)


@query(_wide_sql("overwrite"))
def portfolio_merge_overwrite(t: Tables):
    """All twelve columns of a portfolio updated at once; an absent value replaces a stored one. The
    id a portfolio has stays."""
    return _wide(t, "overwrite")


@query(_wide_sql("keep"))
def portfolio_merge_keep(t: Tables):
    """The same, where an absent value and an unknown creator keep what is stored."""
    return _wide(t, "keep")


@query(f"""
    WITH s AS (SELECT {ORDER_SYMBOL} AS symbol, CASE WHEN o_orderkey % 10 < 7 THEN o_orderdate END AS last_crawled
        FROM orders)
    SELECT symbol, last_crawled, coalesce(last_crawled >= TIMESTAMP '1997-05-28 00:00:00', false) AS skip_detail FROM s""")
def portfolio_cache_skip(t: Tables):
    """Fresh portfolios, the bound included; missing, empty and unreadable times are not fresh."""
    n = F.col("comb_id") % 10
    text = F.when(n < 7, sc.time_text(F.col("updated_at"))).when(n == 7, F.lit("")).when(n == 8, F.lit("bad"))
    stored = t.portfolios().select("symbol", sc.parsed_time(text).alias("portfolio_last_crawled"))
    items = t.portfolios().select("symbol")
    return portfolio.with_cache_state(items, stored, "1997-05-28 03:00:00", CFG.portfolio_cache_hours)


@query(f"""
    SELECT {LINE_SYMBOL} AS symbol, l_linenumber, l_partkey, l_quantity, o_orderkey AS comb_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 3 <> 0""")
def portfolio_id_lookup(t: Tables):
    """Children get their portfolio's id by symbol; those without one are left out."""
    lines = t.lineitem.select(t.symbol_of("l_orderkey").alias("symbol"), "l_linenumber", "l_partkey", "l_quantity")
    return portfolio.attach_ids(lines, t.portfolio_base())


@query(f"""
    WITH f AS (SELECT CASE WHEN l_linenumber = 1 THEN o_custkey ELSE l_partkey END AS user_id,
        {ORDER_SYMBOL} AS symbol, o_custkey AS creator_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT DISTINCT user_id, symbol, CASE WHEN user_id = creator_id THEN 0 ELSE 1 END AS build_or_collection,
        TIMESTAMP '{AS_OF}' AS follow_time FROM f""")
def follow_ownership(t: Tables):
    """Follow edges, each once: 0 where the user built the portfolio, 1 where they follow it."""
    items = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(F.col("l_linenumber") == 1, F.col("o_custkey")).otherwise(F.col("l_partkey")).alias("user_id"),
        t.symbol_of("l_orderkey").alias("symbol"), F.col("l_linenumber").alias("seq"), F.col("l_suppkey").alias("pos"))
    combinations = t.portfolios().select("symbol", F.col("creator_id").alias("user_id"))
    follows = portfolio.follow_rows(items, combinations, AS_OF)
    return first_per_key(follows, ["user_id", "symbol"], ["seq", "pos"]).drop("seq", "pos")


@query(f"""
    WITH f AS (SELECT user_id, event_id % 1000 AS comb_id, event_type AS kind, ts AS follow_time, event_id FROM events)
    SELECT user_id, {SYMBOL.format('comb_id', 'comb_id')} AS symbol, kind, follow_time, event_id FROM f
    WHERE comb_id IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0)
    QUALIFY row_number() OVER (PARTITION BY user_id, comb_id ORDER BY event_id) = 1""")
def follows_key_migration(t: Tables):
    """Follow edges from portfolio ids to symbols."""
    follows = t.events.select(
        "user_id", (F.col("event_id") % 1000).alias("comb_id"), F.col("event_type").alias("kind"),
        F.col("ts").alias("follow_time"), "event_id")
    return portfolio.migrate_follow_keys(follows, t.portfolio_base(), ["event_id"])


@query(f"""
    SELECT ('0x' || substr(md5(CAST(conv_id AS VARCHAR) || '|' || role || '|' || text || '|' ||
            CAST(CASE WHEN turn % 3 = 0 THEN 0 ELSE turn END AS VARCHAR) || '|0'), 1, 15))::BIGINT AS status_id,
        CAST(conv_id AS VARCHAR) AS symbol, CAST(NULL AS BIGINT) AS user_id, text AS content,
        TIMESTAMP '{AS_OF}' AS publish_time, CASE WHEN turn % 3 = 0 THEN 0 ELSE turn END AS like_count,
        CAST(0 AS BIGINT) AS reply_count, CAST(0 AS BIGINT) AS forward_count
    FROM conversations""")
def comment_hash_id(t: Tables):
    """Comments with hashed ids; a like count that is no whole number counts as 0."""
    likes = F.when(F.col("turn") % 3 == 0, F.lit("1.2万")).otherwise(F.concat(F.lit(" "), F.col("turn").cast("string")))
    documents = t.conversations.select(
        F.col("conv_id").cast("string").alias("symbol"),
        F.array(F.struct(F.col("role").alias("author"), F.col("text"), likes.alias("likes"),
                         F.lit("1,234").alias("comments_count"))).alias("comments"))
    return portfolio.comment_rows(documents, ["symbol"], AS_OF).drop("pos")


@query(f"""
    SELECT o_custkey AS user_id, CAST(o_orderkey % 7 AS INT) AS seq,
        CASE WHEN o_orderkey % 7 = 6 THEN 1 ELSE 0 END AS pos, {ORDER_SYMBOL} AS symbol,
        o_orderpriority AS name, CAST(CAST(o_orderkey AS BIGINT) AS VARCHAR) AS net_value
    FROM orders WHERE o_orderkey % 11 <> 0""")
def portfolio_list_shapes(t: Tables):
    """Portfolio lists wherever the payload keeps them; items without a symbol are dropped."""
    named = F.when(F.col("o_orderkey") % 11 != 0, t.symbol_of("o_orderkey")).otherwise("")
    other = F.col("o_orderkey") % 2 == 0
    item = F.to_json(F.struct(
        F.when(~other, named).alias("symbol"), F.when(other, named).alias("cube_symbol"),
        F.col("o_orderpriority").alias("name"), F.col("o_orderkey").cast("string").alias("net_value")))
    wrap = lambda a, b: F.concat(F.lit(a), "item", F.lit(b))
    n = F.col("o_orderkey") % 7
    payload = (
        F.when(n == 0, wrap("[", "]"))
        .when(n == 1, wrap('{"list":[', ',3,null]}'))
        .when(n == 2, wrap('{"data":{"stocks":[', "]}}"))
        .when(n == 3, wrap('{"data":{"items":[', "]}}"))
        .when(n == 4, wrap('{"items":[', "]}"))
        .when(n == 5, wrap('{"ZH0":', ',"total":1}'))
        # The first list found holds no portfolio, so the object's values are looked at, in page order.
        .otherwise(wrap('{"list":[1],"a":', "}")))
    items = t.orders.select("o_custkey", "o_orderkey", item.alias("item"))
    captures = items.select(F.col("o_custkey").alias("user_id"), n.cast("int").alias("seq"), payload.alias("payload"))
    return payloads.portfolio_items(captures).select("user_id", "seq", "pos", "symbol", "name", "net_value")


@query("""
    SELECT l_orderkey, l_linenumber, 0 AS reb_pos, 0 AS pos, 'SH' || CAST(l_partkey AS VARCHAR) AS stock_symbol,
        l_returnflag AS stock_name,
        CASE WHEN l_linenumber % 2 = 0 THEN 5.0 ELSE l_quantity END AS prev_weight,
        l_tax AS target_weight, l_extendedprice AS price,
        CASE WHEN l_linenumber % 3 = 0 THEN l_discount ELSE 7.5 END AS cash_value, 'success' AS status,
        strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS transaction_time,
        CASE WHEN l_suppkey % 2 = 0 THEN l_linestatus END AS notes
    FROM lineitem WHERE l_partkey % 9 <> 0""")
def rebalance_explode(t: Tables):
    """Trades out of rebalancing payloads in four shapes and both spellings."""
    later = F.col("l_linenumber") % 2 == 0
    symbol = F.when(F.col("l_partkey") % 9 != 0, F.concat(F.lit("SH"), F.col("l_partkey").cast("string"))).otherwise("")
    history = F.struct(
        F.when(later, symbol).alias("stock_symbol"), F.when(~later, symbol).alias("stockSymbol"),
        F.when(later, F.col("l_returnflag")).alias("stock_name"), F.when(~later, F.col("l_returnflag")).alias("stockName"),
        F.when(later, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("weight"), F.lit(5.0).alias("prev_weight"),
        F.col("l_tax").alias("target_weight"), F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_suppkey") % 2 == 0, F.col("l_linestatus")).alias("comment"))
    millis = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    reb = F.to_json(F.struct(
        F.lit("success").alias("status"),
        F.when(F.col("l_linenumber") % 3 != 0, F.lit(7.5)).otherwise(F.lit(0.0)).alias("cash_value"),
        F.col("l_discount").alias("cash"),
        F.when(later, millis).alias("updated_at"), F.when(~later, millis).alias("created_at"),
        F.when(later, F.array(history)).alias("rebalancing_histories"),
        F.when(~later, F.array(history)).alias("rebalancingHistories")))
    wrap = lambda a, b: F.concat(F.lit(a), "reb", F.lit(b))
    n = F.col("l_orderkey") % 4
    payload = (
        F.when(n == 0, wrap('{"list":[', ",1]}")).when(n == 1, wrap('{"data":{"list":[', "]}}"))
        .when(n == 2, wrap('{"data":[', "]}")).otherwise(wrap("[", "]")))
    documents = t.lineitem.select("l_orderkey", "l_linenumber", reb.alias("reb")).select(
        "l_orderkey", "l_linenumber", payload.alias("rebalances"))
    return payloads.trade_rows(documents, ["l_orderkey", "l_linenumber"])


@query(f"""
    WITH p AS (SELECT {ORDER_SYMBOL} AS symbol, o_orderkey % 3 = 0 AS has, * FROM orders)
    SELECT CASE WHEN has AND o_orderkey % 2 = 0 THEN o_custkey ELSE 0 END AS user_id, symbol,
        CASE WHEN has THEN 'D' || o_orderpriority ELSE o_orderpriority END AS name,
        CASE WHEN has THEN 1.25 ELSE CAST(o_custkey AS DOUBLE) END AS net_value,
        CAST(CASE WHEN has THEN 1234.5 ELSE 0.0 END AS DOUBLE) AS total_gain,
        CAST(CASE WHEN has THEN -3.0 ELSE 0.0 END AS DOUBLE) AS monthly_gain,
        CAST(CASE WHEN has THEN 0.0 ELSE 7.0 END AS DOUBLE) AS daily_gain,
        CASE WHEN has THEN '2020-01-02' END AS create_time,
        TIMESTAMP '{AS_OF}' AS updated_at,
        CASE WHEN has THEN TIMESTAMP '{AS_OF}' ELSE o_orderdate END AS portfolio_last_crawled,
        CASE WHEN has OR o_orderkey % 5 = 0 THEN '0' ELSE CAST(o_orderkey AS VARCHAR) END AS close_at_time,
        CASE WHEN has THEN 'about ' || symbol END AS description, 1 AS is_public
    FROM p""")
def portfolio_fields(t: Tables):
    """List item and detail document to one row: all fields from the document if there is one."""
    items = t.orders.select(
        t.symbol_of("o_orderkey").alias("symbol"), F.col("o_orderpriority").alias("name"),
        F.col("o_custkey").cast("string").alias("net_value"), F.lit("--").alias("total_gain"),
        F.lit(None).cast("string").alias("monthly_gain"), F.lit(" 7 ").alias("daily_gain"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey")).otherwise(0).cast("string").alias("closed_at"),
        F.col("o_orderdate").alias("last_crawled"))
    documents = t.orders.filter("o_orderkey % 3 = 0").select(
        t.symbol_of("o_orderkey").alias("symbol"), F.concat(F.lit("D"), "o_orderpriority").alias("portfolio_name"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string")).otherwise("unknown").alias("create_user_id"),
        F.lit("1.25").alias("net_worth"), F.lit("1,234.5%").alias("total_return_percentage"),
        F.lit("-3%").alias("monthly_return_percentage"), F.lit("None").alias("daily_return_percentage"),
        F.lit("2020-01-02").alias("create_time"), F.lit("").alias("close_time"),
        F.concat(F.lit("about "), t.symbol_of("o_orderkey")).alias("portfolio_description"))
    return portfolio.combination_rows(portfolio.with_detail(items, documents), AS_OF).drop("comb_id")


@query(f"""
    SELECT {ORDER_SYMBOL} AS symbol, '{{"symbol":"' || {ORDER_SYMBOL} || '","portfolio_name":"' || o_orderpriority
        || '","detailed_position":[{{"category_name":"' || o_orderstatus || '","proportion":null,"stocks":[{{"name":"'
        || CAST(o_custkey AS VARCHAR) || '","weight":"5%"}}]}}],"comments":[]}}' AS document
    FROM orders""")
def portfolio_json(t: Tables):
    """Nested documents as JSON text."""
    stock = F.struct(F.col("o_custkey").cast("string").alias("name"), F.lit("5%").alias("weight"))
    documents = t.orders.select(
        t.symbol_of("o_orderkey").alias("symbol"), F.col("o_orderpriority").alias("portfolio_name"),
        F.array(F.struct(F.col("o_orderstatus").alias("category_name"), F.lit(None).cast("string").alias("proportion"),
                         F.array(stock).alias("stocks"))).alias("detailed_position"),
        F.array().cast("array<string>").alias("comments"))
    return portfolio.portfolio_json(documents)


@query(f"""
    SELECT {CUSTOMER_SYMBOL} AS symbol, c_mktsegment AS portfolio_name, CAST(c_custkey AS VARCHAR) AS portfolio_follows,
        '12.5%' AS total_return_percentage, '-1%' AS daily_return_percentage, '3%' AS monthly_return_percentage,
        CAST(c_acctbal AS VARCHAR) AS net_worth, CAST(NULL AS VARCHAR) AS total_revenue_ranking_exceeds,
        CAST(c_custkey AS VARCHAR) AS create_user_id, 'Name ' || CAST(c_custkey AS VARCHAR) AS create_user_name,
        'about < ' || CAST(c_nationkey AS VARCHAR) AS portfolio_description, c_nationkey = 3 AS is_closed,
        CASE WHEN c_nationkey = 3 THEN '2020-01-02' END AS create_time,
        CASE WHEN c_nationkey = 3 THEN '2021-03-04' END AS close_time,
        2 AS segments, 2 AS stocks_first, 'S-' || CAST(c_nationkey AS VARCHAR) AS segment_name, '40%' AS segment_weight,
        'stock ' || CAST(c_custkey AS VARCHAR) AS stock_name, '9.9' AS stock_price, '20%' AS stock_weight
    FROM customer""")
def portfolio_pages(t: Tables):
    """Portfolio pages to nested documents. The pages are written out of the customer rows."""
    col = lambda c: F.col(c).cast("string")
    stock = ['<div class="stock"><div class="name"> stock ', col("c_custkey"),
             '</div><div class="price">9.9</div><span class="weight stock-weight">20%</span></div>']
    segment = ['<div class="segment"><span class="segment-name">S-', col("c_nationkey"),
               '</span><span class="segment-weight weight">40%</span></div>']
    closed = F.when(F.col("c_nationkey") == 3, F.concat(
        F.lit('<div class="cube-closed"><div class="text"><p>创建于：2020-01-02<p>关停时间： '),
        F.lit("2021-03-04"), F.lit("</div></div>"))).otherwise("")
    parts = [
        '<html><body><div class="cube-title"><span class="name">', col("c_mktsegment"),
        '</span><div class="cube-people-data"><span class="num">', col("c_custkey"), " 人</span></div></div>",
        '<div id="cube-info"><span class="per">12.5%</span><span class="per"> -1%</span><span class="per">3%<br></span>',
        '<b class="per">', col("c_acctbal"), "</b></div>", closed,
        '<div class="cube-creator-info"><a class="creator" href="/', col("c_custkey"), '/"><span class="name">Name ',
        col("c_custkey"), '</span></a><div class="desc"><span class="text">about &lt; ', col("c_nationkey"),
        '</span></div></div><div class="weight-list">', *stock, *segment, *stock, *stock, *segment, "</div></body></html>",
    ]
    page = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    captures = t.spread(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")).select(
        t.symbol_of("c_custkey").alias("symbol"), page.alias("html"), F.lit(None).cast("string").alias("comments_html"),
        F.lit(None).cast("string").alias("rebalances"))
    docs = html.portfolio_documents(captures)
    seg = F.col("detailed_position")[0]
    stock0 = seg["stocks"][0]
    return docs.select(
        *[c for c in docs.columns if c not in ("detailed_position", "comments", "rebalances")],
        F.size("detailed_position").alias("segments"), F.size(seg["stocks"]).alias("stocks_first"),
        seg["category_name"].alias("segment_name"), seg["proportion"].alias("segment_weight"),
        stock0["name"].alias("stock_name"), stock0["price"].alias("stock_price"), stock0["weight"].alias("stock_weight"))


@query("""
    SELECT conv_id, turn, 0 AS pos, CASE WHEN turn % 4 = 3 THEN '未知作者' ELSE role END AS author,
        CASE WHEN turn % 2 = 0 THEN text ELSE text || ' and more' END AS text,
        CAST(turn AS VARCHAR) AS likes, CASE WHEN turn % 3 = 0 THEN '0' ELSE '12' END AS comments_count
    FROM conversations""")
def comment_fragments(t: Tables):
    """Comment HTML to rows: missing authors and counts have defaults, the fuller text is taken."""
    escaped = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    turn = F.col("turn").cast("string")
    author = F.when(F.col("turn") % 4 == 3, F.lit("")).otherwise(
        F.concat(F.lit('<a class="name"> '), "role", F.lit("</a>")))
    shown = F.when(F.col("turn") % 2 == 0, F.concat(F.lit('<div class="text">'), escaped, F.lit("</div>"))).otherwise(
        F.concat(F.lit('<div class="text"><p>'), escaped, F.lit(" <b>and</b> more</div>")))
    hidden = F.lit('<script class="single-description"><i>short</i></script>')
    replies = F.when(F.col("turn") % 3 == 0, F.lit("")).otherwise(
        '<a class="x btn-status-reply"><i></i><em>12</em></a>')
    fragment = F.concat(
        F.lit('<div class="timeline"><div class="a status-item b"><div class="status-retweet-user">'), author, F.lit("</div>"),
        shown, hidden, F.lit('<a class="btn-like"><span><em>'), turn, F.lit("</em></span></a>"), replies, F.lit("</div></div>"))
    return html.comment_rows(t.conversations.select("conv_id", "turn", fragment.alias("html")), ["conv_id", "turn"])


@query("""
    WITH c AS (SELECT *, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS seg_turn
        FROM conversations)
    SELECT CAST(c.conv_id AS VARCHAR) AS symbol, c.turn AS pos, s.text AS segment_name, CAST(s.turn AS VARCHAR) AS segment_weight,
        c.text AS name, CAST(NULL AS VARCHAR) AS price, c.role AS weight
    FROM c JOIN conversations s ON s.conv_id = c.conv_id AND s.turn = c.seg_turn WHERE c.role <> 'user'""")
def segment_fill(t: Tables):
    """Holdings rows under their segment: a user turn opens one, other turns are its stocks."""
    opens = F.col("role") == "user"
    rows = t.conversations.select(
        F.col("conv_id").cast("string").alias("symbol"), F.col("turn").alias("pos"),
        F.when(opens, "segment").otherwise("stock").alias("class"),
        F.when(opens, F.col("text")).alias("segment_name"), F.when(opens, F.col("turn").cast("string")).alias("segment_weight"),
        F.col("text").alias("name"), F.lit(None).cast("string").alias("price"), F.col("role").alias("weight"))
    return html.holding_rows(rows)


@query(r"""
    WITH c AS (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS items FROM pages)
    SELECT page_id, CAST(unnest(range(len(items))) AS INT) AS pos, replace(trim(unnest(items)), '&amp;', '&') AS text FROM c""")
def html_items(t: Tables):
    """List items of the raw pages."""
    return html.element_rows(t.pages, ["page_id"], "li")


@query(ORACLES["html_items"])
def html_items_lateral(t: Tables):
    """The same through a table function in SQL, without a shuffle."""
    t.spark.udtf.register("element_texts", html.ElementTexts)
    return t.spark.sql(
        "SELECT p.page_id, e.pos, e.text FROM {pages} p, LATERAL element_texts(p.html, 'li') e", pages=t.pages.select("page_id", "html"))


@query("""
    SELECT l_orderkey, l_linenumber, CAST(round(l_discount * 100) AS DOUBLE) AS percent, CAST(1234.5 AS DOUBLE) AS thousands, CAST(0 AS DOUBLE) AS missing,
        CAST(floor(l_extendedprice) AS BIGINT) AS whole, CAST(0 AS BIGINT) AS broken,
        CASE WHEN l_linenumber % 2 = 0 THEN l_partkey ELSE 0 END AS creator
    FROM lineitem""")
def loose_number(t: Tables):
    """Numbers out of display text."""
    percent = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
    missing = F.when(F.col("l_linenumber") % 3 == 0, "--").when(F.col("l_linenumber") % 3 == 1, "None")
    creator = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_partkey").cast("string")).otherwise(F.concat(F.lit("u"), "l_partkey"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", sc.loose_number(percent).alias("percent"),
        sc.loose_number(F.lit(" 1,234.5 ")).alias("thousands"), sc.loose_number(missing).alias("missing"),
        sc.int_or_zero(F.concat(F.lit(" "), F.floor("l_extendedprice").cast("string"))).alias("whole"),
        sc.int_or_zero(F.col("l_extendedprice").cast("decimal(12,1)")).alias("broken"),
        sc.digits_or_zero(creator).alias("creator"))
