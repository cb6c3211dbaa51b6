"""Users, sources, quotes and targets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from folioflow.catalogue.registry import query
from folioflow.catalogue.standins import CFG, Tables, ts
from folioflow.functions import scalars as sc
from folioflow.operators.ordered import take_pages
from folioflow.operators.upsert import insert_or_replace, seen
from folioflow.plans import frontier, progress, qualify, tasks
from folioflow.session import shared_folder
from folioflow.sources import payloads
from folioflow.sources.store import TableStore

PROFILES = """
    SELECT c_custkey AS user_id, c_name AS user_name, (c_custkey * 37) % 100 AS comments_count,
        CAST(c_nationkey AS BIGINT) AS friends_count,
        CAST(floor(c_acctbal) AS BIGINT) AS followers_count, c_mktsegment AS description,
        TIMESTAMP '2024-01-31 00:00:00' AS last_updated
    FROM customer"""
QUOTES = """
    SELECT o_custkey AS user_id, p_name AS stock_name,
        CASE l_partkey % 6
            WHEN 0 THEN 'SH' || lpad(CAST(l_partkey AS VARCHAR), 6, '0')
            WHEN 1 THEN lpad(CAST(l_partkey AS VARCHAR), 5, '0')
            WHEN 2 THEN upper(substr(p_name, 1, 3))
            WHEN 3 THEN 'BRK.A'
            WHEN 4 THEN 'SZ' || lpad(CAST(l_partkey AS VARCHAR), 6, '0')
            ELSE 'GOOGL' END AS stock_symbol,
        l_extendedprice AS current_price, l_discount AS percent, l_shipdate AS updated_at,
        l_orderkey, l_linenumber
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""
MARKET = """CASE WHEN stock_symbol LIKE 'SH%' OR stock_symbol LIKE 'SZ%' THEN 'CN'
        WHEN regexp_full_match(stock_symbol, '[0-9]{5}') THEN 'HK'
        WHEN stock_symbol NOT LIKE '%.%' AND length(stock_symbol) < 5 THEN 'US'
        ELSE '未知' END"""
SCANNED = """
    SELECT DISTINCT user_id FROM events WHERE event_type = 'signup' AND user_id % 2 = 0"""


@query(f"""
    SELECT * FROM ({PROFILES}) u
    WHERE user_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def new_users_anti(t: Tables):
    """Profiles that are not known yet; known ones are the customers with a finished order."""
    known = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("user_id")).distinct()
    return frontier.new_users(t.profiles(), known, ["user_name"])


@query(f"""
    SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS last_updated) FROM ({PROFILES}) u
    WHERE followers_count > 5000 AND comments_count > 20""")
def hq_filter(t: Tables):
    return frontier.high_quality(t.profiles(), CFG)


@query("""
    WITH last AS (SELECT user_id, CASE WHEN user_id % 7 <> 0 THEN max(ts) END AS last_updated
        FROM events GROUP BY user_id)
    SELECT * FROM last WHERE last_updated IS NULL OR last_updated < TIMESTAMP '2024-01-25 00:00:00'
    ORDER BY user_id LIMIT 20""")
def pending_tasks(t: Tables):
    """The first 20 users whose task is due: the batch limit is the feature."""
    last = t.events.groupBy("user_id").agg(F.max("ts").alias("ts")).select(
        "user_id", F.when(F.col("user_id") % 7 != 0, F.col("ts")).alias("last_updated"))
    return tasks.pending_tasks(last, "2024-02-15 00:00:00", CFG.cache_days, 20)


@query("SELECT c_custkey AS user_id, c_custkey AS bare, CAST(NULL AS BIGINT) AS broken FROM customer")
def seed_link(t: Tables):
    """Profile links to ids; a bare id is itself, a link to something else gives none."""
    key = F.col("c_custkey").cast("string")
    return t.customer.select(
        sc.seed_id(F.concat(F.lit("https://people.example/u/"), key)).alias("user_id"), sc.seed_id(key).alias("bare"),
        sc.seed_id(F.concat(F.lit("https://people.example/u/"), key, F.lit("/about"))).alias("broken"))


@query(f"""
    WITH u AS (SELECT user_id, CASE WHEN user_id % 4 = 0 THEN TIMESTAMP '2024-02-10 00:00:00'
        WHEN user_id % 2 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' END AS last_updated FROM ({PROFILES}) p)
    SELECT *, last_updated IS NULL OR last_updated < TIMESTAMP '2024-02-04 00:00:00' AS due FROM u""")
def task_lifecycle(t: Tables):
    """Promoted users are pending, are finished in two batches, and are due again after the days a task lasts."""
    store = TableStore(t.spark, f"{shared_folder(t.spark)}/tasks/{uuid.uuid4().hex}")
    store.create_tables("target_users", "task_log")
    store.insert("target_users", tasks.as_pending(t.profiles()), store.begin(1), ["user_id"])
    store.finish(1)
    for epoch, (step, day) in enumerate([(2, "2024-02-01 00:00:00"), (4, "2024-02-10 00:00:00")], 2):
        batch = store.begin(epoch)
        # On the second day those of the first are not due yet; those that are worked on anyway are finished anew.
        worked = store.current("target_users", batch).filter(F.col("user_id") % step == 0)
        store.write("task_log", tasks.finished(worked, "target_users", day), batch)
        store.finish(epoch)
    return store.current("target_users").select(
        "user_id", "last_updated", tasks.is_due(F.col("last_updated"), "2024-02-25 00:00:00", CFG.cache_days).alias("due"))


@query(f"""
    SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'second' ELSE 'first' END AS user_name, followers_count
    FROM ({PROFILES}) p WHERE user_id % 2 = 0 OR user_id % 3 = 0""")
def two_writers(t: Tables):
    """Two writers at the same time, with keys in common: the one that finishes first has them, though it
    began later, and epochs that are run again change nothing."""
    store = _two_writers(t)
    return store.current("users").select("user_id", "user_name", "followers_count")


@query(f"""
    WITH u AS (SELECT user_id FROM ({PROFILES}) p)
    SELECT 'users' AS table_name, count_if(user_id % 2 = 0) + count_if(user_id % 3 = 0) AS n_written,
        count_if(user_id % 2 = 0 OR user_id % 3 = 0) AS n_current FROM u
    UNION ALL SELECT 'target_users', 0, 0""")
def live_counters(t: Tables):
    """Rows counted while two writers put them down, repeated epochs once, beside the rows that are read
    (one row per table)."""
    store = _two_writers(t)
    store.write("target_users", tasks.as_pending(t.profiles()).filter("user_id IS NULL"), store.begin(1))
    store.finish(1)
    tables = [
        store.current(table).agg(F.count(F.lit(1)).alias("n_current")).select(
            F.lit(table).alias("table_name"), F.lit(n).cast("bigint").alias("n_written"), "n_current")
        for table, n in store.written().items()]
    return tables[0].unionByName(tables[1])


def _two_writers(t: Tables) -> TableStore:
    store = TableStore(t.spark, f"{shared_folder(t.spark)}/writers/{uuid.uuid4().hex}")
    store.create_tables("users", "target_users", "task_log")
    first, second = store.writing_as("first"), store.writing_as("second")

    def insert(own: TableStore, step: int) -> None:
        rows = t.profiles().filter(F.col("user_id") % step == 0).withColumn("user_name", F.lit(own.writer))
        own.insert("users", rows, own.begin(1), ["user_id"])

    first.begin(1)
    for own, step in ((second, 3), (first, 2), (second, 3), (first, 2)):
        insert(own, step)
        own.finish(1)
    return store


@query(f"""
    SELECT user_id, user_name, followers_count FROM ({PROFILES}) u
    WHERE followers_count > 5000 AND comments_count > 20 AND user_id NOT IN ({SCANNED})
    ORDER BY followers_count DESC, user_id LIMIT 1""")
def next_source(t: Tables):
    """The unscanned high-quality user with most followers (top 1 is the feature)."""
    scanned = frontier.scanned_ids(t.scanned_keys())
    hq = frontier.high_quality(t.profiles(), CFG)
    return frontier.next_sources(hq, scanned, 1).select("user_id", "user_name", "followers_count")


@query(f"SELECT user_id, user_name FROM ({PROFILES}) u WHERE user_id IN ({SCANNED})")
def scanned_users(t: Tables):
    """Users with a scanned marker."""
    return seen(t.profiles(), frontier.scanned_ids(t.scanned_keys()), ["user_id"]).select("user_id", "user_name")


@query(f"""
    SELECT market, count(*) AS n_quotes, count(DISTINCT stock_symbol) AS n_symbols
    FROM (SELECT *, {MARKET} AS market FROM ({QUOTES}) q) m GROUP BY market""")
def market_class(t: Tables):
    return t.quotes().groupBy("market").agg(
        F.count(F.lit(1)).alias("n_quotes"), F.countDistinct("stock_symbol").alias("n_symbols"))


@query(f"""
    WITH m AS (SELECT user_id, {MARKET} AS market FROM ({QUOTES}) q),
    q AS (SELECT user_id FROM m GROUP BY user_id
        HAVING bool_or(market = 'CN') AND bool_or(market IN ('HK', 'US')))
    SELECT user_id, user_name, followers_count, CAST(NULL AS TIMESTAMP) AS last_updated,
        'known' AS outcome FROM ({PROFILES}) u WHERE user_id % 10 = 0
    UNION ALL
    SELECT user_id, user_name, followers_count, CAST(NULL AS TIMESTAMP), 'new'
        FROM ({PROFILES}) u WHERE user_id % 10 <> 0 AND user_id IN (SELECT user_id FROM q)""")
def target_qualify(t: Tables):
    """Which users become targets; every tenth one already is."""
    pending = tasks.as_pending(t.profiles())
    targets = t.customer.select(F.col("c_custkey").alias("user_id")).filter("user_id % 10 = 0")
    known, to_check = qualify.split_pending(pending, targets)
    new = qualify.new_targets(to_check, t.quotes())
    columns = ["user_id", "user_name", "followers_count", "last_updated"]
    return known.select(*columns, F.lit("known").alias("outcome")).unionByName(
        new.select(*columns, F.lit("new").alias("outcome")))


@query(f"""
    SELECT user_id, stock_name, stock_symbol, current_price, percent, market, updated_at
    FROM (SELECT *, {MARKET} AS market FROM ({QUOTES}) q) m
    QUALIFY row_number() OVER (PARTITION BY user_id, stock_symbol ORDER BY l_linenumber > 2 DESC,
        updated_at DESC, l_orderkey DESC, l_linenumber DESC, stock_name DESC, current_price DESC) = 1""")
def user_stocks_replace(t: Tables):
    """Quotes of later lines replace those of the first two."""
    quotes = t.quotes()
    order = ["updated_at", "l_orderkey", "l_linenumber", "stock_name", "current_price"]
    return insert_or_replace(
        quotes.filter("l_linenumber <= 2"), quotes.filter("l_linenumber > 2"),
        ["user_id", "stock_symbol"], order,
    ).drop("l_orderkey", "l_linenumber")


@query("""
    SELECT src, page, dst, o_orderkey FROM (
        SELECT *, coalesce(sum(n_high) OVER (PARTITION BY src ORDER BY page
            RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM (SELECT *, CAST(floor((row_number() OVER (PARTITION BY src ORDER BY o_orderkey) - 1) / 20) AS BIGINT) AS page
            FROM (SELECT o_orderkey, CAST(floor(o_custkey / 10) AS BIGINT) AS src, o_custkey AS dst,
                CAST(o_totalprice > 250000 AS INT) AS n_high FROM orders) o) r) p
    WHERE before < 15 AND page < 21""")
def source_page_quota(t: Tables):
    """Pages of all sources: at most 21 each, and no more once 15 good follows were found."""
    capped = t.follow_pages().filter(F.col("page") < CFG.page_cap)
    return take_pages(capped, ["src"], "page", F.col("high"), 15).drop("high")


@query("""
    WITH RECURSIVE edges AS (
        SELECT o_custkey AS src, (o_custkey * 7 + o_orderkey * 13) % (SELECT count(*) FROM customer) AS dst
        FROM orders),
    walk AS (
        SELECT CAST(1 AS BIGINT) AS user_id, 0 AS hop
        UNION
        SELECT dst, hop + 1 FROM walk JOIN edges ON src = user_id WHERE hop < 3)
    SELECT user_id, min(hop) AS hop FROM walk GROUP BY user_id""")
def snowball_hops(t: Tables):
    """Users within three follow steps of user 1."""
    start = t.customer.filter("c_custkey = 1").select(F.col("c_custkey").alias("user_id"))
    return frontier.reach(t.follow_edges(), start, 3)


@query("""
    WITH RECURSIVE edges AS (
        SELECT o_custkey AS src, (o_custkey * 7 + o_orderkey * 13) % (SELECT count(*) FROM customer) AS dst
        FROM orders),
    walk AS (
        SELECT CAST(1 AS BIGINT) AS user_id
        UNION
        SELECT dst FROM walk JOIN edges ON src = user_id JOIN customer ON c_custkey = dst)
    SELECT user_id, CAST(floor(c_acctbal) AS BIGINT) AS followers_count, TRUE AS scanned FROM walk JOIN customer ON c_custkey = user_id""")
def expansion_loop(t: Tables):
    """Best-first expansion from user 1 until no known user is unscanned."""
    profiles = t.customer.select(F.col("c_custkey").alias("user_id"), F.floor("c_acctbal").alias("followers_count"))
    start = t.customer.filter("c_custkey = 1").select(F.col("c_custkey").alias("user_id"))
    found = frontier.best_first(t.follow_edges(), profiles, start, k=2000)
    return found.select("user_id", "followers_count", F.col("scanned_round").isNotNull().alias("scanned"))


@query("""
    SELECT c_custkey % 5 AS src, CAST(0 AS BIGINT) AS page, 0 AS pos, c_custkey AS user_id, c_name AS user_name,
        (c_custkey * 37) % 100 AS comments_count, CAST(c_nationkey AS BIGINT) AS friends_count,
        CAST(floor(c_acctbal) AS BIGINT) AS followers_count, c_mktsegment AS description,
        TIMESTAMP '2024-01-31 00:00:00' AS last_updated FROM customer
    UNION ALL
    SELECT c_custkey % 5, 0, 2, c_custkey + 1000000000, c_name, 0, 0, 0, '',
        TIMESTAMP '2024-01-31 00:00:00' FROM customer
    UNION ALL
    SELECT c_custkey % 5, 0, 3, c_custkey + 2000000000, c_name, c_nationkey, 0, CAST(floor(c_acctbal) AS BIGINT), '7',
        TIMESTAMP '2024-01-31 00:00:00' FROM customer""")
def profile_pages(t: Tables):
    """Follow-list payloads: a full profile, one without an id, one with nothing but an id, one with
    its numbers as text, decimals or lists; and elements that are no profiles."""
    full = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("screen_name"),
        ((F.col("c_custkey") * 37) % 100).alias("status_count"),
        F.col("c_nationkey").cast("bigint").alias("friends_count"),
        F.floor("c_acctbal").cast("bigint").alias("followers_count"),
        F.col("c_mktsegment").alias("description"))
    nobody = full.withField("id", F.lit(None).cast("bigint"))
    bare = F.to_json(F.struct((F.col("c_custkey") + 1000000000).alias("id"), F.col("c_name").alias("screen_name")))
    odd = F.concat(
        F.lit('{"id":"'), (F.col("c_custkey") + 2000000000).cast("string"), F.lit('","screen_name":"'), "c_name",
        F.lit('","status_count":'), F.col("c_nationkey").cast("string"), F.lit('.5,"friends_count":["x"],"followers_count":"'),
        F.floor("c_acctbal").cast("string"), F.lit('","description":7}'))
    payload = F.concat(
        F.lit('{"users":['), F.to_json(full), F.lit(",null,"), F.to_json(nobody), F.lit(',7,"x",'), bare, F.lit(",[1],"), odd, F.lit("]}"))
    pages = t.customer.select((F.col("c_custkey") % 5).alias("src"), F.lit(0).cast("bigint").alias("page"), payload.alias("payload"))
    return payloads.follow_rows(pages, "2024-01-31 00:00:00")


@query(f"""
    WITH r AS (
        SELECT CAST(floor(o_orderkey / 500) AS BIGINT) AS src, CAST(floor(o_orderkey % 500 / 20) AS BIGINT) AS page,
            CAST(o_orderkey % 20 AS INT) AS pos,
            u.* FROM orders JOIN ({PROFILES}) u ON u.user_id = o_custkey WHERE floor(o_orderkey % 500 / 20) < 21),
    f AS (SELECT * FROM r WHERE user_id % 3 <> 0
        QUALIFY row_number() OVER (PARTITION BY src, user_id ORDER BY page, pos) = 1),
    b AS (SELECT *, coalesce(sum(CAST(followers_count > 5000 AND comments_count > 20 AS INT)) OVER (
        PARTITION BY src ORDER BY page RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM f),
    n AS (SELECT * FROM b WHERE before < 5
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY src, page, pos) = 1)
    SELECT user_id, user_name, followers_count, comments_count,
        followers_count > 5000 AND comments_count > 20 AS high_quality FROM n""")
def expansion_read(t: Tables):
    """New users and promotions from reading many sources; every third user is known already."""
    from dataclasses import replace

    rows = t.orders.select(
        F.floor(F.col("o_orderkey") / 500).alias("src"), F.floor(F.col("o_orderkey") % 500 / 20).alias("page"),
        (F.col("o_orderkey") % 20).cast("int").alias("pos"), F.col("o_custkey").alias("user_id"),
    ).withColumn("rank", F.col("src")).join(t.profiles(), "user_id")
    known = t.customer.select(F.col("c_custkey").alias("user_id")).filter("user_id % 3 = 0")
    out = frontier.read_sources(rows, known, replace(CFG, batch_size=5))
    promoted = out["high_quality_users"].select("user_id", F.lit(True).alias("high_quality"))
    return out["users"].join(promoted, "user_id", "left").select(
        "user_id", "user_name", "followers_count", "comments_count",
        F.coalesce("high_quality", F.lit(False)).alias("high_quality"))


@query("""
    SELECT l_orderkey AS user_id, CAST(l_linenumber AS INT) AS seq, CAST(0 AS INT) AS pos, l_returnflag AS stock_name,
        CASE WHEN l_partkey % 2 = 0 THEN 'SZ' || CAST(l_partkey AS VARCHAR) ELSE CAST(10000 + l_partkey AS VARCHAR) END AS stock_symbol,
        l_extendedprice AS current_price, l_discount AS percent,
        CASE WHEN l_partkey % 2 = 0 THEN 'CN' WHEN 10000 + l_partkey < 100000 THEN 'HK' ELSE '未知' END AS market,
        TIMESTAMP '2024-01-31 00:00:00' AS updated_at
    FROM lineitem WHERE l_linenumber % 5 <> 4""")
def quote_shapes(t: Tables):
    """Quote payloads in four shapes, and one that carries portfolios and gives no quotes."""
    symbol = F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("SZ"), F.col("l_partkey").cast("string")))
    code = (F.lit(10000) + F.col("l_partkey")).cast("string")
    quote = F.to_json(F.struct(
        symbol.alias("symbol"), code.alias("code"), F.col("l_returnflag").alias("name"),
        F.col("l_extendedprice").alias("current"), F.col("l_discount").alias("percent")))
    wrap = lambda a, b: F.concat(F.lit(a), "quote", F.lit(b))
    n = F.col("l_linenumber") % 5
    payload = (
        F.when(n == 0, wrap('{"data":{"items":[{"quote":', "}]}}"))
        .when(n == 1, wrap('{"data":{"items":[', ',{"symbol":""}, 7]}}'))
        .when(n == 2, wrap('{"items":[{"quote":', "}]}"))
        .when(n == 3, wrap('{"items":[', "]}"))
        .otherwise(wrap('{"x":{"net_value":null},"items":[', "]}")))
    quotes = t.lineitem.select("l_orderkey", "l_linenumber", quote.alias("quote"))
    captures = quotes.select(F.col("l_orderkey").alias("user_id"), F.col("l_linenumber").alias("seq"), payload.alias("payload"))
    return payloads.quote_rows(captures, "2024-01-31 00:00:00")


@query("""
    SELECT (SELECT count(*) FROM customer WHERE c_custkey % 10 = 0) AS targets, 5 AS target_goal,
        (SELECT count(*) FROM customer) AS users, 30 AS user_cap,
        (SELECT count(*) FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL) AS backlog,
        (SELECT count(*) FROM labels) AS labelled,
        (SELECT count(*) FROM labels WHERE quality = 1) AS valuable""", name="progress")
def progress_counts(t: Tables):
    """Counts of one round in one row."""
    category = sc.value_label(F.col("quality") == 1, F.lit("A股"))
    targets = t.customer.filter("c_custkey % 10 = 0")
    return progress.progress(t.customer, targets, t.statuses(), t.labels.select(category.alias("category")), CFG)


@query("""
    SELECT (SELECT count(*) FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL) >= 25 AS reached""")
def backlog_gate(t: Tables):
    """Are at least 25 posts pending? The bound is the feature: the scan may stop there."""
    return progress.has_at_least(t.statuses().filter("is_analyzed = 0"), 25)


@query("""
    SELECT 'SCANNED_FOLLOWERS_' || CAST(user_id AS VARCHAR) AS key, max(strftime(ts, '%Y-%m-%d')) AS value
    FROM events WHERE event_type = 'signup' GROUP BY user_id
    UNION ALL
    SELECT 'COMMENTS_LAST_CRAWLED_' || CAST(user_id AS VARCHAR), strftime(arg_max(ts, (event_id % 2, event_id)), '%Y-%m-%d %H:%M:%S')
    FROM events GROUP BY user_id""")
def meta_upsert(t: Tables):
    """Key/value state: odd events arrive after even ones and replace their keys' values."""
    marks = t.posts().select(
        sc.mark_key(F.col("user_id")).alias("key"), sc.time_text(F.col("ts")).alias("value"), "event_id")
    stored = marks.filter("event_id % 2 = 0")
    arriving = marks.filter("event_id % 2 = 1")
    scans = t.posts().filter("event_type = 'signup'").select(
        sc.scanned_key(F.col("user_id")).alias("key"),
        F.date_format("ts", "yyyy-MM-dd").alias("value"), "event_id")
    none = scans.limit(0)
    return insert_or_replace(stored, arriving, ["key"], ["event_id"]).unionByName(
        insert_or_replace(none, scans, ["key"], ["event_id"])).drop("event_id")
