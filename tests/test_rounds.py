"""The whole run on a small hand-made world, and the streams against their batch plans."""

import json
import random
from dataclasses import replace

from pyspark.sql import functions as F

from folioflow.config import FlowConfig
from folioflow.plans import classify, frontier, progress, rounds
from folioflow.schemas import columns
from folioflow.sources.store import TableStore
from folioflow.streaming import jobs

AS_OF = "2024-01-31 12:00:00"
SEED = 1


def j(value):
    return json.dumps(value, ensure_ascii=False)


def user(uid, followers=9000, statuses=100):
    return {"id": uid, "screen_name": f"u{uid}", "status_count": statuses, "followers_count": followers}


def post(sid, uid, day, text="涨了 12 个点,A股有数据", **more):
    return {"id": sid, "user_id": uid, "text": text, "created_at": f"2024-01-{day:02d} 00:00:00", **more}


def world(spark):
    quote = lambda *symbols: j({"data": {"items": [{"quote": {"symbol": s, "name": s, "current": 1}} for s in symbols]}})
    page = """<div class="cube-title"><span class="name">P</span></div><div class="cube-creator-info">
        <a class="creator" href="/10/"><span class="name">u10</span></a></div>
        <div id="cube-info"><span class="per">12.5%</span><span class="per">1%</span><span class="per">2%</span><span class="per">1.25</span></div>
        <div class="weight-list"><div class="segment"><span class="segment-name">A</span></div>
        <div class="stock"><div class="name">s</div><div class="price">1</div><span class="stock-weight">9%</span></div></div>"""
    rebalances = j({"list": [{"status": "ok", "updated_at": 1700000000000, "rebalancing_histories": [
        {"stock_symbol": "SH1", "weight": 1}, {"stock_symbol": "SH1", "weight": 2}]},
        {"rebalancing_histories": [{"stock_symbol": "SH2"}]}]})
    return rounds.Captures(
        follow_pages=spark.createDataFrame([
            (SEED, 0, j({"users": [user(10), user(11, 10), user(10, 1)]})), (SEED, 1, j({"users": [user(12)]})),
            (10, 0, j({"users": [user(11), user(13)]})), (12, 0, "blocked"),
        ], "src long, page long, payload string"),
        quotes=spark.createDataFrame([
            (10, 0, quote("SH600519", "AAPL")), (12, 0, quote("SH600519", "GOOGL")), (13, 0, quote("SZ000001", "00700")),
        ], "user_id long, seq int, payload string"),
        portfolio_lists=spark.createDataFrame([
            (10, 0, j({"list": [{"symbol": "ZH1", "name": "list name", "net_value": 1}, {"symbol": "ZH2", "name": "bare", "net_value": "2"}]})),
            (13, 0, j([{"symbol": "ZH1", "name": "list name", "net_value": 1}])),
        ], "user_id long, seq int, payload string"),
        portfolio_pages=spark.createDataFrame([("ZH1", page, None, rebalances)],
                                              "symbol string, html string, comments_html string, rebalances string"),
        timelines=spark.createDataFrame([
            (10, 0, j({"statuses": [post(100, 10, 5), post(101, 10, 4, "短"), post(102, 10, 3, type=1)]})),
            (13, 0, j({"statuses": [post(103, 13, 6, "闲聊而已,没有什么数字可看")]})),
        ], "user_id long, page long, payload string"),
        articles=spark.createDataFrame([(10, 102, "标题", "正文 2024 港股")], "user_id long, status_id long, title string, body string"),
    )


def test_whole_run(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path))
    cfg = FlowConfig(target_goal=2, batch_size=1)
    counts = rounds.run(store, world(spark), cfg, AS_OF, SEED, max_rounds=6).first()

    # The seed is read twice, its first page alone meets the quota of one the first time.
    assert rows(store.current("users"), "user_id", "followers_count") == [(10, 9000), (11, 10), (12, 9000), (13, 9000)]
    assert [r[0] for r in rows(store.current("target_users"), "user_id")] == [10, 13]
    assert counts.targets == 2 and counts.target_goal == 2
    assert rows(store.current("user_stocks"), "user_id", "stock_symbol", "market")[:2] == [(10, "AAPL", "US"), (10, "SH600519", "CN")]

    combos = {r.symbol: r for r in store.current("user_combinations").collect()}
    assert (combos["ZH2"].name, combos["ZH2"].net_value, combos["ZH2"].portfolio_last_crawled) == ("bare", 2.0, None)
    # The second visit falls into the cache time: list values overwrite, the crawl stamp stays.
    assert combos["ZH1"].name == "list name" and combos["ZH1"].user_id == 0
    assert combos["ZH1"].portfolio_last_crawled is not None
    assert rows(store.current("user_portfolio_follows"), "user_id", "symbol", "build_or_collection") == [
        (10, "ZH1", 0), (10, "ZH2", 1), (13, "ZH1", 1)]
    assert rows(store.current("portfolio_positions"), "segment_name", "stock_name") == [("A", "s")]
    assert rows(store.current("portfolio_transactions"), "stock_symbol", "prev_weight") == [("SH1", 1.0)]
    assert rows(store.log("quarantine"), "source", "reason", "payload")[0] == ("follow_pages", "payload is no JSON", "blocked")
    assert rows(store.log("quarantine"), "reason") == [("payload is no JSON",), ("trade without a time",)]

    statuses = {r.status_id: r for r in store.current("raw_statuses").collect()}
    assert statuses[102].description == "【长文标题】标题\n正文 2024 港股"
    labels = dict(rows(store.current("value_comments"), "comment_id", "category"))
    assert labels[100] == "A股" and labels[102] == "港股" and 101 not in labels
    assert statuses[101].is_analyzed == 1


def test_steps_can_be_repeated(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.create_tables()
    cfg, cap = FlowConfig(batch_size=1), world(spark)
    tables = ["users", "high_quality_users", "target_users", "user_combinations", "portfolio_positions", "raw_statuses", "value_comments"]

    def run(first, last):
        for number in range(first, last + 1):
            rounds.run_round(store, cap, cfg, AS_OF, number, SEED, classify.RuleScorer())
        return {t: rows(store.current(t).select(*[F.col(c).cast("string") for c in store.current(t).columns])) for t in tables}

    once = run(1, 2)
    assert run(2, 2) == once


def shown(store, rows):
    tables = ["users", "high_quality_users", "target_users", "user_combinations", "portfolio_positions", "raw_statuses", "value_comments"]
    return {t: rows(store.current(t).select(*[F.col(c).cast("string") for c in store.current(t).columns])) for t in tables}


def test_a_run_goes_on_where_it_stopped(spark, rows, tmp_path):
    """One round, a step that is lost, and another round: as two rounds at once."""
    cfg, cap = FlowConfig(target_goal=2), world(spark)
    whole = TableStore(spark, str(tmp_path / "whole"))
    assert rounds.run(whole, cap, cfg, AS_OF, SEED, max_rounds=2).first().stopped == "round limit"

    parts = TableStore(spark, str(tmp_path / "parts"))
    rounds.run(parts, cap, cfg, AS_OF, SEED, max_rounds=1)
    rounds.mine_posts(parts, cap, cfg, AS_OF, parts.begin(rounds.STEPS + 1))  # lost before it was finished
    rounds.run(parts, cap, cfg, AS_OF, SEED, max_rounds=1)
    assert parts.finished() == whole.finished() == 2 * rounds.STEPS
    assert shown(parts, rows) == shown(whole, rows)


def test_a_seed_without_pages_stalls_nothing(spark, rows, tmp_path):
    cap = world(spark)
    cap.follow_pages = cap.follow_pages.filter(F.col("src") != SEED)
    store = TableStore(spark, str(tmp_path))
    store.create_tables()
    known = spark.range(1).select(
        F.lit(10).cast("bigint").alias("user_id"), F.lit("u10").alias("user_name"), F.lit(100).cast("bigint").alias("comments_count"),
        F.lit(0).cast("bigint").alias("friends_count"), F.lit(9000).cast("bigint").alias("followers_count"), F.lit("").alias("description"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("last_updated"))
    setup = store.writing_as("setup")
    for table in ("users", "high_quality_users"):
        setup.write(table, known, setup.begin(1))
    setup.finish(1)
    rounds.expand(store, cap, FlowConfig(target_goal=None), AS_OF, store.begin(1), SEED)
    store.finish(1)
    assert rows(store.current("users"), "user_id") == [(10,), (11,), (13,)]


def test_a_run_ends_when_a_round_changes_nothing(spark, tmp_path):
    cap = world(spark)
    for name in ("follow_pages", "quotes", "portfolio_lists", "portfolio_pages", "timelines", "articles"):
        setattr(cap, name, getattr(cap, name).limit(0))
    counts = rounds.run(TableStore(spark, str(tmp_path)), cap, FlowConfig(), AS_OF, SEED).first()
    assert counts.stopped == "nothing left to do" and counts.users == 0


def test_batches_have_one_owner(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    one, two = store.writing_as("one"), store.writing_as("two")
    assert [one.begin(1), two.begin(1), one.begin(1), one.begin(2), two.begin(2)] == [1, 2, 1, 3, 4]
    one.finish(1)
    assert one.finished() == 1 and two.finished() == 0
    assert TableStore(spark, str(tmp_path), "two").begin(3) == 5


def test_writers_at_the_same_time(spark, rows, tmp_path):
    """What was read once stays; an epoch that is run again writes the same rows."""
    store = TableStore(spark, str(tmp_path))
    store.create_tables()
    a, b, c = (store.writing_as(w) for w in "abc")

    def user(own, *ids):
        data = [(i, own.writer) for i in ids]
        own.insert("users", spark.createDataFrame(data, "user_id long, user_name string").select("*", *(
            F.lit(None).cast(kind).alias(n) for n, kind in columns("users").items() if n not in ("user_id", "user_name"))), own.begin(1), ["user_id"])

    def position(own):
        own.insert("portfolio_positions", spark.createDataFrame(
            [(1, "s", "1", "n", "2", "3"), (1, None, "1", "n", "2", "3")],
            "comb_id long, segment_name string, segment_weight string, stock_name string, stock_price string, stock_weight string"
        ).withColumn("updated_at", F.lit(None).cast("timestamp_ntz")), own.begin(1), ["stock_name"])

    assert (a.begin(1), b.begin(1)) == (1, 2)
    user(b, 1, 2)
    position(b)
    assert rows(store.current("users")) == []  # not finished
    b.finish(1)
    assert rows(store.current("users"), "user_id", "user_name") == [(1, "b"), (2, "b")]
    user(a, 1, 3)
    position(a)
    a.finish(1)
    assert rows(store.current("users"), "user_id", "user_name") == [(1, "b"), (2, "b"), (3, "a")]
    # A row with a null in its key never equals another.
    assert store.current("portfolio_positions").count() == 3
    for own, ids, kept in ((b, (1, 2), [1, 2]), (a, (1, 3), [1, 3])):
        user(own, *ids)
        own.finish(1)
        assert rows(store.log("users").filter(F.col("batch_id") == own.begin(1)), "user_id") == [(i,) for i in kept]
    user(c, 1, 2, 3, 4)
    c.finish(1)
    assert rows(store.current("users"), "user_id", "user_name") == [(1, "b"), (2, "b"), (3, "a"), (4, "c")]
    assert store.written() == {"portfolio_positions": 4, "users": 5}


def test_a_run_counts_what_it_writes(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    out = rounds.run(store, world(spark), FlowConfig(target_goal=2), AS_OF, SEED, max_rounds=1).first()
    assert out.written["users"] == store.log("users").count() > 0
    assert out.written["value_comments"] == store.log("value_comments").count()
    again = rounds.run(TableStore(spark, str(tmp_path)), world(spark), FlowConfig(target_goal=2), AS_OF, SEED, max_rounds=0).first()
    assert again.written == {}


def test_two_streams_into_one_table_lose_nothing(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    store.create_tables()
    landed = str(tmp_path / "landed")
    times = spark.range(1, 6).select(F.col("id").alias("status_id"), F.col("id").alias("user_id"), F.lit(AS_OF).cast("timestamp_ntz").alias("created_at"))
    raw(times).write.parquet(landed)
    schema = spark.read.parquet(landed).schema
    page = spark.createDataFrame([(77, 0, j({"statuses": [post(900, 77, 5)]}))], "user_id long, page long, payload string")
    page.write.parquet(str(tmp_path / "pages"))
    articles = world(spark).articles
    for checkpoint in ("first", "fresh"):
        posts = spark.readStream.schema(schema).parquet(landed)
        pages = spark.readStream.schema("user_id long, page long, payload string").parquet(str(tmp_path / "pages"))
        jobs.post_stream(posts, store, str(tmp_path / f"p-{checkpoint}"), ["status_id"]).awaitTermination()
        jobs.timeline_stream(pages, articles, store, FlowConfig(), str(tmp_path / f"t-{checkpoint}")).awaitTermination()
        assert rows(store.current("raw_statuses"), "status_id") == [(1,), (2,), (3,), (4,), (5,), (900,)]


def test_no_bounds(spark, rows, tmp_path):
    """Without bounds the first visit reads a source to its end and goes on with all users at once."""
    store = TableStore(spark, str(tmp_path))
    cfg = FlowConfig(post_quota=None, user_cap=None, target_goal=None, batch_size=None, page_cap=None)
    rounds.run(store, world(spark), cfg, AS_OF, SEED, max_rounds=1)
    assert rows(store.current("users"), "user_id") == [(10,), (11,), (12,)]
    assert rows(store.current("scan_state"), "user_id") == [(SEED,)]


def test_expansion_waits_and_caps(spark, tmp_path):
    cfg = FlowConfig(batch_size=1)
    hq = spark.range(5).select(F.col("id").alias("user_id"), F.lit(None).cast("timestamp_ntz").alias("last_updated"))
    assert progress.expansion_waits(hq, cfg, AS_OF)
    assert not progress.expansion_waits(hq.filter("user_id > 0"), cfg, AS_OF)


def test_reading_sources(spark, rows):
    cfg = FlowConfig(batch_size=1, page_cap=3)
    data = []
    for src, pages in {1: [[0], [1], [0]], 2: [[0], [0], [0]], 3: [[0], [0]]}.items():
        for page, kinds in enumerate(pages):
            data += [(src, src, page, i, src * 100 + page * 10 + i, 9000 if k else 1) for i, k in enumerate(kinds)]
    follow = spark.createDataFrame(data, "src long, rank long, page long, pos int, user_id long, followers_count long").select(
        "*", F.lit("n").alias("user_name"), F.lit(50).cast("long").alias("comments_count"), F.lit(0).cast("long").alias("friends_count"),
        F.lit("").alias("description"), F.lit(AS_OF).cast("timestamp_ntz").alias("last_updated"))
    known = spark.createDataFrame([(300,)], "user_id long")
    out = frontier.read_sources(follow, known, cfg)
    assert [r[0] for r in rows(out["users"], "user_id")] == [100, 110, 200, 210, 220, 310]
    assert rows(out["high_quality_users"], "user_id", "last_updated") == [(110, None)]
    # Source 1 met the quota, source 2 the page cap; only source 3 is finished.
    assert rows(out["scanned"]) == [(3,)]
    grown = follow.withColumn("followers_count", F.when(F.col("user_id") == 300, 9000).otherwise(F.col("followers_count")))
    again = frontier.read_sources(grown, known, cfg, reevaluate=True)
    assert [r[0] for r in rows(again["high_quality_users"], "user_id")] == [110, 300]


def test_reach_equals_breadth_first_search(spark, rows):
    import random

    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(70)]
    hop, frontier_now = {0: 0}, {0}
    for n in range(1, 9):
        frontier_now = {d for s, d in edges if s in frontier_now} - set(hop)
        hop.update({u: n for u in frontier_now})
    got = frontier.reach(spark.createDataFrame(edges, "src long, dst long"), spark.createDataFrame([(0,)], "user_id long"), 8, 3)
    assert dict(rows(got)) == hop


def test_accepted_rows_are_counted_while_written(spark, tmp_path):
    from pyspark.sql import Observation

    seen = Observation("accepted")
    progress.observed(spark.range(7), seen).write.parquet(str(tmp_path / "out"))
    assert seen.get["rows"] == 7
    assert progress.accepted_counts(spark.range(7).selectExpr("id % 2 AS k"), ["k"]).count() == 2


class FailsOnDigits:
    def score(self, text):
        if "7" in text:
            raise RuntimeError("model unavailable")
        return "no json" if "8" in text else '{"valuable": true, "cat": "A股"}'


def test_scorer_failures_stay_with_their_row(spark, rows):
    texts = ["a long enough text", "a long enough text 7", "a long enough text 8", "<b>short</b>", None]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "status_id long, description string, is_analyzed int")
    got = classify.score_posts(classify.queue(df), FailsOnDigits(), FlowConfig())
    assert rows(got, "status_id", "is_analyzed", "category") == [
        (0, 1, "A股"), (1, 2, None), (2, 2, None), (3, 1, None), (4, 1, None)]
    assert classify.queue(df, 2).count() == 2


class Batches:
    """Set up once per worker; a batch that holds a 7 fails as a whole."""

    def open(self):
        self.calls = 0
        return self

    def score_batch(self, texts):
        self.calls += 1
        if any("7" in t for t in texts):
            raise RuntimeError("no sevens")
        return ["no json" if "8" in t else '{"valuable": true, "cat": "A股"}' for t in texts]


class TooFew:
    def score_batch(self, texts):
        return ['{"valuable": true}'] * (len(texts) - 1 if len(texts) > 1 else 1)


def test_batch_scorers(spark, rows):
    texts = ["a long enough text", "a long enough text 7", "a long enough text 8", "<b>short</b>", None]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "status_id long, description string, is_analyzed int").coalesce(1)
    got = classify.score_posts(classify.queue(df), Batches(), FlowConfig())
    assert rows(got, "status_id", "is_analyzed", "category", "error") == [
        (0, 1, "A股", None), (1, 2, None, "RuntimeError: no sevens"), (2, 2, None, "reply is no JSON"), (3, 1, None, None), (4, 1, None, None)]
    # A batch with a reply too few is scored text by text.
    got = classify.score_posts(classify.queue(df), TooFew(), FlowConfig())
    assert [r[1] for r in rows(got, "status_id", "is_analyzed")] == [1] * 5
    assert classify.score_posts(df.limit(0), Batches(), FlowConfig()).count() == 0


def plain_best_first(edges, followers, start, k, cap, limit):
    known, scanned, number = {u: 0 for u in start if u in followers}, {}, 0
    rank = lambda u: (followers[u] is None, -(followers[u] or 0), u)
    while (limit is None or number < limit) and (cap is None or len(known) < cap):
        number += 1
        chosen = sorted((u for u in known if u not in scanned), key=rank)[:k]
        scanned.update({u: number for u in chosen})
        met = {}
        for src, dst in edges:
            if src in chosen and dst in followers and dst not in known:
                met[dst] = min(rank(src), met.get(dst, rank(src)))
        order = sorted(met, key=lambda u: (met[u], u))
        known.update({u: number for u in (order if cap is None else order[:cap - len(known)])})
        if not chosen:
            break
    return sorted(((u, followers[u], n, scanned.get(u)) for u, n in known.items()), key=repr)


def test_best_first_expansion(spark, rows):
    rng = random.Random(2)
    followers = {u: rng.choice([None, 5, rng.randrange(1000)]) for u in range(60)}
    edges = [(rng.randrange(70), rng.randrange(70)) for _ in range(150)]
    e = spark.createDataFrame(edges, "src long, dst long")
    p = spark.createDataFrame(list(followers.items()), "user_id long, followers_count long")
    start = spark.createDataFrame([(1,), (2,), (65,)], "user_id long")
    for k, cap, limit in ((3, None, None), (2, 25, None), (4, None, 3)):
        got = frontier.best_first(e, p, start, k, cap, limit)
        assert rows(got, "user_id", "followers_count", "found_round", "scanned_round") == plain_best_first(edges, followers, [1, 2, 65], k, cap, limit)


def test_best_first_takes_many_rounds_a_step(spark, rows, monkeypatch):
    """Rounds do not cost a write each, and what a step may hold changes nothing."""
    rng = random.Random(5)
    followers = {u: rng.choice([None, 7, rng.randrange(3000)]) for u in range(450)}
    edges = [(rng.randrange(450), rng.randrange(500)) for _ in range(2500)] + [(3, u) for u in range(0, 450, 3)]
    e = spark.createDataFrame(edges, "src long, dst long")
    p = spark.createDataFrame(list(followers.items()), "user_id long, followers_count long")
    start = spark.createDataFrame([(1,), (3,)], "user_id long")
    steps = []
    cut = frontier.cut_lineage
    monkeypatch.setattr(frontier, "cut_lineage", lambda df: steps.append(1) or cut(df))
    got = frontier.best_first(e, p, start, 4)
    expected = plain_best_first(edges, followers, [1, 3], 4, None, None)
    assert rows(got, "user_id", "followers_count", "found_round", "scanned_round") == expected
    # About 110 rounds.
    assert max(r[3] for r in expected) > 100 and len(steps) < 60
    for users, links, k, cap, limit in ((32, 3_000_000, 16, None, 12), (64, 90, 70, 300, None)):
        monkeypatch.setattr(frontier, "FIRST_USERS", users)
        monkeypatch.setattr(frontier, "MOST_USERS", 2 * users)
        monkeypatch.setattr(frontier, "MOST_LINKS", links)
        got = frontier.best_first(e, p, start, k, cap, limit)
        assert rows(got, "user_id", "followers_count", "found_round", "scanned_round") == plain_best_first(edges, followers, [1, 3], k, cap, limit)


def test_best_first_writes_do_not_grow_with_rounds_or_links(spark, rows, monkeypatch):
    """However little is looked at at once, the loop puts down a few tables; links repeat, lead nowhere or lack an end."""
    rng = random.Random(11)
    followers = {u: rng.choice([None, 7, rng.randrange(400)]) for u in range(300)}
    edges = [(rng.randrange(300), rng.randrange(330)) for _ in range(900)] + [(5, u) for u in range(0, 300, 2)] * 2
    e = spark.createDataFrame(edges + [(None, 1), (2, None)], "src long, dst long")
    p = spark.createDataFrame([*followers.items(), (None, 3)], "user_id long, followers_count long")
    start = spark.createDataFrame([(5,), (5,), (400,)], "user_id long")
    monkeypatch.setattr(frontier, "FIRST_USERS", 16)
    monkeypatch.setattr(frontier, "MOST_USERS", 32)
    monkeypatch.setattr(frontier, "MOST_LINKS", 20)
    steps = []
    cut = frontier.cut_lineage
    monkeypatch.setattr(frontier, "cut_lineage", lambda df: steps.append(1) or cut(df))
    for k, cap, limit in ((1, None, None), (None, None, None), (300, 200, None), (3, 152, None), (2, 1, 5), (2, None, 0)):
        del steps[:]
        got = frontier.best_first(e, p, start, k, cap, limit)
        assert rows(got, "user_id", "followers_count", "found_round", "scanned_round") == plain_best_first(edges, followers, [5], k, cap, limit)
        assert len(steps) <= 4
    assert frontier.best_first(e, p.limit(0), start, 2).count() == frontier.best_first(e, p, start.limit(0), 2).count() == 0


def raw(df):
    zero = F.lit(0).cast("long")
    return df.select(
        "status_id", "user_id", F.lit("text long enough 1").alias("description"), "created_at",
        F.lit(None).cast("array<string>").alias("stock_tags"), F.lit(0).alias("is_analyzed"),
        zero.alias("forward"), zero.alias("comment_count"), zero.alias("like_count"))


def test_streams_equal_batches(spark, rows, tmp_path):
    """One file per micro-batch gives what all files at once give, where posts come in order."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("event_id").alias("status_id"), "user_id", F.col("ts").alias("created_at"))
    landed = str(tmp_path / "landed")
    for part in range(3):
        raw(events.filter((F.col("status_id") >= part * 334) & (F.col("status_id") < part * 334 + 340))).coalesce(1).write.mode("append").parquet(landed)
    schema = spark.read.parquet(landed).schema

    def source():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)

    store = TableStore(spark, str(tmp_path / "t"))
    store.create_tables()
    jobs.post_stream(source(), store, str(tmp_path / "c1"), ["status_id"]).awaitTermination()
    assert rows(store.current("raw_statuses"), "status_id") == rows(events, "status_id")
    newest = events.groupBy("user_id").agg(F.max("created_at"))
    assert rows(store.current("timeline_marks")) == rows(newest)

    jobs.label_stream(source(), store, FlowConfig(), classify.RuleScorer(), str(tmp_path / "c2")).awaitTermination()
    assert store.current("value_comments").count() == 1000
    assert store.current("raw_statuses").filter("is_analyzed = 1").count() == 1000

    # Nothing is left to do when the same source is drained again.
    jobs.label_stream(source(), store, FlowConfig(), classify.RuleScorer(), str(tmp_path / "c2")).awaitTermination()
    assert store.current("value_comments").count() == 1000


def test_timeline_stream(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    store.create_tables()
    landed, schema = str(tmp_path / "landed"), "user_id long, page long, payload string"
    batches = [[(10, 0, j({"statuses": [post(1, 10, 5), post(2, 10, 4)]}))],
               [(10, 0, j({"statuses": [post(3, 10, 6), post(1, 10, 5)]})), (11, 0, j({"statuses": [post(4, 11, 1)]}))]]
    articles = world(spark).articles
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        jobs.timeline_stream(stream, articles, store, replace(FlowConfig(), post_quota=2), str(tmp_path / "c")).awaitTermination()
    assert rows(store.current("raw_statuses"), "status_id") == [(1,), (2,), (3,), (4,)]
    assert rows(store.current("timeline_marks"), "user_id", F.dayofmonth("last_created_at")) == [(10, 6), (11, 1)]
