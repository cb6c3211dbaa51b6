"""One round of the run: posts, then qualification and portfolios, then expansion.

Downstream work goes first, so that started users are finished before new ones are found. Each
step is one batch of the store; a step that fails halfway is repeated under the same number, and a
run that is started again goes on after the last step that was finished.
Only single-row guards come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from folioflow.config import FlowConfig
from folioflow.functions import scalars as sc, variants as vr
from folioflow.operators.upsert import seen
from folioflow.plans import classify, frontier, portfolio, progress, qualify, tasks, timeline
from folioflow.schemas import TABLES
from folioflow.session import cut_lineage
from folioflow.sources import html, landed, payloads
from folioflow.sources.store import TableStore

STEPS = 4  # batches per round, one per step


@dataclass
class Captures:
    """Landed captures, each a DataFrame.

    ``follow_pages(src, page, payload)``, ``quotes(user_id, seq, payload)``,
    ``portfolio_lists(user_id, seq, payload)``,
    ``portfolio_pages(symbol, html, comments_html, rebalances)``,
    ``timelines(user_id, page, payload)``, ``articles(user_id, status_id, title, body)``.
    """

    follow_pages: DataFrame
    quotes: DataFrame
    portfolio_lists: DataFrame
    portfolio_pages: DataFrame
    timelines: DataFrame
    articles: DataFrame


def set_aside(store: TableStore, cap: Captures, batch: int) -> None:
    """Captures that cannot be read go to ``quarantine``, each once."""
    bad = landed.set_aside({name: getattr(cap, name) for name in ("follow_pages", "quotes", "portfolio_lists", "timelines")})
    known = store.log("quarantine", batch).select("source", "reason", "payload")
    # A missing payload is a row as well.
    same = [F.col(f"bad.{c}").eqNullSafe(F.col(f"known.{c}")) for c in known.columns]
    store.write("quarantine", bad.distinct().alias("bad").join(known.alias("known"), same, "left_anti"), batch)


def mine_posts(store: TableStore, cap: Captures, cfg: FlowConfig, as_of, batch: int) -> None:
    # Users without captures stay due and do not hold up the others.
    captured = seen(store.current("target_users", batch), cap.timelines, ["user_id"])
    due = cut_lineage(tasks.pending_tasks(captured, as_of, cfg.cache_days, cfg.batch_size))
    posts = cut_lineage(payloads.post_rows(seen(cap.timelines, due, ["user_id"])))
    out = timeline.ingest(posts, store.current("timeline_marks", batch), cap.articles, cfg)
    store.insert("raw_statuses", out["raw_statuses"], batch, ["visited_id", "page", "pos"])
    store.insert("timeline_marks", out["timeline_marks"], batch, ["last_created_at"])
    # Only users with a readable page are done; the others stay due.
    store.write("task_log", tasks.finished(out["visited"], "target_users", as_of), batch)


def qualify_users(store: TableStore, cap: Captures, cfg: FlowConfig, as_of, batch: int) -> None:
    targets = store.ids("target_users", batch)
    captured = cap.quotes.select("user_id").unionByName(cap.portfolio_lists.select("user_id"))
    can_go_on = seen(store.current("high_quality_users", batch), captured.unionByName(targets), ["user_id"])
    due = cut_lineage(tasks.pending_tasks(can_go_on, as_of, cfg.cache_days, cfg.batch_size))
    done, to_check = qualify.split_pending(due, targets)

    quotes = cut_lineage(payloads.quote_rows(seen(cap.quotes, to_check, ["user_id"]), as_of))
    store.insert("user_stocks", quotes, batch, ["seq", "pos"])
    store.insert("target_users", qualify.new_targets(to_check, quotes), batch, ["user_id"])

    items = cut_lineage(payloads.portfolio_items(seen(cap.portfolio_lists, to_check, ["user_id"])))
    wanted = seen(cap.portfolio_pages, items, ["symbol"])
    documents = cut_lineage(html.portfolio_documents(wanted))
    out = portfolio.ingest(
        items, documents, store.current("user_combinations", batch), as_of,
        cfg.portfolio_cache_hours, cfg.on_null,
    )
    store.insert("user_combinations", out["user_combinations"], batch, ["updated_at"])
    orders = {
        "user_portfolio_follows": ["seq", "pos"],
        "portfolio_positions": ["seg_pos", "stock_pos"],
        "portfolio_transactions": ["reb_pos", "pos"],
        "portfolio_comments": ["pos"],
    }
    for table, order in orders.items():
        store.insert(table, out[table], batch, order)
    store.write("quarantine", out["quarantine"], batch)

    mine = seen(cap.quotes.unionByName(cap.portfolio_lists), to_check, ["user_id"])
    readable = mine.filter(vr.is_readable(F.col("payload")))
    finished = done.select("user_id").unionByName(seen(to_check, readable, ["user_id"]).select("user_id"))
    store.write("task_log", tasks.finished(finished, "high_quality_users", as_of), batch)


def expand(store: TableStore, cap: Captures, cfg: FlowConfig, as_of, batch: int, seed: int, sources: int = 1) -> None:
    users = store.current("users", batch)
    if progress.expansion_waits(store.current("high_quality_users", batch), cfg, as_of):
        return
    if cfg.user_cap is not None and progress.has_at_least(users, cfg.user_cap).first()[0]:
        return
    scanned = store.ids("scan_state", batch)
    start = store.spark.range(seed, seed + 1).select(
        F.col("id").alias("user_id"), F.lit(0).cast("bigint").alias("followers_count"),
    ).join(scanned, "user_id", "left_anti")
    # The seed is a source like any other: without a readable page it holds nobody up. Payloads are
    # parsed once, and where a seed is due only the seed's.
    readable = vr.is_readable(F.col("payload"))
    own = cap.follow_pages.join(start.select(F.col("user_id").alias("src")), "src", "left_semi").filter(readable)
    start = seen(start, own.select(F.col("src").alias("user_id")), ["user_id"])
    if start.isEmpty():
        open_users = store.current("high_quality_users", batch).join(scanned, "user_id", "left_anti")
        pages = cap.follow_pages.join(open_users.select(F.col("user_id").alias("src")), "src", "left_semi").filter(readable)
        known = seen(open_users, pages.select(F.col("src").alias("user_id")), ["user_id"])
        start = frontier.next_sources(known, scanned, sources)
    ranked = cut_lineage(start.select(
        F.col("user_id").alias("src"), (-F.coalesce("followers_count", F.lit(0))).alias("rank")))
    mine = cap.follow_pages.join(ranked, "src").filter(readable)
    rows = cut_lineage(payloads.follow_rows(mine, as_of).join(ranked, "src"))
    out = frontier.read_sources(rows, users, cfg, mine)
    store.insert("users", out["users"], batch, ["user_id"])
    store.insert("high_quality_users", out["high_quality_users"], batch, ["user_id"])
    store.write("scan_state", out["scanned"].withColumn("scanned_on", sc.moment(as_of).cast("date")), batch)


def label_posts(store: TableStore, cfg: FlowConfig, scorer: classify.Scorer, batch: int) -> None:
    """The whole backlog in one batch."""
    scored = cut_lineage(classify.score_posts(
        classify.queue(store.current("raw_statuses", batch)), scorer, cfg))
    store.insert("value_comments", classify.value_comments(scored), batch, ["comment_id"])
    store.write("status_log", classify.status_rows(scored), batch)


def _steps(cap: Captures, cfg: FlowConfig, as_of, seed: int, scorer: classify.Scorer, sources: int, look_through: bool) -> list:
    def first(store: TableStore, batch: int) -> None:
        if look_through:
            set_aside(store, cap, batch)
        mine_posts(store, cap, cfg, as_of, batch)

    return [
        first,
        lambda store, batch: qualify_users(store, cap, cfg, as_of, batch),
        lambda store, batch: expand(store, cap, cfg, as_of, batch, seed, sources),
        lambda store, batch: label_posts(store, cfg, scorer, batch),
    ]


def run_round(store: TableStore, cap: Captures, cfg: FlowConfig, as_of, number: int, seed: int,
              scorer: classify.Scorer, sources: int = 1, after: int = 0, look_through: bool = True) -> bool:
    """The steps of a round whose epoch is past ``after``. Did any of them write a row?

    Repeating a round writes the same batches again. ``look_through`` sets unreadable captures aside.
    """
    steps = _steps(cap, cfg, as_of, seed, scorer, sources, look_through)
    batches = []
    for epoch, step in enumerate(steps, STEPS * (number - 1) + 1):
        batches.append(store.begin(epoch))
        if epoch > after:
            step(store, batches[-1])
            store.finish(epoch)
    written = [
        store.log(t).filter(F.col("batch_id").isin(batches)).select("batch_id") for t in TABLES if t != "system_meta"]
    return not reduce(DataFrame.unionAll, written).isEmpty()


def _as_map(counts: dict[str, int]) -> Column:
    pairs = [F.lit(part) for table, n in counts.items() for part in (table, n)]
    return F.create_map(*pairs).cast("map<string,bigint>")


def run(store: TableStore, cap: Captures, cfg: FlowConfig, as_of, seed: int,
        scorer: classify.Scorer | None = None, max_rounds: int | None = None, sources: int = 1) -> DataFrame:
    """Rounds until enough targets are found or a round changes nothing; one row of counts.

    The column ``stopped`` says why it ended, ``written`` how many rows this call put down per table,
    counted while they were written. ``max_rounds`` bounds one call; calling again goes on.
    """
    scorer = scorer or classify.RuleScorer()
    store.create_tables()
    finished = store.finished()
    number, rounds, stopped = finished // STEPS + 1, 0, None
    while stopped is None:
        if cfg.target_goal is not None and progress.has_at_least(store.current("target_users"), cfg.target_goal).first()[0]:
            stopped = "goal reached"
        elif max_rounds is not None and rounds >= max_rounds:
            stopped = "round limit"
        elif not run_round(store, cap, cfg, as_of, number, seed, scorer, sources, finished, rounds == 0):
            stopped = "nothing left to do"
        number, rounds = number + 1, rounds + 1
    return progress.progress(
        store.current("users"), store.current("target_users"),
        store.current("raw_statuses"), store.current("value_comments"), cfg,
    ).withColumn("stopped", F.lit(stopped)).withColumn("written", _as_map(store.written()))
