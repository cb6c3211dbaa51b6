"""Step 3: posts of target users, newest first, down to the high-water mark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioflow.config import FlowConfig
from folioflow.functions import scalars as sc
from folioflow.operators.ordered import quota_cutoff

LONG_FORM = ("1", "3")


def with_marks(posts: DataFrame, marks: DataFrame, user: str) -> DataFrame:
    mark = marks.select(F.col("user_id").alias(user), F.col("last_created_at").alias("mark"))
    return posts.join(mark, user, "left")


def is_old(created: Column, mark: Column) -> Column:
    """At or before the mark. Without a mark or a readable time a post is never old."""
    return F.coalesce(created <= mark, F.lit(False))


def newer_than_mark(posts: DataFrame, marks: DataFrame, user: str = "user_id", created: str = "created_at") -> DataFrame:
    marked = with_marks(posts, marks, user)
    return marked.filter(~is_old(F.col(created), F.col("mark"))).drop("mark")


def newest_seen(posts: DataFrame, user: str = "user_id", created: str = "created_at") -> DataFrame:
    return posts.groupBy(user).agg(F.max(created).alias("newest_seen"))


def advance_marks(marks: DataFrame, newest: DataFrame) -> DataFrame:
    """Marks only move forward; users without a readable time keep theirs."""
    seen = newest.filter(F.col("newest_seen").isNotNull())
    return seen.join(marks, "user_id", "left").select(
        "user_id", F.greatest("newest_seen", "last_created_at").alias("last_created_at")
    )


def last_pages(posts: DataFrame, user: str, page: str, old: Column, new: Column, quota: int | None) -> DataFrame:
    """Per user the last page that is read, where anything stops the reading.

    Three things stop it, each a plain aggregate: an old post (tested from the second page on),
    a later page without new posts, and the quota.
    """
    p = F.col(page)
    pages = posts.groupBy(user, page).agg(
        F.bool_or(old).alias("__old"), F.count_if(new).alias("__new")
    )
    # least() passes over nulls, greatest() would too: keep "no old post" null.
    oldest = F.min(F.when(F.col("__old"), F.greatest(p, F.lit(1).cast("bigint"))))
    dry = F.min(F.when((p >= 1) & (F.col("__new") == 0), p))
    stops = pages.groupBy(user).agg(F.least(oldest, dry).alias("__stop"))
    if quota:
        full = quota_cutoff(posts, [user], page, new, quota, "__full")
        stops = stops.join(full, user, "left").withColumn("__stop", F.least("__stop", "__full"))
    return stops.filter(F.col("__stop").isNotNull()).select(user, F.col("__stop").alias("last_page"))


def pages_until_old(posts: DataFrame, user: str, page: str, old: Column, new: Column, quota: int | None = None) -> DataFrame:
    stops = last_pages(posts, user, page, old, new, quota)
    return posts.join(stops, user, "left").filter(
        F.col("last_page").isNull() | (F.col(page) <= F.col("last_page"))
    ).select(*posts.columns)


def is_long_form(post_type: Column) -> Column:
    return F.coalesce(post_type.cast("string").isin(*LONG_FORM), F.lit(False))


def with_articles(posts: DataFrame, articles: DataFrame, user: str = "user_id") -> DataFrame:
    """Long-form posts take the captured article's text where it is not empty."""
    texts = articles.select(
        F.col("user_id").alias(user), "status_id",
        sc.article_text(F.col("title"), F.col("body")).alias("__full"),
    ).withColumn("__long", F.lit(True))
    marked = posts.withColumn("__long", is_long_form(F.col("post_type")))
    return marked.join(texts, [user, "status_id", "__long"], "left").withColumn(
        "description", F.coalesce("__full", "description")
    ).select(*posts.columns)


def ingest(posts: DataFrame, marks: DataFrame, articles: DataFrame, cfg: FlowConfig) -> dict[str, DataFrame]:
    """``posts`` come from ``post_rows``; the mark is that of the visited user."""
    marked = with_marks(posts, marks, "visited_id")
    old = is_old(F.col("created_at"), F.col("mark"))
    new = ~old & F.col("status_id").isNotNull()
    taken = pages_until_old(marked, "visited_id", "page", old, new, cfg.post_quota)
    fresh = taken.filter(new).drop("mark")
    newest = newest_seen(taken, "visited_id").withColumnRenamed("visited_id", "user_id")
    return {
        "raw_statuses": with_articles(fresh, articles, "visited_id").withColumn("is_analyzed", F.lit(0)),
        "timeline_marks": advance_marks(marks, newest),
        "visited": posts.select(F.col("visited_id").alias("user_id")).distinct(),
    }
