"""Ordered work over blocks equals brute force, with one key holding a third of the rows."""

import random

import pytest
from pyspark.sql import Window, functions as F

from folioflow.operators.ordered import (
    fill_forward, number_rows, quota_cutoff, take_pages,
)
from folioflow.plans import timeline
from folioflow.config import FlowConfig


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows, a third of them of key 0, with bursts of equal times."""
    rng = random.Random(7)
    data = [(0 if i % 3 == 0 else rng.randrange(1, 40), i, rng.choice([0, 10, 500, rng.randrange(10**6)]),
             rng.random() < 0.6) for i in range(3000)]
    return spark.createDataFrame(data, "k long, id long, t long, ok boolean").cache()


@pytest.mark.parametrize("down", [False, True])
def test_row_numbers(skewed, down):
    order = [F.desc("t"), F.desc("id")] if down else ["t", "id"]
    got = number_rows(skewed, ["k"], order, "rn")
    plain = skewed.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    assert got.count() == 3000
    assert got.exceptAll(plain).count() == 0


def test_one_key_at_one_time_spans_tasks(spark):
    """All rows of one key and one time: they are still dealt to several tasks."""
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.lit(5).alias("t"), "id")
    got = number_rows(df, ["k"], ["t", "id"], "rn")
    assert got.filter(F.col("rn") != F.col("id") + 1).count() == 0
    ranged = df.repartitionByRange(8, "k", "t", "id").groupBy(F.spark_partition_id()).count()
    assert ranged.agg(F.max("count")).first()[0] < 6_000


def test_null_keys_are_numbered(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, id int")
    assert rows(number_rows(df, ["k"], ["id"], "rn"), "id", "rn") == [(1, 1), (2, 2), (3, 1)]


def test_no_quota_reads_all(skewed):
    assert take_pages(skewed, ["k"], "id", F.col("ok"), None).count() == 3000


@pytest.mark.parametrize("width", [1, 7, 65536])
def test_fill_forward(skewed, width):
    value = F.when(F.col("ok") & (F.col("id") > 40), F.col("t"))
    got = fill_forward(skewed, ["k"], "id", value, "filled", width)
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.withColumn("filled", F.last(value, ignorenulls=True).over(w))
    assert got.count() == 3000
    assert got.exceptAll(plain).count() == 0


def test_fill_forward_golden(spark, rows):
    data = [("p", i, c) for i, c in enumerate(["s0", "A", "s1", "B", "s2"])]
    df = spark.createDataFrame(data, "p string, i int, c string")
    filled = fill_forward(df, ["p"], "i", F.when(F.col("c").rlike("^[A-Z]"), F.col("c")), "seg", 2)
    assert rows(filled, "c", "seg") == [("A", "A"), ("B", "B"), ("s0", None), ("s1", "A"), ("s2", "B")]


@pytest.mark.parametrize("quota", [1, 20, 333, 5000])
def test_page_quota(skewed, quota):
    paged = skewed.withColumn("page", F.floor(F.col("id") / 13))
    got = take_pages(paged, ["k"], "page", F.col("ok"), quota)
    w = Window.partitionBy("k").orderBy("page").rangeBetween(Window.unboundedPreceding, -1)
    plain = paged.withColumn("before", F.coalesce(F.sum(F.col("ok").cast("int")).over(w), F.lit(0))).filter(
        F.col("before") < quota).drop("before")
    assert got.count() == plain.count()
    assert got.exceptAll(plain).count() == 0


def test_page_quota_golden(spark, rows):
    df = spark.createDataFrame([(1, p, i < 9) for p in range(4) for i in range(10)], "u long, page long, ok boolean")
    taken = take_pages(df, ["u"], "page", F.col("ok"), 20)
    assert rows(taken.filter("ok").groupBy("page").count()) == [(0, 9), (1, 9), (2, 9)]
    with pytest.raises(ValueError):
        quota_cutoff(df, ["u"], "page", F.col("ok"), 0)


def _read(pages, quota):
    """Brute force of the page loop: ``pages`` is a list of lists of 'old' / 'new'."""
    taken, added, reached = [0], pages[0].count("new"), "old" in pages[0]
    for number in range(1, len(pages)):
        if added >= quota:
            break
        taken.append(number)
        fresh = pages[number].count("new")
        if fresh == 0:
            break
        added += fresh
        reached = reached or "old" in pages[number]
        if reached:
            break
    return taken


def test_where_reading_stops(spark):
    rng = random.Random(3)
    cases = {u: [[rng.choice(["new", "new", "new", "old"]) for _ in range(rng.randrange(1, 5))]
                 for _ in range(rng.randrange(1, 8))] for u in range(60)}
    cases[100] = [["old"], ["new"], ["new"]]
    cases[101] = [["new"], ["old", "new"], ["new"]]
    cases[102] = [["new"], ["old"], ["new"]]
    cases[103] = [["new"] * 30, ["new"]]
    data = [(u, p, kind) for u, pages in cases.items() for p, posts in enumerate(pages) for kind in posts]
    df = spark.createDataFrame(data, "u long, page long, kind string")
    old = F.col("kind") == "old"
    for quota in (3, 20):
        taken = timeline.pages_until_old(df, "u", "page", old, ~old, quota)
        got = {}
        for r in taken.select("u", "page").distinct().collect():
            got.setdefault(r.u, []).append(r.page)
        assert {u: sorted(p) for u, p in got.items()} == {u: _read(p, quota) for u, p in cases.items()}


def test_marks(spark, rows):
    posts = spark.sql("""SELECT * FROM VALUES (1L, TIMESTAMP_NTZ'2024-01-02 00:00:00'), (1L, TIMESTAMP_NTZ'2024-01-02 00:00:01'),
        (1L, NULL), (2L, TIMESTAMP_NTZ'2023-01-01 00:00:00') AS t(user_id, created_at)""")
    marks = spark.sql("SELECT 1L AS user_id, TIMESTAMP_NTZ'2024-01-02 00:00:00' AS last_created_at")
    kept = timeline.newer_than_mark(posts, marks)
    assert sorted((r.user_id, r.created_at and r.created_at.second) for r in kept.collect() if r.created_at) == [(1, 1), (2, 0)]
    assert kept.count() == 3
    older = posts.filter("user_id = 2").withColumn("user_id", F.lit(1).cast("long"))
    moved = timeline.advance_marks(marks, timeline.newest_seen(older))
    assert moved.first().last_created_at.year == 2024
