import datetime as dt

import pytest
from pyspark.sql import functions as F

from folioflow.config import FlowConfig
from folioflow.functions import scalars as sc
from folioflow.plans import frontier, portfolio, tasks


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select("i", fn(F.col("x")).alias("y")).select("y").collect()]


@pytest.mark.parametrize("fn, cases", [
    (sc.loose_number, {
        "12.5%": 12.5, "1,234.5": 1234.5, "--": 0.0, "None": 0.0, "": 0.0, None: 0.0, " 7 ": 7.0,
        "abc": 0.0, "1e3": 1000.0, "+3%": 3.0, "12 %": 12.0, "1d": 0.0, "2.5f": 0.0, "-1%": -1.0,
    }),
    (sc.int_or_zero, {" 12 ": 12, "1,234": 0, "1.5": 0, "1.2万": 0, None: 0, "-3": -3}),
    (sc.market_class, {
        "SH600519": "CN", "SZ000001": "CN", "00700": "HK", "AAPL": "US", "GOOGL": "未知",
        "SHOP": "CN", "BRK.A": "未知", "0700": "US", "BJ430047": "未知",
    }),
    (sc.readable_time, {
        "1700000000999": "2023-11-14 22:13:20", "2024-01-05 03:02:01": "2024-01-05 03:02:01",
        None: None, "": "", "9" * 25: "9" * 25,
    }),
    (sc.parsed_time, {
        "2024-1-5 3:2:1": dt.datetime(2024, 1, 5, 3, 2, 1), "None": None, "": None, None: None,
        "24-1-5 3:2:1": None, "2024-13-01 00:00:00": None, "2024-01-05": None,
    }),
    (sc.clean_text, {"<p>　hi<br\n/>there\nyou</p> ": "hithere you", None: None, "\x1ca\x1f": "a"}),
    (sc.last_segment, {"/1234567890/": "1234567890", "/u/42": "42"}),
    (sc.digits_or_zero, {"42": 42, None: 0, "abc": 0, "-1": 0}),
    (sc.closed_or_zero, {None: "0", "0": "0", "": "0", "2024-01-05": "2024-01-05"}),
    (sc.first_digits, {"被 123 人关注 4": "123", "none": None}),
])
def test_text_functions(spark, fn, cases):
    assert apply(spark, fn, list(cases)) == list(cases.values())


def test_comment_id(spark):
    df = spark.createDataFrame([("ZH1", "张三", "hi", 3, 0)], "s string, a string, c string, l int, r int")
    assert df.select(sc.comment_id(*map(F.col, "sacl"), F.col("r"))).first()[0] == 137826520644519427


def test_choice(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 5.0), (2, 3.0, 5.0), (3, None, 0.0), (4, 0.0, None)], "i int, a double, b double")
    got = [r[0] for r in df.orderBy("i").select(sc.number_or(F.col("a"), F.col("b")), "i").collect()]
    assert got == [5.0, 3.0, 0.0, None]
    df = spark.createDataFrame([(1, "", "b"), (2, "a", "b"), (3, None, "")], "i int, a string, b string")
    got = [r[0] for r in df.orderBy("i").select(sc.text_or(F.col("a"), F.col("b")), "i").collect()]
    assert got == ["b", "a", ""]


def test_labels(spark):
    df = spark.createDataFrame([(1, True, "A股"), (2, False, "A股"), (3, False, None)], "i int, v boolean, c string")
    got = [r[0] for r in df.orderBy("i").select(sc.value_label(F.col("v"), F.col("c")), "i").collect()]
    assert got == ["A股", "[低价值]-A股", "[低价值]-其他"]


def test_verdicts(spark):
    replies = ['{"valuable": true, "cat": "A股"}', '{"valuable": "true"}', '{"valuable": "false", "cat": null}',
               "{}", "no json", None]
    df = spark.createDataFrame(list(enumerate(replies)), "i int, r string")
    valuable, cat = sc.verdict_fields(F.col("r"))
    got = [tuple(r)[1:] for r in df.orderBy("i").select("i", valuable, cat).collect()]
    assert got == [(True, "A股"), (True, "其他")] + [(False, "其他")] * 4


def test_article_text(spark):
    df = spark.createDataFrame([(1, "T", "B"), (2, None, "B"), (3, "T", None), (4, None, None), (5, None, "")],
                               "i int, t string, b string")
    got = [r[0] for r in df.orderBy("i").select(sc.article_text(F.col("t"), F.col("b")), "i").collect()]
    assert got == ["【长文标题】T\nB", "B", "【长文标题】T\n", None, None]


def test_figures_and_closing_lines(spark):
    df = spark.createDataFrame(
        [(["1", "2", "3"], ["创建于：2020-01-02 ", "关停时间：2021-03-04"], ["a"], ["b", "c"])],
        "f array<string>, n array<string>, s array<string>, h array<string>")
    row = df.select(
        *sc.named_figures(F.col("f"), ["x", "y"]), sc.named_figures(F.col("f"), list("pqrs"))[3],
        sc.label_value(F.col("n"), "创建于").alias("a"), sc.label_value(F.col("n"), "关停时间", unless="创建于").alias("b"),
        sc.fuller_text(F.col("s"), F.col("h")).alias("t"), sc.fuller_text(F.col("h"), F.col("s")).alias("u"),
    ).first()
    assert tuple(row) == ("1", "2", None, "2020-01-02", "2021-03-04", "bc", "bc")


def test_high_quality_bounds(spark):
    df = spark.createDataFrame([(1, 5000, 21), (2, 5001, 20), (3, 5001, 21), (4, None, 50)],
                               "user_id long, followers_count long, comments_count long")
    kept = df.filter(frontier.is_high_quality(FlowConfig())).collect()
    assert [r.user_id for r in kept] == [3]


def test_due_bounds(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2024-01-10 12:00:00'),
        (2, TIMESTAMP_NTZ'2024-01-10 11:59:59'), (3, NULL) AS t(user_id, last_updated)""")
    due = tasks.pending_tasks(df, "2024-01-31 12:00:00", 21)
    assert sorted(r.user_id for r in due.collect()) == [2, 3]
    assert tasks.pending_tasks(df, "2024-01-31 12:00:00", 21, 0).count() == 2
    assert tasks.pending_tasks(df, "2024-01-31 12:00:00", 21, 1).first().user_id == 2


def test_cache_bounds(spark):
    texts = ["2024-01-31 09:00:00", "2024-01-31 08:59:59", None, "bad"]
    fresh = apply(spark, lambda x: portfolio.is_fresh(sc.parsed_time(x), "2024-01-31 12:00:00", 3), texts)
    assert fresh == [True, False, False, False]


def test_keys(spark):
    keys = ["SCANNED_FOLLOWERS_12", "SCANNED_FOLLOWERS_x", "scanned_followers_3", "COMMENTS_LAST_CRAWLED_4", None]
    assert apply(spark, lambda k: sc.key_user(k, sc.SCANNED_PREFIX), keys) == [12, None, None, None, None]
