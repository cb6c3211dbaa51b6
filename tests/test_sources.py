import gzip
import json

from pyspark.sql import functions as F

from folioflow.functions import variants as vr
from folioflow.plans import portfolio
from folioflow.sources import html, landed, payloads

AS_OF = "2024-01-31 00:00:00"


def captures(spark, payload_list, keys="user_id long, seq int"):
    return spark.createDataFrame(
        [(1, i, p if isinstance(p, str) else json.dumps(p, ensure_ascii=False)) for i, p in enumerate(payload_list)],
        f"{keys}, payload string")


def test_landed_files(spark, rows, tmp_path):
    """Plain and gzipped lines; what cannot be read has a reason and keeps its text."""
    lines = ['{"user_id":1,"seq":0,"payload":{"a":1}}', '{"user_id":1,"seq":1,"payload":"{\\"a\\":2}"}',
             '{"user_id":1,"seq":2,"payload":"no json"}', "not a line", '{"user_id":1,"seq":3}',
             '{"user_id":"x","seq":4,"payload":{"a":3}}']
    with gzip.open(tmp_path / "x.json.gz", "wt") as out:
        out.write("\n".join(lines))
    (tmp_path / "y.json").write_text("\n".join(lines[:3]))
    good, bad = landed.split(landed.read_captures(spark, str(tmp_path), "user_id long, seq int"))
    assert rows(good, "seq", vr.whole(vr.parse(F.col("payload")), "$.a")) == [(0, 1), (0, 1), (1, 2), (1, 2)]
    assert rows(bad.filter("source = 'x.json.gz'"), "reason", "payload") == [
        ("key of another kind", '{"a":3}'), ("line is no JSON", "not a line"), ("no payload", None), ("payload is no JSON", "no json")]
    assert rows(bad.filter("source = 'y.json'"), "payload") == [("no json",)]


def test_bodies(spark):
    text = '{"a":"张"}'
    data = [(1, gzip.compress(text.encode()), "GZIP"), (2, text.encode(), None), (3, b"\xff\xfe", None),
            (4, b"plain", "gzip"), (5, None, "gzip")]
    df = spark.createDataFrame(data, "i int, body binary, enc string")
    got = [r[0] for r in df.orderBy("i").select(payloads.body_text(F.col("body"), F.col("enc")), "i").collect()]
    assert got == [text, text, None, None, None]


def test_quote_shapes_agree(spark, rows):
    q = {"symbol": "SH600519", "name": "茅台", "current": 1700.5, "percent": None}
    shapes = [{"data": {"items": [{"quote": q}]}}, {"data": {"items": [q]}}, {"items": [{"quote": q}]}, {"items": [q, 3]}]
    got = payloads.quote_rows(captures(spark, shapes), AS_OF)
    assert rows(got, "stock_symbol", "stock_name", "current_price", "percent", "market") == [
        ("SH600519", "茅台", 1700.5, 0.0, "CN")] * 4
    none = [{"x": {"net_value": 1}, "items": [q]}, {"data": {"items": []}, "items": [q]}, [q], "nope", {"items": [{"symbol": ""}]}]
    assert payloads.quote_rows(captures(spark, none), AS_OF).count() == 0
    odd = [{"items": [{"code": "00700", "current": "1,234"}, {"symbol": 700, "current": "x"}]}]
    assert rows(payloads.quote_rows(captures(spark, odd), AS_OF), "stock_symbol", "current_price", "market") == [
        ("00700", 1234.0, "HK"), ("700", 0.0, "US")]


def test_portfolio_shapes_agree(spark, rows):
    p = {"symbol": "ZH1", "name": "n", "net_value": "1.5"}
    shapes = [[p], {"list": [p]}, {"data": {"stocks": [p]}}, {"data": {"items": [p]}}, {"items": [p]}, {"ZH1": p, "n": 3},
              {"list": [1], "k": p}, [{"cube_symbol": "ZH1", "symbol": "", "name": "n", "net_value": "1.5"}, "junk"]]
    got = payloads.portfolio_items(captures(spark, shapes))
    assert rows(got, "symbol", "name", "net_value") == [("ZH1", "n", "1.5")] * len(shapes)
    none = [[1, 2], {"list": []}, {"a": 1}, "3", {"items": [{"net_value": 1}]}]
    assert payloads.portfolio_items(captures(spark, none)).count() == 0


def test_rebalance_shapes_agree(spark, rows):
    h = {"stock_symbol": "SH1", "stock_name": "a", "weight": 0, "prev_weight": 5, "target_weight": 1.5, "price": "9.5", "comment": {"x": 1}}
    b = {"status": "ok", "cash_value": 0, "cash": 3, "updated_at": 1700000000000, "rebalancing_histories": [h, None, 4]}
    other = {"status": "ok", "cash": 3, "updatedAt": 1700000000000,
             "rebalancingHistories": [{"stockSymbol": "SH1", "stockName": "a", "prev_weight": 5, "target_weight": 1.5, "price": 9.5}]}
    shapes = [{"list": [b]}, {"data": {"list": [b]}}, {"data": [b, 1]}, [b], [other]]
    df = captures(spark, shapes).withColumnRenamed("payload", "rebalances")
    got = payloads.trade_rows(df, ["seq"]).drop("seq", "reb_pos", "pos")
    assert rows(got.distinct()) == [("SH1", "a", 5.0, 1.5, 9.5, 3.0, "ok", "2023-11-14 22:13:20", None)]
    assert got.count() == 5
    untimed = captures(spark, [[{"rebalancing_histories": [dict(h, comment="why")]}]]).withColumnRenamed("payload", "rebalances")
    assert rows(payloads.trade_rows(untimed, ["seq"]), "transaction_time", "notes") == [(None, "why")]


def test_follow_and_timeline_pages(spark, rows):
    pages = captures(spark, [{"users": [{"id": 1, "followers_count": None}, {"id": None}, {"id": 2, "description": "d"}]}, {"x": 1}, "bad"],
                     "src long, page long")
    assert rows(payloads.follow_rows(pages, AS_OF), "user_id", "followers_count", "description", "pos") == [(1, 0, "", 0), (2, 0, "d", 2)]
    posts = captures(spark, [{"statuses": [{"id": 5, "user_id": 1, "text": "", "description": "d", "created_at": 1700000000000, "type": 3}]},
                             {"statuses": []}, "bad"], "user_id long, page long")
    got = payloads.post_rows(posts)
    assert rows(got, "page", "status_id", "description", "created_text", "post_type") == [
        (0, 5, "d", "2023-11-14 22:13:20", "3"), (1, None, None, None, "0")]


FRAGMENT = """<div class="timeline"><div class="status-item x">
<div class="status-retweet-user"><a class="name"> 张三 </a><a class="name">second</a></div>
<div class="text">hi &amp; <b>bye</b></div><script class="single-description">short</script>
<a class="i btn-like"><em>3</em></a><a class="btn-status-reply"><i></i></a></div>
<div class="status-item"><div class="status-retweet-user"><span><a class="name">nested</a></span></div>
<script class="single-description">only hidden</script></div></div>"""


def test_comment_fragment(spark, rows):
    df = spark.createDataFrame([("ZH1", FRAGMENT), ("ZH2", None), ("ZH3", "<p>none")], "symbol string, html string")
    assert rows(html.comment_rows(df, ["symbol"])) == [
        ("ZH1", 0, "张三", "hi & bye", "3", "0"), ("ZH1", 1, "未知作者", "only hidden", "0", "0")]


def test_list_elements_without_end_tags(spark, rows):
    df = spark.createDataFrame([(1, "<ul><li>a<li>b <i>c</i></ul><p>x<br>y</p>")], "i int, html string")
    assert rows(html.element_rows(df, ["i"], "li")) == [(1, 0, "a"), (1, 1, "b c")]
    assert rows(html.element_rows(df, ["i"], "p")) == [(1, 0, "xy")]


def test_holdings_drop_stocks_before_a_segment(spark, rows):
    page = """<div class="cube-title"><span class="name">P</span></div><div class="weight-list">
      <div class="stock"><div class="name">lost</div></div>
      <div class="segment"><span class="segment-name">A</span><span class="segment-weight weight">60%</span></div>
      <div class="stock"><div class="name">s1</div><div class="price">1</div><span class="stock-weight w">30%</span></div>
      <div class="segment"><span class="segment-name">B</span></div></div>"""
    df = spark.createDataFrame([("ZH1", page, FRAGMENT, "[]"), ("ZH2", "<html>blocked", None, None)],
                               "symbol string, html string, comments_html string, rebalances string")
    docs = html.portfolio_documents(df)
    row = docs.collect()
    assert [r.symbol for r in row] == ["ZH1"]
    assert row[0].is_closed is False and row[0].create_time is None and len(row[0].comments) == 2
    assert rows(portfolio.position_rows(docs, ["symbol"]), "segment_name", "segment_weight", "stock_name", "stock_weight") == [
        ("A", "60%", "s1", "30%"), ("B", None, None, None)]
    listed = spark.createDataFrame(
        [("ZH1", 0, "stock", None, None, "lost"), ("ZH1", 1, "segment", "A", "60%", None), ("ZH1", 2, "stock", None, None, "s1"),
         ("ZH1", 3, "other", None, None, "x")], "symbol string, pos int, class string, segment_name string, segment_weight string, name string")
    filled = html.holding_rows(listed.withColumn("price", F.lit("1")).withColumn("weight", F.lit("2")))
    assert rows(filled, "segment_name", "name") == [("A", "s1")]


def test_portfolios_by_name_keep_page_order(spark, rows):
    payload = '{"b": {"symbol": "ZH2"}, "note": "x", "a": {"symbol": "ZH1"}, "n": 3}'
    df = spark.createDataFrame([(1, 0, payload)], "user_id long, seq int, payload string")
    found = payloads.portfolio_items(df).orderBy("pos").collect()
    assert [r.symbol for r in found] == ["ZH2", "ZH1"]


def test_landed_files_are_bounded(spark, rows, tmp_path):
    """More text gives more files, not larger ones; little text gives the files asked for."""
    from folioflow.catalogue.posts import _land

    docs = spark.range(1000).selectExpr("id AS doc_id", "repeat('word ', 20) AS text")
    for at, (files, file_bytes, expected) in enumerate(((4, 1 << 20, 4), (2, 10_000, 10))):
        path = str(tmp_path / f"landed{at}")
        _land(docs, path, files, file_bytes)
        assert len(list((tmp_path / f"landed{at}").glob("*.parquet"))) == expected
        assert rows(spark.read.parquet(path), "doc_id") == rows(docs, "doc_id")
    _land(docs.limit(0), str(tmp_path / "none"), 2)
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
