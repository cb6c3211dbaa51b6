import pytest

from folioflow.operators.dedup import first_per_key, first_per_key_nulls_distinct, last_per_key
from folioflow.operators.upsert import insert_or_ignore, insert_or_replace, upsert_columns, with_latest
from folioflow.plans import frontier
from folioflow.sources.store import TableStore

KV = "k long, v string, at long"


def test_first_and_last_per_key(spark, rows):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3)], KV)
    assert rows(first_per_key(df, ["k"], ["at"])) == [(1, "a", 1), (2, "c", 3)]
    assert rows(last_per_key(df, ["k"], ["at"])) == [(1, "b", 2), (2, "c", 3)]


def test_only_one_row_per_key_and_task_is_shuffled(spark, capsys):
    first_per_key(spark.range(10).selectExpr("id % 2 AS k", "id"), ["k"], ["id"]).explain()
    text = capsys.readouterr().out
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_null_keys_are_distinct(spark, rows):
    df = spark.createDataFrame([("s", None, 1), ("s", None, 2), ("s", "x", 3), ("s", "x", 4)], "a string, b string, at long")
    assert rows(first_per_key_nulls_distinct(df, ["a", "b"], ["at"])) == [
        ("s", "x", 3), ("s", None, 1), ("s", None, 2)]


def test_insert_or_ignore(spark, rows):
    stored = spark.createDataFrame([(1, "old", 0)], KV)
    new = spark.createDataFrame([(1, "new", 1), (2, "first", 2), (2, "second", 3), (None, "x", 4)], KV)
    assert rows(insert_or_ignore(stored, new, ["k"], ["at"])) == [(2, "first", 2)]


def test_insert_or_ignore_nulls_distinct(spark, rows):
    stored = spark.createDataFrame([(1, None, 0), (1, "x", 0)], KV)
    new = spark.createDataFrame([(1, None, 1), (1, "x", 2), (1, "y", 3), (None, "z", 4)], KV)
    got = insert_or_ignore(stored, new, ["k", "v"], ["at"], required=["k"], nulls_distinct=True)
    assert rows(got) == [(1, "y", 3), (1, None, 1)]


def test_insert_or_replace(spark, rows):
    stored = spark.createDataFrame([(1, "old", 9), (3, "stays", 9)], KV)
    new = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3)], KV)
    assert rows(insert_or_replace(stored, new, ["k"], ["at"]), "k", "v") == [(1, "b"), (2, "c"), (3, "stays")]


@pytest.mark.parametrize("mode, creator", [("overwrite", None), ("keep", 7)])
def test_upsert(spark, rows, mode, creator):
    stored = spark.createDataFrame([(10, "A", 7, 1.0), (11, "B", 8, 2.0)], "id long, symbol string, creator long, net double")
    new = spark.createDataFrame([("A", None, 5.0, 99), ("C", 9, 6.0, 12)], "symbol string, creator long, net double, id long")
    got = upsert_columns(stored, new, "symbol", ["creator", "net"], mode)
    assert rows(got) == sorted([(10, "A", creator, 5.0), (11, "B", 8, 2.0), (12, "C", 9, 6.0)], key=repr)


def test_upsert_rejects_unknown_mode(spark):
    df = spark.createDataFrame([(1, "a", 1)], KV)
    with pytest.raises(ValueError):
        upsert_columns(df, df, "k", ["v"], on_null="other")


def test_latest_status(spark, rows):
    df = spark.createDataFrame([(1, 0), (2, 0)], "k long, s int")
    log = spark.createDataFrame([(1, 2, 1), (1, 1, 2)], "k long, s int, batch_id long")
    assert rows(with_latest(df, log, ["k"], "s", ["batch_id"])) == [(1, 1), (2, 0)]


def test_scanned_markers_without_number_do_not_empty_the_result(spark):
    meta = spark.createDataFrame([("SCANNED_FOLLOWERS_1",), ("SCANNED_FOLLOWERS_abc",), (None,)], "key string")
    hq = spark.createDataFrame([(1, 10), (2, 5), (3, 5)], "user_id long, followers_count long")
    top = frontier.next_sources(hq, frontier.scanned_ids(meta), 1)
    assert [r.user_id for r in top.collect()] == [2]


def test_store_replay_changes_nothing(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.create_tables()
    follow = "user_id long, symbol string, build_or_collection int, follow_time timestamp_ntz, at long"

    def batch(*data):
        return spark.createDataFrame([(*d, None, i) for i, d in enumerate(data)], follow)

    steps = [batch((1, "A", 0), (1, "A", 1)), batch((1, "A", 1), (2, "B", 1)), batch((3, "C", 1), (2, "B", 0))]

    def run(number):
        store.insert("user_portfolio_follows", steps[number - 1], number, ["at"])

    for number in (1, 2, 3, 2, 3, 1):
        run(number)
    table = ["user_id", "symbol", "build_or_collection"]
    assert rows(store.current("user_portfolio_follows"), *table) == [(1, "A", 0), (2, "B", 1), (3, "C", 1)]
    store.create_tables()
    assert store.current("user_portfolio_follows").count() == 3


def test_store_last_wins_status_and_meta(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.create_tables()
    mark = lambda t: spark.sql(f"SELECT 5L AS user_id, TIMESTAMP_NTZ'{t}' AS last_created_at")
    store.insert("timeline_marks", mark("2024-01-01 00:00:00"), 1, ["last_created_at"])
    store.insert("timeline_marks", mark("2024-01-02 00:00:00"), 2, ["last_created_at"])
    store.write("scan_state", spark.sql("SELECT 5L AS user_id, DATE'2024-01-03' AS scanned_on"), 1)
    assert rows(store.meta()) == [
        ("COMMENTS_LAST_CRAWLED_5", "2024-01-02 00:00:00"), ("SCANNED_FOLLOWERS_5", "2024-01-03")]
    assert rows(store.current("timeline_marks", before=2))[0][1].day == 1
    with pytest.raises(ValueError):
        store.write("scan_state", store.current("scan_state"), 0)
    store.compact("timeline_marks", str(tmp_path / "compact"))
    assert rows(TableStore(spark, str(tmp_path / "compact")).current("timeline_marks"))[0][1].day == 2
