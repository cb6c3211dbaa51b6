"""What the planner makes of the queries."""

import re

import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
BATCH = sorted(n for n in contract.queries() if not n.startswith("stream_"))


def plan(spark, capsys, name):
    contract.queries()[name](spark, SF).explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", BATCH)
def test_no_all_pairs_join(spark, capsys, name):
    text = plan(spark, capsys, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["transactions_first", "insert_ignore", "user_stocks_replace", "user_row_cap",
                                  "page_quota", "source_page_quota", "expansion_read", "follow_ownership", "meta_upsert"])
def test_keys_are_cut_before_the_shuffle(spark, capsys, name):
    assert "WindowGroupLimit" in plan(spark, capsys, name)


@pytest.mark.parametrize("name, columns, filters", [
    ("target_qualify", "struct<o_orderkey:bigint,o_custkey:bigint>", ""),
    ("market_class", "struct<p_partkey:bigint,p_name:string>", ""),
    ("new_users_anti", "struct<o_custkey:bigint,o_orderstatus:string>", "EqualTo(o_orderstatus,F)"),
    ("newest_mark", "struct<ts:timestamp_ntz,user_id:bigint>", ""),
])
def test_scans_are_pruned(spark, capsys, name, columns, filters):
    text = re.sub(r"\s+", " ", plan(spark, capsys, name))
    assert columns in text and filters in text


@pytest.mark.parametrize("name", ["quote_shapes", "rebalance_explode", "portfolio_list_shapes", "timeline_posts",
                                  "positions_explode", "profile_pages", "portfolio_pages", "clean_text", "score_posts"])
def test_payload_work_does_not_shuffle(spark, capsys, name):
    assert "Exchange" not in plan(spark, capsys, name)


def test_pages_are_parsed_on_all_cores(spark):
    """A table of one small file is dealt out before its rows become pages."""
    pages = contract.queries()["portfolio_pages"](spark, SF)
    assert pages.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
