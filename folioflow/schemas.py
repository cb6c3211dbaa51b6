"""The tables and the payloads, as explicit types in DDL: no session is needed to import them."""

from __future__ import annotations

# Times are without zone; text only at the edge.
_PROFILE = """user_id bigint, user_name string, comments_count bigint, friends_count bigint,
    followers_count bigint, description string, last_updated timestamp_ntz"""


TABLES: dict[str, str] = {
    "system_meta": "key string, value string",
    "users": _PROFILE,
    "high_quality_users": _PROFILE,
    "target_users": _PROFILE,
    "raw_statuses": """status_id bigint, user_id bigint, description string, created_at timestamp_ntz,
        stock_tags array<string>, is_analyzed int, forward bigint, comment_count bigint,
        like_count bigint""",
    "value_comments": """comment_id bigint, user_id bigint, content string, publish_time timestamp_ntz,
        mentioned_stocks array<string>, category string, forward bigint, comment_count bigint,
        like_count bigint""",
    "user_stocks": """user_id bigint, stock_name string, stock_symbol string, current_price double,
        percent double, market string, updated_at timestamp_ntz""",
    "user_combinations": """comb_id bigint, user_id bigint, symbol string, name string, net_value double,
        total_gain double, monthly_gain double, daily_gain double, create_time string,
        updated_at timestamp_ntz, portfolio_last_crawled timestamp_ntz, close_at_time string,
        description string, is_public int""",
    "portfolio_transactions": """comb_id bigint, stock_symbol string, stock_name string, prev_weight double,
        target_weight double, price double, cash_value double, status string,
        transaction_time string, notes string""",
    "portfolio_comments": """status_id bigint, comb_id bigint, user_id bigint, content string,
        publish_time timestamp_ntz, like_count bigint, reply_count bigint, forward_count bigint""",
    "portfolio_positions": """comb_id bigint, segment_name string, segment_weight string, stock_name string,
        stock_price string, stock_weight string, updated_at timestamp_ntz""",
    "user_portfolio_follows": "user_id bigint, symbol string, build_or_collection int, follow_time timestamp_ntz",
    # Typed state behind the key/value table, and the change logs of the status columns.
    "scan_state": "user_id bigint, scanned_on date",
    "timeline_marks": "user_id bigint, last_created_at timestamp_ntz",
    "task_log": "table_name string, user_id bigint, last_updated timestamp_ntz",
    "status_log": "status_id bigint, is_analyzed int",
    "quarantine": "source string, reason string, payload string",
}


def columns(table: str) -> dict[str, str]:
    """Column names and types of a table, in order."""
    return dict(part.split(maxsplit=1) for part in TABLES[table].split(","))


# Key of each table, and what an arriving row does to a stored one with the same key.
KEYS: dict[str, list[str]] = {
    "system_meta": ["key"],
    "users": ["user_id"],
    "high_quality_users": ["user_id"],
    "target_users": ["user_id"],
    "raw_statuses": ["status_id"],
    "value_comments": ["comment_id"],
    "user_stocks": ["user_id", "stock_symbol"],
    "user_combinations": ["symbol"],
    "portfolio_transactions": ["comb_id", "transaction_time", "stock_symbol"],
    "portfolio_comments": ["status_id"],
    "portfolio_positions": [
        "comb_id", "segment_name", "stock_name", "stock_price", "stock_weight", "segment_weight",
    ],
    "user_portfolio_follows": ["user_id", "symbol"],
    "scan_state": ["user_id"],
    "timeline_marks": ["user_id"],
    "task_log": ["table_name", "user_id"],
    "status_log": ["status_id"],
}
LAST_WINS = {"system_meta", "user_stocks", "user_combinations", "scan_state", "timeline_marks",
             "task_log", "status_log"}
NULLS_DISTINCT = {"portfolio_positions"}
REQUIRED: dict[str, list[str]] = {
    "portfolio_positions": ["comb_id"],
    "portfolio_comments": ["status_id", "comb_id", "content", "publish_time"],
}

# The field names of the payloads. Everything is read as text, so that a field of an
# unexpected kind costs that field and not its row or page.
FOLLOWEE = """id string, screen_name string, status_count string, friends_count string,
    followers_count string, description string"""
POST = """id string, user_id string, text string, description string, created_at string, type string,
    stockCorrelation string, retweet_count string, reply_count string, like_count string"""
COMMENT = "struct<author: string, text: string, likes: string, comments_count: string>"
SEGMENT = """struct<category_name: string, proportion: string,
    stocks: array<struct<name: string, price: string, weight: string>>>"""
