"""Scalar expressions. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Labels and prefixes that appear in the results.
MARKET_MAINLAND = "CN"
MARKET_HONG_KONG = "HK"
MARKET_US = "US"
MARKET_UNKNOWN = "未知"
CATEGORY_DEFAULT = "其他"
LOW_VALUE_PREFIX = "[低价值]-"
ARTICLE_TITLE_PREFIX = "【长文标题】"
AUTHOR_UNKNOWN = "未知作者"
CREATED_LABEL = "创建于"
CLOSED_LABEL = "关停时间"
SCANNED_PREFIX = "SCANNED_FOLLOWERS_"
MARK_PREFIX = "COMMENTS_LAST_CRAWLED_"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# What counts as white space.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Patterns guard the casts: each cast that fails costs an exception, one per row.
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_WHOLE = r"^[+-]?[0-9]+$"
_TIME_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"


def strip_blanks(text: Column) -> Column:
    """Trim Unicode white space, not only ASCII blanks."""
    return F.btrim(text, F.lit(BLANKS))


def is_digits(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9]+$"), F.lit(False))


# --- choice -----------------------------------------------------------------

def _first_where(usable, cols) -> Column:
    *heads, out = cols
    for col in reversed(heads):
        out = F.when(F.coalesce(usable(col), F.lit(False)), col).otherwise(out)
    return out


def text_or(*cols: Column) -> Column:
    """First non-empty text; the last choice is returned as it is."""
    return _first_where(lambda c: c != "", cols)


def number_or(*cols: Column) -> Column:
    """First non-zero number; the last choice is returned as it is."""
    return _first_where(lambda c: c != 0, cols)


# --- time -------------------------------------------------------------------

def readable_time(raw: Column) -> Column:
    """Epoch milliseconds become ``yyyy-MM-dd HH:mm:ss`` in the session zone; other text stays."""
    raw = raw.cast("string")
    millis = F.when(raw.rlike("^[0-9]+$"), raw.try_cast("bigint"))
    # Beyond that a timestamp, counted in microseconds, has no room.
    millis = F.when(millis <= (1 << 63) // 1000 - 1, millis)
    return F.coalesce(F.date_format(F.timestamp_millis(millis), TIME_FORMAT), raw)


def parsed_time(text: Column) -> Column:
    """A timestamp without zone, or null. One-digit fields are accepted."""
    tidy = F.regexp_replace(text, r"\s+", " ")
    return F.when(
        text.rlike(_TIME_SHAPE),
        F.try_to_timestamp(tidy, F.lit("y-M-d H:m:s")).cast("timestamp_ntz"),
    )


def moment(as_of) -> Column:
    """The run's time as a literal: plans never read the clock."""
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def time_text(ts: Column) -> Column:
    return F.date_format(ts, TIME_FORMAT)


# --- numbers ----------------------------------------------------------------

def loose_number(raw: Column) -> Column:
    """Number out of display text: ``12.5%``, ``1,234.5``; anything unreadable is 0."""
    text = strip_blanks(raw.cast("string"))
    bare = F.replace(F.replace(text, F.lit("%"), F.lit("")), F.lit(","), F.lit(""))
    return F.coalesce(F.when(bare.rlike(_NUMBER), bare.try_cast("double")), F.lit(0.0))


def int_or_zero(raw: Column) -> Column:
    text = strip_blanks(raw.cast("string"))
    return F.coalesce(F.when(text.rlike(_WHOLE), text.try_cast("bigint")), F.lit(0).cast("bigint"))


def whole_number(raw: Column) -> Column:
    """A whole number written as one, as a decimal (cut off) or as text; null for anything else."""
    text = strip_blanks(raw.cast("string"))
    decimal = F.when(text.rlike(_NUMBER), text.try_cast("double")).try_cast("bigint")
    return F.when(text.rlike(_WHOLE), text.try_cast("bigint")).otherwise(decimal)


def digits_or_zero(raw: Column) -> Column:
    raw = raw.cast("string")
    return F.coalesce(F.when(is_digits(raw), raw.try_cast("bigint")), F.lit(0).cast("bigint"))


def first_digits(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, "([0-9]+)", 1), F.lit(""))


# --- text -------------------------------------------------------------------

def clean_text(html: Column) -> Column:
    """Drop tags, trim, then flatten line breaks, in that order."""
    return F.replace(strip_blanks(F.regexp_replace(html, "<[^>]+>", "")), F.lit("\n"), F.lit(" "))


def seed_id(link: Column) -> Column:
    """The user of a profile link: what follows its last ``u/``. A bare id is itself."""
    return F.substring_index(link, "u/", -1).try_cast("bigint")


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(path, "^/+|/+$", ""), "/"), -1)


def article_text(title: Column, body: Column) -> Column:
    """Heading line plus body; null when the capture holds neither."""
    heading = F.when(title.isNotNull(), F.concat(F.lit(ARTICLE_TITLE_PREFIX), title, F.lit("\n")))
    return F.nullif(
        F.concat(F.coalesce(heading, F.lit("")), F.coalesce(body, F.lit(""))), F.lit("")
    )


def article_link(base: str, user_id: Column, status_id: Column) -> Column:
    return F.concat_ws("/", F.lit(base), user_id.cast("string"), status_id.cast("string"))


def tags_text(tags: Column) -> Column:
    return F.array_join(tags, ",")


def closed_or_zero(raw: Column) -> Column:
    """Closing time as text, ``'0'`` while the portfolio is open."""
    raw = raw.cast("string")
    return F.when(F.coalesce((raw != "") & (raw != "0"), F.lit(False)), raw).otherwise("0")


def named_figures(values: Column, names: list[str]) -> list[Column]:
    """Figures in page order under their names: extra ones are dropped, missing ones are null."""
    return [F.get(values, F.lit(i)).alias(name) for i, name in enumerate(names)]


def fuller_text(shown: Column, hidden: Column) -> Column:
    """Join the text nodes of the hidden copy where it has more of them than the shown one."""
    return strip_blanks(F.array_join(F.when(F.size(shown) < F.size(hidden), hidden).otherwise(shown), ""))


def label_value(texts: Column, label: str, unless: str | None = None) -> Column:
    """Value of the last line that carries ``label``, without the label and its colon."""
    def carries(line):
        hit = F.contains(line, F.lit(label))
        return hit & ~F.contains(line, F.lit(unless)) if unless else hit

    line = F.element_at(F.filter(texts, carries), -1)
    line = F.when(F.size(F.filter(texts, carries)) > 0, line)
    return strip_blanks(F.replace(line, F.lit(label + "："), F.lit("")))


# --- domain -----------------------------------------------------------------

def market_class(symbol: Column) -> Column:
    """Order matters: the mainland prefix wins over the length rules."""
    return (
        F.when(symbol.startswith("SH") | symbol.startswith("SZ"), MARKET_MAINLAND)
        .when(symbol.rlike("^[0-9]{5}$"), MARKET_HONG_KONG)
        .when(~symbol.contains(".") & (F.length(symbol) < 5), MARKET_US)
        .otherwise(MARKET_UNKNOWN)
    )


def comment_id(*parts: Column) -> Column:
    """60-bit id out of the md5 of the joined parts."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 15), 16, 10).cast("bigint")


def surrogate_id(natural_key: Column) -> Column:
    return F.xxhash64(natural_key)


def scanned_key(user_id: Column) -> Column:
    return F.concat(F.lit(SCANNED_PREFIX), user_id.cast("string"))


def mark_key(user_id: Column) -> Column:
    return F.concat(F.lit(MARK_PREFIX), user_id.cast("string"))


def key_user(key: Column, prefix: str) -> Column:
    """User id out of a prefixed key; null for other keys and for suffixes that are no number."""
    suffix = F.substr(key, F.lit(len(prefix) + 1))
    return F.when(key.startswith(prefix) & suffix.rlike(_WHOLE), suffix.try_cast("bigint"))


def verdict_fields(reply: Column) -> tuple[Column, Column]:
    """(valuable, category) out of a scorer's JSON reply, with their defaults."""
    js = F.from_json(reply, "valuable string, cat string")
    valuable = F.coalesce(F.lower(js["valuable"]) == "true", F.lit(False))
    return valuable, F.coalesce(js["cat"], F.lit(CATEGORY_DEFAULT))


def value_label(valuable: Column, category: Column) -> Column:
    category = F.coalesce(category, F.lit(CATEGORY_DEFAULT))
    return F.when(valuable, category).otherwise(F.concat(F.lit(LOW_VALUE_PREFIX), category))
