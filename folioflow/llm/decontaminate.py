"""Benchmark passages in documents: exact similarity over item-sized windows. DataFrame functions only.

A benchmark item of L words is compared with document windows of L words, by the weighted word
shingles: sum of least over sum of largest counts. Only shingles that document and item share count
towards the similarity, so it is worked out from those alone. They are found with a Bloom filter
of fixed size, held as a literal, and confirmed by an ordinary join.

A window passes at similarity t only if it holds t (a + b) / (1 + t) shared shingles, where a and b
are the numbers of its shingles and the item's. The windows that hold so many are scored, all others
are below t: no passage is lost.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from folioflow.llm.common import session, whole
from folioflow.session import cut_lineage

_SEPARATORS = r"[^\p{L}\p{M}\p{N}]+"
_PROBES = 3
# A filter of texts is a literal of at most 2 ** _MOST_BITS bits; beyond that more texts are joined.
_MOST_BITS = 19


def word_hashes(text: Column) -> Column:
    """A hash per word in lower case; words are runs of letters, marks and digits."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATORS)
    return F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w))


def shingles(words: Column, width: int) -> Column:
    """A hash per shingle of ``width`` words. ``words`` must be a column, not an expression: the
    lambda reads it for every element."""
    last = F.size(words) - width
    return F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.lit(width), *(F.get(words, i + k) for k in range(width))),
    )).otherwise(F.array().cast("array<bigint>"))


def _probes(h: Column, bits: int) -> list[Column]:
    return [F.shiftrightunsigned(h, 20 * n).bitwiseAND(F.lit((1 << bits) - 1)) for n in range(_PROBES)]


def _filter_literal(hashes: DataFrame, bits: int) -> Column:
    """A Bloom filter of 2 ** bits bits over column ``h``; that many bits come to the driver."""
    probe = F.explode(F.array(*_probes(F.col("h"), bits))).alias("p")
    words = hashes.select(probe).groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("set"))
    held = {r.word: r.set for r in words.collect()}
    # Parsed once, when the plan is optimised.
    return F.split(F.lit(",".join(str(held.get(n, 0)) for n in range(1 << (bits - 6)))), ",").cast("array<bigint>")


def _in_filter(h: Column, held: Column, bits: int) -> Column:
    tests = [
        F.shiftrightunsigned(F.get(held, F.shiftright(p, 6).cast("int")), 0).bitwiseAND(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), p.bitwiseAND(F.lit(63)).cast("int"))) != 0
        for p in _probes(h, bits)
    ]
    return reduce(lambda a, b: a & b, tests)


def _similarity(shared: Column, start: Column, own: Column, item: Column) -> Column:
    """Of the window whose first of ``own`` shingles is at ``start`` with an item of ``item`` shingles.
    ``shared`` is an array of ``pos, h, n``, n being the count in the item."""
    inside = F.filter(shared, lambda x: (x["pos"] >= start) & (x["pos"] < start + own))
    hashes = F.transform(inside, lambda x: x["h"])
    repeats = F.aggregate(
        F.array_distinct(F.transform(inside, lambda x: F.struct(x["h"].alias("h"), x["n"].alias("n")))), F.lit(0).cast("bigint"),
        lambda sum_, x: sum_ + F.least(F.size(F.filter(hashes, lambda h: h == x["h"])), x["n"]))
    common = F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.size(hashes).cast("bigint")).otherwise(repeats)
    return common / (own + item - common)


def matches(docs: DataFrame, benchmark: DataFrame, width: int = 5, similarity: float = 0.8,
            filter_bits: int = 19, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text") -> DataFrame:
    """``doc_id, content, item_id, similarity, start_word, n_words``: the best window per row and item.

    ``content`` is the SHA-256 of the text. Words are compared in lower case without punctuation.
    Items with fewer words than ``width`` are one shingle; items without a word, and null texts,
    match nothing. A document shorter than an item is one window. Rows that repeat an id and text
    give one row each; of equally similar windows the first is shown. Items may have any length.
    """
    session(docs.sparkSession)
    items = cut_lineage(
        benchmark.select(F.col(item_col).alias("item_id"), word_hashes(F.col(item_text_col)).alias("item_words"))
        .filter(F.size("item_words") > 0)
        .withColumn("length", F.size("item_words")).withColumn("width", F.least(F.lit(width), F.col("length")))
        .withColumn("item", F.monotonically_increasing_id())
    )
    # At most ``width`` numbers.
    widths = sorted(r.width for r in items.select("width").distinct().collect()) or [width]
    parts = [
        items.filter(F.col("width") == w).select(
            "item", "item_id", "length", "width", F.explode(shingles(F.col("item_words"), w)).alias("h"))
        for w in widths
    ]
    item_shingles = cut_lineage(reduce(DataFrame.unionByName, parts).groupBy(
        "item", "item_id", "length", "width", "h").agg(F.count(F.lit(1)).alias("n")))
    held = _filter_literal(item_shingles.select("h").distinct(), filter_bits)

    hashed = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), word_hashes(F.col(text_col)).alias("words"))
    marked = [
        F.array_compact(F.transform(
            shingles(F.col("words"), w),
            lambda h, i: F.when(_in_filter(h, held, filter_bits), F.struct(i.alias("pos"), h.alias("h")))))
        for w in widths
    ]
    # The generated id keeps the filter above this projection: below it the anchors, and for each of
    # their elements the words, would be worked out once more.
    anchored = hashed.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text", "words", F.concat(*marked).alias("anchors"))
    anchored = cut_lineage(anchored.filter(F.size("anchors") > 0).select(
        "row", "doc_id", F.sha2("text", 256).alias("content"), "words", "anchors"))

    # Windows of a text shorter than the item are the whole text.
    at = anchored.select("row", F.size("words").alias("size"), F.inline("anchors")).join(item_shingles, "h")
    grouped = at.groupBy("row", "item", "item_id", "length", "width", "size").agg(
        F.sort_array(F.collect_set(F.struct("pos", "h", "n"))).alias("shared"))
    own = (F.least("length", "size") - F.col("width") + 1).alias("own")
    item = (F.col("length") - F.col("width") + 1).alias("item_shingles")
    counted = grouped.select("row", "item", "item_id", "size", F.least("length", "size").alias("span"), "shared", own, item).withColumn(
        "least", F.ceil((F.col("own") + F.col("item_shingles")) * F.lit(similarity / (1.0 + similarity)) - 1e-6).cast("int"))
    counted = counted.withColumn("least", F.greatest("least", F.lit(1)))
    enough = cut_lineage(counted.filter((F.col("own") > 0) & (F.size("shared") >= F.col("least"))))
    # Every run of ``least`` shared shingles that fits a window, and the windows that hold it.
    position = lambda i: F.get("shared", i)["pos"]
    runs = F.transform(F.sequence(F.lit(0), F.size("shared") - F.col("least")), lambda i: F.struct(
        F.greatest(F.lit(0), position(i + F.col("least") - 1) - F.col("own") + 1).alias("first"),
        F.least(position(i), F.col("size") - F.col("span")).alias("last")))
    starts = F.array_distinct(F.flatten(F.transform(
        F.filter(runs, lambda r: r["first"] <= r["last"]), lambda r: F.sequence(r["first"], r["last"]))))
    started = cut_lineage(enough.withColumn("starts", starts))
    scores = F.transform("starts", lambda s: F.struct(
        _similarity(F.col("shared"), s, F.col("own"), F.col("item_shingles")).alias("similarity"), (-s).alias("before")))
    best = cut_lineage(started.select("row", "item_id", "span", F.array_max(scores).alias("best"))).filter(
        F.col("best.similarity") >= similarity)
    return best.join(anchored.select("row", "doc_id", "content"), "row").select(
        "doc_id", "content", "item_id", "best.similarity", (-F.col("best.before")).alias("start_word"),
        F.col("span").cast("bigint").alias("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, with all their columns.

    What a row holds hangs on its text alone, so rows are matched by the text's digest and ids may
    be null or repeated.
    """
    found = cut_lineage(matches(docs, benchmark, text_col=text_col, **options).select(F.col("content").alias("leaked")).distinct())
    # Most texts hold nothing: a filter of the digests lets them pass without moving.
    bits = min(_MOST_BITS, max(10, (16 * found.count()).bit_length()))
    held = _filter_literal(found.select(F.xxhash64("leaked").alias("h")), bits)
    content = F.sha2(F.col(text_col), 256)
    rows = docs.select(whole(docs).alias("row"), content.alias("content"), _in_filter(F.xxhash64(content), held, bits).alias("near"))
    near = rows.filter("near").join(found, F.col("content") == F.col("leaked"), "left_anti")
    return rows.filter("NOT near").select("row.*").unionByName(near.select("row.*"))
