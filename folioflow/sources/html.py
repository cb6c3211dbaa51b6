"""HTML captures. Python, in Arrow batches, only picks the pieces of text out of the markup; what
they mean is written as column expressions."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from folioflow.functions import scalars as sc
from folioflow.operators.ordered import fill_forward

# Elements that never have an end tag, and ones a sibling ends.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
         "track", "wbr"}
_ENDED_BY_SIBLING = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}


class _Node:
    __slots__ = ("tag", "attrs", "depth", "pos", "end", "text")

    def __init__(self, tag, attrs, depth, pos, text=None):
        self.tag, self.attrs, self.depth, self.pos, self.end, self.text = tag, attrs, depth, pos, pos, text

    def is_a(self, tag, cls, cls_has):
        if self.text is not None or tag is not None and tag != self.tag:
            return False
        own = self.attrs.get("class") or ""
        return (cls is None or own == cls) and (cls_has is None or cls_has in own)


class _Page(HTMLParser):
    """Nodes in document order; a node's descendants are the ones from ``pos + 1`` to ``end``."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes, self.open = [], []
        self.feed(html)
        self.close()
        self._end_from(0)

    def updatepos(self, i, j):
        """Line numbers are not asked for, so they are not counted."""
        return j

    def _add(self, tag, attrs=(), text=None):
        self.nodes.append(_Node(tag, dict(attrs), len(self.open), len(self.nodes), text))

    def _end_from(self, level):
        for node in self.open[level:]:
            node.end = len(self.nodes) - 1
        del self.open[level:]

    def handle_starttag(self, tag, attrs):
        if tag in _ENDED_BY_SIBLING and self.open and self.open[-1].tag == tag:
            self._end_from(len(self.open) - 1)
        self._add(tag, attrs)
        if tag not in _VOID:
            self.open.append(self.nodes[-1])

    def handle_startendtag(self, tag, attrs):
        self._add(tag, attrs)

    def handle_endtag(self, tag):
        for level in range(len(self.open) - 1, -1, -1):
            if self.open[level].tag == tag:
                return self._end_from(level)

    def handle_data(self, data):
        last = self.nodes[-1] if self.nodes else None
        if last and last.text is not None and last.depth == len(self.open):
            last.text += data
        else:
            self._add("#text", text=data)

    def under(self, node):
        if node is None:
            return []
        return self.nodes[node.pos + 1:node.end + 1]

    def all(self, within, tag=None, cls=None, cls_has=None):
        return [n for n in within if n.is_a(tag, cls, cls_has)]

    def first(self, within, tag=None, cls=None, cls_has=None):
        return next((n for n in within if n.is_a(tag, cls, cls_has)), None)

    def texts(self, *nodes):
        return [n.text for node in nodes for n in self.under(node) if n.text is not None]

    def text(self, node):
        return None if node is None else "".join(self.texts(node)).strip()


_STRING, _STRINGS = T.StringType(), T.ArrayType(T.StringType())


def _struct(**fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _per_page(html: pa.Array, one, kind: T.DataType) -> pa.Array:
    found = (None if text is None else one(_Page(text)) for text in html.to_pylist())
    return pa.array(list(found), to_arrow_type(kind))


# --- list elements ----------------------------------------------------------

def element_texts(tag: str):
    @F.arrow_udf(_STRINGS)
    def run(html: pa.Array) -> pa.Array:
        return _per_page(html, lambda page: [page.text(e) for e in page.all(page.nodes, tag)], _STRINGS)

    return run


def element_rows(pages: DataFrame, keep: list[str], tag: str, html: str = "html") -> DataFrame:
    """One row per ``tag`` element: its place among them and its text."""
    return pages.select(*keep, element_texts(tag)(F.col(html)).alias("found")).select(
        *keep, F.posexplode("found").alias("pos", "text"))


@F.udtf(returnType="pos: int, text: string")
class ElementTexts:
    """The elements of a page under one tag, for use in SQL: ``pages p, LATERAL element_texts(p.html, 'li')``."""

    def eval(self, html: str, tag: str):
        if html is not None:
            page = _Page(html)
            for pos, element in enumerate(page.all(page.nodes, tag)):
                yield pos, page.text(element)


# --- comment fragments ------------------------------------------------------

_COMMENTS = T.ArrayType(_struct(
    author=_STRING, shown=_STRINGS, hidden=_STRINGS, likes=_STRING, replies=_STRING))


@F.arrow_udf(_COMMENTS)
def _comment_parts(html: pa.Array) -> pa.Array:
    def part(page, item):
        inside = page.under(item)

        def counter(button):
            buttons = page.all(inside, "a", cls_has=button)
            ems = [em for a in buttons for em in page.all(page.under(a), "em")]
            return next(iter(page.texts(*ems)), None)

        names = [
            a for head in page.all(inside, "div", cls="status-retweet-user")
            for a in page.all(page.under(head), "a", cls="name") if a.depth == head.depth + 1
        ]
        return {
            "author": next(iter(page.texts(*names)), None),
            "shown": page.texts(*page.all(inside, "div", cls="text")),
            "hidden": page.texts(*page.all(inside, "script", cls="single-description")),
            "likes": counter("btn-like"), "replies": counter("btn-status-reply"),
        }

    def one(page):
        return [part(page, i) for i in page.all(page.nodes, "div", cls_has="status-item")]

    return _per_page(html, one, _COMMENTS)


def comments(html: Column) -> Column:
    """Comments of a fragment, in page order; absent authors and counts have their defaults."""
    return F.transform(_comment_parts(html), lambda c: F.struct(
        F.coalesce(sc.strip_blanks(c["author"]), F.lit(sc.AUTHOR_UNKNOWN)).alias("author"),
        sc.fuller_text(c["shown"], c["hidden"]).alias("text"),
        F.coalesce(c["likes"], F.lit("0")).alias("likes"),
        F.coalesce(c["replies"], F.lit("0")).alias("comments_count"),
    ))


def comment_rows(fragments: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """``(.., html)`` to one row per comment."""
    return fragments.select(*keep, F.posexplode(comments(F.col(html))).alias("pos", "c")).select(
        *keep, "pos", "c.*")


# --- portfolio pages --------------------------------------------------------

# The figures in page order.
FIGURES = ["total_return_percentage", "daily_return_percentage", "monthly_return_percentage",
           "net_worth", "total_revenue_ranking_exceeds"]
_PARTS = _struct(
    name=_STRING, follows=_STRING, figures=_STRINGS, creator_href=_STRING, creator=_STRING,
    about=_STRING, closed=T.BooleanType(), notes=_STRINGS,
    listed=T.ArrayType(_struct(
        cls=_STRING, category_name=_STRING, proportion=_STRING, name=_STRING, price=_STRING,
        weight=_STRING)),
)


@F.arrow_udf(_PARTS)
def _portfolio_parts(html: pa.Array) -> pa.Array:
    def listed(page, item):
        inside = page.under(item)

        def pick(*args, **kwargs):
            return page.text(page.first(inside, *args, **kwargs))

        return {
            "cls": item.attrs["class"],
            "category_name": pick("span", cls="segment-name"),
            "proportion": pick("span", cls="segment-weight weight"),
            "name": pick("div", cls="name"), "price": pick("div", cls="price"),
            "weight": pick("span", cls_has="stock-weight"),
        }

    def one(page):
        title = page.first(page.nodes, cls_has="cube-title")
        info = next((n for n in page.nodes if n.attrs.get("id") == "cube-info"), None)
        box = page.under(page.first(page.nodes, "div", cls_has="cube-creator-info"))
        creator = page.first(box, "a", cls_has="creator")
        closed = page.first(page.nodes, "div", cls="cube-closed")
        holds = page.first(page.nodes, "div", cls="weight-list")
        return {
            "name": page.text(page.first(page.under(title), cls="name")),
            "follows": page.text(page.first(page.under(title), "span", cls="num")),
            "figures": [page.text(n) for n in page.all(page.under(info), cls_has="per")],
            "creator_href": creator and creator.attrs.get("href"),
            "creator": creator and page.text(page.first(page.under(creator), cls="name")),
            "about": page.text(page.first(page.under(page.first(box, "div", cls="desc")), "span", cls="text")),
            "closed": closed is not None,
            "notes": [page.text(p) for p in page.all(page.under(page.first(page.under(closed), "div", cls="text")), "p")],
            "listed": [
                listed(page, n) for n in page.under(holds)
                if n.text is None and n.depth == holds.depth + 1 and n.attrs.get("class")
            ],
        }

    return _per_page(html, one, _PARTS)


# Marked so that the filter on the title is not moved below it, which would parse every page twice.
_parts_once = _portfolio_parts.asNondeterministic()


def holdings(listed: Column) -> Column:
    """Segments with their stocks; a stock belongs to the segment before it."""
    placed = F.transform(listed, lambda x, i: x.withField("at", i))
    is_segment = lambda x: F.contains(x["cls"], F.lit("segment"))
    segments = F.filter(placed, is_segment)
    stocks = F.filter(placed, lambda x: ~is_segment(x) & F.contains(x["cls"], F.lit("stock")))

    def segment(seg, i):
        end = F.coalesce(F.get(segments, i + 1)["at"], F.size(listed))
        mine = F.filter(stocks, lambda s: (s["at"] > seg["at"]) & (s["at"] < end))
        return F.struct(
            seg["category_name"].alias("category_name"), seg["proportion"].alias("proportion"),
            F.transform(mine, lambda s: F.struct(s["name"], s["price"], s["weight"])).alias("stocks"),
        )

    return F.transform(segments, segment).cast(
        "array<struct<category_name: string, proportion: string, stocks: "
        "array<struct<name: string, price: string, weight: string>>>>"
    )


def portfolio_documents(captures: DataFrame) -> DataFrame:
    """``(symbol, html, comments_html, rebalances)`` to the nested portfolio document.

    A page without a title is a failed capture and gives no document.
    """
    p = F.col("parts")
    return (
        captures.select(
            "symbol", "rebalances", _parts_once(F.col("html")).alias("parts"),
            comments(F.col("comments_html")).alias("comments"),
        )
        .filter(p["name"].isNotNull())
        .select(
            "symbol", p["name"].alias("portfolio_name"),
            sc.first_digits(p["follows"]).alias("portfolio_follows"),
            *sc.named_figures(p["figures"], FIGURES),
            sc.last_segment(p["creator_href"]).alias("create_user_id"),
            p["creator"].alias("create_user_name"), p["about"].alias("portfolio_description"),
            p["closed"].alias("is_closed"),
            sc.label_value(p["notes"], sc.CREATED_LABEL).alias("create_time"),
            sc.label_value(p["notes"], sc.CLOSED_LABEL, unless=sc.CREATED_LABEL).alias("close_time"),
            holdings(p["listed"]).alias("detailed_position"), "comments", "rebalances",
        )
    )


def holding_rows(children_rows: DataFrame) -> DataFrame:
    """Captured holdings children as rows: each stock under the segment before it.

    Input ``(symbol, pos, class, segment_name, segment_weight, name, price, weight)``. Stocks
    before any segment are dropped.
    """
    is_segment = F.contains(F.col("class"), F.lit("segment"))
    segment = F.when(is_segment, F.struct("segment_name", "segment_weight"))
    rows = children_rows.filter(F.contains("class", F.lit("segment")) | F.contains("class", F.lit("stock")))
    filled = fill_forward(rows, ["symbol"], "pos", segment, "segment")
    return filled.filter(~is_segment & F.col("segment").isNotNull()).select(
        "symbol", "pos", F.col("segment.segment_name").alias("segment_name"),
        F.col("segment.segment_weight").alias("segment_weight"), "name", "price", "weight",
    )
