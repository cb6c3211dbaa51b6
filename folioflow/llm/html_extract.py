"""The main text of a web page by tree scoring.

Paragraphs earn points for their length and commas, discounted by their link density, and pass
them to their ancestors: all to the parent, half to the grandparent, a third of a half and so on
further up. The container with the most points is the article; its siblings stay if they score
well or read like text. What is never article is cut before scoring: menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments, by tag or by the words of
class, id and role.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import DataFrame, functions as F

from folioflow.llm.common import map_texts, narrow

# Elements of HTML by what they are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section
    summary table tbody td tfoot th thead tr ul""".split())
# A start tag of these ends an open paragraph.
_ENDS_PARAGRAPH = BLOCKS - {"html", "body", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "summary"}
# A start tag ends an open element of the listed kinds, looked for up to the listed bounds.
_ENDS_ITEM = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
              "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
              "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
CUT_TAGS = frozenset("""aside audio base button canvas datalist dialog embed fieldset footer form head header iframe
    input link map menu meta nav noscript object script select style svg template textarea title video""".split())
CUT_ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search
    toolbar""".split())
CUT_WORDS = frozenset("""ad adbox ads adslot adsense adunit adv advert adverts advertisement advertising alert aside
    banner banners bottombar breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies copyright
    disclaimer discussion disqus feedback footer gdpr header login masthead menu menus modal nav navbar navigation
    newsletter notice notices outbrain overlay pager pagination paywall popup promo promoted promotion rail reactions
    recommended related replies reply respond share sharing shoutbox sidebar sidebars signup skip social sponsor sponsored
    subscribe subscription taboola toolbar topbar widget widgets""".split())
# "has-sidebar" says something about a container, "entry-header" is part of an article.
_ABOUT_WORDS = frozenset("has no with without".split())
_ARTICLE_PARTS = frozenset("article entry post story".split())
_HEAD_WORDS = frozenset("banner header byline".split())
_ARTICLE_WORDS = frozenset("article body content entry main post story text".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SCORED = frozenset("p pre td blockquote li dd div section article main".split())
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "cut", "score", "words", "length", "links")

    def __init__(self, tag: str, parent: Node | None, cut: bool = False, words: frozenset = frozenset()):
        self.tag, self.parent, self.cut, self.words = tag, parent, cut, words
        self.children: list = []  # nodes and texts
        self.score = 0.0
        self.length = self.links = 0  # characters below, and those of them in links


def _labels(attrs: list) -> tuple[frozenset, str]:
    words, role = set(), ""
    for name, value in attrs:
        if value and name in ("class", "id"):
            words.update(w.lower() for w in _WORD.findall(value))
        elif value and name == "role":
            role = value.strip().lower()
    return frozenset(words), role


def _is_cut(tag: str, words: frozenset, role: str, attrs: list, parent: Node) -> bool:
    if tag in ("html", "body"):
        return False
    if tag == "header":
        # An article's own header holds its title.
        return not _inside(parent, {"article", "main"})
    if tag in CUT_TAGS or role in CUT_ROLES:
        return True
    if any(n == "hidden" or n == "aria-hidden" and v == "true" or n == "style" and v and "display:none" in v.replace(" ", "")
           for n, v in attrs):
        return True
    if words & _ABOUT_WORDS:
        return False
    return bool(words & (CUT_WORDS - _HEAD_WORDS if words & _ARTICLE_PARTS else CUT_WORDS))


def _inside(node: Node | None, tags: set) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


class _Tree(HTMLParser):
    """A tolerant tree: unclosed paragraphs, items and inline elements end where they must."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.open: Counter = Counter()  # so that no walk looks for what is not there

    def _end(self, node: Node) -> None:
        while True:
            at, self.at = self.at, self.at.parent
            self.open[at.tag] -= 1
            if at is node:
                return

    def _close(self, tags: set, bounds: set) -> None:
        if not any(self.open[t] for t in tags):
            return
        node = self.at
        while node.parent is not None and node.tag not in bounds:
            if node.tag in tags:
                return self._end(node)
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("html", "body"):
            # A body ends a head that was left open.
            self._close({"head"}, set())
            return
        if tag in _ENDS_PARAGRAPH:
            self._close({"p"}, {"button", "table", "td", "th", "object", "template"})
        if tag in _ENDS_ITEM:
            self._close(*_ENDS_ITEM[tag])
        words, role = _labels(attrs) if attrs else (frozenset(), "")
        cut = self.at.cut or _is_cut(tag, words, role, attrs, self.at)
        node = Node(tag, self.at, cut, words)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if not self.open[tag]:
            return
        node = self.at
        while node.tag != tag:
            # An inline end tag does not reach out of its block.
            if tag not in BLOCKS and node.tag in BLOCKS:
                return
            node = node.parent
        self._end(node)

    def handle_data(self, data: str) -> None:
        if not self.at.cut:
            self.at.children.append(data)

    def unknown_decl(self, data: str) -> None:
        """A CDATA section is text."""
        if data.startswith("CDATA[") and not self.at.cut:
            self.at.children.append(data[6:])


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def _own_text(node: Node, linked: bool = False) -> tuple[list[str], int, int]:
    """Texts of a block without those of blocks in it; their length, and the length in links."""
    texts, length, links, stack = [], 0, 0, [(c, linked) for c in reversed(node.children)]
    while stack:
        child, inside = stack.pop()
        if isinstance(child, str):
            size = len(child.strip())
            texts.append(child)
            length += size
            links += size if inside else 0
        elif not child.cut and child.tag not in BLOCKS:
            inside = inside or child.tag == "a"
            stack.extend((c, inside) for c in reversed(child.children))
    return texts, length, links


def _score(root: Node) -> list[Node]:
    """Let every text block pass its points up; the nodes that got any."""
    scored, stack = [], [root]
    while stack:
        node = stack.pop()
        stack.extend(c for c in node.children if isinstance(c, Node) and not c.cut)
        if node.tag not in _SCORED and node.tag not in _HEADINGS:
            continue
        texts, length, links = _own_text(node)
        if not length:
            continue
        text = "".join(texts)
        points = (min(1.0, length / 25) + text.count(",") + min(length / 100, 3.0)) * (1 - links / length)
        # A block that only holds text of its own passes points on; one with blocks in it keeps them.
        holder, share = (node if node.tag in ("div", "section", "article", "main") else node.parent), 1.0
        level = 0
        while holder is not None and level < 6:
            if holder.score == 0.0:
                scored.append(holder)
            holder.score += points * share + 1e-9
            level += 1
            share = 0.5 if level == 1 else 0.5 / (3 * (level - 1))
            holder = holder.parent
    return scored


def _weight(node: Node) -> float:
    if node.tag in ("article", "main"):
        return 1.5
    return 1.2 if node.words & _ARTICLE_WORDS else 1.0


def _measure(root: Node) -> None:
    """Lengths of the texts below each node, all and in links."""
    order, stack = [], [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.tag == "a"
        order.append(node)
        for child in node.children:
            if isinstance(child, str):
                size = len(child.strip())
                node.length += size
                node.links += size if inside else 0
            elif not child.cut:
                stack.append((child, inside))
    for node in reversed(order[1:]):
        node.parent.length += node.length
        node.parent.links += node.links


def _link_density(node: Node) -> float:
    return node.links / node.length if node.length else 0.0


def _article(root: Node) -> list[Node]:
    """The best container with the siblings that belong to it, in page order."""
    _measure(root)
    scored = _score(root)
    if not scored:
        return [root]
    best = max(scored, key=lambda n: n.score * _weight(n) * (1 - _link_density(n)))
    # Part of an article element: take the article.
    node = best
    while node is not None:
        if node.tag == "article":
            best = node
        node = node.parent
    if best.parent is None:
        return [best]
    enough = max(2.0, best.score * 0.2)
    kept = []
    for child in best.parent.children:
        if isinstance(child, str) or child.cut:
            continue
        if child is best or child.score >= enough and _link_density(child) < 0.5:
            kept.append(child)
        elif child.tag == "p" or child.tag in _HEADINGS:
            _, length, links = _own_text(child)
            if length > 80 and links / length < 0.25 or child.tag == "h1":
                kept.append(child)
    return kept


def _blocks(node: Node) -> list[str]:
    """The texts of the blocks under a node, in page order, white space folded."""
    out, run = [], []

    def end():
        text = _SPACE.sub(" ", "".join(run)).strip()
        if text:
            out.append(text)
        run.clear()

    stack: list = [node]
    while stack:
        at = stack.pop()
        if at is None:
            end()
        elif isinstance(at, str):
            run.append(at)
        elif at.cut:
            continue
        elif at.tag == "br":
            run.append("\n")
        else:
            if at.tag in BLOCKS:
                end()
                stack.append(None)
            stack.extend(reversed(at.children))
    end()
    return out


def main_text(html: str) -> str:
    """Blocks of the main text joined by an empty line; the empty text if there is none."""
    if not html:
        return ""
    return "\n\n".join(b for node in _article(parse(html)) for b in _blocks(node))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", *others: str) -> DataFrame:
    """``doc_id``, the other columns asked for, ``text`` and ``n_chars``: one row per page.

    A null or empty page has the empty text. Pages are read whole, broken or cut off as they may be;
    rows that repeat stay.
    """
    def run(texts: list[str]) -> dict:
        found = [main_text(t) for t in texts]
        return {"text": found, "n_chars": [len(t) for t in found]}

    rows = narrow(pages, id_col, html_col, *others).withColumnRenamed("text", "html")
    kept = rows.select("doc_id", *(F.col(c) for c in others), "html")
    return map_texts(kept, run, "text string, n_chars bigint", text_col="html")
