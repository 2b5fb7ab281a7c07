"""Main text of web pages by tag-path ratios.

Every block of text belongs to a path of tags from the root. For each path the text's length and its punctuation are
added up and divided by the number of its nodes; the two ratios are smoothed along the page's sequence of paths, fused by
their product and thresholded. Every block whose path passes is text. So are the other blocks of the articles (or main elements)
where these hold half of the fused weight; elsewhere those below the common ancestor of the passing blocks that aren't mostly
links, and headings beside it. Menus, headers, footers, sidebars, adverts, forms and reader comments go at once. Names that can
be those of an article's parts as well (all but adverts and comments inside an article) only remove an element none of whose paths passes.

A null or empty page has an empty text; repeated rows have one text each, an empty table has none, other columns are ignored. Broken markup is
read leniently: unclosed elements end where an element above them ends, and a stray end tag is passed over. Quotes only open
after an attribute's equals sign; one that is never closed is an ordinary sign. Every step takes time in proportion to the page, however deep
its elements are.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_texts, bounded_batches, record_batches

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea select svg math iframe object canvas title noembed noframes video audio button option".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
#: An element of the key ends an open one of the values, up to the nearest of those listed as bounds.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
BOUNDS = frozenset("ul ol dl table tbody thead tfoot article section div main aside nav header footer form body html".split())
#: Elements, and words in class, id or role, that mark what isn't the article.
BESIDE = frozenset("nav aside footer form head dialog menu".split())
MARKS = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|menu\w*|nav|navbar|navigation|breadcrumbs?|sidebar|side-bar|footer|site-header|page-header|masthead|comments?|commentlist|disqus|discussion|replies|"
    r"cookies?|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|widget|toolbar|pagination|pager|copyright|disclaimer|complementary|contentinfo|search)(?:$|[^a-z])"
)
#: Of these, the ones that can name an article's subject or part: they count only where no path passes.
DOUBTFUL = re.compile(r"(?:^|[^a-z])(?:discussion|replies|notices?|alert|subscribe|signup|login|share|sharing|social|related|recommended|copyright|disclaimer|search)(?:$|[^a-z])")
#: Whole words of a class or role that count at once inside an article too.
FOREIGN = re.compile(r"(?:^|\s)(?:ads?|advert\w*|adsense|sponsored|comments?|commentlist|disqus)(?:$|\s)")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold text rather than parts of a page, and sections: their names are no more than a hint.
HINTED = frozenset("section p li dt dd td th pre blockquote figure figcaption".split())
TEXTUAL = HINTED - {"section"}
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"([^\s=>\"'/][^\s=>/]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
TELLING = frozenset("class id role hidden aria-hidden style".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
SPACE = re.compile(r"\s+")


class Node:
    """An element. What an element above it decides is kept on it, so nothing is looked for upwards."""

    __slots__ = ("article", "beside", "doubt", "hidden", "holder", "linked", "main", "number", "open", "parent", "path", "tag")

    def __init__(self, tag: str, parent: Node | None, number: int = 0, path: int = 0, attributes: str = ""):
        self.tag, self.parent, self.number, self.path = tag, parent, number, path
        self.beside = parent.beside if parent else False
        self.hidden = parent.hidden if parent else False
        self.doubt: Node | None = parent.doubt if parent else None  # the outermost element with a doubtful name
        self.linked = tag == "a" or (parent is not None and parent.linked)
        self.article: Node | None = parent.article if parent else None  # the outermost ones
        self.main: Node | None = parent.main if parent else None
        self.holder: Node = parent.holder if parent and tag in INLINE else self  # the nearest that isn't inline
        #: Open elements by tag up to the nearest bound.
        self.open: Counter = Counter() if parent is None or tag in BOUNDS else parent.open
        self.open[tag] += 1
        if parent is not None and not self.beside:
            article = self.article is not None or self.main is not None
            self.beside = tag in BESIDE or (tag == "header" and not article)
            if attributes and not self.beside and tag not in ("html", "body", "article", "main"):
                named: dict[str, str] = {}
                for k, v in ATTRIBUTE.findall(attributes):
                    if k.lower() in TELLING:
                        named.setdefault(k.lower(), v.strip("\"'").lower())
                if named.get("aria-hidden") == "true" or "hidden" in named or "display:none" in named.get("style", "").replace(" ", ""):
                    self.beside = self.hidden = True
                elif tag not in HEADINGS:
                    self.mark(named, article)
        if tag == "article" and self.article is None:
            self.article = self
        if tag == "main" and self.main is None:
            self.main = self

    def mark(self, named: dict[str, str], article: bool) -> None:
        """Judge by the words in class, id and role."""
        words = " ".join(named.get(k, "") for k in ("class", "id", "role")).replace("_", "-")
        if not words.strip() or not MARKS.search(words):
            return
        if FOREIGN.search(f"{named.get('class', '')} {named.get('role', '')}"):
            self.beside = True
        elif not article and self.tag not in HINTED and not DOUBTFUL.search(words):
            self.beside = True
        elif self.doubt is None and self.tag not in INLINE:
            self.doubt = self


class Block:
    __slots__ = ("linked", "node", "parts", "plain")

    def __init__(self, node: Node):
        self.node, self.parts, self.linked, self.plain = node, [], 0, False

    def text(self) -> str:
        return SPACE.sub(" ", "".join(self.parts)).strip()

    def mostly_links(self) -> bool:
        return self.linked * 2 >= len(self.text())


class Scanner:
    """Tags and the texts between them."""

    def __init__(self, page: str):
        self.page = page
        self.missing: set[str] = set()  # what doesn't occur any more

    def find(self, what: str, at: int) -> int:
        if what in self.missing:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def close(self, at: int) -> int:
        """Where the tag ends whose attributes begin at a place; -1 if it doesn't."""
        page = self.page
        while True:
            end = self.find(">", at)
            if end < 0:
                return -1
            sign = page.find("=", at, end)
            if sign < 0:
                return end
            at = sign + 1
            while at < len(page) and page[at].isspace():
                at += 1
            quote = page[at : at + 1]
            if quote in ('"', "'") and quote:
                shut = self.find(quote, at + 1)
                at = at + 1 if shut < 0 else shut + 1
            else:
                while at < len(page) and page[at] != ">" and not page[at].isspace():
                    at += 1

    def tags(self) -> Iterator[tuple[str, str, str, str, int]]:
        """(text before, "/" or "", tag, attributes, place after); a tag of "" for what is left out, one of "#" after the last text."""
        page, at, begin = self.page, 0, 0
        while True:
            at = page.find("<", at)
            if at < 0 or at + 1 >= len(page):
                break
            sign = page[at + 1]
            if sign in "!?" or (sign == "/" and not page[at + 2 : at + 3].isalpha()):
                if page.startswith("<!--", at):
                    end = self.find("-->", at + 2)
                    end = end + 2 if end >= 0 else -1
                else:
                    end = self.find(">", at)
                end = len(page) if end < 0 else end + 1
                yield page[begin:at], "", "", "", end
            else:
                m = TAG.match(page, at)
                if m is None:
                    at += 1
                    continue
                end = self.close(m.end())
                if end < 0:  # a tag that never ends is text
                    at += 1
                    continue
                yield page[begin:at], m[1], m[2].lower(), page[m.end() : end], end + 1
                end = self.skip if self.skip > end else end + 1
            at = begin = end
        yield page[begin:], "", "#", "", len(page)

    skip = 0  # set by the reader: go on here


def blocks(page: str) -> list[Block]:
    """The page's blocks of text in order, each with its nearest element that isn't inline."""
    root = Node("#", None)
    top, out, block = root, [], None
    scan, number, paths = Scanner(page), 0, {}
    opened: Counter = Counter()
    low = page.lower()
    low = low if len(low) == len(page) else page
    endless: set[str] = set()

    def leave(n: Node) -> None:
        """Close the open elements up to n."""
        nonlocal top
        stop = n.parent
        while top is not stop:
            top.open[top.tag] -= 1
            opened[top.tag] -= 1
            top = top.parent  # type: ignore[assignment]

    def add(text: str) -> None:
        nonlocal block
        if not text:
            return
        if "&" in text:
            text = unescape(text)
        blank = not text.strip()
        if block is None:
            if blank:
                return
            block = Block(top.holder)
            out.append(block)
        if top.hidden and not block.node.hidden:
            return
        block.parts.append(text)
        if not blank and (not top.beside or block.node.beside):
            block.plain = True  # not all of it stands in marked inline elements
        if top.linked:
            block.linked += len(text)

    for text, slash, tag, attributes, at in scan.tags():
        add(text)
        if not tag or tag == "#":
            continue
        if tag == "br":
            if block is not None:
                block.parts.append(" ")
            continue
        if tag in RAW:
            if not slash and not attributes.endswith("/") and tag not in endless:
                end = low.find(f"</{tag}", at)
                if end >= 0:
                    close = page.find(">", end)
                    scan.skip = close + 1 if close >= 0 else len(page)
                elif tag in ("script", "style"):
                    scan.skip = len(page)
                else:
                    endless.add(tag)
            continue
        if tag in VOID:
            if tag == "hr":
                block = None
            continue
        if tag not in INLINE:
            block = None
        if slash:
            if not (top.open if tag in INLINE and top.tag not in BOUNDS else opened)[tag] or (tag in INLINE and top.tag in BOUNDS):
                continue
            n = top
            while n.tag != tag and n.parent is not None:
                if n.tag in BOUNDS and tag in INLINE:
                    break
                n = n.parent
            if n.tag == tag and n.parent is not None:
                leave(n)
            continue
        if tag not in INLINE:  # a block ends an open paragraph or heading, a list item the one before, and so on
            ends = ENDS.get(tag, frozenset())
            here = top.open
            if here["p"] > 0 or any(here[x] > 0 for x in ends):
                n, hit = top, None
                while n is not None and n.tag not in BOUNDS:
                    if n.tag == "p" or n.tag in ends:
                        hit = n
                    n = n.parent  # type: ignore[assignment]
                if n is not None and n.tag in ends:
                    hit = n
                if hit is not None and hit.parent is not None:
                    leave(hit)
        if not attributes.endswith("/"):
            number += 1
            path = top.path if tag in INLINE and tag != "a" else paths.setdefault((top.path, tag), len(paths) + 1)
            top = Node(tag, top, number, path, attributes)
            opened[tag] += 1
    return [b for b in out if b.text()]


def path_weights(found: list[Block]) -> dict[int, float]:
    """The fused ratio of each path: text and punctuation by node, smoothed along the page, damped by links."""
    total: dict[int, list[float]] = {}
    for b in found:
        t = b.text()
        r = total.setdefault(b.node.path, [0.0, 0.0, 0.0, 0.0])
        r[0] += 1
        r[1] += len(t)
        r[2] += len(PUNCTUATION.findall(t))
        r[3] += min(b.linked, len(t))
    line = [b.node.path for b in found]
    ratio = {p: (r[1] / r[0], (r[2] + 0.1) / r[0], 1 - r[3] / max(r[1], 1)) for p, r in total.items()}
    kernel = [math.exp(-d * d / 2) for d in range(-2, 3)]
    smooth: dict[int, list[float]] = {}
    for i, p in enumerate(line):
        near = [(k, ratio[line[i + d]]) for d, k in zip(range(-2, 3), kernel, strict=True) if 0 <= i + d < len(line)]
        whole = sum(k for k, _ in near)
        s = smooth.setdefault(p, [0.0, 0.0, 0.0])
        s[0] += sum(k * x[0] for k, x in near) / whole
        s[1] += sum(k * x[1] for k, x in near) / whole
        s[2] += 1
    return {p: math.sqrt(s[0] * s[1]) / s[2] * ratio[p][2] * math.log1p(total[p][1]) for p, s in smooth.items()}


def main_text(page: str) -> str:
    found = blocks(page)
    kept = [b for b in found if b.plain and not b.node.beside]
    if not kept:
        return ""
    weight = path_weights(kept)
    cut = sum(weight.values()) / len(weight) * 0.5
    passes = lambda b: weight[b.node.path] >= cut
    sound = {b.node.doubt for b in kept if passes(b)}
    kept = [b for b in kept if b.node.doubt is None or (b.node.doubt in sound and (passes(b) or not b.mostly_links()))]
    strong = [b for b in kept if passes(b)]
    mass = [weight[b.node.path] * len(b.text()) for b in strong]
    for tag in ("article", "main"):
        region = lambda n: getattr(n, tag)  # noqa: B023,E731
        regions = [region(b.node) for b in strong]
        if sum(m for m, r in zip(mass, regions, strict=True) if r is not None) >= 0.5 * sum(mass):
            whole = {r for r in regions if r is not None}
            return "\n\n".join(b.text() for b in kept if passes(b) or region(b.node) in whole)
    root = common_ancestor([b.node for b in strong])
    # a block's own element isn't the root of a page
    while root.parent is not None and (root.tag in TEXTUAL or root.tag in HEADINGS):
        root = root.parent

    known = {root: True}

    def inside(n: Node | None) -> bool:
        chain = []
        while n is not None and n not in known:
            chain.append(n)
            n = n.parent
        found = n is not None and known[n]
        known.update(dict.fromkeys(chain, found))
        return found

    title = lambda b: b.node.tag in HEADINGS and b.node.parent is root.parent
    return "\n\n".join(b.text() for b in kept if (inside(b.node) and (passes(b) or weight[b.node.path] >= cut * 0.2 or not b.mostly_links())) or title(b))


def common_ancestor(nodes: list[Node]) -> Node:
    """The deepest element that holds all of the nodes, or is one of them and holds the others: that of the first and the last in page order."""
    first, last = min(nodes, key=lambda n: n.number), max(nodes, key=lambda n: n.number)
    above = set()
    at: Node | None = first
    while at is not None:
        above.add(at)
        at = at.parent
    while last not in above:
        last = last.parent  # type: ignore[assignment]
    return last


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of each page."""
    bounded_batches(pages.sparkSession)
    kinds = dict(pages.dtypes)

    def run(it):
        for b in record_batches(it):
            texts = [main_text(x) for x in as_texts(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [id_col, url_col, "text", "n_chars"])

    source = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))
    return source.mapInArrow(run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")
