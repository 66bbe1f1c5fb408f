"""Main text of web pages by composite text density.

A page is parsed into elements; scripts, styles, forms, menus, headers, footers, sidebars, notices,
adverts and reader comments go by their tags, roles and labels. For each remaining element i, with C
characters, T tags, LC link characters, LT link tags and NLC = C - LC in it, and Cb and LCb those of the
body, the link-adjusted density is

    C / T * log_b(C * T / (LC * LT))    with b = ln(C * LC / NLC + LCb * C / Cb + e)

(counts of 0 taken as 1). The density sum of an element adds up its children's densities. On every
page the element of the body with the largest sum sets the threshold: the least density on its path to
the body; going down from the body, each element that reaches the threshold gives its part with the
largest sum. Marks are hints and exclude nothing: <article> and <main> win ties of the sum, and a part
within an <article>, or within a <main> that holds no article, brings the whole of it.

The text is that of the selected elements: one line per block, in page order, character references
decoded, white space of a block made one space. Nothing is capped.

Rows are independent, so nothing is shuffled; only one page at a time is taken apart. Edge cases: a
null, empty or tagless page (its text is its only block); unclosed and misplaced tags follow the usual
rules (a block start ends an open paragraph, an end tag without a start is ignored); repeated rows are
extracted each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import whole_text

# Names of HTML elements by their part in a page, and words of class and id labels.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
GONE = frozenset(
    "script style noscript template iframe svg canvas video audio object embed applet map nav footer aside form button select textarea input"
    " dialog menu head title datalist xmp noembed noframes".split()
)
ARTICLE = frozenset(("article", "main"))
#: Start tags that end an open element of the same kind, up to the given container.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
LABELS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr popup newsletter"
    " subscribe signup comment comments commentlist disqus replies respond sidebar menu nav navbar navigation breadcrumb breadcrumbs"
    " pagination pager share sharing social related recommended masthead footer".split()
)
#: Labels that count only on elements without a word of CONTENT.
WEAK_LABELS = frozenset("header banner notice notices alert modal overlay widget toolbar topbar login search disclaimer side".split())
CONTENT = frozenset("article content post entry body story main text".split())

_NAME, _NAME_END, _SPECIAL = re.compile(r"</?[a-zA-Z]"), re.compile(r"[\s/>]"), re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_LABEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("tag", "parent", "children", "gone", "in_article", "holds_article", "mark", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: Node | None) -> None:
        self.tag, self.parent, self.children = tag, parent, []  # children: nodes and texts
        self.gone = self.in_article = self.holds_article = False
        self.mark = self
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _unwanted(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in GONE or (tag == "header" and not in_article):
        return True
    if not attributes.strip() or tag in ("html", "body"):
        return False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if found.get("role", "").lower() in ROLES or "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True
    words = {w.lower() for w in _LABEL.findall(f"{found.get('class', '')} {found.get('id', '')}")}
    return bool(words & LABELS or (words & WEAK_LABELS and not words & CONTENT)) and not (tag in ARTICLE and not words & {"comment", "comments", "ad", "sponsored", "related"})


class _Tags:
    """The tags of a page from left to right, in time proportional to its length: places looked up once
    are remembered, and so are quotes and angle brackets that are known not to end a tag."""

    def __init__(self, page: str) -> None:
        self.page, self.at = page, 0
        self.last = {c: page.rfind(c) for c in ">\"'"}
        self.seen: dict[re.Pattern, tuple[int, int]] = {}
        self.unended: set[int] = set()

    def _next(self, pattern: re.Pattern, at: int) -> int:
        """The first place of the pattern from ``at`` on, or the end of the page."""
        low, found = self.seen.get(pattern, (1, 0))
        if not low <= at <= found:
            m = pattern.search(self.page, at)
            found = m.start() if m else len(self.page)
            self.seen[pattern] = (at, found)
        return found

    def _end(self, at: int) -> int:
        """The place of the bracket that ends the tag, quoted parts passed over; -1 if there is none."""
        passed = []
        while True:
            at = self._next(_SPECIAL, at)
            if at >= len(self.page) or at in self.unended or at > self.last[">"]:
                break
            if self.page[at] == ">":
                return at
            passed.append(at)
            if at >= self.last[self.page[at]]:
                break  # the quote is never closed
            at = self.page.index(self.page[at], at + 1) + 1
        self.unended.update(passed)
        return -1

    def __iter__(self) -> Iterator[tuple[str, bool, str, str]]:
        """(text before, whether it is an end tag, its name, its attributes) of each tag; the name is empty
        after a comment or declaration. ``at`` may be moved on meanwhile."""
        page, start = self.page, 0
        while (start := page.find("<", start)) >= 0:
            if page.startswith("<!--", start):
                stop = page.find("-->", start + 4)
                found = ("", "", len(page) if stop < 0 else stop + 3)
            elif page.startswith(("<!", "<?"), start):
                stop = page.find(">", start + 2)
                found = ("", "", len(page) if stop < 0 else stop + 1)
            elif start < self.last[">"] and (m := _NAME.match(page, start)):
                first = m.end() - 1
                stop = self._next(_NAME_END, first)
                end = self._end(stop)
                found = (page[first:stop], page[stop:end], end + 1) if end >= 0 else None
            else:
                found = None
            if found is None:
                start += 1
                continue
            before, self.at = page[self.at : start], found[2]
            yield before, bool(found[0]) and page[start + 1] == "/", found[0].lower(), found[1]
            start = self.at


class _Open:
    """The open elements, with the depths of each tag."""

    def __init__(self, root: Node) -> None:
        self.stack, self.depths, self.blocks = [root], {}, []  # blocks: depths of blocks other than p

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in BLOCK and node.tag != "p":
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def _innermost(self, tags) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def close(self, names: set[str], barrier: int) -> None:
        """End the innermost open element of these names, unless it is outside the barrier."""
        depth = self._innermost(names)
        if depth and depth >= barrier:
            for node in self.stack[depth:]:
                self.depths[node.tag].pop()
                if node.tag in BLOCK and node.tag != "p":
                    self.blocks.pop()
            del self.stack[depth:]

    def end(self, tag: str) -> None:
        """An end tag: of a block, whatever is open within; of another element, up to the next block."""
        self.close({tag}, 0 if tag in BLOCK else max(self.block(), self._innermost(("p",))))

    def block(self) -> int:
        return self.blocks[-1] if self.blocks else 0

    def start(self, tag: str) -> None:
        """What a start tag ends by itself."""
        if tag in BLOCK and tag not in ("html", "body"):
            self.close({"p"}, self.block())
        if tag in ENDS:
            names, until = ENDS[tag]
            self.close(names, self._innermost(until))


def parse(page: str) -> list[Node]:
    """The elements of a page in order, the root first; texts stand among the children."""
    root = Node("#root", None)
    nodes, open_, tags = [root], _Open(root), _Tags(page)
    for before, ends, tag, attributes in tags:
        now = open_.stack[-1]
        if before:
            now.children.append(before)
        if not tag:
            continue
        if ends:
            open_.end(tag)
            continue
        open_.start(tag)
        now = open_.stack[-1]
        node = Node(tag, now)
        node.in_article = now.in_article or tag in ARTICLE
        node.gone = now.gone or _unwanted(tag, attributes, now.in_article)
        now.children.append(node)
        nodes.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, tags.at)
            if not node.gone:
                node.children.append(page[tags.at : end.start() if end else len(page)])
            stop = page.find(">", end.start()) if end else -1
            tags.at = stop + 1 if stop >= 0 else len(page)
        elif tag not in VOID and (tag in BLOCK or not attributes.rstrip().endswith("/")):
            open_.push(node)  # a slash does not end a block
    if tags.at < len(page):
        open_.stack[-1].children.append(page[tags.at :])
    return nodes


def _densities(nodes: list[Node], body: Node) -> None:
    for x in reversed(nodes):  # children come after their parents
        if x.gone:
            continue
        for c in x.children:
            if isinstance(c, str):
                x.chars += len("".join(html.unescape(c).split()))
            elif not c.gone:
                x.chars, x.tags = x.chars + c.chars, x.tags + c.tags + 1
                x.link_chars, x.link_tags = x.link_chars + c.link_chars, x.link_tags + c.link_tags
                x.holds_article = x.holds_article or c.holds_article or (c.tag == "article" and c.chars > 0)
        if x.tag == "a":
            x.link_chars, x.link_tags = x.chars, x.link_tags + 1
    share = body.link_chars / max(body.chars, 1)
    for x in nodes:
        if x.gone or not x.chars:
            continue
        tags, link_chars, link_tags = max(x.tags, 1), max(x.link_chars, 1), max(x.link_tags, 1)
        base = math.log(x.chars * link_chars / max(x.chars - x.link_chars, 1) + share * x.chars + math.e)
        x.density = x.chars / tags * math.log(max(x.chars * tags / (link_chars * link_tags), 1.0)) / math.log(max(base, 1.0001))
    for x in nodes:
        if x.parent is not None and not x.gone:
            x.parent.sum += x.density
        # the article around an element, or a main that holds no article; else the element
        if x.parent is not None and not (x.tag == "article" or (x.tag == "main" and not x.holds_article)):
            above = x.parent.mark
            x.mark = above if above.tag in ARTICLE and (above.tag == "article" or not above.holds_article) else x


def _blocks(x: Node) -> bool:
    return any(not isinstance(c, str) and not c.gone and c.tag in BLOCK for c in x.children)


def select(nodes: list[Node]) -> list[Node]:
    """The elements that hold the main text."""
    _densities(nodes, nodes[0])
    body = next((x for x in nodes if x.tag == "body"), nodes[0])
    if body.chars < nodes[0].chars:
        body = nodes[0]  # there is text outside the body element
    if body.chars == 0:
        return []
    live = [x for x in nodes if not x.gone]
    rank = lambda x: (x.sum, x.tag in ARTICLE)
    parts: dict[int, Node] = {}  # of each element, the part with blocks that has the largest sum
    for x in reversed(live):  # children come after their parents
        below = [parts[id(c)] for c in x.children if not isinstance(c, str) and id(c) in parts]
        if found := max([x, *below] if _blocks(x) else below, key=rank, default=None):
            parts[id(x)] = found
    largest = lambda x: max(x, parts.get(id(x), x), key=rank)
    best = largest(body)
    least, x = best.density, best
    while x is not body:
        x = x.parent
        least = min(least, x.density)
    picked: dict[int, Node] = {}
    open_ = [body]
    while open_:
        x = open_.pop()
        if x.density < least:
            continue
        top = largest(x)
        if top is not x:
            open_ += [c for c in x.children if not isinstance(c, str) and not c.gone and c.tag in BLOCK]
        picked[id(top.mark)] = top.mark
    return list(picked.values())


def main_text(page: str) -> str:
    nodes = parse(page)
    picked = {id(x) for x in select(nodes)}
    lines: list[str] = []
    held: list[str] = []

    def end_block() -> None:
        line = " ".join(html.unescape("".join(held)).split())
        if line:
            lines.append(line)
        held.clear()

    todo: list[tuple[Node | str | None, bool]] = [(nodes[0], False)]
    while todo:
        x, taken = todo.pop()
        if x is None:
            end_block()
        elif isinstance(x, str):
            if taken:
                held.append(x)
        elif not x.gone:
            taken = taken or id(x) in picked
            if x.tag == "br":
                held.append(" ")
            if x.tag in BLOCK:
                end_block()
                todo.append((None, False))
            todo += [(c, taken) for c in reversed(x.children)]
    end_block()
    return "\n".join(lines)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(x) for x in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    # a page_id goes through pandas as text, which keeps nulls and large numbers whole
    rows = pages.select(F.col(page_id).cast("long").cast("string").alias("page_id"), F.col(url).alias("url"), whole_text(page).alias("html"))
    return rows.mapInPandas(run, "page_id string, url string, text string, n_chars long").withColumn("page_id", F.col("page_id").cast("long"))
