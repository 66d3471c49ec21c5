"""Main text of web pages by tree scoring.

A page is cut into tags and text; block elements form a tree, inline markup is transparent. Each text block (heading, paragraph,
list item, cell or bare text of a container) earns points: one, one for each comma, one for each hundred characters up to
three. Points go to the parent in full, to the grandparent by half, and further up divided by the distance, ``LEVELS`` levels at most; a container's sum is
reduced by its link density. The best container is kept, and of its siblings those that score a fifth of it or hold
an unlinked paragraph of some length; of equal scores the first counts. Of what is kept, all blocks are given in page order.

Left out with all they hold: navigation, headers and footers of the page, sidebars, scripts, styles and the like by their
tags, and hidden elements. Left out by a hint: forms, and notices, adverts, reader comments and so on by words of class, id or role. A name that is such a word counts
everywhere, a compound one by its first or last part, unless it begins like "has-" or "no-"; in an article compounds count by their last part, or by their first if that names comments, sharing or adverts.
An article or main element is never left out for its class unless it lies in another one, and a hint does not count on an element that holds an article, or without which
a tenth of the page's unlinked text would be left at most: then it is a wrapper. Comments, sharing and adverts are wrappers only where nothing else is left.

A page is read in one pass: tags by a scanner that never goes back, open elements by their depth for each name, scores bottom up when the tree is complete. So time grows
with the page's length, whatever its markup. Quotes count as part of a tag where they are closed before the page ends.

Nulls: null or empty pages have an empty text, as have pages without text. Whole pages are read; unclosed and surplus tags
are tolerated. Repeated rows are handled one by one; an empty table gives an empty result; other columns are handed on,
those named like an output are replaced.
"""

from __future__ import annotations

import heapq
import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.text import packed, require, unpacked
from colloquy.session import ship

#: Element names.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label map mark meter nobr output picture progress q "
    "rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr link meta base".split()
)
SKIPPED = frozenset(
    "aside button canvas dialog embed footer head header iframe menu nav noscript object select svg template textarea "
    "audio video script style title math".split()
)
RAW_TEXT = frozenset("script style textarea title iframe noscript template svg math".split())
VOID = frozenset("area col embed hr param".split())
PROTECTED = frozenset("html body article main".split())
#: Elements that can stand in a head; any other closes an open one.
IN_HEAD = frozenset("base bgsound basefont link meta noframes noscript script style template title".split())
BONUS = {"article": 25.0, "main": 15.0, "section": 3.0, "div": 3.0}
#: An opening tag on the left closes an open element on the right.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "thead": ("tr",), "tfoot": ("tr", "td", "th", "tbody"),
}
NO_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul li dd dt".split()
)
#: Words of class, id or role of what is no part of an article.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie "
    "cookies consent disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification "
    "overlay pagination pager popup promo promoted promotion related replies reply respond share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
#: Beginnings of names that say the contrary, and first parts that count in an article, too.
CONTRARY = frozenset("has is no non not with without".split())
IN_ARTICLE = frozenset("ad ads advert adverts advertisement comment comments disqus newsletter share sharing sponsored".split())
SIBLING_SHARE, LONG_PARAGRAPH = 0.2, 80
#: Levels that points go up; share of a page's unlinked text without which a hinted element is a wrapper.
LEVELS, LEFT_OVER = 8, 0.1

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_QUOTED_OR_END = re.compile(r"[\"'>]")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """A block element: children and text blocks (text, linked characters) in page order."""

    __slots__ = ("tag", "parent", "items", "points", "chars", "linked", "skipped", "hinted", "article", "longest")

    def __init__(self, tag: str, parent: Node | None, skipped: bool = False, hinted: int = 0) -> None:
        self.tag, self.parent, self.skipped, self.hinted = tag, parent, skipped, hinted
        self.items: list[Node | tuple[str, int]] = []
        self.points, self.chars, self.linked, self.longest, self.article = 0.0, 0, 0, 0, False

    @property
    def score(self) -> float:
        """Points, discounted by link density; an element that earned none has no bonus either."""
        if self.points <= 0:
            return 0.0
        return (self.points + BONUS.get(self.tag, 0.0)) * (1 - self.linked / max(self.chars, 1))


def _hinted(rest: str, inside: bool) -> tuple[bool, int]:
    """Whether an element is hidden, and whether its names hint at something else than an article (2: at comments, sharing or adverts);
    ``inside`` an article, its own header is no header of the page."""
    hints = HINTS - ({"header"} if inside else set())
    found = 0
    for name, *values in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
            return True, found
        if name in ("class", "id", "role"):
            for token in value.split():
                parts = [part.lower() for part in _PART.findall(token)]
                if parts and parts[0] not in CONTRARY:
                    if parts[-1] in hints or parts[0] in (IN_ARTICLE if inside else hints):
                        found = max(found, 2 if {parts[0], parts[-1]} & IN_ARTICLE else 1)
    return False, found


class Scanner:
    """Tags of a page, from left to right: (start, end, name, closing, rest)."""

    def __init__(self, page: str) -> None:
        self.page, self.last_end, self.quotes = page, page.rfind(">"), {'"': True, "'": True}

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag; quoted ones don't, while quotes can be trusted."""
        page, start = self.page, at
        while self.quotes['"'] or self.quotes["'"]:
            found = _QUOTED_OR_END.search(page, at)
            if found is None:
                self.quotes = dict.fromkeys(self.quotes, False)  # all ends are quoted: they are taken as they come
                break
            mark, at = found[0], found.end()
            if mark == ">":
                return at - 1
            if self.quotes[mark]:
                closed = page.find(mark, at)
                if closed < 0:
                    self.quotes[mark] = False
                else:
                    at = closed + 1
        return page.find(">", start)

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """The next piece of markup; a comment or declaration has no name."""
        page = self.page
        while (start := page.find("<", at)) >= 0 and start < self.last_end:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, len(page) if end < 0 else end + 3, "", False, ""
            if page.startswith(("<!", "<?"), start):
                return start, page.find(">", start) + 1, "", False, ""
            closing = page.startswith("</", start)
            name = _NAME.match(page, start + 1 + closing)
            if name:
                end = self.tag_end(name.end())
                return start, end + 1, name[0].lower(), closing, page[name.end() : end]
            at = start + 1
        if start >= 0 and page.startswith("<!--", start):
            return start, len(page), "", False, ""
        return None


class Tree:
    """The elements of a page; ``path`` are the open ones, ``places`` their depths by name."""

    def __init__(self, page: str) -> None:
        self.root = Node("html", None)
        self.path, self.places = [self.root], {}
        self.text: list[str] = []
        self.in_link, self.linked = False, 0
        self._read(page)

    @property
    def at(self) -> Node:
        return self.path[-1]

    def _depth(self, *names: str) -> int:
        """Depth of the innermost open element of one of these names; 0 without one."""
        return max((self.places[name][-1] for name in names if self.places.get(name)), default=0)

    def _read(self, page: str) -> None:
        scanner, last, size = Scanner(page), 0, len(page)
        while found := scanner.next(last):
            start, end, name, closing, rest = found
            if start > last:
                self._add(page[last:start])
            last = end
            if name and closing:
                self._close(name)
            elif name:
                self._open(name, rest)
                if name in RAW_TEXT and not rest.endswith("/"):
                    close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, last)
                    last = close.start() if close else size
        tail = page[last:]
        cut = tail.rfind("<")  # a tag that the page's end cuts off
        if cut >= 0 and (tail[cut + 1 : cut + 2] in ("!", "?") or _NAME.match(tail, cut + 1 + tail.startswith("/", cut + 1))):
            tail = tail[:cut]
        self._add(tail)
        self._flush()

    def _add(self, piece: str) -> None:
        if self.at.tag == "head" and piece.strip():
            self._leave_head()
        if not self.at.skipped:
            self.text.append(piece)
            if self.in_link:
                self.linked += len(piece)

    def _flush(self) -> None:
        if self.text:
            block = " ".join(html.unescape("".join(self.text)).split())
            if block:
                self.at.items.append((block, min(self.linked, len(block))))
        self.text, self.linked = [], 0

    def _open(self, name: str, rest: str) -> None:
        if name not in IN_HEAD and name not in ("html", "head"):
            self._leave_head()
        if name in INLINE:
            if name == "br":
                self._add(" ")
            elif name == "a":
                self.in_link = not rest.endswith("/")
            return
        self._flush()
        self.in_link = False
        if name in ("html", "body"):
            return
        if name in NO_PARAGRAPH:
            self._end("p", self._depth("td", "th", "table", "button"))
        for closed in CLOSES.get(name, ()):
            self._end(closed, self._depth("ul", "ol", "table", "dl", "select"))
        inside = self._depth("article", "main") > 0
        skipped = self.at.skipped or name in SKIPPED and not (name == "header" and inside)
        hinted, article = int(name == "form"), False
        if not skipped:
            hidden, hint = _hinted(rest, inside)
            skipped, hinted = hidden, max(hinted, hint)
            if name in PROTECTED and not inside:
                skipped, hinted, article = False, 0, not hint
        if name in VOID or rest.endswith("/") and name not in PROTECTED:
            return
        node = Node(name, self.at, skipped, hinted)
        node.article = article
        if not skipped:
            self.at.items.append(node)
        self.places.setdefault(name, []).append(len(self.path))
        self.path.append(node)

    def _cut(self, depth: int) -> None:
        """Close the open element at this depth and all in it."""
        self._flush()
        for node in self.path[depth:]:
            self.places[node.tag].pop()
        del self.path[depth:]

    def _leave_head(self) -> None:
        """</head> is optional: what cannot stand in a head ends it. A template or noscript in it keeps what it holds."""
        head = self._depth("head")
        if head and self._depth(*RAW_TEXT) < head:
            self._cut(head)
            self.in_link = False

    def _end(self, name: str, beyond: int) -> None:
        """Close an open element of this name, if there is one deeper than its container."""
        depth = self._depth(name)
        if depth > beyond:
            self._cut(depth)

    def _close(self, name: str) -> None:
        if name in INLINE:
            if name == "a":
                self.in_link = False
        elif name not in ("html", "body") and (depth := self._depth(name)):
            self._cut(depth)
            self.in_link = False


def _bottom_up(root: Node) -> list[Node]:
    """All elements, children before parents."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack += [x for x in node.items if isinstance(x, Node)]
    return found[::-1]


def _unhint(root: Node) -> None:
    """Drop hinted elements but for wrappers: those with an article, and the largest ones while little text is left outside."""
    free, article = {}, {}
    for node in _bottom_up(root):
        below = [x for x in node.items if isinstance(x, Node)]
        free[node] = sum(len(x[0]) - x[1] for x in node.items if not isinstance(x, Node)) + sum(free[x] for x in below)
        article[node] = node.article or any(article[x] for x in below)

    def outermost(node: Node) -> tuple[int, list[Node]]:
        """Unlinked characters outside hinted elements, and the outermost of these; articles are let through."""
        outside, found, stack = 0, [], [node]
        while stack:
            for x in stack.pop().items:
                if not isinstance(x, Node):
                    outside += len(x[0]) - x[1]
                elif x.hinted and not article[x]:
                    found.append(x)
                else:
                    x.hinted = 0
                    stack.append(x)
        return outside, found

    outside, found = outermost(root)
    heap = [(x.hinted, -free[x], k, x) for k, x in enumerate(found)]
    heapq.heapify(heap)
    k = len(heap)
    while heap and heap[0][1] and outside <= (LEFT_OVER * free[root] if heap[0][0] == 1 else 0):
        node = heapq.heappop(heap)[3]
        more, found = outermost(node)
        outside += more
        for x in found:
            k += 1
            heapq.heappush(heap, (x.hinted, -free[x], k, x))
    for *_, node in heap:
        node.skipped = True


def _score(root: Node) -> list[Node]:
    """All elements that stay, in page order, with points and counts."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        node.items = [x for x in node.items if not (isinstance(x, Node) and x.skipped)]
        order.append(node)
        stack += [x for x in reversed(node.items) if isinstance(x, Node)]
    for node in reversed(order):
        bare = node.tag in BONUS or node.tag in PROTECTED
        for x in node.items:
            if isinstance(x, Node):
                node.chars, node.linked, node.longest = node.chars + x.chars, node.linked + x.linked, max(node.longest, x.longest)
                continue
            block, linked = x
            node.chars, node.linked = node.chars + len(block), node.linked + linked
            if not linked:
                node.longest = max(node.longest, len(block))
            points = 1 + block.count(",") + min(len(block) / 100, 3)
            up, level = node if bare else node.parent or node, 0
            while up is not None and level < LEVELS:
                up.points += points if level == 0 else points / (2 * level)
                up, level = up.parent, level + 1
    return order


def _blocks(node: Node) -> list[str]:
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, Node):
            stack += reversed(x.items)
        else:
            out.append(x[0])
    return out


def _dense(node: Node) -> bool:
    return node.linked > 0.5 * max(node.chars, 1)


def main_text(page: str | None) -> str:
    """Blocks of the best container and of its related siblings, joined by empty lines."""
    if not page:
        return ""
    root = Tree(page).root
    _unhint(root)
    best = max(_score(root), key=lambda node: node.score)
    if best.score <= 0:
        return ""
    # an article or main element around the best part is the container
    up = best
    while up is not None:
        if up.tag in ("article", "main"):
            best = up
            break
        up = up.parent
    if best.parent is None:
        return "\n\n".join(_blocks(best))
    kept: list[str] = []
    for item in best.parent.items:
        if item is best:
            kept += _blocks(best)
        elif isinstance(item, Node) and not _dense(item):
            alike = item.score >= SIBLING_SHARE * best.score and item.tag == best.tag
            if alike or item.tag == "p" and item.longest >= LONG_PARAGRAPH:
                kept += _blocks(item)
    return "\n\n".join(kept)


def _extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([main_text(page) for page in pages], dtype="object")


def extract(pages: DataFrame) -> DataFrame:
    """All rows and columns with ``text`` and ``n_chars``."""
    require(pages, "html")
    ship(pages.sparkSession)
    of = F.pandas_udf(_extracted, "string")
    rows = pages.select(packed(pages), of(F.coalesce(F.col("html"), F.lit(""))).alias("text"))
    return rows.select(*unpacked(rows, ("text", "n_chars")), "text", F.length("text").cast("bigint").alias("n_chars"))
