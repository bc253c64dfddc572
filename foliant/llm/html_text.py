"""Main text of web pages: paragraphs give points to their ancestors; the best container and its like are kept."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.common import slices, small_batches

# Fixed values of HTML.
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand on lines of their own.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Starting one of these ends an open paragraph.
ENDS_P = BLOCKS - {"br", "body", "html", "caption", "legend", "option", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: Starting one of these ends an open one of those, unless one of the third stands between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements whose content is no markup.
RAW = frozenset("script style title textarea iframe noframes noembed xmp".split())
#: Elements that never hold an article's text.
DROPPED = frozenset(
    "aside audio button canvas datalist dialog embed fieldset footer frame frameset head input label math menu nav noscript object optgroup "
    "option select svg template video".split()
)
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar tooltip".split())
#: Elements that, when left out, may hold articles of their own.
INCLUDING = frozenset("article aside div footer main noscript section template".split())
#: Elements that are parts of a text rather than containers of one.
PARTS = frozenset(
    "address blockquote br caption dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr li menu ol p pre summary table tbody tfoot thead tr ul".split()
)

#: Words of classes and ids that name what is no article.
OTHER = frozenset(
    "ad ads adbox adsense advert advertisement advertising adverts alert announcement banner bottombar breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies copyright disclaimer discussion disqus dropdown footer form gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices notification "
    "outbrain overlay pager pagination paywall popup privacy promo promoted promotion recommended related remark remarks replies reply respond rss search share sharing shoutbox "
    "sidebar sidenav signup social sponsor sponsored subscribe taboola tagcloud tags toc toolbar topbar widget widgets".split()
)
#: Words of classes and ids that name an article.
MAIN = frozenset("article articlebody articlecontent body content entry hentry main maincontent post postbody postcontent story text".split())
#: Words after which a class names what its element has or lacks, not what it is.
APART = frozenset("has hide is no not show with without".split())

#: Points of a container for its name (twice for an article element); of a paragraph: one, one for each comma, one for
#: each ``PER_POINT`` code points up to ``MOST``.
NAME_POINTS, PER_POINT, MOST = 25, 100, 3
#: Part of its points that a container passes to the one around it.
PASSED = 0.5
#: Least points of a sibling container, as a part of the best one's; most links and least code points of a paragraph beside it.
SIBLING, LINKS, LEAST = 0.2, 0.25, 80

_COMMAS = re.compile("[,،、，﹐]")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""")
#: For a page in which a quote or a tag never ends.
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]*)))?""")
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE) for tag in RAW}


class _Node:
    """An element: its children (elements and texts) and what it holds."""

    __slots__ = ("tag", "parent", "children", "names", "article", "points", "text", "linked", "holds")

    def __init__(self, tag: str, parent: _Node | None, names: frozenset = frozenset(), article: bool = False):
        self.tag, self.parent, self.names, self.article = tag, parent, names, article
        self.children: list[_Node | str] = []
        #: points, code points of text and of that in links, tags of articles and headlines inside
        self.points, self.text, self.linked, self.holds = 0.0, 0, 0, frozenset()


def _tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(name, ``/`` at an end, attributes) of each tag; texts have no name and come last. Takes time linear in the page."""
    at, size, pattern = 0, len(html), _TAG
    while at < size:
        mark = html.find("<", at)
        if mark < 0 or mark + 1 >= size:
            yield "", "", html[at:]
            return
        if mark > at:
            yield "", "", html[at:mark]
        after = html[mark + 1]
        if after in "!?":
            close = html.find("-->", mark + 2) if html.startswith("<!--", mark) else html.find(">", mark)
            if close < 0:
                return
            at = close + (3 if html.startswith("<!--", mark) else 1)
            continue
        found = pattern.match(html, mark) if after == "/" or after.isalpha() else None
        if found is None and pattern is _TAG and (after == "/" or after.isalpha()):
            pattern = _LOOSE_TAG
            found = pattern.match(html, mark)
        if found is None:
            if (after == "/" or after.isascii() and after.isalpha()) and html.find(">", mark) < 0:
                return  # the page ends inside a tag
            yield "", "", "<"
            at = mark + 1
            continue
        at, end, tag = found.end(), found[1], found[2].lower()
        if tag in RAW and not end:
            close = _RAW_END[tag].search(html, at)
            if close is not None:
                at = html.find(">", close.start()) + 1 or size
            elif tag != "title":
                return
            continue
        yield tag, end, found[3]


class _Tree:
    """Elements of a page; those that never hold an article's text are left out with all they hold."""

    def __init__(self, html: str, trust: bool = True):
        """Without ``trust``, an article starts wherever its tag stands, as if what was left out before had been closed."""
        self.root = _Node("", None)
        #: all elements, parents before what they hold; open ones, and how many of each tag
        self.nodes, self.open, self.count = [self.root], [self.root], Counter()
        #: whether something that is left out is never closed
        self.unclosed = False
        #: open elements from one that is left out on
        skipped: list[str] = []
        depth: Counter = Counter()
        for tag, end, rest in _tokens(html):
            if not tag:
                if not skipped:
                    # a text is never cut inside a reference
                    self.open[-1].children.append(unescape(rest) if "&" in rest else rest)
            elif skipped:
                if end:
                    if depth[tag]:
                        while (last := skipped.pop()) != tag:
                            depth[last] -= 1
                        depth[tag] -= 1
                    elif tag in ("article", "main", "body", "html"):  # what was left out is never closed
                        skipped, depth, self.unclosed = [], Counter(), True
                        self._end(tag)
                elif tag in ("article", "main") and not (trust and skipped[0] in INCLUDING):
                    skipped, depth = [], Counter()
                    self._start(tag, rest)
                elif tag not in VOID:
                    skipped.append(tag)
                    depth[tag] += 1
            elif end:
                self._end(tag)
            elif self._start(tag, rest) and tag not in VOID:
                skipped, depth = [tag], Counter([tag])
        self.unclosed |= bool(skipped)

    def _start(self, tag: str, rest: str) -> bool:
        """Add an element; whether it is left out."""
        if tag in ENDS_P and self.count["p"]:
            self._close({"p"}, {"table", "td", "th", "caption"})
        if tag in ENDS:
            self._close(*ENDS[tag])
        elif tag == "a" and self.count["a"]:
            self._close({"a"}, BLOCKS)
        elif tag in ("html", "body") and self.count[tag]:
            return False
        names, article = frozenset(), tag in ("article", "main")
        if rest and not rest.isspace():
            found = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)}
            names = _names(found)
            article = article or found.get("role") in ("article", "main") or found.get("itemprop") == "articleBody"
            if tag not in ("html", "body") and (found.get("role") in DROPPED_ROLES or "hidden" in found or _HIDDEN.search(found.get("style", "")) or names & OTHER):
                return True
        if tag in DROPPED or (tag == "header" or "header" in names and not names & (MAIN - {"content", "main"})) and not any(n.article for n in self.open):
            return True  # an article's own header holds its headline
        node = _Node(tag, self.open[-1], names, article)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.count[tag] += 1
        self.nodes.append(node)
        return False

    def _end(self, tag: str) -> None:
        if not self.count[tag]:
            return
        if tag in BLOCKS:
            self._close({tag}, set())
        else:
            self._close({tag}, BLOCKS)

    def _close(self, tags: set[str], walls: frozenset | set) -> None:
        """Close the nearest open element of a tag, or the outermost of several, that no element of ``walls`` surrounds."""
        found = 0
        if sum(self.count[t] for t in tags):
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag in tags:
                    found = i
                    if len(tags) == 1:
                        break
                elif self.open[i].tag in walls:
                    break
        if found:
            for node in self.open[found:]:
                self.count[node.tag] -= 1
            del self.open[found:]


def _names(attributes: dict[str, str]) -> frozenset:
    """Words of class and id, in parts and joined: ``post-body`` is post, body and postbody."""
    words = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = [w.lower() for w in _WORDS.findall(name)]
        for i, word in enumerate(parts):
            if word in APART:
                parts = parts[:i]
                break
        words.update(parts)
        words.add("".join(parts))
    return frozenset(words)


def _blocks(top: _Node) -> Iterator[tuple[_Node, str, int]]:
    """Texts of the blocks under ``top`` in order, white space made one space, each with its block element and the
    code points of it in links."""
    pieces: list[str] = []
    owner, linked, anchors = top, 0, 0
    stack: list[tuple[_Node, int, _Node]] = [(top, 0, top)]

    def text() -> str:
        return " ".join("".join(pieces).split())

    while stack:
        node, i, above = stack.pop()
        block = node is top or node.tag in BLOCKS
        if i == 0 and block:
            if said := text():
                yield owner, said, linked
            pieces, linked, owner = [], 0, node
        for i in range(i, len(node.children)):
            child = node.children[i]
            if isinstance(child, str):
                pieces.append(child)
                linked += len(" ".join(child.split())) if anchors else 0
            else:
                anchors += child.tag == "a"
                stack += [(node, i + 1, above), (child, 0, node if block else above)]
                break
        else:
            anchors -= node.tag == "a"
            if block:
                if said := text():
                    yield owner, said, linked
                pieces, linked, owner = [], 0, above


def _score(nodes: list[_Node]) -> list[_Node]:
    """Containers with points: those of the paragraphs in them and, passed on, of the containers in them, less their links."""
    for block, said, linked in _blocks(nodes[0]):
        block.text += len(said)
        block.linked += min(linked, len(said))
        block.points += (1 + len(_COMMAS.findall(said)) + min(len(said) / PER_POINT, MOST)) * (1 - min(linked / len(said), 1))
    scored = []
    for node in reversed(nodes):
        above = node.parent
        if above is not None:
            above.text += node.text
            above.linked += node.linked
            above.points += node.points * (1 if node.tag in PARTS or node.tag not in BLOCKS else PASSED)
            inside = node.holds | {node.tag} if node.tag in ("h1", "article", "main") else node.holds
            if inside - above.holds:
                above.holds |= inside
        if node.text and node.tag not in PARTS and (node.tag in BLOCKS or above is None):
            node.points *= 1 - node.linked / node.text
            scored.append(node)
    for node in scored:
        if node.text > node.linked:
            node.points += NAME_POINTS * (2 * node.article or bool(node.names & MAIN))
    return scored[::-1]


def main_text(html: str) -> str:
    """The article of a page as one line: its blocks in order, joined by a space."""
    tree = _Tree(html)
    if tree.unclosed and not any(n.article for n in tree.nodes):
        tree = _Tree(html, trust=False)
    # a form goes, unless the article stands in it
    forms = [n for n in tree.nodes if n.tag == "form"]
    if forms:
        wrapping = {id(a) for n in tree.nodes if n.article for a in _around(n)}
        gone = {id(n) for n in forms if id(n) not in wrapping}
        for node in tree.nodes:
            if gone:
                node.children = [c for c in node.children if id(c) not in gone]
        reached, todo = [], [tree.root]
        while todo:
            reached.append(todo.pop())
            todo += [c for c in reversed(reached[-1].children) if not isinstance(c, str)]
        tree.nodes = reached
    scored = _score(tree.nodes)
    if not scored:
        return ""
    best = max(scored, key=lambda n: n.points)  # of equals the first
    # an article that the best container is a part of
    best = next((n for n in _around(best) if n.article), None) or next((n for n in _around(best) if n.names & MAIN and n.tag not in ("html", "body")), best)
    kept = [best] if best.parent is None else [n for n in best.parent.children if n is best or isinstance(n, _Node) and _alike(n, best)]
    return " ".join(said for node in kept for _, said, _ in _blocks(node))


def _around(node: _Node | None) -> Iterator[_Node]:
    while node is not None:
        yield node
        node = node.parent


def _alike(node: _Node, best: _Node) -> bool:
    """Whether a sibling of the best container belongs to the article."""
    if not node.text:
        return False
    if node.tag in ("h1", "h2", "h3"):
        return "h1" not in best.holds and (node.tag == "h1" or not best.article)
    if best.article:
        return node.article and node.points >= SIBLING * best.points
    if node.tag in PARTS:
        return node.linked <= LINKS * node.text and (node.text >= LEAST or not best.names & MAIN)
    return node.tag in BLOCKS and node.points >= SIBLING * best.points


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "_html"):
            texts = [main_text(h) if h else "" for h in part.column("_html").to_pylist()]
            kept = [part.column(i) for i in range(part.num_columns - 1)]
            yield pa.record_batch([*kept, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*part.schema.names[:-1], "_text", "_chars"])


def extracted(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """The columns ``keep``, ``text`` and ``n_chars`` (its code points) of every page.

    1. The page is read as a tree as browsers do, whatever is not closed or nested wrongly. Menus, page headers, footers,
       side columns, notices, adverts, forms, scripts, comments and what is hidden go by element, role or name.
    2. Every block of text gives points, one and more for commas and length, less its share of links, to its container
       and, ever less, to the ancestors. Names and elements of articles add points; a container's links discount it.
    3. The best container is kept, and those of its siblings that come near it or are paragraphs with few links.

    A null or empty page has no text; pages with ties keep the first container; equal rows come back as often as they
    went in; a kept column that is called as a result gives way to it. One page is held by one task at a time.
    """
    kept = [c for c in keep if c not in ("text", "n_chars")]
    named = small_batches(pages).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(kept)], F.col(html_col).alias("_html"))
    schema = T.StructType([*named.schema.fields[:-1], *T.StructType.fromDDL("_text string, _chars long").fields])
    return named.mapInArrow(_extract, schema).toDF(*kept, "text", "n_chars")
