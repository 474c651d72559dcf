"""Main text of web pages by composite text density.

The page becomes a DOM tree. A node's composite density is its characters per tag, adjusted by the share of characters and tags in
links; a node's density sum adds its children's densities. The node with the largest sum leads to the article: the smallest density
on its path to the body is the threshold, and of every node that reaches it the subtree of the largest sum is marked as text.

Between marked subtrees lie headings and short blocks whose own density says little. Inside an `article` all blocks stay that are not
mostly links; inside `main`, or beside the best node where a page has neither, headings and paragraphs stay, and other unmarked
blocks go; so do blocks of a line or two after the best node, which densities alone would keep.

Scripts, styles, form controls and the like never count as text. Blocks that HTML names as navigation, header, footer or aside, forms, and
those whose class, id or role says so (menus, adverts, notices, comments) are left out before densities are taken. A name is taken by
its last word, if its other words belong to asides or tell where they are (`cookie-notice`, `site-footer`, but not `has-sidebar` or
`profit-share`; what such a word names is left to the densities). A name alone drops no text that outweighs all the rest, nor, inside an article, a paragraph
under a name like `discussion`; comments, and rows of named items, go wherever there is an article beside them. Where all this would leave
under a tenth of the largest density sum that the page has with asides, those around that sum's node stay.

Parsing and marking take time in proportion to the page: open elements are counted by name and by scope, as HTML's "has an element in
scope", and each element is closed once.
"""

from __future__ import annotations

import html as _html
import math
import re

from pyspark.sql import DataFrame

from .common import as_text, map_columns, text_of

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "script style head title noscript template textarea select option button input iframe noembed noframes object svg canvas xmp "
    "datalist dialog".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html li legend main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body caption html legend tbody td tfoot th thead tr".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u span mark sub sup label abbr cite q".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements that hold text rather than other blocks.
FLOW = HEADINGS | FORMATTING | frozenset("p blockquote pre ul ol dl table figure address center hr br img".split())
#: End tags do not reach out of these.
SCOPES = frozenset("table td th caption".split())
#: Kinds of elements that an opening tag of the same kind closes, and the elements that begin a new scope for them.
KIND = {"li": "li", "dt": "dl", "dd": "dl", "td": "cell", "th": "cell", "tr": "row", "tbody": "part", "thead": "part", "tfoot": "part", "option": "option"}
BOUNDS = {
    "ul": ("li",), "ol": ("li",), "menu": ("li",), "dir": ("li",), "dl": ("dl",), "tr": ("cell",), "table": ("cell", "row", "part"),
    "select": ("option",), "td": ("li", "dl"), "th": ("li", "dl"), "caption": ("li", "dl"),
}
ENDS = {"cell": ("cell",), "row": ("cell", "row"), "part": ("cell", "row", "part"), "li": ("li",), "dl": ("dl",), "option": ("option",)}

ASIDE_TAGS = frozenset("nav footer aside menu search form".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form note".split())
# Words that name an aside as the last word of a class or id, and words of containers that may follow them.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adsbygoogle sponsor sponsored sponsors promo promos promotion "
    "banner nav navbar navigation menu menus breadcrumb breadcrumbs sidebar masthead footer cookie cookies consent gdpr notice popup modal "
    "overlay comment comments disqus replies discussion related recommended recommendations share sharing subscribe newsletter "
    "signup login toolbar pagination pager".split()
)
CONTAINERS = frozenset(
    "list lists box area wrap wrapper container content contents inner outer block section bar panel item items left right top bottom "
    "links link posts form slot unit row col column group title heading header text body holder thread".split()
)
SITE_HEADER = frozenset("header site-header global-header top-header page-header".split())
COMMENTS = frozenset("comment comments disqus replies".split())
#: Words that may stand before an aside's name without making it another thing's (`site-footer`, but not `profit-share`).
QUALIFIERS = frozenset(
    "site page main post article entry blog user users reader readers visitor visitors social email mail web google top bottom left right upper lower global local mobile desktop "
    "primary secondary sub super mini sticky fixed floating inline native display video text home story news view all my the side".split()
)
#: Names that inside an article are as often a part of it.
TOPICS = frozenset("discussion share sharing promotion consent related recommended recommendations".split())
#: Plain characters outside comments from which on a page has an article beside them, and those of a paragraph that is no label.
ENOUGH, PARAGRAPH = 200, 80
#: Characters of a block that stands alone after the text and is no part of it.
LINES = 160
#: These are never the article, however much text they hold.
FIRM = frozenset("nav footer aside menu search header".split())
NEGATED = frozenset("has have with without no not hide show hidden is after before js".split())
#: Markup of a page: comments, declarations, tags; names of attributes that matter. Quotes count only after an equals sign.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>\x00]*)((?:=\s*+(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>])*+)(?:>|\Z)",
    re.S,
)
_SAID = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden)\s*+(?:=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WHITE = re.compile(r"\s+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("tag", "parent", "children", "said", "chars", "tags", "link_chars", "link_tags", "density", "total", "out", "at")

    def __init__(self, tag: str, parent: Node | None, said: str = ""):
        self.tag, self.parent, self.said = tag, parent, said
        self.children: list[Node | str] = []
        self.out = False
        if parent is not None:
            parent.children.append(self)


class _Open:
    """The open elements, counted so that an end tag without its element costs nothing, and each element is closed once."""

    def __init__(self, body: Node):
        self.stack = [body]
        self.counts: list[dict[str, int]] = [{}]  # open elements by name, for each scope
        self.blocks = [0]  # places of the open elements other than formatting ones
        self.inline: list[dict[str, int]] = [{}]  # open formatting elements by name, for each of these
        self.kinds: dict[str, list[int | None]] = {k: [None] for k in set(KIND.values())}  # place of the open one, for each scope of a kind
        self.tables: list[int] = []

    def push(self, node: Node) -> None:
        tag, at = node.tag, len(self.stack)
        self.stack.append(node)
        self.counts[-1][tag] = self.counts[-1].get(tag, 0) + 1
        if tag in FORMATTING:
            self.inline[-1][tag] = self.inline[-1].get(tag, 0) + 1
            return
        self.blocks.append(at)
        self.inline.append({})
        if tag in KIND:
            self.kinds[KIND[tag]][-1] = at
        for kind in BOUNDS.get(tag, ()):
            self.kinds[kind].append(None)
        if tag in SCOPES:
            self.counts.append({})
        if tag == "table":
            self.tables.append(at)

    def close(self, at: int) -> None:
        """Closes the elements from place `at` on."""
        while len(self.stack) > at:
            tag = self.stack.pop().tag
            if tag in SCOPES:
                self.counts.pop()
            self.counts[-1][tag] -= 1
            if tag in FORMATTING:
                self.inline[-1][tag] -= 1
                continue
            self.blocks.pop()
            self.inline.pop()
            for kind in BOUNDS.get(tag, ()):
                self.kinds[kind].pop()
            if tag in KIND:
                self.kinds[KIND[tag]][-1] = None
            if tag == "table":
                self.tables.pop()

    def close_before(self, tag: str) -> None:
        """Closes what an opening tag closes."""
        if tag in CLOSES_P and self.stack[self.blocks[-1]].tag == "p":
            self.close(self.blocks[-1])
        for kind in ENDS.get(KIND.get(tag, ""), ()):
            if (at := self.kinds[kind][-1]) is not None:
                self.close(at)

    def close_by_end(self, tag: str) -> None:
        if tag in KIND:
            at = self.kinds[KIND[tag]][-1]
            if at is not None and self.stack[at].tag == tag:
                self.close(at)
        elif tag == "table":
            if self.tables:
                self.close(self.tables[-1])
        elif (self.inline if tag in FORMATTING else self.counts)[-1].get(tag):  # a formatting end never closes a block
            at = len(self.stack) - 1
            while self.stack[at].tag != tag:
                at -= 1
            self.close(at)


def parse(page: str) -> Node:
    """The tree of a page; open elements are closed as HTML says where it matters for blocks. Text is decoded."""
    root = Node("html", None)
    opened = _Open(Node("body", root))
    at, size, decode = 0, len(page), _html.unescape
    while at < size:
        m = _TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            opened.stack[-1].children.append(decode(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in ("html", "body"):
            continue
        if m[1]:
            opened.close_by_end(tag)
            continue
        opened.close_before(tag)
        node = Node(tag, opened.stack[-1], m[3])
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I).search(page, at)
            if m[3].endswith("/") and not end[0]:
                continue  # an empty element of XML, which has no end tag
            if tag not in HIDDEN:
                node.children.append(page[at : end.start()])
            at = end.end()
        elif tag not in VOID:
            opened.push(node)
    return root


def _names_aside(value: str) -> str:
    """The word by which a class or id names an aside: its last one, if the others belong to asides or tell where they are; else nothing."""
    for name in value.split():
        words = [w.lower() for w in _WORDS.findall(name) if len(w) > 1]
        if not words or not NEGATED.isdisjoint(words):
            continue
        if "".join(words) in ASIDE_WORDS:
            return "".join(words)
        while words and words[-1] in CONTAINERS:
            words.pop()
        if words and words[-1] in ASIDE_WORDS and all(w in ASIDE_WORDS or w in QUALIFIERS or w in CONTAINERS for w in words):
            return words[-1]
    return ""


def _aside(node: Node, inside: bool) -> str:
    """How HTML or a name says that the element is no part of an article: by "tag", by a word, or not at all. inside: it lies in an article or main element."""
    if node.tag in ASIDE_TAGS or node.tag == "header" and not inside:
        return "tag"
    for name, *values in _SAID.findall(node.said) if node.said else ():
        value = next((v for v in values if v), "")
        name = name.lower()
        if name in ("class", "id") and node.tag != "main":
            if word := _names_aside(value):
                return word
            if not inside and not SITE_HEADER.isdisjoint(value.lower().split()):
                return "header"
        elif name == "role" and value.strip().lower() in ASIDE_ROLES:
            return "tag"
    return ""


def _hidden(node: Node) -> bool:
    if node.tag in HIDDEN:
        return True
    return any(k.lower() == "hidden" or k.lower() == "aria-hidden" and (a or b or c).lower() == "true" for k, a, b, c in (_SAID.findall(node.said) if "hidden" in node.said.lower() else ()))


def _walk(root: Node) -> list[Node]:
    """All nodes, parents before children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def _measure(nodes: list[Node], body: Node) -> None:
    """Characters, tags, and those in links, of each node; then densities and their sums over children."""
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        if node.out:
            continue
        for c in node.children:
            if isinstance(c, str):
                node.chars += len(_WHITE.sub(" ", c).strip())
            elif not c.out:
                node.chars += c.chars
                node.tags += c.tags + 1
                node.link_chars += c.link_chars
                node.link_tags += c.link_tags + (c.tag == "a")
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
    share = body.link_chars / max(1, body.chars)
    for node in nodes:
        c, lc, t, lt = node.chars, max(1, node.link_chars), max(1, node.tags), max(1, node.link_tags)
        if node.out or not c:
            node.density = 0.0
            continue
        plain = max(1, c - node.link_chars)
        base = math.log(c / plain * node.link_chars + share * c + math.e)
        amount = math.log(max(1.0, c / lc * t / lt))
        node.density = c / t * max(0.0, amount / math.log(base) if base > 1.0000001 else amount * 1e6)
    for node in nodes:
        node.total = sum(c.density for c in node.children if isinstance(c, Node))


def _leave_out(nodes: list[Node], hidden: set[int], asides: set[int]) -> list[Node]:
    """Marks hidden nodes, asides and all below them as out, measures the rest and returns it."""
    for node in nodes:
        node.out = node.parent.out or node.at in hidden or node.at in asides
    _measure(nodes, nodes[0])
    return [n for n in nodes if not n.out]


def _live(nodes: list[Node]) -> list[Node]:
    """The nodes that may be text: without what is hidden, and without asides unless hardly anything is left then."""
    hidden, asides, inside, mains, named = set(), set(), set(), [], {}
    for at, node in enumerate(nodes):
        node.at = at
        up = node.parent.at if at else -1
        if up in inside or node.tag in ("article", "main"):
            inside.add(at)
        if node.tag == "main":
            mains.append(node)
        if at and _hidden(node):
            hidden.add(at)
        elif at and (how := _aside(node, up in inside)):
            asides.add(at)
            if how != "tag":
                named[at] = how
    for node in mains:  # an aside never holds the main element
        while node is not None and node.at >= 0:
            asides.discard(node.at)
            node = node.parent if node.at else None
    _spare(nodes, hidden, asides, named, inside)
    live = _leave_out(nodes, hidden, asides)
    if not asides or nodes[0].chars * 5 >= sum(len(c) for n in nodes if n.at not in hidden for c in n.children if isinstance(c, str)):
        return live
    left = max(n.total for n in live)
    best = max(_leave_out(nodes, hidden, set()), key=lambda n: n.total)
    if left * 10 < best.total:
        around = {n.at for n in _up(best) if n.tag not in FIRM and not _is_comments(n)}
        if not any(n.at in asides and n.at not in around for n in _up(best)):
            asides -= around
    return _leave_out(nodes, hidden, asides)


def _spare(nodes: list[Node], hidden: set[int], asides: set[int], named: dict[int, str], inside: set[int]) -> None:
    """Takes out of asides what a name alone calls one, though it holds more plain text than is left without it, or is a topic of its article."""
    some = {at for at in named if at in asides}
    if not some:
        return
    _leave_out(nodes, hidden, asides)
    rest = nodes[0].chars - nodes[0].link_chars
    _leave_out(nodes, hidden, asides - some)
    plain = {at: nodes[at].chars - nodes[at].link_chars for at in some if not nodes[at].out}
    for at in sorted(plain, key=lambda at: (-plain[at], at)):
        node = nodes[at]
        up = node.parent
        while up is not None and up.at > 0 and up.at not in asides:
            up = up.parent
        if up is not None and up.at > 0:
            continue  # goes with what is around it
        like_comments = named[at] in COMMENTS or _repeats(node)
        if like_comments:
            spared = rest < ENOUGH and plain[at] > 9 * rest
        else:
            spared = plain[at] > rest or named[at] in TOPICS and at in inside and _has_paragraph(node)
        if spared:
            asides.discard(at)
            rest += plain[at] - sum(plain.get(n.at, 0) for n in _outermost(node, asides))


def _outermost(top: Node, asides: set[int]) -> list[Node]:
    """The asides below a node that lie in no other one below it."""
    out, stack = [], [c for c in top.children if isinstance(c, Node)]
    while stack:
        n = stack.pop()
        if n.at in asides:
            out.append(n)
        else:
            stack.extend(c for c in n.children if isinstance(c, Node))
    return out


def _repeats(node: Node) -> bool:
    """Does the element hold a row of items, as lists of comments or links do: entries of a list, articles, or blocks that share a name?"""
    while True:
        held = [c for c in node.children if isinstance(c, Node) and not c.out and c.chars]
        items: dict[tuple[str, str], int] = {}
        for c in held:
            name = " ".join(a or b or d for k, a, b, d in _SAID.findall(c.said) if k.lower() == "class")
            if c.tag in ("li", "article", "dd") or name and c.tag not in FLOW:
                items[c.tag, name] = items.get((c.tag, name), 0) + 1
        if any(n > 1 for n in items.values()):
            return True
        held = [c for c in held if c.tag not in HEADINGS]
        if len(held) != 1:
            return False
        node = held[0]


def _has_paragraph(node: Node) -> bool:
    return any(isinstance(n, Node) and n.tag in ("p", "blockquote", "pre") and n.chars - n.link_chars >= PARAGRAPH for n in _walk(node))


def _is_comments(node: Node) -> bool:
    said = " ".join(a or b or c for k, a, b, c in _SAID.findall(node.said) if k.lower() in ("class", "id"))
    return any(w.lower() in COMMENTS for w in _WORDS.findall(said))


def _largest(live: list[Node]) -> dict[int, Node]:
    """For each live node, by its place, the node with the largest sum in its subtree."""
    largest: dict[int, Node] = {}
    for node in reversed(live):
        top = node
        for c in node.children:
            if isinstance(c, Node) and not c.out and largest[c.at].total > top.total:
                top = largest[c.at]
        largest[node.at] = top
    return largest


def _best(live: list[Node], largest: dict[int, Node]) -> Node:
    """The node with the largest sum; if most of its text lies in one article or main element below it, that of this element."""
    body = live[0]
    best = largest[body.at]
    while True:
        held = [c for c in _below(best) if c.tag in ("article", "main")]
        top = max(held, key=lambda n: n.chars - n.link_chars, default=None)
        if top is None or (top.chars - top.link_chars) * 2 < best.chars - best.link_chars or not top.chars:
            return best
        best = largest[top.at]


def _below(node: Node):
    """The live nodes below a node, but not those below an article or main element."""
    stack = [c for c in reversed(node.children) if isinstance(c, Node) and not c.out]
    while stack:
        n = stack.pop()
        yield n
        if n.tag not in ("article", "main"):
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node) and not c.out)


def main_nodes(root: Node) -> list[Node]:
    """The nodes whose subtrees are the main text, in page order. What is left out below them is marked out."""
    body = root.children[0]
    live = _live(_walk(body))
    largest = _largest(live)
    best = _best(live, largest)
    # The threshold is the smallest density on the way from the best node to the body.
    threshold = min(n.density for n in _up(best))
    marked = {largest[n.at].at for n in live if n.density >= threshold} | {best.at}
    holds = set()  # nodes with a marked one below them
    for n in reversed(live):
        if n is not body and (n.at in marked or n.at in holds):
            holds.add(n.parent.at)
    around = next((n for n in _up(best) if n.tag == "article"), None) or next((n for n in _up(best) if n.tag == "main"), None)
    linked = lambda n: n.link_chars * 2 > n.chars and n.density < threshold
    leaf = lambda n: not any(isinstance(c, Node) and c.tag in BLOCK for c in n.children)
    for n in live:  # menus in the text: blocks that are mostly links
        if n.tag in BLOCK and n.tag not in HEADINGS and n.tag != "p" and n.link_tags and linked(n) and n is not body and n.at not in holds:
            n.out = True
    if around is None:
        picked = set(marked)
        for step in _up(best):
            beside = [c for c in step.parent.children if isinstance(c, Node)] if step is not body else []
            dense = [i for i, c in enumerate(beside) if c.at in marked or c.at in holds]
            for i, c in enumerate(beside):
                between = c.tag in FLOW or leaf(c) and dense[0] < i < dense[-1]
                if not linked(c) and (c.tag in HEADINGS or step is best and between):
                    picked.add(c.at)
            for c in reversed(beside):  # a line or two after the text, as footers are
                if c is step or (c.at in marked or c.at in holds) and (c.tag in FLOW or not leaf(c) or c.chars >= LINES):
                    break
                if c.tag not in FLOW and leaf(c) and c.chars < LINES:
                    picked.difference_update(n.at for n in _walk(c))
    else:
        picked = {n.at for n in live if n.at in marked and n.tag in ("article", "main")} | {around.at}
        if around.tag == "main":
            for n in _inner(around):
                if n is not around and n.at not in marked and n.at not in holds and n.tag not in FLOW and not leaf(n) and n.density < threshold:
                    n.out = True
    out, covered = [], set()
    for n in live:
        if n is not body and n.parent.at in covered:
            covered.add(n.at)
        elif n.at in picked:
            covered.add(n.at)
            out.append(n)
    return out


def _inner(top: Node):
    """The live nodes of a subtree by whose own blocks the text is made: not those below a marked-out one, nor below text-level elements."""
    stack = [top]
    while stack:
        n = stack.pop()
        yield n
        if not n.out and n.tag not in FLOW:
            stack.extend(c for c in n.children if isinstance(c, Node) and not c.out)


def _up(node: Node):
    """The node and what is around it, up to the body."""
    while node.parent is not None:
        yield node
        node = node.parent


def blocks(nodes: list[Node]) -> list[str]:
    """Text of the subtrees by block, white space inside a block as one space, empty blocks left out."""
    out: list[str] = []
    run: list[str] = []

    def close():
        text = _WHITE.sub(" ", "".join(run)).strip()
        run.clear()
        if text:
            out.append(text)

    for top in nodes:
        close()
        stack: list[Node | str | None] = [top]
        while stack:
            x = stack.pop()
            if x is None:
                close()
            elif isinstance(x, str):
                run.append(x)
            elif x.out:
                continue
            elif x.tag == "br":
                run.append(" ")
            else:
                if x.tag in BLOCK:
                    close()
                    stack.append(None)
                stack.extend(reversed(x.children))
    close()
    return out


def extract(page: str) -> str:
    """The main text of a page; empty for an empty page."""
    return "\n\n".join(blocks(main_nodes(parse(page)))) if page else ""


def _batch(pages):
    texts = [extract(p) for p in as_text(pages)]
    return [texts, list(map(len, texts))]


def main_text(pages: DataFrame, keep: list, html_col: str = "html") -> DataFrame:
    """Columns keep, text and n_chars for every row of pages; null html counts as empty and has no text."""
    return map_columns(pages, keep, [text_of(pages, html_col)], {"text": "string", "n_chars": "bigint"}, _batch)
