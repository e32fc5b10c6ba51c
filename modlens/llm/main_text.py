"""Main text of web pages by scoring the element tree.

Paragraphs earn points for their length and their commas.  They pass them to the elements that
enclose them, all to the parent and less to each further ancestor; an element's points are
discounted by the share of its text that stands in links.  The element with most points is the
article; siblings of it that earn enough are kept with it.  Elements whose name says outright that they are
something else are left out; a name with such a word in it only if most of the page's points lie elsewhere.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from modlens.llm.common import with_arrow

NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
STOP = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?:;|$)", re.I)
#: Elements whose content is no text of the page, up to their end tag.  A head is none: only its title holds text, and where
#: </head> is left out the body begins all the same.
ENDS = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in "script style noscript template svg iframe textarea select title".split()}
#: Where code without an end tag stops.
NOT_CODE = re.compile(
    r"</?(?:address|article|aside|blockquote|body|center|details|dialog|div|dl|fieldset|figure|footer|form|h[1-6]|header|hr|main|menu|nav|ol|p|pre"
    r"|section|table|ul)(?=[\s/>])|</(?:head|html)\b",
    re.I,
)
_PART = (
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|header|masthead|footer|sidebar|side|aside"
    r"|related|recommend\w*|share|sharing|social|cookies?|consent|gdpr|notices?|newsletter|subscri\w*|popup|modal|comments?|replies|disqus"
    r"|respond|toolbar|pagination|pager|login|search|complementary|contentinfo|navigation|skip)"
)
_WHERE = r"(?:site|page|main|top|bottom|left|right|global|primary|secondary|sub|user|reader|cookie|ad|email|sticky|mobile|desktop)"
_PIECE = r"(?:list|section|area|wrap|wrapper|container|box|bar|block|widget|form|thread|item|inner|links?|buttons?|icons?|panel|slot|unit|message|overlay|left|right|top|bottom|\d+)"
#: Names that say outright that an element is not the article: ``sidebar``, ``site-footer``, ``comment-list``.
NEVER = re.compile(rf"(?:(?:{_WHERE}[_-])*{_PART}(?:[_-]{_PIECE})*|(?:post|article|entry|story)[_-]comments?(?:[_-]{_PIECE})*)", re.I)
#: Names that have such a word in them: ``has-sidebar``, ``comments-open``.  These go unless most of the page's prose stands there.
UNLIKELY = re.compile(rf"(?:^|.*[_-]){_PART}(?:$|[_-].*)", re.I)
ARTICLE_NAMES = frozenset("article body content entry main post story text".split())
LIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|header|masthead|footer|sidebar|side|aside"
    r"|related|recommend\w*|share|sharing|social|cookies?|consent|gdpr|notices?|newsletter|subscri\w*|popup|modal|comments?|replies|disqus"
    r"|respond|toolbar|pagination|pager|login|search|complementary|contentinfo|navigation|skip)(?:$|[\s_-])",
    re.I,
)
LIKELY = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text)(?:$|[\s_-])", re.I)
DROPPED = frozenset("nav footer aside form button header dialog menu fieldset object embed audio video canvas map option".split())
BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul aside dialog menu button".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CONTAINERS = frozenset("article body center dd details div dl figure html main ol section table tbody td tr ul li blockquote".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSES_P = BLOCKS - {"html", "body"}
WEIGHT = {"article": 25.0, "main": 20.0, "section": 3.0, "blockquote": -1.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "table": -1.0}
SPACE = re.compile(r"\s+")


def attributes_of(tag: str) -> dict[str, str]:
    """Attributes by lower-cased name, the first of a name; one without a value is empty."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(tag):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return found


def is_hidden(found: dict[str, str]) -> bool:
    """Whether an element with these attributes is not shown."""
    return (
        found.get("hidden", "false").strip().lower() != "false"
        or found.get("aria-hidden", "").strip().lower() == "true"
        or bool(NO_DISPLAY.search(found.get("style", "")))
    )


def _after(html: str, tag: str, at: int, unclosed: set[str]) -> int:
    """Where a page goes on after an element of no text whose start tag ends at ``at``.

    Without an end tag, code goes on to the next tag of a block, a title to the next tag; of the others only the tag goes.
    """
    end = None if tag in unclosed else ENDS[tag].search(html, at)
    if end:
        return end.end()
    unclosed.add(tag)  # nor has any that follows
    if tag in ("script", "style"):
        code = NOT_CODE.search(html, at)
        return code.start() if code else len(html)
    if tag == "title":
        begin = html.find("<", at)
        return begin if begin >= 0 else len(html)
    return at


class _Node:
    __slots__ = ("tag", "parent", "dropped", "doubtful", "headings", "points", "prose", "chars", "linked", "begin", "end", "bonus")

    def __init__(self, tag: str, parent: _Node | None, attributes: str = "", begin: int = 0):
        self.tag, self.parent, self.begin, self.end = tag, parent, begin, None
        found = attributes_of(attributes) if attributes else {}
        names = names_of(found)
        inside = bool(parent and parent.tag in ("article", "main"))
        #: of an article's own header only the headings are text
        self.headings = bool(parent and parent.headings) or (tag == "header" and inside)
        self.dropped = bool(parent and parent.dropped) or (tag in DROPPED and not (tag == "header" and inside))
        self.doubtful = False
        if names and tag not in ("html", "body", "article", "main"):
            if not ARTICLE_NAMES.isdisjoint(n.lower() for n in names):
                pass
            elif any(NEVER.fullmatch(n) for n in names):
                self.dropped = True
            else:
                self.doubtful = any(UNLIKELY.fullmatch(n) for n in names)
        if found and tag not in ("html", "body"):
            self.dropped |= is_hidden(found)
        self.bonus = WEIGHT.get(tag, 0.0) + (10.0 if any(LIKELY.search(n) for n in names) else 0.0)
        self.points = self.prose = self.chars = self.linked = 0.0


def names_of(found: dict[str, str]) -> list[str]:
    """An element's class, id and role names."""
    return " ".join(found[k] for k in ("class", "id", "role") if k in found).split()


class _Tags:
    """Ends of tags, each character looked at a bounded number of times however broken the page is."""

    def __init__(self, html: str):
        self.html, self.quotes, self.last = html, True, html.rfind(">")

    def end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag, -1 if nothing does.

        A quoted value may hold a ``>``; a quote that is not closed is a character.  Once a tag is found to run to the end of
        the page that way, quotes count no more.
        """
        html = self.html
        if at > self.last:
            return -1
        here = at
        while self.quotes and (stop := STOP.search(html, here)):
            if stop[0] == ">":
                return stop.start()
            close = html.find(stop[0], stop.end())
            here = stop.end() if close < 0 else close + 1
            if close < 0:
                break
        self.quotes = False
        return html.find(">", here if here <= self.last else at)


class _Page:
    """A page's elements and blocks of text, in page order."""

    def __init__(self, html: str):
        self.root = self.node = _Node("html", None)
        self.order = [self.root]
        self.open = {"html": 1}
        self.texts: list[tuple[_Node, str, int]] = []  # a block: its element, its text, how much of it is link text
        self.parts: list[str] = []
        self.in_link = self.link = 0
        self.skipped: tuple[_Node, str, int] | None = None  # inside an inline element that is no text: where, which, how deep
        self._read(html)
        self._flush()
        for n in self.order:
            if n.end is None:
                n.end = len(self.texts)

    def _flush(self) -> None:
        text = SPACE.sub(" ", unescape("".join(self.parts))).strip()
        self.parts.clear()
        chars, self.in_link = self.in_link, 0
        node = self.node
        if text and not node.dropped and (not node.headings or node.tag in HEADINGS):
            self.texts.append((node, text, min(chars, len(text))))

    def _close(self, node: _Node) -> None:
        """End an element and what is open in it."""
        at = self.node
        while True:
            at.end = len(self.texts)
            self.open[at.tag] -= 1
            if at is node:
                break
            at = at.parent
        self.node = node.parent or self.root
        if self.skipped and self.skipped[0].end is not None:
            self.skipped = None

    def _inline(self, name: str, closing: bool, attributes: str) -> None:
        if self.skipped:
            holder, tag, depth = self.skipped
            if name == tag:
                depth += -1 if closing else 1
                self.skipped = (holder, tag, depth) if depth else None
            return
        if not closing and attributes and name not in VOID:
            found = attributes_of(attributes)
            if is_hidden(found) or any(NEVER.fullmatch(n) for n in names_of(found)):
                self.skipped = self.node, name, 1
                return
        if name == "a":
            self.link = 0 if closing else 1
        elif name == "br":
            self.parts.append("\n")

    def _block(self, name: str, closing: bool, attributes: str) -> None:
        self._flush()
        if closing:
            if self.open.get(name) and name != "html":
                at = self.node
                while at.tag != name:
                    at = at.parent
                self._close(at)
                self.link = 0
            return
        if name in VOID:
            return
        tag = self.node.tag
        if tag == "option" or (tag == "p" and name in CLOSES_P) or (name == tag and name in ("li", "dt", "dd", "tr", "td", "th")):
            self._close(self.node)
        if name in ("html", "body"):
            return
        self.node = _Node(name, self.node, attributes, len(self.texts))
        self.node.dropped |= self.skipped is not None
        self.open[name] = self.open.get(name, 0) + 1
        self.order.append(self.node)

    def _read(self, html: str) -> None:
        tags, unclosed, past = _Tags(html), set(), 0
        while past < len(html):
            begin = html.find("<", past)
            if begin != past:
                text = html[past : begin if begin >= 0 else len(html)]
                self._text(text)
                past += len(text)
                continue
            if html.startswith("<!--", past):
                end = html.find("-->", past + 4)
                past = end + 3 if end >= 0 else len(html)
                continue
            name = NAME.match(html, past + 1)
            end = tags.end(name.end()) if name else html.find(">", past) if html[past + 1 : past + 2] in ("!", "?") and past < tags.last else -1
            if end < 0:
                self._text("<")
                past += 1
                continue
            past = end + 1
            if name is None:
                continue
            low, closing = name[2].lower(), bool(name[1])
            if low in ENDS:
                if not closing:
                    self.parts.append(" ")
                    if low != "svg" or html[end - 1] != "/":
                        past = _after(html, low, past, unclosed)
            elif low in BLOCKS or low in DROPPED:
                self._block(low, closing, html[name.end() : end])
            else:
                self._inline(low, closing, html[name.end() : end])

    def _text(self, text: str) -> None:
        if not self.skipped:
            self.parts.append(text)
            if self.link:
                self.in_link += len(text.strip())


def _points(text: str, linked: int) -> float:
    """Points of one paragraph, less the share of it that is links."""
    if len(text) < 2:
        return 0.0
    return (1.0 + text.count(",") + text.count("\uff0c") + min(len(text) / 100.0, 3.0)) * (1.0 - min(1.0, linked / len(text)))


def _drop_doubtful(page: _Page) -> set[int]:
    """Blocks in elements with an unlikely name, but for those that hold at least half of the page's points."""
    for node, text, linked in page.texts:
        node.prose += _points(text, linked)
    for n in reversed(page.order):
        if n.parent is not None:
            n.parent.prose += n.prose
    gone: set[int] = set()
    for n in page.order:
        if n.doubtful and not n.dropped and 2 * n.prose < page.root.prose:
            n.dropped = True
        if n.parent is not None and n.parent.dropped:
            n.dropped = True
        elif n.dropped:
            gone.update(range(n.begin, n.end))
    return gone


def main_text(html: str) -> str:
    """The article's blocks, in page order, joined by blank lines; empty if the page has none."""
    page = _Page(html)
    gone = _drop_doubtful(page)
    kept = [i for i in range(len(page.texts)) if i not in gone]
    if not kept:
        return ""
    for i in kept:
        node, text, linked = page.texts[i]
        node.chars += len(text)
        node.linked += linked
        at, step = (node if node.tag in CONTAINERS else node.parent) or page.root, 1
        while at is not None and step <= 4:
            at.points += _points(text, linked) / step
            at, step = at.parent, step * 2
    for n in reversed(page.order):
        if n.parent is not None:
            n.parent.chars += n.chars
            n.parent.linked += n.linked

    def value(n: _Node) -> float:
        return (n.points + (n.bonus if n.points else 0.0)) * (1.0 - n.linked / n.chars) if n.chars else 0.0

    best = max((n for n in page.order if n.tag in CONTAINERS and not n.dropped), key=value)
    while best.parent is not None and best.tag in ("li", "tr", "td", "tbody", "dd"):
        best = best.parent
    wanted = set(range(best.begin, best.end))
    if best.parent is not None:
        least = max(10.0, 0.2 * value(best))
        for n in page.order:
            if n.parent is best.parent and n is not best and n.chars and not n.dropped:
                near = 1.0 - n.linked / n.chars
                last = next(i for i in range(n.end - 1, -1, -1) if i not in gone)
                prose = n.tag == "p" and near > 0.75 and (n.chars > 80 or page.texts[last][1][-1:] in ".!?")
                heading = n.tag in ("h1", "h2", "h3") and near > 0.75
                if prose or heading or (n.tag in CONTAINERS and value(n) >= least):
                    wanted.update(range(n.begin, n.end))
    return "\n\n".join(page.texts[i][1] for i in sorted(wanted - gone))


def extract_main_text(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Add ``out``, the main text of the whole ``html``.

    A null or empty page, and one without text, give an empty text.  Rows are independent: repeated
    rows give the same text each; a column named ``out`` is replaced, all others are kept.
    """
    at = df.columns.index(html)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([main_text(v.as_py() or "") for v in batch.column(at)], pa.string())]

    return with_arrow(df, run, f"`{out}` string")
