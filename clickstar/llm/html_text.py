"""Main text of web pages by tree scoring."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed lists of HTML: elements without content, elements whose content is no markup, elements that
# stand in a line of text, and elements that a start tag of the same or a like kind closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
# Start tags that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
# Never part of the main text: by element.
DROPPED = frozenset(
    "script style noscript template iframe object embed svg canvas button select option input textarea head title audio "
    "video map".split()
)
# Not part of the main text unless they hold it: by element, by role, and by a name in class or id.
ASIDE = frozenset("nav header footer aside dialog menu".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar aside header masthead footer foot comment comments disqus respond "
    "reply replies cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended toolbar pagination pager skip hidden copyright legal widget form".split()
)
# Names of text by readers and lawyers, of which a page may have more than of its own.
LONG_WORDS = frozenset("comment comments disqus respond reply replies cookie cookies consent gdpr legal".split())
# Words that leave a name what it is: "cookie-banner", "site-header" and "related-posts" name such blocks,
# "overflow-hidden", "has-sidebar" and "widget-area" do not.
PLAIN_WORDS = frozenset("site page main top bottom left right global bar box block list item items links posts buttons slot unit".split())
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# Comments, declarations, tags and text; a lone "<" is text.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|([^<]+|<)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")

# A paragraph shorter than this gives no points.
LEAST_CHARS = 25
# Elements round a block that it gives points to; the last of them gets a hundredth.
LEVELS = 32
# Paragraph-like elements.
SCORED = frozenset("p td pre blockquote li dd div section article main body figcaption".split())


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "doubt", "score", "points", "chars", "link_chars", "order")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, doubt: int = 0):
        self.tag, self.parent, self.dropped, self.doubt = tag, parent, dropped, doubt
        # Text as str, elements as Node.
        self.children: list[Node | str] = []
        self.score, self.points, self.chars, self.link_chars, self.order = 0.0, 0.0, 0, 0, 0


# How an element that may not be main text is known: by name or as a form, by the name of a long
# text, or by its element, its role or as hidden.
_NAMED, _LONG, _MARKED = 1, 2, 3


def _named(names: str) -> int:
    """``_NAMED`` or ``_LONG`` if a whole name of a class or id is one of a block beside the text."""
    doubt = 0
    for name in names.split():
        words = [w.lower() for w in _NAME_WORD.findall(name)]
        if "".join(words) not in DROPPED_WORDS:
            hits = sum(w in DROPPED_WORDS for w in words)
            if not hits or any(w not in DROPPED_WORDS and w not in PLAIN_WORDS for w in words):
                continue
        doubt = _LONG if doubt == _LONG or any(w in LONG_WORDS for w in words) else _NAMED
    return doubt


def _doubt(tag: str, attributes: str) -> int:
    """Whether an element may be no main text, and by what; 0 if nothing speaks against it."""
    if tag in ASIDE:
        return _MARKED
    doubt = _NAMED if tag == "form" else 0
    if not attributes.strip() or tag in ("html", "body", "article", "main"):
        return doubt
    for found in _ATTRIBUTE.finditer(attributes):
        name, value = found[1].lower(), unescape((found[2] or "").strip("\"'"))
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return _MARKED
        if name == "role" and value.lower() in DROPPED_ROLES:
            return _MARKED
        if name == "style" and _HIDDEN.search(value):
            return _MARKED
        if name in ("class", "id"):
            doubt = max(doubt, _named(value))
    return doubt


def parse(html: str) -> Node:
    """Tree of a page.  End tags without start are ignored, open elements end with their parent."""
    root = node = Node("#root", None, False)
    at, end = 0, len(html)
    while at < end:
        found = _TOKEN.match(html, at)
        if found is None:
            # A tag that never ends; a quote without its partner ends at the next ">".
            close = html.find(">", at)
            found_name = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)").match(html, at)
            if close < 0 or found_name is None:
                break
            closing, tag, attributes, text, at = found_name[1], found_name[2], html[found_name.end() : close], None, close + 1
        else:
            at = found.end()
            closing, tag, attributes, text = found[1], found[2], found[3], found[4]
        if text is not None:
            node.children.append(text)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            up = node
            while up is not root and up.tag != tag:
                # An end tag of a line element does not close blocks.
                if tag in INLINE and up.tag not in INLINE:
                    up = root
                    break
                up = up.parent
            if up is not root:
                node = up.parent
            continue
        if tag in ENDS_P:
            up = node
            while up is not root and (up.tag in INLINE):
                up = up.parent
            if up.tag == "p":
                node = up.parent
        elif tag in CLOSED_BY:
            closes, stops = CLOSED_BY[tag]
            up, last = node, None
            while up is not root and up.tag not in stops:
                if up.tag in closes:
                    last = up
                up = up.parent
            if last is not None:
                node = last.parent
        child = Node(tag, node, tag in DROPPED, _doubt(tag, attributes or ""))
        node.children.append(child)
        if tag in RAW:
            stop = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = stop.end() if stop else end
        elif tag not in VOID and not (attributes or "").endswith("/"):
            node = child
    return root


def _walk(root: Node) -> Iterator[tuple[Node, bool]]:
    """Each element that is not dropped, twice: when it begins (True) and when it ends."""
    stack: list[tuple[Node, bool]] = [(root, True)]
    while stack:
        node, begins = stack.pop()
        yield node, begins
        if begins:
            stack.append((node, False))
            stack.extend((c, True) for c in reversed(node.children) if not isinstance(c, str) and not c.dropped)


@dataclass
class _Held:
    """What an element holds besides links; ``clean`` and what begins with it without what is
    in doubt in it.  ``article``: the longest article or main element."""

    text: int = 0
    article: int = 0
    articles: int = 0
    main: bool = False
    title: bool = False
    clean: int = 0
    clean_article: int = 0
    clean_line: bool = False
    clean_title: bool = False

    def add(self, other: _Held, clean: bool) -> None:
        self.text += other.text
        self.article = max(self.article, other.article)
        self.articles += other.articles
        self.main |= other.main
        self.title |= other.title
        if clean:
            self.add_clean(other)

    def add_clean(self, other: _Held) -> None:
        self.clean += other.clean
        self.clean_article = max(self.clean_article, other.clean_article)
        self.clean_line |= other.clean_line
        self.clean_title |= other.clean_title


def _settle(root: Node) -> None:
    """Drops the elements in doubt that do not hold the main text.

    Judged from outside inwards against the text that is not in doubt.  The main text is in an
    element with the main element, with the longest article, or with most of the text; if the title
    stands over other text, with nearly all of it.  A text that
    readers or lawyers wrote may be longer than all else, so an element with such a name must have
    the title too, unless nothing else has a line of text; one that is marked as no main text by
    its element must have a main element or an article with most of the text.
    """
    held: dict[Node, _Held] = {}
    links = 0
    for node, begins in _walk(root):
        links += (1 if begins else -1) if node.tag == "a" else 0
        if begins:
            held[node] = _Held()
            continue
        own = held[node]
        if not links and node.tag != "a":
            lengths = [len(c.strip()) for c in node.children if isinstance(c, str)]
            own.text += sum(lengths)
            own.clean += sum(lengths)
            own.clean_line |= max(lengths, default=0) >= LEAST_CHARS and node.tag not in ("h1", "h2", "h3")
        if node.tag == "h1":
            own.title = own.clean_title = True
        if node.tag in ("article", "main") and own.text:
            own.article, own.clean_article, own.articles = own.text, own.clean, own.articles + 1
            own.main |= node.tag == "main"
        if node.parent is not None:
            held[node.parent].add(own, not node.doubt)
    page = held[root]
    total, articles = page.text, page.articles

    def holds(node: Node) -> bool:
        own = held[node]
        longest = own.article > page.clean_article
        most = longest and 2 * own.article > page.clean
        if node.doubt == _MARKED:
            return own.main or most
        elsewhere = page.clean_title and page.clean_line and not own.title
        found = (
            own.main or most or longest and own.articles == articles == 1
            or own.text > (4 * page.clean if elsewhere else total / 2) and 10 * page.clean_article < own.text
        )
        return found and (node.doubt == _NAMED or own.main or own.title or not page.clean_line)

    # By rounds of depth, the longest first, so that what one of them holds counts for the others.
    stack = [root]
    while stack:
        waiting: list[Node] = []
        while stack:
            node = stack.pop()
            inner = [c for c in node.children if not isinstance(c, str) and not c.dropped]
            waiting.extend(c for c in inner if c.doubt)
            stack.extend(c for c in inner if not c.doubt)
        for node in sorted(waiting, key=lambda n: -held[n].text):
            if holds(node):
                page.add_clean(held[node])
                stack.append(node)
            else:
                node.dropped = True


def _measure(root: Node) -> list[Node]:
    """Fills in the characters of all elements and the points; gives the elements in page order."""
    nodes: list[Node] = []
    for node, begins in _walk(root):
        if begins:
            node.order = len(nodes)
            nodes.append(node)
            continue
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        inner = [c for c in node.children if not isinstance(c, str) and not c.dropped]
        node.chars = own + sum(c.chars for c in inner)
        node.link_chars = node.chars if node.tag == "a" else sum(c.link_chars for c in inner)
        node.points = sum(c.points for c in inner)
        if node.tag not in SCORED or node.parent is None:
            continue
        # The text that stands in this block itself, not in blocks within it.
        line, commas = 0, 0
        waiting: list[Node | str] = list(node.children)
        while waiting:
            c = waiting.pop()
            if isinstance(c, str):
                line += len(c.strip())
                commas += c.count(",") + c.count("，") + c.count("、")
            elif c.tag in INLINE and not c.dropped:
                waiting.extend(c.children)
        if line < LEAST_CHARS:
            continue
        points = (1 + commas + min(line // 100, 3)) * (1 - node.link_chars / max(node.chars, 1))
        node.points += points
        # A block gives to its parent, half to the next, then ever less; a block that holds text
        # itself beside others keeps its points.
        up, share = (node.parent, 1.0) if node.tag not in ("div", "section", "article", "main", "body") else (node, 1.0)
        level = 1
        while up is not None and level <= LEVELS:
            up.score += points * share
            level += 1
            share = 1 / 2 if level == 2 else 1 / (3 * (level - 1))
            up = up.parent
    return nodes


def _density(node: Node) -> float:
    return node.link_chars / max(node.chars, 1)


def _blocks(node: Node) -> Iterator[list[Node | str]]:
    """The blocks in an element; text and line elements that follow each other are one."""
    run: list[Node | str] = []
    for c in node.children:
        if isinstance(c, str) or c.tag in INLINE:
            run.append(c)
            continue
        if run:
            yield run
            run = []
        yield [c]
    if run:
        yield run


def _mostly_links(block: list[Node | str]) -> bool:
    shown = [c for c in block if isinstance(c, str) or not c.dropped]
    chars = sum(len(c.strip()) if isinstance(c, str) else c.chars for c in shown)
    return 2 * sum(c.link_chars for c in shown if not isinstance(c, str)) > chars


def _whole(best: Node) -> Node:
    """The element round all sections of the text of which ``best`` is one: the farthest one with
    several blocks of text that are not links, its parent at least."""
    whole, up = best.parent or best, best.parent
    while up is not None and up.tag != "html":
        blocks = [c for c in up.children if not isinstance(c, str) and not c.dropped and c.points > 0 and _density(c) < 0.25]
        if len(blocks) > 1:
            whole = up
        up = up.parent
    return whole


def _text(node: Node | str, out: list[str]) -> None:
    """The text below ``node``; a blank at each edge of a block."""
    stack: list[Node | str] = [node]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            # References are decoded per run of text: none goes on behind a tag.
            out.append(unescape(item) if "&" in item else item)
        elif not item.dropped:
            if item.tag not in INLINE or item.tag == "br":
                out.append(" ")
                stack.append(" ")
            stack.extend(reversed(item.children))


def main_text(html: str) -> str:
    """The article of a page as one line of text, empty if there is none."""
    root = parse(html)
    _settle(root)
    nodes = _measure(root)
    best = max(nodes, key=lambda n: (n.score * (1 - _density(n)), -n.order), default=root)
    if best.score <= 0:
        # No paragraph is long enough: the smallest container with all the text that is not links.
        best = root
        while True:
            inner = [c for c in best.children if not isinstance(c, str) and not c.dropped and c.chars > c.link_chars]
            own = any(isinstance(c, str) and c.strip() for c in best.children)
            if own or len(inner) != 1:
                break
            best = inner[0]
        kept: list[Node | str] = [best] if best.chars > best.link_chars else []
    else:
        # An article element round the best container is the whole article.
        up = best
        while up is not None and up.tag not in ("article", "main"):
            up = up.parent
        kept = []
        if up is None:
            kept = [] if best.parent else [best]
            for block in _blocks(_whole(best)) if best.parent else []:
                if best in block or not _mostly_links(block):
                    kept.extend(block)
        else:
            best = up
            limit = 0.2 * best.score * (1 - _density(best))
            for sibling in best.parent.children if best.parent else [best]:
                if isinstance(sibling, str) or sibling.dropped:
                    continue
                density = _density(sibling)
                if sibling is best or sibling.score * (1 - density) >= limit:
                    kept.append(sibling)
                elif sibling.tag in ("p", "h1", "h2", "h3", "blockquote", "pre") and (
                    sibling.chars > 80 and density < 0.25 or sibling.tag != "p" and sibling.chars and density < 0.25
                ):
                    kept.append(sibling)
    out: list[str] = []
    for node in kept:
        _text(node, out)
    # White space, also that of references, becomes one blank.
    return " ".join("".join(out).split())


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages`` (page_id, url, html).

    Paragraphs give points for their length and commas, less the share of links, to the elements
    round them.  Of the article or main element round the best one the text is kept, with siblings
    that score near it or are long paragraphs; without such an element, that of all blocks beside
    the best one and of all sections, but for those that are mostly links.  Navigation, headers,
    footers, sidebars, notices, adverts, forms and comments of readers are left out unless they hold
    the main text; scripts and styles always are.  Null and empty pages and pages without text give an empty
    text; broken markup is read as far as it goes.  Repeated rows and rows without page_id are pages
    of their own.  Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("h"),
    ).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
