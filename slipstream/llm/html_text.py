"""Main text of web pages by tree scoring.

A page becomes a tree of its block elements. Every block of text has a point for each line of text and for each comma, less the share of
it that is links; it gives them to the container around it, half of them to the next one out, and so on. A container's
points are discounted by the share of links in all its text, and the best container is kept: the whole article or main
element that it lies in, or else itself with all that stands among the siblings that read like text, at its own level and, if
they weigh enough beside it, further out. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments never take part.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipstream.llm import arrow

LINE = 80  # characters of a line of text, which is worth as much as a comma
LEVELS = 20  # ancestors that points reach; they are halved from one to the next
LINKED = 0.5  # share of links from which text is a list of links
BESIDE = 0.1  # of the best container's points: what a sibling of one of its ancestors needs to be part of the text

_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*')|=)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")

_RAW = {"script", "style", "title", "textarea", "iframe", "xmp", "noembed", "noframes", "template", "svg"}
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul button head label".split()
)
_EMPTY = {"hr", "br", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
_DROPPED = set("nav footer aside form button select option optgroup menu dialog head fieldset legend label search dir".split())
_CLOSES = {  # start tags that end an open element of these, unless one of the second set lies between
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
_KEEPS_P = {"body", "div", "article", "section", "main", "td", "th", "table", "blockquote", "li", "aside", "nav", "header", "footer", "form", "button"}
_UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|alert|popup|pop-up|modal|overlay|"
    r"sidebar|side-bar|aside|menu|nav|navbar|navigation|breadcrumbs?|footer|foot|header|masthead|topbar|toolbar|comments?|commentlist|"
    r"disqus|replies|respond|share|sharing|social|related|recommend\w*|newsletter|subscribe|subscription|signup|login|search|widget|"
    r"pagination|pager|skip|legal|copyright|teaser|outbrain|taboola|rail)(?=$|[\s_-]|\d)",
    re.I,
)
# names that say an element holds the text itself, whatever else they say
_TEXT_NAMES = re.compile(r"(?:^|[\s_-])(?:article|content|entry|main|post|story|text)(?=$|[\s_-]|\d)", re.I)
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}


class _Node:
    __slots__ = ("tag", "up", "order", "score", "total", "letters", "linked", "blocks", "children", "names", "drop")

    def __init__(self, tag: str, up, names: str = "", drop: bool = False):
        self.tag, self.up, self.names, self.drop = tag, up, names, drop
        self.score, self.total, self.letters, self.linked = 0.0, 0.0, 0, 0
        self.blocks, self.children = [], []  # texts of this element by itself; both in page order
        self.order = []


def _dropped(tag: str, attrs: str, within: bool) -> tuple[bool, str]:
    """Whether an element never belongs to the main text, and its class and id."""
    if tag in _DROPPED or tag == "header" and not within:
        return True, ""
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return False, ""
    found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attrs)}
    names = f"{found.get('class', '')} {found.get('id', '')}".strip()
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or found.get("role", "").lower() in _ROLES:
        return True, names
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return True, names
    return tag not in ("body", "html", "article", "main") and bool(_UNLIKELY.search(names)) and not (
        _TEXT_NAMES.search(names) and not re.search(r"comment|repl(?:y|ies)|disqus|sidebar|advert|(?:^|[\s_-])ads?(?:$|[\s_-])", names, re.I)
    ), names


def _tree(page: str) -> tuple[_Node, list[_Node]]:
    """The tree of the blocks that can belong to the main text, and its nodes in page order."""
    root = _Node("root", None)
    nodes, stack, link, text, linked = [root], [root], None, [], 0
    skipping = 0  # how many open elements of the stack belong to a dropped one
    within = 0  # open article or main elements
    muted = None  # a dropped inline element: [its tag, how many of that tag are open, the stack's height]

    def flush():
        nonlocal linked
        if text:
            words = " ".join("".join(text).split())
            text.clear()
            if words and not skipping:
                node = stack[-1]
                node.blocks.append((words, linked))
                node.order.append(words)
            linked = 0

    def pop(depth: int):
        nonlocal skipping, within, link, muted
        flush()
        while len(stack) > depth:
            node = stack.pop()
            skipping -= bool(skipping)
            within -= node.tag in ("article", "main")
        if link is not None and link > len(stack):
            link = None
        if muted is not None and muted[2] > len(stack):
            muted = None

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else size
        if stop > at and not skipping and muted is None:
            piece = html.unescape(page[at:stop]) if "&" in page[at:stop] else page[at:stop]
            text.append(piece)
            if link is not None:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA[") and not skipping:
                text.append(m[0][9:].removesuffix("]]>"))
            continue
        ending = bool(m["end"])
        if tag in _RAW:
            if not ending and not m["attrs"].endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else size
            continue
        if tag == "a":
            link = None if ending else len(stack)
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag not in _BLOCK:
            if muted is not None and tag == muted[0]:
                muted[1] += -1 if ending else 1
                muted = muted if muted[1] else None
            elif muted is None and not ending and not skipping and tag not in _EMPTY and m["attrs"]:
                if _dropped(tag, m["attrs"], bool(within))[0]:  # an inline advert or hidden text
                    muted = [tag, 1, len(stack)]
            continue
        if ending:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    pop(depth)
                    break
                if stack[depth].tag in ("td", "th", "table") and tag not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "body", "html"):
                    break
            else:
                flush()
            continue
        flush()
        if tag == "hr" or tag in ("html", "body") and not skipping:
            continue
        for depth in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
            if stack[depth].tag == "p":
                pop(depth)
                break
            if stack[depth].tag in _KEEPS_P:
                break
        if tag in _CLOSES:
            closes, bounds = _CLOSES[tag]
            found = None
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in bounds:
                    break
                if stack[depth].tag in closes:
                    found = depth
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
            if found is not None:
                pop(found)
        if skipping:
            stack.append(_Node(tag, stack[-1], "", True))
            skipping += 1
            continue
        drop, names = _dropped(tag, m["attrs"], bool(within))
        node = _Node(tag, stack[-1], names, drop)
        stack.append(node)
        if m["attrs"].endswith("/") and tag not in ("p", "div", "article", "section", "main", "li", "td"):
            stack.pop()
            continue
        if drop:
            skipping = 1
            continue
        node.up.children.append(node)
        node.up.order.append(node)
        nodes.append(node)
        within += tag in ("article", "main")
    flush()
    return root, nodes


def _texts(node: _Node) -> list[str]:
    """The blocks below a node in page order."""
    out, todo = [], [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        else:
            todo.extend(reversed(item.order))
    return out


def _whole(node: _Node) -> _Node:
    """The outermost article around a node, or else the outermost main element, or else the node itself."""
    found, up = node, node
    while up is not None:
        if up.tag == "article" or up.tag == "main" and found.tag != "article":
            found = up
        up = up.up
    return found


_AROUND = set("p pre li td th blockquote dd dt figcaption caption summary h1 h2 h3 h4 h5 h6".split())  # their text counts for the element around
_PARTS = set("p ul ol dl li dd dt table tr tbody thead td th figure pre blockquote".split())  # never the whole text
_HEADING = re.compile(r"h[1-6]")
_SENTENCE = re.compile(r"[.!?…:。！？]['\"»”’)\]]*$")


def _reads(item) -> bool:
    """Whether an element or a loose text reads like a part of a text: some block of it is a sentence, and it is no list of links."""
    if isinstance(item, str):
        return bool(_SENTENCE.search(item))
    if not item.letters or item.linked > LINKED * item.letters:
        return False
    return any(_SENTENCE.search(t) for t in _texts(item))


def _beside(node: _Node, least: float) -> list:
    """A node with its siblings: all from the first to the last that read like text and have the least points, but lists of links; and
    the headings right before them."""
    items = node.up.order
    at = next(k for k, item in enumerate(items) if item is node)
    reading = [k for k, item in enumerate(items) if k == at or (least <= 0 or not isinstance(item, str) and item.total >= least) and _reads(item)]
    first, last = reading[0], reading[-1]
    while first and not isinstance(items[first - 1], str) and _HEADING.fullmatch(items[first - 1].tag):
        first -= 1
    return [item for item in items[first : last + 1] if item is node or isinstance(item, str) or item.linked <= LINKED * item.letters]


def extract(page: str | None) -> str:
    """The main text of a page: its blocks in page order, one to a line; empty if there is none."""
    if not page:
        return ""
    root, nodes = _tree(page)
    for node in nodes:
        for words, linked in node.blocks:
            linked = min(linked, len(words))
            node.letters += len(words)
            node.linked += linked
            points = (len(words) / LINE + words.count(",")) * (1 - linked / len(words))
            node.total += points
            target = node.up if node.tag in _AROUND and node.up is not None else node
            for _ in range(LEVELS):
                if target is None or _HEADING.fullmatch(node.tag):
                    break
                target.score += points
                points, target = points / 2, target.up
    for node in reversed(nodes):  # children before their parents
        if node.up is not None:
            node.up.letters += node.letters
            node.up.linked += node.linked
            node.up.total += node.total
    scored = [n for n in nodes if n.score]
    if not scored:
        return "\n".join(_texts(root))
    best = max(scored, key=lambda n: (n.score * (1 - n.linked / n.letters) if n.letters else 0.0, n.letters))
    while best.up is not None and best.tag in _PARTS:
        best = best.up
    whole = _whole(best)
    if whole is not best or best.tag in ("article", "main"):
        return "\n".join(_texts(whole))
    lines, least = _texts(best), 0.0
    node = best
    while node.up is not None:
        lines = [t for item in _beside(node, least) for t in (lines if item is node else [item] if isinstance(item, str) else _texts(item))]
        node, least = node.up, BESIDE * best.total
    return "\n".join(lines)


def main_text(pages: DataFrame, source: str = "html") -> DataFrame:
    """Add ``text``, the main text of the whole page, and ``n_chars``, its code points.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one line feed. A
    null, empty or textless page gives an empty text. Columns of the same names are replaced, all others are kept, rows are
    neither merged nor dropped.
    """

    def begin():
        return lambda column: [pa.array([extract(page.as_py()) for page in column], pa.string())]

    found = arrow.extended(pages.withColumn(source, F.col(f"`{source}`").cast("string")), {"text": T.StringType()}, begin, source)
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))
