"""Main text of HTML pages by tree scoring.

Every paragraph earns points for its length and its commas and passes them on:
all to its parent, half to the parent above, a smaller share to each further
ancestor.  A container's total is discounted by the share of its text inside
links.  The best container is kept with those of its siblings that score
alongside it.  Parts that are never main text (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, reader comments) are known by tag,
role, class or id and are left out.  Headings, paragraphs and everything inside
<article> or <main> are left out for a class or role that says nothing else,
never for an id, which may be made from a heading.  Blocks of links are left
out of pages and of <main>, but not of an <article>, or of <main> without one.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, rows_of

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.S)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?(?=[\s/>]|\Z)""", re.I)
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_COMMA = re.compile("[,،、，;]")
_STOP, _MARK, _CUT_OFF = re.compile(r"[\s/>]"), re.compile("""[>"']"""), re.compile("<[a-zA-Z/!]")

# Elements by their part in a page.
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes".split())
#: inside these a slash closes any element, and HTML elements end them; some of their elements hold HTML again
FOREIGN = frozenset("svg math".split())
HOLDS_HTML = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
ENDS_FOREIGN = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li "
                         "listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset("head nav footer aside form button select option menu dialog object audio video canvas datalist "
                     "fieldset label legend svg annotation annotation-xml".split()) | RAW
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary "
                  "table tbody td tfoot th thead tr ul br".split())
PARAGRAPH = frozenset("p pre td blockquote li dd figcaption div section article main body html center".split())
ENDS_PARAGRAPH = BLOCK - {"br", "html", "body", "td", "th", "tr", "tbody", "thead", "tfoot"}
ENDS_ITSELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
               "th": {"tr", "table"}, "option": {"select"}}
KEPT_WHATEVER_CLASS = frozenset("html body article main".split())
BASE = {"article": 10.0, "main": 8.0, "div": 5.0, "section": 3.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0,
        "ul": -3.0, "ol": -3.0, "dl": -3.0, "address": -3.0}
NEVER = frozenset("ad ads advert advertisement adverts advertising sponsor sponsored comment comments disqus respond "
                  "replies cookie cookies consent gdpr nav navbar navigation menu breadcrumb breadcrumbs footer sidebar "
                  "newsletter subscribe subscription pagination pager toolbar skip login signup complementary "
                  "contentinfo search".split())
SELDOM = frozenset("header banner masthead notice notices alert popup modal overlay promo related recommended share "
                   "sharing social widget rail outbrain taboola disclaimer copyright tags".split())
LIKELY = frozenset("article body content entry main post story text page".split())
#: words that say nothing about a part's content next to one of NEVER or SELDOM
FILLER = frozenset("section list box block area wrapper wrap container bar link links post posts article articles button "
                   "buttons icon icons form panel unit slot thread row item items inner outer main site page top bottom "
                   "left right primary secondary global mobile sub".split())
#: of SELDOM, what a part of an article may well be
IN_ARTICLES = frozenset("header masthead notice notices alert disclaimer copyright".split())
MARKS = NEVER | SELDOM
STRICT = MARKS - IN_ARTICLES
TEXT = frozenset("p h1 h2 h3 h4 h5 h6".split())
NOT_ITSELF = frozenset("has with no without is hide".split())


#: of a text: whether it begins and ends with white space, its length without those and with inner white space as one
#: space each, and its commas; a text of white space alone has length 0
_NOTHING = (False, False, 0, 0)
_BREAK = (True, True, 0, 0)


def _run(text: str) -> tuple[bool, bool, int, int]:
    plain = _SPACE.sub(" ", html.unescape(text))
    inner = plain.strip(" ")
    return plain[:1] == " ", plain[-1:] == " ", len(inner), len(_COMMA.findall(inner))


def _joined(a: tuple, b: tuple) -> tuple:
    """The same of two texts, one after the other."""
    if not a[2] or not b[2]:
        blank, other = (b, a) if a[2] else (a, b)
        space = blank[0]
        return (other[0] or space, other[1], other[2], other[3]) if other is b else (other[0], other[1] or space, other[2], other[3])
    return a[0], b[1], a[2] + b[2] + (a[1] or b[0]), a[3] + b[3]


class _Ends:
    """Where the tags of a page end, known for all of them after one pass from its end.

    A tag ends at the first ``>`` outside its quotes; one whose quotes or itself
    never end is text.
    """

    def __init__(self, page: str):
        self.stops = [m.start() for m in _STOP.finditer(page)]
        self.marks = [m.start() for m in _MARK.finditer(page)]
        self.ends = [False] * (len(self.marks) + 1)
        last = {}
        for k in range(len(self.marks) - 1, -1, -1):
            c = page[self.marks[k]]
            # a quote goes on behind the next one of its kind
            self.ends[k] = c == ">" or c in last and self.ends[last[c] + 1]
            last[c] = k

    def has(self, name_at: int) -> bool:
        """Whether the tag whose name begins there ends."""
        k = bisect_left(self.stops, name_at)
        return k < len(self.stops) and self.ends[bisect_left(self.marks, self.stops[k])]


class _Path:
    """The open elements from the root down, and how deep the innermost of every kind is."""

    def __init__(self, root: Node):
        self.nodes: list[Node] = []
        self.depths: dict[str, list[int]] = defaultdict(list)
        self.push(root)

    @property
    def here(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node) -> None:
        self.depths[node.tag].append(len(self.nodes))
        self.nodes.append(node)

    def innermost(self, tags) -> int:
        """Depth of the innermost open element of one of these kinds; -1 if there is none."""
        return max((d[-1] for t in tags if (d := self.depths.get(t))), default=-1)

    def close(self, depth: int) -> None:
        """End the element at this depth and all in it; the root stays."""
        while len(self.nodes) > max(depth, 1):
            self.depths[self.nodes.pop().tag].pop()


class Node:
    __slots__ = ("tag", "parent", "parts", "out", "score", "paragraph", "size", "linked", "foreign", "inside", "run", "points")

    def __init__(self, tag: str, parent: Node | None, out: bool):
        self.tag, self.parent, self.out = tag, parent, out
        self.parts: list = []  # texts and nodes in page order
        self.score, self.paragraph, self.size, self.linked = 0.0, False, 0, 0
        self.run, self.points = _NOTHING, [0.0] * 5
        # 2 in an article, 1 in <main> alone, else 0
        self.inside: int = max(parent.inside if parent else 0, 2 * (tag == "article"), tag == "main")
        # the drawing or formula that the node's content is part of
        above = parent.foreign if parent else None
        self.foreign: Node | None = self if tag in FOREIGN else None if tag in HOLDS_HTML else above


def _left_out(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in LEFT_OUT or tag == "header" and not inside_article:
        return True
    if tag in KEPT_WHATEVER_CLASS or not attributes.strip(" /"):
        return False
    strict, words = inside_article or tag in TEXT, set()
    for name, value in _ATTR.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        elif name in ("class", "id", "role") and not (strict and name == "id"):
            for item in value.split():
                parts = [w.lower() for w in _WORD.findall(item)]
                if parts and parts[0] in NOT_ITSELF:
                    continue
                if strict or name == "id":  # the whole value, not a word of it
                    marks, seen = STRICT if strict else MARKS, set(parts)
                    if not seen & marks or not seen <= marks | FILLER:
                        words.update(LIKELY.intersection(parts) if not strict else ())
                        continue
                    if strict:
                        return True
                words.update(parts)
    return bool(words & NEVER) or bool(words & SELDOM and not words & LIKELY)


def parse(page: str) -> Node:
    """A forgiving tree of the page: unclosed elements end where a browser ends them.

    Linear in the page's length: what a tag or an end tag looks for is kept as
    the page is read, not searched again.
    """
    root = Node("html", None, False)
    path, ends = _Path(root), None
    at = look = 0  # where the text not yet taken begins, and where the next tag is looked for
    while (start := page.find("<", look)) >= 0:
        name_at = start + 1 + (page[start + 1:start + 2] == "/")
        first = page[name_at:name_at + 1]
        tag_like = first.isascii() and first.isalpha()
        if not tag_like and first not in ("!", "?") or name_at > start + 1 and not tag_like or (
                tag_like and ends is not None and not ends.has(name_at)):
            look = start + 1
            continue
        found = _TOKEN.match(page, start)
        if not found:
            ends = _Ends(page) if ends is None else ends
            look = start + 1
            continue
        if start > at:
            path.here.parts.append(page[at:start])
        at = look = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            path.close(path.innermost((tag,)) if path.innermost((tag,)) > 0 else len(path.nodes))
            continue
        if tag == "html" and len(path.nodes) == 1:
            continue
        while path.here.foreign and tag in ENDS_FOREIGN:
            path.close(path.innermost(FOREIGN))
        closed = found[3].endswith("/")
        if tag in ENDS_PARAGRAPH:
            depth = path.innermost(("p", "td", "th", "button"))
            if depth > 0 and path.nodes[depth].tag == "p":
                path.close(depth)
        if tag in ENDS_ITSELF:
            depth = path.innermost((tag, *ENDS_ITSELF[tag]))
            if depth > 0 and path.nodes[depth].tag == tag:
                path.close(depth)
        elif tag == "body" or path.here.tag == "head" and tag in BLOCK:
            while path.here.tag == "head":
                path.close(len(path.nodes) - 1)
        here = path.here
        new = Node(tag, here, here.out or _left_out(tag, found[3], here.inside > 0))
        here.parts.append(new)
        if tag in RAW and not (closed and here.foreign):  # its content is text up to its own end tag
            end = _raw_end(tag).search(page, at)
            close = page.find(">", end.start()) if end else -1
            at = look = close + 1 if close >= 0 else len(page)
        elif tag not in VOID and not closed:
            path.push(new)
    rest = page[at:]
    if rest:
        cut = _CUT_OFF.search(rest, rest.rfind(">") + 1)  # a tag that the page's end cuts off is no text
        path.here.parts.append(rest[:cut.start()] if cut else rest)
    return root


_RAW_ENDS: dict[str, re.Pattern] = {}


def _raw_end(tag: str) -> re.Pattern:
    if tag not in _RAW_ENDS:
        _RAW_ENDS[tag] = re.compile(f"</{tag}", re.I)
    return _RAW_ENDS[tag]


def _measure(root: Node, whole: int) -> list[Node]:
    """Text and link sizes of every kept node, bottom up; returns the paragraphs."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.parts if isinstance(c, Node) and not c.out]
    paragraphs = []
    for node in reversed(order):
        own = sum(len(_SPACE.sub(" ", t).strip()) for t in node.parts if isinstance(t, str))
        kids = [c for c in node.parts if isinstance(c, Node) and not c.out]
        node.size = own + sum(c.size for c in kids)
        node.linked = node.size if node.tag == "a" else sum(c.linked for c in kids)
        inline = own + sum(c.size for c in kids if c.tag not in BLOCK)
        node.paragraph = node.tag in PARAGRAPH and inline > 0 and (node.tag == "p" or inline * 2 > node.size)
        run = _BREAK if node.tag in BLOCK else _NOTHING
        for part in node.parts:
            if isinstance(part, str):
                run = _joined(run, _run(part))
            elif not part.out and not _links_only(part, whole):
                run = _joined(run, part.run)
        node.run = _joined(run, _BREAK) if node.tag in BLOCK else run
        if node.paragraph:
            paragraphs.append(node)
    return paragraphs[::-1]


def _score(paragraphs: list[Node]) -> dict[int, Node]:
    """Every paragraph's points passed to its ancestors, less the further up; scored nodes in the order they get points."""
    scored: dict[int, Node] = {}
    for p in paragraphs:
        _, _, length, commas = p.run
        points = (min(length / 100, 3.0) + commas + (length >= 25)) * (1 - _density(p))
        node = p if p.tag != "p" and p.tag in ("article", "main", "body", "div", "section") else p.parent
        if node is None:
            continue
        node.points[0] += points
        while node is not None and id(node) not in scored:  # the ancestors of a scored node are scored
            scored[id(node)] = node
            node = node.parent
    depth: dict[int, int] = {}
    for node in scored.values():
        above = []
        while node is not None and id(node) not in depth:
            above.append(node)
            node = node.parent
        base = depth[id(node)] if node is not None else -1
        depth.update((id(n), base + 1 + k) for k, n in enumerate(reversed(above)))
    for node in sorted(scored.values(), key=lambda n: -depth[id(n)]):  # children before their parents
        node.score = BASE.get(node.tag, 0.0) + sum(x / share for x, share in zip(node.points, (1, 2, 6, 9, 12), strict=True))
        if node.parent is not None:
            up = node.parent.points
            for level, x in enumerate(node.points):
                up[min(level + 1, 4)] += x
    return scored


def _links_only(node: Node, whole: int) -> bool:
    """Whether a part is a block of links that is no text of its container."""
    return node.tag in ("ul", "ol", "div", "table") and node.inside < whole and node.size > 0 and _density(node) > 0.6


def _density(node: Node) -> float:
    return node.linked / node.size if node.size else 0.0


def _text(node: Node, whole: int = 2) -> str:
    """Decoded text below a node: white space inside blocks as one space, blocks joined by one.

    Blocks of links are left out where ``inside`` is below ``whole``.
    """
    blocks: list[list[str]] = [[]]

    def walk() -> None:
        stack: list = [node]
        while stack:
            item = stack.pop()
            if item is None:
                blocks.append([])
            elif isinstance(item, str):
                blocks[-1].append(item)
            elif not item.out and (item is node or not _links_only(item, whole)):
                if item.tag in BLOCK:
                    blocks.append([])
                    stack.append(None)
                stack += item.parts[::-1]

    walk()
    cleaned = (_SPACE.sub(" ", html.unescape("".join(b))).strip() for b in blocks)
    return " ".join(b for b in cleaned if b)


def extract(page: str | None) -> str:
    """Main text of a whole page; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    whole = 2 if _first(root, ("article",)) else 1
    scored = _score(_measure(root, whole))
    if not scored:
        node = _first(root, ("article", "main", "body")) or root
        return _text(node, whole)
    best = max(scored.values(), key=lambda n: n.score * (1 - _density(n)))
    node = best
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    best = node or best
    if best.parent is None:
        return _text(best, whole)
    limit = max(10.0, 0.2 * best.score * (1 - _density(best)))
    kept = []
    for sibling in best.parent.parts:
        if not isinstance(sibling, Node) or sibling.out:
            continue
        if sibling is best or sibling.score * (1 - _density(sibling)) >= limit:
            kept.append(_text(sibling, whole))
        elif sibling.tag == "p" and sibling.size and (
                sibling.size > 80 and _density(sibling) < 0.25
                or not sibling.linked and _text(sibling, whole).endswith((".", "!", "?"))):
            kept.append(_text(sibling, whole))
    return " ".join(t for t in kept if t)


def _first(node: Node, tags: tuple[str, ...]) -> Node | None:
    for tag in tags:
        stack = [node]
        while stack:
            item = stack.pop()
            if item.tag == tag and not item.out:
                return item
            stack += [c for c in item.parts if isinstance(c, Node) and not c.out][::-1]
    return None


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for page_id, url, page in rows_of(batches):
            text = extract(page)
            yield page_id, url, text, len(text)
    return batches_of(rows(), _OUT, 512)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    A null or empty page has an empty text; null ids and urls and repeated rows
    stay as they are; an empty table gives an empty result.  No shuffle.
    """
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html")).mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")
