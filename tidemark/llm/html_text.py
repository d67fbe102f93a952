"""Main text of web pages by tag-path ratios.

A page becomes a sequence of text blocks, each with the element that holds it and the path
of tags from the root. Per path, text length, punctuation and linked text of all its blocks
are added up and divided by the number of blocks: running text has long, punctuated blocks
without links, menus have many short linked ones. The ratios are smoothed along the page and
fused into one number per path. A block weighs its length times the number of its path.
Weights are carried to every enclosing element; the deepest element that keeps nearly all
weight is the content node. A path is kept if its fused ratio reaches a part of the content
node's mean: a small part inside a content node, half of it where the whole page is one.

Tags decide only what the standard defines to be no article text (scripts, menus, footers,
asides, ...), and text inside ``article`` and ``main`` weighs more. Whole words of class, id
or role names (``ad``, ``comments``; never a part of ``no-ads``) and forms are left out if
they hold less than half of the weight, so that a name alone never loses an article.

Elements and paths are numbered, so that time and memory grow with the page, not its depth.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, record_batches, short_batches

#: Attribute values are read as the standard does: a quote opens a value only after ``=``.
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)"
    r"((?:=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+|[^=>])*+)(?:>|\Z)"
    r"|[^<]+|<",
    re.S,
)
NAMING = re.compile(
    r"(?:^|(?<=[\s\"'/]))(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I
)
PUNCTUATION = re.compile(r"[.,;:!?…。，！？、；：]")

# Names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY_BLOCK = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
P_SCOPE = frozenset("table td th li article body form div".split())
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of the standard that hold a page's main content.
MAIN = frozenset(("article", "main"))
#: Elements that are part of a text and never the node that holds all of it.
PARTS = HEADINGS | frozenset(
    "p li dt dd pre blockquote figure figcaption address summary caption "
    "ul ol dl table thead tbody tfoot tr td th".split()
)
#: Elements that the standard defines to hold no text of the article.
LEFT_OUT = frozenset(
    "head script style noscript template nav footer aside button select option textarea "
    "iframe object svg canvas audio video title dialog menu".split()
)
#: Whole words of class, id or role that name an element beside the article.
NAMED = frozenset(
    "ad ads advert advertisement sponsored promo banner navbar navigation breadcrumb breadcrumbs "
    "sidebar footer masthead notice cookies cookie-banner popup newsletter share sharing search "
    "comments comment-list disqus related complementary contentinfo".split()
)

#: How much more text inside ``article`` and ``main`` weighs.
MAIN_WEIGHT = 16.0
#: Part of all weight that the content node must keep.
KEPT_WEIGHT = 0.7
#: An element named as one beside the article is kept from this part of all weight on.
NAMED_WEIGHT = 0.5
#: Part of the mean fused ratio a path must reach inside a content node, and without one.
INSIDE, WITHOUT = 0.05, 0.5

ROWS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("text", pa.string()),
        ("n_chars", pa.int64()),
    ]
)


@dataclass
class Blocks:
    """Elements by number (an element's parent has a smaller one) and text blocks in page order.

    Element 0 is the page itself. ``path`` numbers the path of tags of an element.
    """

    tag: list[str] = field(default_factory=lambda: [""])
    parent: list[int] = field(default_factory=lambda: [-1])
    path: list[int] = field(default_factory=lambda: [0])
    main: list[bool] = field(default_factory=lambda: [False])
    named: list[bool] = field(default_factory=lambda: [False])
    #: ``(element, text, linked characters)``.
    texts: list[tuple[int, str, int]] = field(default_factory=list)
    paths: dict[tuple[int, str], int] = field(default_factory=dict)

    def open(self, tag: str, parent: int, named: bool) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.path.append(self.paths.setdefault((self.path[parent], tag), len(self.paths) + 1))
        self.main.append(self.main[parent] or tag in MAIN)
        self.named.append(named)
        return len(self.tag) - 1


def _is_named(tag: str, attributes: str) -> bool:
    if tag == "form":
        return True
    if tag in ("html", "body") or "=" not in attributes:
        return False
    return any(
        not NAMED.isdisjoint((a or b or c).lower().split()) for a, b, c in NAMING.findall(attributes)
    )


def text_blocks(page: str) -> Blocks:
    """The page's blocks of text, without the elements of :data:`LEFT_OUT`."""
    out = Blocks()
    stack: list[tuple[str, int, bool]] = []  # (tag, element, hides)
    opened: Counter[str] = Counter()
    held: list[str] = []
    linked = hidden = 0
    link_depth = -1  # Open elements where the open link began, -1 without one.

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.texts.append((stack[-1][1] if stack else 0, text, min(linked, len(text))))
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal hidden, link_depth
        while len(stack) > depth:
            tag, _, hides = stack.pop()
            opened[tag] -= 1
            hidden -= hides
        if link_depth > depth:
            link_depth = -1

    def find(names, until=()) -> int:
        """Depth of the innermost open element of these names, -1 if there is none."""
        if not any(opened[n] for n in names):
            return -1
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in names:
                return depth
            if stack[depth][0] in until:
                return -1
        return -1

    at = 0
    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        closes, tag, attributes = m.groups()
        if tag is None:
            part = m[0]
            if not hidden and not (part[0] == "<" and len(part) > 1):
                part = html.unescape(part)
                held.append(part)
                if link_depth >= 0:
                    linked += len(" ".join(part.split()))
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                held.append(" ")
            elif tag == "a":
                link_depth = -1 if closes else len(stack)
            continue
        flush()
        if closes:
            if (depth := find((tag,))) >= 0:
                pop_to(depth)
            continue
        depth = -1
        if tag in CLOSED_BY_BLOCK:
            depth = find(("p",), P_SCOPE)
        elif tag in SIBLINGS:
            depth = find(*SIBLINGS[tag])
        if depth >= 0:
            pop_to(depth)
        if tag in VOID or attributes.endswith("/") and tag in ("svg", "path"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        parent = stack[-1][1] if stack else 0
        hides = tag in LEFT_OUT or tag == "header" and not out.main[parent]
        hidden += hides
        if not hidden:
            parent = out.open(tag, parent, _is_named(tag, attributes))
        stack.append((tag, parent, hides))
        opened[tag] += 1
    flush()
    return out


def _smoothed(values: list[float]) -> list[float]:
    """Weights 1, 2, 1 over neighbours in page order."""
    out = []
    for i, v in enumerate(values):
        before = values[i - 1] if i else v
        after = values[i + 1] if i + 1 < len(values) else v
        out.append((before + 2 * v + after) / 4)
    return out


def fused_ratios(blocks: Blocks) -> dict[int, float]:
    """Per path: length and punctuation of a block, smoothed, times its part without links."""
    length: Counter[int] = Counter()
    marks: Counter[int] = Counter()
    links: Counter[int] = Counter()
    count: Counter[int] = Counter()
    order = [blocks.path[element] for element, _, _ in blocks.texts]
    for path, (_, text, linked) in zip(order, blocks.texts, strict=True):
        length[path] += len(text)
        marks[path] += len(PUNCTUATION.findall(text))
        links[path] += linked
        count[path] += 1
    lengths = _smoothed([length[p] / count[p] for p in order])
    punctuation = _smoothed([marks[p] / count[p] for p in order])
    fused = dict.fromkeys(length, 0.0)
    for path, t, k in zip(order, lengths, punctuation, strict=True):
        fused[path] += math.sqrt(t * (1 + k)) / count[path]
    return {p: f * (1 - links[p] / length[p]) for p, f in fused.items()}


def _weights(blocks: Blocks, fused: dict[int, float], dropped: list[bool]) -> list[float]:
    """Weight of the kept text in each element and all below it."""
    weight = [0.0] * len(blocks.tag)
    for element, text, _ in blocks.texts:
        if not dropped[element]:
            more = MAIN_WEIGHT if blocks.main[element] else 1.0
            weight[element] += len(text) * fused[blocks.path[element]] * more
    for element in range(len(weight) - 1, 0, -1):
        weight[blocks.parent[element]] += weight[element]
    return weight


def _content_node(blocks: Blocks, weight: list[float]) -> int:
    """The deepest element that keeps nearly all weight and is no part of a text itself.

    An element below the body that holds text of its own is not left for one inside it.
    """
    heaviest: dict[int, int] = {}
    for element in range(1, len(weight)):
        parent = blocks.parent[element]
        if weight[element] > weight[heaviest[parent]] if parent in heaviest else weight[element] > 0:
            heaviest[parent] = element
    holds_text = {element for element, _, _ in blocks.texts}
    node = 0
    while (child := heaviest.get(node)) is not None:
        tag = blocks.tag[child]
        leaf = tag in PARTS or child not in heaviest and tag not in MAIN
        own = node in holds_text and blocks.tag[node] not in ("", "html", "body") and tag not in MAIN
        if leaf or own or weight[child] < KEPT_WEIGHT * weight[0]:
            break
        node = child
    return node


def main_text(page: str) -> str:
    """The article's blocks, one per line; empty if there is no text."""
    blocks = text_blocks(page)
    if not blocks.texts:
        return ""
    fused = fused_ratios(blocks)
    size = len(blocks.tag)
    dropped = [False] * size
    if any(blocks.named):
        weight = _weights(blocks, fused, dropped)
        for e in range(1, size):
            beside = blocks.named[e] and weight[e] < NAMED_WEIGHT * weight[0]
            dropped[e] = dropped[blocks.parent[e]] or beside
    weight = _weights(blocks, fused, dropped)
    node = _content_node(blocks, weight)
    inside = [e == node for e in range(size)]
    for e in range(node + 1, size):
        inside[e] = inside[blocks.parent[e]]
    texts = [(e, t) for e, t, _ in blocks.texts if inside[e] and not dropped[e]]
    chars = sum(len(t) for _, t in texts)
    if not chars:
        return ""
    mean = sum(len(t) * fused[blocks.path[e]] for e, t in texts) / chars
    least = mean * (WITHOUT if blocks.tag[node] in ("", "html", "body") else INSIDE)
    kept = [fused[blocks.path[e]] >= least and fused[blocks.path[e]] > 0 for e, _ in texts]
    # A heading stands or falls with the next text that is none.
    follows = False
    for i in range(len(texts) - 1, -1, -1):
        if blocks.tag[texts[i][0]] in HEADINGS:
            kept[i] = kept[i] or follows
        else:
            follows = kept[i]
    return "\n".join(t for (_, t), k in zip(texts, kept, strict=True) if k)


def extract_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars.

    A null or empty html, and one without text, give an empty text. Rows that repeat are
    extracted each; other columns are not read.
    """
    short_batches(pages.sparkSession)

    def extract(batches):
        for batch in batches:
            rows = (
                (page_id, url, text, len(text))
                for page_id, url, page in zip(
                    column(batch, "page_id"), column(batch, "url"), column(batch, "html"), strict=True
                )
                for text in (main_text(page or ""),)
            )
            yield from record_batches(rows, ROWS, 1000)

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return narrow.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
