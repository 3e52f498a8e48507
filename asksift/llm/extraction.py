"""Main-text extraction from HTML by minimum-cut labelling of blocks.

A page is cut into text blocks at block-level tags. A linear classifier over a
block's own text and its place in the document gives each block its log-odds of
being content, bounded, so that no hint alone decides; these are its capacities to
source and sink. Blocks that follow each other, and blocks under one parent, are
joined by edges that weaken with their distance in the document tree and that
together can outweigh a doubtful block. The minimum cut, found by maximum flow, labels
all blocks at once.

Text of scripts, styles, templates and of the page's head is no block at all.
A null or empty page has an empty text; a page cut off in a tag is read up to
there. Elements that are left open end with the one around them, and a quote inside an
unquoted attribute is part of it, as browsers have it. Ties of the cut go to
boilerplate. Repeated rows are extracted one by one. Extra columns pass through; one
that is called like the result is an error, and ``into`` gives another name. An empty
table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.stages import require_columns

# Element names of HTML by their use.
RAW_TEXT = {"script", "style", "template", "textarea", "svg", "iframe", "title"}
#: Those of them that are passed over when they are not closed.
LEFT_OPEN = {"svg", "iframe", "template", "title"}
VOID = {"br", "img", "input", "hr", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike",
    "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "ruby", "rt", "rp",
    "math", "mi", "mn", "mo", "mtext", "mrow", "mfrac", "msqrt", "mroot", "msub", "msup", "msubsup",
}
CLOSES_ITSELF = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
STOPS_CLOSING = {"ul", "ol", "dl", "table", "div", "article", "section", "main", "body", "nav", "aside", "footer", "header", "form", "blockquote"}
CONTENT_TAGS = {"article", "main"}
BOILERPLATE_TAGS = {"nav", "aside", "footer", "form", "menu", "button", "select", "dialog", "fieldset"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')|=)*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?")
HINT_ATTRIBUTES = ("class", "id", "role", "aria-label")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!\s*important\s*)?(?=;|$)", re.I)
#: Names that tell a state, or what the text is about, rather than the part of the page.
_STATE = re.compile(
    r"(?:has|is|no|not|with|without|show|hide|js|category|cat|format|type|status|tags?(?![_-]+(?:cloud|lists?|links)$))[_-].*|"
    r".*[_-](?:open|opened|closed|on|off|enabled|disabled|allowed|active|visible|collapsed|expanded)",
    re.I,
)
#: Names of parts of the article itself: its header, or a text that is set apart.
_OF_CONTENT = re.compile(
    r"(?:article|post|entry|story|content|page)[_-]+(?:header|head|heading|title)|"
    r"(?:alert|notice|legal|promo)[_-]+(?:text|title|heading|lead)",
    re.I,
)
_BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|adsense|banner\w*|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|"
    r"side-?bar\w*|widgets?|footer|foot|footnav|header|masthead|topbar|toolbar|cookies?|consent|gdpr|notice\w*|alert\w*|popup\w*|"
    r"modal|newsletter|subscri\w*|signup|login|search\w*|share\w*|sharing|social|related|recommend\w*|comments?|"
    r"commentlist|disqus|respons\w*|replies|reply|pagination|pager|legal|copyright|disclaimer|tags?|toc|skip|"
    r"navigation|contentinfo|complementary)(?=$|[\s_-])",
    re.I,
)
_CONTENT = re.compile(
    r"(?:^|[\s_-])(?:article\w*|post|entry|story|main|content|body|text|prose)(?=$|[\s_-])", re.I
)
_SENTENCE = re.compile(r"[.!?…。](?:\s|$)")

#: Weights of the block classifier; positive speaks for content.
BIAS = -0.4
WEIGHTS = {
    "in_content": 2.6,
    "in_boilerplate": -7.0,
    "content_hint": 1.4,
    "boilerplate_hint": -7.0,
    "container_hint": -2.0,
    "header": -5.0,
    "paragraph": 0.6,
    "heading": 0.3,
    "list_item": -0.5,
    "link_share": -3.0,
    "sentences": 0.6,
    "length": 0.3,
}
#: The largest log-odds of a block, whatever speaks for or against it.
BOUND = 2.0
SMOOTHNESS = 0.8
REACH = 2.0


class Block(NamedTuple):
    text: str
    path: tuple[int, ...]
    score: float


class _Element(NamedTuple):
    tag: str
    number: int
    flags: frozenset[str]
    hints: tuple[int, ...]


def _attributes(raw: str) -> dict[str, str]:
    """Attributes by name; of a repeated one the first counts."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return out


def _flags(tag: str, attributes: str, above: frozenset[str]) -> set[str]:
    """What an element by itself says about the blocks below it."""
    new = set()
    if tag in CONTENT_TAGS:
        new.add("in_content")
    if tag in BOILERPLATE_TAGS:
        new.add("in_boilerplate")
    if tag == "header" and "in_content" not in above:
        new.add("header")
    if tag in ("p", "blockquote", "pre"):
        new.add("paragraph")
    if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        new.add("heading")
    if tag in ("li", "dt", "dd", "option"):
        new.add("list_item")
    if attributes.strip(" /"):
        named = _attributes(attributes)
        for name in HINT_ATTRIBUTES:
            hints = [t for t in named.get(name, "").split() if not _STATE.fullmatch(t) and not _OF_CONTENT.fullmatch(t)]
            if tag not in ("body", "html") and any(map(_BOILERPLATE.search, hints)):
                new.add("container_hint" if tag in CONTENT_TAGS else "boilerplate_hint")
            elif any(map(_CONTENT.search, hints)):
                new.add("content_hint")
        if "hidden" in named or named.get("aria-hidden", "").strip().lower() == "true" or _UNSEEN.search(named.get("style", "")):
            new.add("hidden")
    return new


def _hint_flags(flags: frozenset[str], hints: tuple[int, ...], wide: set[int]) -> frozenset[str]:
    """A name that speaks for boilerplate counts less on an element around most
    of the page's text, unless another one inside says so, too."""
    if all(h in wide for h in hints):
        return flags | {"container_hint"} if hints else flags
    return (flags | {"boilerplate_hint"}) - {"container_hint"}


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page with their places and classifier scores."""
    found_blocks: list[tuple[str, tuple[int, ...], int, frozenset[str], tuple[int, ...]]] = []
    stack = [_Element("", 0, frozenset(), ())]
    parts: list[str] = []
    linked = 0
    links = 0
    number = 0
    at = 0

    def end_block() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text and "hidden" not in stack[-1].flags:
            path = tuple(e.number for e in stack if e.tag not in INLINE)
            found_blocks.append((text, path, linked, stack[-1].flags, stack[-1].hints))
        parts.clear()
        linked = 0

    while at < len(page):
        found = _TOKEN.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            parts.append(text)
            if links:
                linked += len(text)
        if found is None:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag not in INLINE:
                end_block()
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth and (tag not in INLINE or all(e.tag in INLINE for e in stack[depth:])):
                links -= sum(e.tag == "a" for e in stack[depth:])
                del stack[depth:]
            continue
        if tag in RAW_TEXT or tag == "head":
            closing = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            if tag == "head" and closing is None:
                continue
            if closing is None and tag in LEFT_OPEN:
                continue
            if not found[3].endswith("/"):
                at = closing.end() if closing else len(page)
            parts.append(" ")
            continue
        if tag == "br" or (tag in VOID and tag not in INLINE):
            parts.append(" ")
            continue
        if tag in VOID:
            continue
        if tag not in INLINE:
            end_block()
            _close_implied(stack, tag)
            links = sum(e.tag == "a" for e in stack)
        number += 1
        links += tag == "a"
        _, _, flags, hints = stack[-1]
        new = _flags(tag, found[3], flags)
        if "boilerplate_hint" in new:
            new.remove("boilerplate_hint")
            hints = (*hints, number)
        stack.append(_Element(tag, number, flags | new if new else flags, hints))
    end_block()
    under: Counter[int] = Counter()
    for text, _, _, _, hints in found_blocks:
        for h in hints:
            under[h] += len(text)
    whole = sum(len(b[0]) for b in found_blocks)
    wide = {h for h, n in under.items() if 2 * n > whole}
    return [
        Block(text, path, _score(text, linked, _hint_flags(flags, hints, wide)))
        for text, path, linked, flags, hints in found_blocks
    ]


def _close_implied(stack: list[_Element], tag: str) -> None:
    """A block-level start tag ends an open paragraph, and an item, row or cell
    ends the one before it."""
    for i in range(len(stack) - 1, 0, -1):
        open_tag = stack[i].tag
        if open_tag == "p" or (open_tag == tag and tag in CLOSES_ITSELF):
            del stack[i:]
            return
        if open_tag in STOPS_CLOSING:
            return


def _score(text: str, linked: int, flags: frozenset[str]) -> float:
    score = BIAS + sum(WEIGHTS[f] for f in flags)
    score += WEIGHTS["link_share"] * min(1.0, linked / len(text))
    score += WEIGHTS["sentences"] * bool(_SENTENCE.search(text))
    score += WEIGHTS["length"] * (min(math.log10(len(text)), 3.0) - 1.0)
    return BOUND * math.tanh(score / BOUND)


def edges_of(blocks: list[Block]) -> dict[tuple[int, int], float]:
    """Smoothness edges: neighbours in the page, and neighbours under one
    parent, each weaker the further apart they are in the tree."""
    edges: dict[tuple[int, int], float] = {}
    last_under: dict[int, int] = {}
    for i, block in enumerate(blocks):
        near = {i - 1} if i else set()
        parent = block.path[-2] if len(block.path) > 1 else block.path[-1]
        if parent in last_under:
            near.add(last_under[parent])
        last_under[parent] = i
        for j in near:
            common = 0
            for a, b in zip(block.path, blocks[j].path):
                if a != b:
                    break
                common += 1
            steps = len(block.path) + len(blocks[j].path) - 2 * common
            edges[j, i] = SMOOTHNESS * math.exp(-max(0, steps - 2) / REACH)
    return edges


def minimum_cut(scores: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """True for the blocks on the content side of the minimum cut.

    A block whose own cost outweighs all its edges keeps its label in every
    minimum cut, so it is settled first and its edges become costs of its
    neighbours; the flow runs on what is left.
    """
    n = len(scores)
    own = list(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), weight in edges.items():
        near[i][j] = near[i].get(j, 0.0) + weight
        near[j][i] = near[j].get(i, 0.0) + weight
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is not None or abs(own[i]) <= sum(near[i].values()):
            continue
        label[i] = own[i] > 0
        for j, weight in near[i].items():
            own[j] += weight if label[i] else -weight
            del near[j][i]
            queue.append(j)
        near[i] = {}
    left = [i for i in range(n) if label[i] is None]
    if left:
        for i, content in zip(left, _source_side(left, own, near)):
            label[i] = content
    return [bool(x) for x in label]


def _source_side(nodes: list[int], own: list[float], near: list[dict[int, float]]) -> list[bool]:
    """Maximum flow by shortest augmenting paths in layers; returns which nodes
    the source still reaches."""
    place = {node: k for k, node in enumerate(nodes)}
    source, sink = len(nodes), len(nodes) + 1
    capacity: list[dict[int, float]] = [{} for _ in range(len(nodes) + 2)]
    for node, k in place.items():
        for other, weight in near[node].items():
            capacity[k][place[other]] = weight
        if own[node] > 0:
            capacity[source][k], capacity[k][source] = own[node], 0.0
        else:
            capacity[k][sink], capacity[sink][k] = -own[node], 0.0
    least = 1e-12
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for v, c in capacity[u].items():
                if c > least and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return [k in level for k in range(len(nodes))]
        untried = [iter(list(c)) for c in capacity]
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                steps = list(zip(path, path[1:]))
                flow = min(capacity[a][b] for a, b in steps)
                for a, b in steps:
                    capacity[a][b] -= flow
                    capacity[b][a] = capacity[b].get(a, 0.0) + flow
                cut = next(k for k, (a, b) in enumerate(steps) if capacity[a][b] <= least)
                del path[cut + 1 :]
                continue
            for v in untried[u]:
                if level.get(v) == level[u] + 1 and capacity[u][v] > least:
                    path.append(v)
                    break
            else:
                path.pop()


def label_blocks(page: str | None) -> list[tuple[str, float, bool]]:
    """Text, score and label of every block of a page."""
    blocks = blocks_of(page or "")
    labels = minimum_cut([b.score for b in blocks], edges_of(blocks))
    return [(b.text, b.score, keep) for b, keep in zip(blocks, labels)]


def main_text(page: str | None) -> str:
    return "\n\n".join(text for text, _, keep in label_blocks(page) if keep)


BLOCKS_TYPE = "array<struct<text:string,score:double,content:boolean>>"


def _free(pages: DataFrame, into: str) -> None:
    if into in pages.columns:
        raise ValueError(f"column(s) already there: {into}")


def extract_text(pages: DataFrame, page: str = "html", into: str = "text") -> DataFrame:
    """Add the main text of a column of HTML; other columns pass through."""
    require_columns(pages, page)
    _free(pages, into)

    @F.arrow_udf("string")
    def texts(column: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py()) for x in column], pa.string())

    return pages.withColumn(into, texts(F.col(page).cast("string")))


def extract_blocks(pages: DataFrame, page: str = "html", into: str = "blocks") -> DataFrame:
    """Add all blocks of a page with their classifier scores and labels."""
    require_columns(pages, page)
    _free(pages, into)
    kind = pa.list_(pa.struct([("text", pa.string()), ("score", pa.float64()), ("content", pa.bool_())]))

    def rows(column: pa.Array) -> Iterator[list[dict]]:
        for x in column:
            yield [dict(zip(("text", "score", "content"), b)) for b in label_blocks(x.as_py())]

    @F.arrow_udf(BLOCKS_TYPE)
    def blocks(column: pa.Array) -> pa.Array:
        return pa.array(list(rows(column)), kind)

    return pages.withColumn(into, blocks(F.col(page).cast("string")))
