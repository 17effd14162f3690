"""Main text of web pages by minimum-cut labelling.

A page becomes a list of text blocks with their place in the element tree. A linear classifier
over block statistics says what it costs to call a block content or boilerplate; these are
the capacities to the two terminals. Blocks next to each other on the page or close in the
tree are joined by smoothness edges. The minimum cut between the terminals is the labelling of
least total cost. Pages are independent, so Spark spreads them over the tasks and nothing is
shuffled.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import map_arrow, slices, whole_text

# Element names by their meaning in HTML.
HIDDEN = frozenset("script style noscript template head title svg math iframe object canvas "
                   "audio video map datalist select option textarea button".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
ENDS_PARAGRAPH = BLOCKS - {"body", "html"}
SIBLING_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOILERPLATE = frozenset("nav header footer aside form menu dialog fieldset".split())
PROSE = frozenset("p blockquote pre h1 h2 h3 h4 h5 h6 dd dt figcaption td li".split())
# Words of class, id and role attributes that name page furniture, or the article.
FURNITURE = re.compile(
    r"^(?:ads?|adv|advert|advertis\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|"
    r"notices?|alerts?|notification|comments?|commentlist|respond|reply|replies|disqus|discussion|"
    r"sidebar\w*|side|nav\w*|menu\w*|breadcrumbs?|pagination|pager|footer\w*|header\w*|masthead|"
    r"topbar|toolbar|share|sharing|social\w*|related|recommend\w*|more|trending|popular|popup|"
    r"modal|overlay|newsletter|subscribe|subscription|signup|login|search|widgets?|copyright|"
    r"legal|disclaimer|tags?|taglist|byline|meta|skip|hidden|complementary|contentinfo|dialog)$")
ARTICLE = re.compile(r"^(?:article\w*|content|main|story|post|entry|body|text|prose|hentry)$")
LAYOUT = frozenset("header footer side more meta hidden legal tag tags search login alert".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)",
    re.S)
NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""",
                   re.I)

# Weights of the classifier, in units of cost; positive speaks for content.
WEIGHTS = {
    "bias": -0.6, "article": 2.2, "prose": 1.0, "heading": 0.4, "length": 1.6, "sentences": 0.5,
    "links": -3.5, "furniture": -7.0, "furniture_in_article": -6.0,
}
NEXT, NEAR = 0.5, 1.2


@dataclass
class Node:
    name: str
    parent: Node | None
    depth: int
    furniture: bool = False
    article: bool = False
    hidden: bool = False


@dataclass
class Block:
    """Text between two block borders, with the element that holds it."""

    node: Node
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _names_furniture(word: str, in_article: bool) -> bool:
    """Whether a class or id names page furniture by itself, by its last or its first part.

    ``has-sidebar`` and ``header-fixed`` describe a layout, ``entry-header`` part of an article.
    """
    parts = [p for p in re.split("[-_:]+", word) if p]
    if not parts or parts[0] in ("has", "with", "no", "is"):
        return False
    if in_article and parts[-1] == "header":
        return False
    return bool(FURNITURE.match(word) or FURNITURE.match(parts[-1])
                or FURNITURE.match(parts[0]) and parts[0] not in LAYOUT)


def _node(name: str, parent: Node | None, rest: str) -> Node:
    node = Node(name, parent, parent.depth + 1 if parent else 0)
    if parent:
        node.furniture, node.article, node.hidden = parent.furniture, parent.article, parent.hidden
    # A heading group inside an article belongs to it; a header or footer of the page does not.
    if name in BOILERPLATE and not (name == "header" and node.article):
        node.furniture = True
    if name in ("article", "main"):
        node.article = True
    if name in HIDDEN:
        node.hidden = True
    for key, value in NAMED.findall(rest) if rest else ():
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value == "true":
            node.hidden = True
        elif key == "style":
            node.hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
        elif name not in ("body", "html"):
            if any(_names_furniture(w, node.article) for w in value.lower().split()):
                node.furniture = True
            elif any(ARTICLE.match(w) for x in value.lower().split() for w in re.split("[-_]+", x)):
                node.article = True
    return node


def blocks_of(page: str) -> list[Block]:
    """The non-empty text blocks of a page, in order; markup may be broken or cut off."""
    stack = [_node("html", None, "")]
    found: list[Block] = []
    now = Block(stack[0])
    links = 0

    def border() -> None:
        nonlocal now
        if now.parts and now.text:
            found.append(now)
        now = Block(stack[-1])

    def close(names, limit=BLOCKS | {"html"}) -> None:
        """Close the innermost open element of these names, unless a limit lies above it."""
        nonlocal links
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                links -= sum(n.name == "a" for n in stack[i:])
                if any(n.name in BLOCKS for n in stack[i:]):
                    del stack[i:]
                    border()
                else:
                    del stack[i:]
                return
            if stack[i].name in limit:
                return

    def words(raw: str) -> None:
        if not raw or stack[-1].hidden:
            return
        text = html.unescape(raw)
        now.parts.append(text)
        if links:
            now.linked += len(text.strip())

    at = 0
    while True:
        found_tag = TOKEN.search(page, at)
        if found_tag is None:
            words(page[at:])
            break
        words(page[at:found_tag.start()])
        at = found_tag.end()
        name = found_tag["name"]
        if name is None:
            continue
        name = name.lower()
        if found_tag["end"]:
            if name == "br":
                words(" ")
            elif name in BLOCKS:
                close({name}, frozenset())
            else:
                close({name}, BLOCKS)
            continue
        rest = found_tag["rest"]
        if name in VOID:
            if name == "hr":
                border()
            else:
                words(" ")
            continue
        if name in RAW:
            shut = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = shut.end() if shut else len(page)
            continue
        if name in ENDS_PARAGRAPH:
            close({"p"}, BLOCKS - {"p"})
        if name in SIBLING_ENDS:
            close(SIBLING_ENDS[name], {"ul", "ol", "menu", "dl", "table", "select"})
        if name[0] == "h" and name[1:].isdigit():
            close({"h1", "h2", "h3", "h4", "h5", "h6"}, BLOCKS - {"h1", "h2", "h3", "h4", "h5", "h6"})
        if name in ("html", "body") and len(stack) > 1:
            continue
        stack.append(_node(name, stack[-1], rest))
        links += name == "a"
        if name in BLOCKS:
            border()
    border()
    return found


def content_score(block: Block) -> float:
    """The classifier: positive for content, in units of cost."""
    text, node = block.text, block.node
    words = text.count(" ") + 1
    holder = node
    while holder.parent is not None and holder.name not in BLOCKS:
        holder = holder.parent
    z = WEIGHTS["bias"] + WEIGHTS["length"] * min(1.0, math.log1p(words) / math.log(40.0))
    z += WEIGHTS["links"] * min(1.0, block.linked / max(1, len(text)))
    if text[-1] in ".!?:;。…" and words > 3:
        z += WEIGHTS["sentences"]
    if holder.name in PROSE:
        z += WEIGHTS["prose"]
    if holder.name[0] == "h" and holder.name[1:].isdigit():
        z += WEIGHTS["heading"]
    if node.article:
        z += WEIGHTS["article"]
    if node.furniture:
        z += WEIGHTS["furniture_in_article" if node.article else "furniture"]
    return z


def _distance(a: Node, b: Node, most: int) -> int:
    """Steps between two elements through their nearest common ancestor, at most ``most``."""
    steps = 0
    while a is not b and steps < most:
        if a.depth >= b.depth and a.parent is not None:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between blocks that follow each other, and between near ones in the tree."""
    edges = []
    last_under: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            steps = _distance(blocks[i - 1].node, block.node, 6)
            edges.append((i - 1, i, NEXT + NEAR * 0.5 ** steps))
        holder = id(block.node.parent)
        before = last_under.get(holder)
        if before is not None and before < i - 1:
            edges.append((before, i, NEAR * 0.5))
        last_under[holder] = i
    return edges


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node is on the content side of the least costly cut.

    Leaving a node on the wrong side costs the size of its score, parting the ends of an edge
    its weight. A node whose score outweighs all its edges is on its own side in every minimum
    cut, so it is fixed first and its edges become costs of its neighbours; augmenting paths
    settle the others.
    """
    n = len(scores)
    unary = list(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b and w > 0:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    side: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if side[i] is not None or abs(unary[i]) < sum(near[i].values()) - 1e-12:
            continue
        side[i] = unary[i] > 0
        for j, w in near[i].items():
            unary[j] += w if side[i] else -w
            del near[j][i]
            queue.append(j)
        near[i].clear()
    left = [i for i in range(n) if side[i] is None]
    if left:
        content = _source_side(left, unary, near)
        for i in left:
            side[i] = i in content
    return [bool(s) for s in side]


def _source_side(nodes: list[int], unary: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes the source still reaches when shortest augmenting paths are used up."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {source: {}, sink: {}}
    for i in nodes:
        room[i] = dict(near[i])
    for i in nodes:
        if unary[i] > 0:
            room[source][i] = unary[i]
            room[i][source] = 0.0
        elif unary[i] < 0:
            room[i][sink] = -unary[i]
            room[sink][i] = 0.0
    while True:
        came = {source: source}
        queue = deque([source])
        while queue and sink not in came:
            i = queue.popleft()
            for j, free in room[i].items():
                if free > 1e-9 and j not in came:
                    came[j] = i
                    queue.append(j)
        if sink not in came:
            return set(came) - {source}
        path, j = [], sink
        while j != source:
            path.append((came[j], j))
            j = came[j]
        flow = min(room[i][j] for i, j in path)
        for i, j in path:
            room[i][j] -= flow
            room[j][i] = room[j].get(i, 0.0) + flow


def main_text(page: str) -> tuple[str, int]:
    """Text of the content blocks joined by one newline, and the number of all blocks."""
    blocks = blocks_of(page)
    if not blocks:
        return "", 0
    keep = minimum_cut([content_score(b) for b in blocks], smoothness(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k), len(blocks)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """Main text of each page: page_id, url, text, n_blocks; one row per input row.

    Null and empty html give empty text, as does a page without content. White space inside a
    block is one space; a line break inside a block is white space. Markup may be cut off
    anywhere. Repeated rows are repeated; other columns are not read. Memory is bounded by the
    longest page.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 4 << 20):
            done = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([t for t, _ in done], pa.string()),
                 pa.array([n for _, n in done], pa.int32())],
                names=["page_id", "url", "text", "n_blocks"])

    named = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                         F.col(f"`{url_col}`").cast("string").alias("url"),
                         whole_text(html_col).alias("html"))
    return map_arrow(named, rows, "page_id long, url string, text string, n_blocks int")
