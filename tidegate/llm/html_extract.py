"""Main text of web pages by minimum-cut labelling of their text blocks (operator 1).

A page is read into text blocks (runs of text between block-level tags). A linear classifier over a block's own words,
links, tag and enclosing elements gives each label a cost; the costs are terminal capacities. Smoothness edges join
blocks that follow one another, weaker the further apart they are in the tree, and blocks of one parent that something
else interrupts. The minimum cut, found by maximum flow, labels all blocks of a page at once: content or boilerplate.
A block whose terminal outweighs all its edges is settled first (its label is the same in every minimum cut), which
leaves small graphs for the flow.

The costs are set by hand, as no table marks blocks. What HTML itself says weighs most (nav, footer, aside, form, ...).
Names of classes and ids only hint: a name counts by its words and their place (``with-sidebar`` is a layout,
``entry-header`` a title, ``article-social-text`` a text, ``post-tags`` a list of tags), and a hinted element that holds
most of the page's prose is no boilerplate (for reader comments, menus and adverts only if an article, main or first
heading is inside). So a hint can be outweighed by a block's own words and by its neighbours, a tag hardly.

Defined results: null or empty html gives the empty text; truncated or broken markup is read as far as it goes, at any
depth; a page without content blocks gives the empty text; repeated rows each give their row; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import ship, slices

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SILENT = frozenset("script style noscript template svg iframe title textarea select math canvas audio video map".split())
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in _SILENT}
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr nobr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_ASIDE = frozenset("nav footer aside form menu dialog button fieldset".split())
_MAIN = frozenset("article main".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class names and ids that speak for boilerplate; the strong ones do so even where most prose is inside.
_STRONG = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer ad ads advert adverts advertisement advertising adsense sponsor sponsored cookie cookies consent gdpr"
    " comment comments commentlist reply replies respond disqus discussion copyright pagination pager login signin signup contentinfo complementary".split()
)
_WEAK = frozenset(
    "header masthead sidebar side aside banner promo promotion notice notices alert popup modal overlay newsletter subscribe subscription share sharing social related recommended"
    " recommendations trending popular widget legal disclaimer toolbar search form skip tag tags".split()
)
_MAIN_WORDS = frozenset("article articlebody post entry content main story body text hentry prose".split())
#: A name that begins so tells how something is laid out or that it is there, not what the element is.
_ABOUT = frozenset("with has have no without not is layout js single".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\w")


def hints(value: str) -> tuple[float, bool, float]:
    """Of a class or id value: weight for boilerplate, whether a strong word says so, weight for content."""
    aside, strong, main = 0.0, False, 0.0
    for name in value.split():
        words = [w.lower() for w in _NAME.findall(name)]
        if not words or words[0] in _ABOUT:
            continue
        own, last = [w for w in words if w in _STRONG or w in _WEAK], words[-1]
        kind = any(w in _MAIN_WORDS for w in words)
        title = last in ("header", "masthead", "banner") and (kind or words[0] in ("page", "section", "title"))
        if own and not title and (not kind or last in own):
            aside = max(aside, 1.0)
            strong = strong or any(w in _STRONG for w in own)
        elif kind and not own:
            main = max(main, 1.0)
    return aside, strong, main


@dataclass(slots=True, eq=False)
class Element:
    name: str
    up: Element | None
    depth: int
    aside: int = 0
    main: float = 0.0
    hidden: bool = False
    #: The nearest element with a hint, this one included, and of such an element: weight, kind and what is inside.
    hinted: Element | None = None
    hint: float = 0.0
    strong: bool = False
    prose: int = 0
    lead: bool = False
    cost: float = 0.0


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    holder: Element
    tag: str


def _element(name: str, attributes: str, up: Element | None) -> Element:
    out = Element(name, up, up.depth + 1 if up else 0)
    if up:
        out.aside, out.main, out.hidden, out.hinted = up.aside, up.main, up.hidden, up.hinted
    if name in _ASIDE or (name == "header" and out.main < 4):
        out.aside += 1
    weight, strong, main = 0.0, False, 0.0
    if attributes and name not in ("html", "body"):
        for kind, *values in _ATTRIBUTE.findall(attributes):
            kind, value = kind.lower(), "".join(values)
            if kind == "hidden" or (kind == "style" and re.search(r"display\s*:\s*none", value)):
                out.hidden = True
            elif kind != "style" and value:
                w, s, m = hints(value)
                weight, strong, main = max(weight, w), strong or s, max(main, m)
    if weight and not (name in _MAIN and not strong):
        out.hinted, out.hint, out.strong = out, weight, strong
    elif name in _MAIN:
        out.main = 4.0
    elif main:
        out.main = max(out.main, 1.5)
    return out


def weigh(found: list[Block], hinted: list[tuple[Element, Element | None]]) -> None:
    """Cost of each hinted element, those around it included: none where it holds most of the page's prose."""
    total, first = 0, True
    for block in found:
        words = block.text.count(" ") + 1
        prose = len(block.text) - block.linked if words >= 8 and not block.holder.aside and not block.holder.hidden else 0
        total += prose
        lead = block.holder.main >= 4 or (first and block.tag == "h1")
        first = first and block.tag != "h1"
        if block.holder.hinted:
            block.holder.hinted.prose += prose
            block.holder.hinted.lead |= lead
    for element, around in reversed(hinted):  # inner ones first
        if around:
            around.lead |= element.lead
            around.prose += element.prose
    for element, around in hinted:
        most = 2 * element.prose > total and (element.lead or not element.strong)
        element.cost = (around.cost if around else 0.0) + (0.0 if most else (8.0 if element.strong else 5.0) * element.hint)


def blocks(page: str) -> list[Block]:
    """Text blocks in page order; character references are decoded and white space is one blank."""
    root = here = Element("", None, 0)
    out: list[Block] = []
    parts: list[str] = []
    in_link, linked, at, n = False, 0, 0, len(page)
    holder, tag = root, ""
    hinted: list[tuple[Element, Element | None]] = []
    opened: dict[str, int] = {}

    def flush() -> None:
        nonlocal linked, parts
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, min(linked, len(text)), holder, tag))
        parts, linked = [], 0

    while at < n:
        m = _MARKUP.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            if not parts:
                holder = here
                tag = here.name
            parts.append(piece := page[at:stop])
            if in_link:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in _SILENT and not closing:
            if attributes.endswith("/") and name in ("svg", "math", "iframe"):
                continue
            end = _ENDS[name].search(page, at)
            at = end.end() if end else n
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name == "a":
            in_link = not closing
        if name in _INLINE:
            continue
        flush()
        in_link = False
        if closing:
            if opened.get(name):
                while True:
                    last, here = here, here.up
                    opened[last.name] -= 1
                    if last.name == name:
                        break
            continue
        if (name in _CLOSES_P and here.name == "p") or (name == here.name and name in ("li", "dt", "dd", "tr", "td", "th", "option")):
            opened[here.name] -= 1
            here = here.up
        if name in _VOID or attributes.endswith("/"):
            continue
        around = here.hinted
        here = _element(name, attributes, here)
        opened[name] = opened.get(name, 0) + 1
        if here.hinted is here:
            hinted.append((here, around))
    flush()
    weigh(out, hinted)
    return out


def preference(block: Block) -> float:
    """Classifier's log-odds for content: cost of the other label if positive, of content if negative."""
    words = block.text.count(" ") + 1
    holder, density = block.holder, block.linked / len(block.text)
    z = -1.0 + min(words, 40) / 12
    z += 0.8 * (block.text[-1] in ".!?…:\"'”’»。") - 3.5 * density
    z += 0.9 * (block.tag in ("p", "pre", "blockquote")) + (1.0 + (block.tag == "h1")) * (block.tag in _HEADINGS) - 0.8 * (block.tag == "li")
    z += holder.main - 9.0 * (holder.aside > 0) - 12.0 * holder.hidden - (min(holder.hinted.cost, 9.0) if holder.hinted else 0.0)
    if re.match(r"(?:©|\(c\)|copyright\b|all rights reserved)", block.text, re.I):
        z -= 6.0
    return z


def _distance(a: Element, b: Element) -> int:
    """Steps in the tree between two elements, 8 at most."""
    steps = 0
    while a is not b and steps < 8:
        if a.depth >= b.depth and a.up is not None:
            a = a.up
        else:
            b = b.up
        steps += 1
    return steps


def _zone(block: Block) -> tuple[bool, bool]:
    holder = block.holder
    return holder.aside > 0, bool(holder.hinted and holder.hinted.cost)


def edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness between blocks: adjacency by distance in the tree, and parents that go on after an interruption."""
    out, last = [], {}
    for k, block in enumerate(found):
        parent = id(block.holder.up or block.holder)
        if k:
            before = found[k - 1]
            out.append((k - 1, k, (3.0 if _zone(before) == _zone(block) else 0.4) / (1 + _distance(before.holder, block.holder) / 2)))
        if parent in last and last[parent] < k - 1:
            out.append((last[parent], k, 1.2 if _zone(found[last[parent]]) == _zone(block) else 0.2))
        last[parent] = k
    return out


def minimum_cut(terminal: list[float], joined: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node is on the source side of a minimum cut; ``terminal``: capacity from (+) or to (-) the terminals."""
    n = len(terminal)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, c in joined:
        near[a].append((b, c))
        near[b].append((a, c))
    z, label = list(terminal), [None] * n
    weight = [sum(c for _, c in x) for x in near]
    queue = deque(range(n))
    while queue:  # what its terminal alone decides
        k = queue.popleft()
        if label[k] is None and abs(z[k]) >= weight[k] and (z[k] or not weight[k]):
            label[k] = z[k] > 0
            for other, c in near[k]:
                if label[other] is None:
                    z[other] += c if label[k] else -c
                    weight[other] -= c
                    queue.append(other)
    rest = [k for k in range(n) if label[k] is None]
    if rest:
        number = {k: i for i, k in enumerate(rest)}
        flow = Flow(len(rest) + 2)
        source, sink = len(rest), len(rest) + 1
        for k in rest:
            if z[k] > 0:
                flow.join(source, number[k], z[k], 0.0)
            elif z[k] < 0:
                flow.join(number[k], sink, -z[k], 0.0)
        for a, b, c in joined:
            if a in number and b in number:
                flow.join(number[a], number[b], c, c)
        side = flow.source_side(source, sink)
        for k in rest:
            label[k] = side[number[k]]
    return label


class Flow:
    """Maximum flow by shortest augmenting layers (Dinic)."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def join(self, a: int, b: int, there: float, back: float) -> None:
        for x, y, c in ((a, b, there), (b, a, back)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(c)

    def _layers(self, source: int) -> list[int]:
        layer = [-1] * len(self.out)
        layer[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                if self.room[e] > 1e-9 and layer[self.to[e]] < 0:
                    layer[self.to[e]] = layer[a] + 1
                    queue.append(self.to[e])
        return layer

    def source_side(self, source: int, sink: int) -> list[bool]:
        while (layer := self._layers(source))[sink] >= 0:
            nxt, path, at = [0] * len(self.out), [], source
            while True:
                if at == sink:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    path, at = [], source
                elif nxt[at] < len(self.out[at]):
                    e = self.out[at][nxt[at]]
                    if self.room[e] > 1e-9 and layer[self.to[e]] == layer[at] + 1:
                        path.append(e)
                        at = self.to[e]
                    else:
                        nxt[at] += 1
                elif path:
                    at = self.to[path.pop() ^ 1]
                    nxt[at] += 1
                else:
                    break
        return [x >= 0 for x in layer]


def extract(page: str) -> str:
    found = blocks(page)
    side = minimum_cut([preference(b) for b in found], edges(found))
    return "\n".join(b.text for b, content in zip(found, side, strict=True) if content)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of (page_id, url, html); a narrow map."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [extract(x) if x else "" for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_pydict({"page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    taken = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return taken.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
