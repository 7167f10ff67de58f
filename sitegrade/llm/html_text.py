"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is cut into blocks at block-level tags. A classifier, and what the tags
and class names around a block say, give the cost of calling it boilerplate or
content: the capacities to the two terminals. Adjacent blocks and siblings in
the document tree are joined by smoothness edges, weaker with their distance in
the tree. The minimum cut is the labelling of least total cost.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegrade.llm.common import map_batches

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)"
    r"(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>|[^<>]*>)", re.S)
_CLASSES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

#: Element names by their part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre "
    "section summary table tbody td tfoot th thead tr ul".split())
HIDDEN = frozenset(
    "script style head noscript template iframe object svg select textarea button canvas "
    "audio video annotation annotation-xml".split())
RAW = frozenset("script style textarea title".split())
EMPTY = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
#: Elements an opening tag ends when they are still open.
ENDS = {
    "p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"),
    "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"),
    "option": ("option",),
} | {name: ("p",) for name in BLOCKS - {"p", "li", "dt", "dd", "tr", "td", "th", "option", "html", "body"}}
#: Elements that may stand in a head; any other, or text, ends it.
HEAD_ONLY = frozenset(
    "base basefont bgsound link meta noframes noscript script style template title".split())
#: Elements with the syntax of XML, those inside them that hold HTML again, and
#: the HTML elements that end them when they were left open.
FOREIGN = frozenset(("svg", "math"))
HTML_INSIDE = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li "
    "listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul "
    "var".split())
#: Words of class, id and role names that tell boilerplate or content.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement alert banner breadcrumb breadcrumbs consent cookie cookies "
    "copyright disclaimer footer gdpr header login masthead menu modal nav navbar navigation "
    "newsletter notice pager pagination popup promo promoted promotion recommended related search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar "
    "widget".split())
COMMENT_WORDS = frozenset(
    "comment comments commentlist discussion disqus replies reply respond responses".split())
CONTENT_WORDS = frozenset("article content entry main post story".split())
#: First and last parts of names that tell a state or a topic, not what an element is.
STATE_FIRST = frozenset(
    "category format has hide is no not show status tag type with without".split())
STATE_LAST = frozenset("active closed count disabled enabled hidden off on open visible".split())

OUTSIDE = 5.0  # cost that nav, footer, aside and whole comment names give, to all inside them
TAGS = 3.0  # article, main and header
NAMES = 2.5  # other class, id and role names
FORM = 1.0  # whole pages stand in forms
SHALLOW = 4.5  # the classifier stays within; alone or with the edges it can outweigh all of them
SMOOTH = 1.2
FARTHEST = 64  # steps in the tree; an edge of more would weigh less than 1e-13
#: Elements that end tags of inline elements inside do not reach out of.
WALLS = frozenset("td th article body".split())
#: Weights of the shallow features before any page is seen: long, unlinked,
#: punctuated blocks are content.
PRIOR = np.array([-2.0, 0.8, -3.0, 1.0, 0.5, -0.5, 0.0, 0.0])


@dataclass(eq=False)
class _Open:
    """An open element; links and places, so that no question walks the whole stack."""

    name: str
    number: int
    stance: float
    fixed: bool  # an enclosed element cannot turn it to content again
    hidden: bool
    depth: int = 0  # block-level elements from the outermost one to this one
    block: _Open | None = None  # the innermost block-level element, maybe this one
    outer: _Open | None = None  # the innermost block-level element around this one
    edge: int = -1  # place of the innermost block-level, svg, math or embedded html element
    wall: int = -1  # place of the innermost element that end tags of inline elements stay inside


@dataclass
class Block:
    """A run of text between block-level tags, with its place in the tree."""

    text: str
    within: _Open | None  # the innermost block-level element, linked to those around it
    stance: float  # what the elements around say: above 0 content, below 0 boilerplate
    link_chars: int

    @property
    def tag(self) -> str:
        return self.within.name if self.within else ""


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=list)
    places: dict[str, list[int]] = field(default_factory=dict)  # of the open elements, by name
    text: list[str] = field(default_factory=list)
    links: int = 0
    count: int = 0
    foreigners: bool = False  # an svg or math element was opened

    def push(self, element: _Open) -> None:
        at, name = len(self.stack), element.name
        up = self.stack[-1] if self.stack else None
        element.depth, element.outer = (up.depth, up.block) if up else (0, None)
        element.block = element.outer
        if name in BLOCKS:
            element.depth, element.block = element.depth + 1, element
        element.edge = at if name in BLOCKS or name in FOREIGN or name in HTML_INSIDE else up.edge if up else -1
        element.wall = at if name in WALLS else up.wall if up else -1
        self.places.setdefault(name, []).append(at)
        self.stack.append(element)

    def cut(self, at: int) -> None:
        """End the element of this place and all inside it."""
        for element in self.stack[at:]:
            self.places[element.name].pop()
        del self.stack[at:]

    def end_head(self, name: str) -> None:
        """End an open head before what cannot stand in it; its end tag may be left out."""
        if name == "body":
            if heads := self.places.get("head"):
                self.cut(heads[0])
        elif self.stack and self.stack[-1].name == "head" and name not in HEAD_ONLY:
            self.cut(len(self.stack) - 1)

    def foreign(self) -> int:
        """Place of the open svg or math element whose syntax holds here; -1 for none."""
        at = self.stack[-1].edge if self.stack else -1
        return at if at >= 0 and self.stack[at].name in FOREIGN else -1

    def add(self, text: str) -> None:
        if text and not text.isspace():
            self.end_head("")
        if not text or self.stack and self.stack[-1].hidden:
            return
        text = html.unescape(text)
        self.text.append(text)
        if any(e.name == "a" for e in self.stack[-8:]):
            self.links += len(text.strip())

    def end_block(self) -> None:
        if self.text:
            words = " ".join("".join(self.text).split())
            if words:
                top = self.stack[-1] if self.stack else None
                self.blocks.append(Block(
                    words, top.block if top else None, top.stance if top else 0, self.links))
            self.text, self.links = [], 0

    def open(self, name: str, rest: str) -> bool:
        """Take a start tag; whether the element stays open."""
        self.end_head(name)
        at = self.foreign() if self.foreigners else -1
        if at >= 0 and name in BREAKOUT:
            self.cut(at)
        elif (at >= 0 or name in FOREIGN) and rest.endswith("/>"):
            return False
        if name in BLOCKS:
            self.end_block()
            at = self.stack[-1].edge if self.stack else -1
            while at >= 0:
                other, below = self.stack[at].name, self.stack[at - 1].edge if at else -1
                if other in ENDS.get(name, ()):
                    self.cut(at)
                elif other in BLOCKS or other in HTML_INSIDE:
                    break
                at = below
        elif name == "br":
            self.text.append(" ")
        if name in EMPTY:
            return False
        self.foreigners |= name in FOREIGN
        up = self.stack[-1] if self.stack else _Open("", 0, 0.0, False, False)
        stance, fixed = (up.stance, True) if up.fixed else _stance(name, rest, up.stance)
        self.count += 1
        self.push(_Open(name, self.count, stance, fixed, up.hidden or name in HIDDEN))
        return True

    def close(self, name: str) -> None:
        places = self.places.get(name)
        if not places:
            if name in BLOCKS:
                self.end_block()
            return
        at = places[-1]
        if name not in BLOCKS and self.stack[-1].wall > at:
            return
        if self.stack[-1].depth > (self.stack[at - 1].depth if at else 0):
            self.end_block()
        self.cut(at)


def _named(rest: str) -> tuple[int, int, bool]:
    """Content and boilerplate parts of an element's names, and whether one names comments."""
    content, boilerplate, comments = set(), set(), False
    for found in _CLASSES.findall(rest):
        for token in "".join(found).lower().split():
            parts = [x for x in re.split(r"[^a-z]+", token) if x]
            if len(parts) > 1 and (parts[0] in STATE_FIRST or parts[-1] in STATE_LAST):
                continue
            if not COMMENT_WORDS.isdisjoint(parts):
                comments = True
                continue
            content |= CONTENT_WORDS.intersection(parts)
            boilerplate |= BOILERPLATE_WORDS.intersection(parts)
    return len(content), len(boilerplate), comments


def _stance(name: str, rest: str, up: float) -> tuple[float, bool]:
    """What an element says of its text, and whether that holds for all inside it.

    Content and boilerplate parts of its names are weighed against each other;
    an element that says nothing takes over what those around it say.
    """
    if name in ("nav", "footer", "aside", "dialog", "menu"):
        return -OUTSIDE, True
    good, bad, comments = _named(rest) if "=" in rest and name not in ("html", "body") else (0, 0, False)
    if comments and not good:
        return -OUTSIDE, True
    told = bool(good or bad)
    cost = NAMES * (good - bad) / (good + bad) if told else 0.0
    if comments:
        cost -= OUTSIDE
    if name in ("article", "main"):
        return TAGS + cost, False
    if name == "header" and up <= 0:
        return cost - TAGS, False
    if name in ("form", "fieldset"):
        return cost - FORM, False
    return (cost if told else up), False


def page_blocks(page: str) -> list[Block]:
    """The text blocks of a whole page, in order."""
    state, at = _Page(), 0
    lower = None
    while (tag := _TAG.search(page, at)) is not None:
        state.add(page[at:tag.start()])
        at = tag.end()
        name = tag["name"]
        if name is None:
            continue
        name = name.lower()
        if tag["close"]:
            state.close(name)
            continue
        if state.open(name, tag["rest"]) and name in RAW:
            # raw text reaches to its own end tag, whatever it holds
            lower = page.lower() if lower is None else lower
            end = lower.find(f"</{name}", at)
            at = len(page) if end < 0 else end
    state.add(page[at:])
    state.end_block()
    return state.blocks


def shallow_features(blocks: list[Block]) -> np.ndarray:
    """Features of text and position that hold on any page."""
    n = len(blocks)
    rows = []
    for i, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        marks = sum(map(b.text.count, ".,;!?"))
        rows.append((
            1.0, math.log1p(words), min(1.0, b.link_chars / len(b.text)), min(1.0, marks / words),
            float(b.tag == "p"), float(b.tag == "li"), float(b.tag[:1] == "h" and len(b.tag) == 2),
            abs(2 * i / max(1, n - 1) - 1) if n > 1 else 0.0))
    return np.array(rows)


def smooth_edges(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges of neighbouring blocks and of siblings, weaker with tree distance."""
    edges = []
    last_of: dict[int, int] = {}

    def weight(a: Block, b: Block) -> float:
        x, y, apart = a.within, b.within, 0
        while x is not y and apart < FARTHEST:
            if y is None or x is not None and x.depth >= y.depth:
                x, apart = x.outer, apart + 1
            else:
                y, apart = y.outer, apart + 1
        return 0.0 if x is not y else SMOOTH * 0.6 ** max(0, apart - 2)

    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, weight(blocks[i - 1], b)))
        around = b.within.outer.number if b.within and b.within.outer else 0
        before = last_of.get(around)
        if before is not None and before < i - 1:
            edges.append((before, i, 0.5 * weight(blocks[before], b)))
        last_of[around] = i
    return edges


def minimum_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of least cost: ``gain`` is what label True saves, edges cost when cut.

    A block whose own gain outweighs all its edges keeps its sign in every
    minimum cut; such blocks are settled first and their edges become gains of
    their neighbours. A maximum flow decides the rest.
    """
    n = len(gain)
    gain = list(gain)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * n
    wait = deque(range(n))
    while wait:
        i = wait.popleft()
        if label[i] is None and abs(gain[i]) >= sum(near[i].values()):
            label[i] = gain[i] > 0
            for j, w in near[i].items():
                gain[j] += w if label[i] else -w
                del near[j][i]
                wait.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        for i, side in zip(rest, _max_flow(rest, gain, near), strict=True):
            label[i] = side
    return [bool(x) for x in label]


def _max_flow(rest: list[int], gain: list[float], near: list[dict[int, float]]) -> list[bool]:
    """The source side of a maximum flow over the unsettled blocks (level graphs)."""
    place = {i: k for k, i in enumerate(rest)}
    source, sink = len(rest), len(rest) + 1
    graph: list[list[int]] = [[] for _ in range(len(rest) + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, there: float, back: float) -> None:
        graph[a].append(len(to))
        to.append(b)
        room.append(there)
        graph[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in rest:
        if gain[i] > 0:
            join(source, place[i], gain[i], 0.0)
        else:
            join(place[i], sink, -gain[i], 0.0)
        for j, w in near[i].items():
            if i < j:
                join(place[i], place[j], w, w)
    while True:
        level = [-1] * len(graph)
        level[source] = 0
        wait = deque([source])
        while wait:
            a = wait.popleft()
            for e in graph[a]:
                if room[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    wait.append(to[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(len(rest))]
        tried = [0] * len(graph)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                path, a = [], source
                continue
            while tried[a] < len(graph[a]):
                e = graph[a][tried[a]]
                if room[e] > 1e-12 and level[to[e]] == level[a] + 1:
                    break
                tried[a] += 1
            if tried[a] < len(graph[a]):
                path.append(e)
                a = to[e]
            elif a == source:
                break
            else:
                a = to[path.pop() ^ 1]
                tried[a] += 1


def main_text(page: str, weights: np.ndarray) -> str:
    """The content blocks of a page, one per line."""
    blocks = page_blocks(page)
    if not blocks:
        return ""
    shallow = np.clip(shallow_features(blocks) @ weights, -SHALLOW, SHALLOW)
    gain = [b.stance + float(s) for b, s in zip(blocks, shallow, strict=True)]
    label = minimum_cut(gain, smooth_edges(blocks))
    return "\n".join(b.text for b, good in zip(blocks, label, strict=True) if good)


def train(pages: DataFrame, sample_pages: int = 400, longest: int = 65_536) -> np.ndarray:
    """Weights of the shallow features, from pages whose own tags label their blocks.

    The sample is bounded: ``sample_pages`` pages by the order of a hash, of at
    most ``longest`` characters. Pages without telling tags teach nothing.
    """
    # only ids are ordered; the html of the chosen pages alone reaches the driver
    chosen = (
        pages.where("page_id IS NOT NULL").select("page_id").distinct()
        .orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages))
    rows = (
        pages.where(F.length("html") <= longest).join(F.broadcast(chosen), "page_id", "left_semi")
        .select("page_id", "html").dropDuplicates(["page_id"]).collect())
    rows.sort(key=lambda r: r["page_id"])
    x, y, weight = [], [], []
    for row in rows:
        blocks = page_blocks(row["html"])
        if blocks:
            told = [b.stance for b in blocks]
            features = shallow_features(blocks)
            x += [f for f, s in zip(features, told, strict=True) if s]
            y += [float(s > 0) for s in told if s]
            n = sum(map(bool, told))
            weight += [min(1.0, 20 / n) for _ in range(n)]  # a page of many blocks is one page
    if not x or len(set(y)) < 2:
        return PRIOR
    return fit_logistic(np.array(x), np.array(y), np.array(weight), PRIOR)


def fit_logistic(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: np.ndarray, ridge: float = 100.0
) -> np.ndarray:
    """Logistic weights of weighted rows by Newton steps, drawn to those of ``prior``.

    Tags that pages happen to use in one part only would decide alone without it.
    """
    w = prior.copy()
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (weight * (y - p)) - ridge * (w - prior))
    return w


def extract_pages(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    The whole html is read. A null or empty html, or one without content, gives
    an empty text; repeated rows are extracted each; other columns are ignored.
    """
    weights = train(pages) if weights is None else weights

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            texts = [main_text(h, weights) for h in batch.column("html").to_pylist()]
            return {"page_id": batch.column("page_id"), "url": batch.column("url"),
                    "text": texts, "n_chars": list(map(len, texts))}

        return step

    types = {f.name: f.dataType.simpleString() for f in pages.schema}
    return map_batches(
        pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")), make,
        f"page_id {types['page_id']}, url {types['url']}, text string, n_chars bigint")
