"""Main text of web pages: a minimum cut between content and boilerplate.

A page becomes a row of text blocks.  A linear classifier gives every block a score, from the
elements around it and the shape of its text: the cost of calling it boilerplate if positive, of
calling it content if negative.  Blocks next to each other, and blocks of one parent, are joined by
edges that cost something where their labels differ, the more so the nearer they are in the tree.
Scores are the capacities to source and sink, edges those between blocks; the maximum flow's cut is
the cheapest labelling.

A block whose score outweighs all its edges keeps its side in every minimum cut, so it is taken out
first and its edges become scores of its neighbours.  Only what is left needs a flow.
"""

from __future__ import annotations

import html
import re
from collections import deque
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 1000  # capacities are whole numbers of this part of a score


@dataclass(frozen=True)
class Costs:
    """Weights of the classifier and of the edges."""

    boilerplate: float = -12.0  # an element, role or name that marks boilerplate
    main: float = 6.0  # an element or role that marks the main part
    name: float = 2.0  # a class or id that hints at the main part
    base: float = -1.5
    per_word: float = 0.1
    most_words: int = 40
    sentence: float = 1.0  # the block ends like a sentence
    links: float = -6.0  # times the share of linked characters
    rights: float = -6.0  # a short block with a copyright sign
    of_element: dict[str, float] = field(
        default_factory=lambda: {"p": 1.5, "blockquote": 1.5, "pre": 1.5, "li": -0.5, "td": -0.5, "th": -0.5}
        | {"h1": 1.5}
        | {f"h{i}": 1.0 for i in range(2, 7)}
    )
    neighbours: float = 2.0  # divided by the distance in the tree
    siblings: float = 0.5


#: Fixed values of HTML: elements whose content is not text of the page, elements without content,
#: and elements that do not interrupt a line.
RAW = ("script", "style", "title", "textarea", "xmp")
HIDDEN = ("noscript", "template", "svg", "math", "iframe", "object", "select", "button", "canvas", "audio", "video", "datalist")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var".split()
)
#: Elements that end an open paragraph, and elements that end an open one of their own kind.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
CLOSES_OWN = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "body": ("head",),
}
SCOPES = frozenset("ul ol dl table body html article main section".split())
#: Names of boilerplate: elements, roles, and words of classes and ids.
BOILER_ELEMENTS = frozenset("nav footer aside dialog menu head".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
BOILER_NAMES = frozenset(
    "ad ads advert adverts advertisement adsense adsbygoogle sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead topbar footer share sharing social "
    "related recommended recommendations comment comments disqus reply replies respond subscribe newsletter signup login "
    "search widget pagination pager copyright disclaimer toolbar hidden".split()
)
COMMENT_NAMES = frozenset({"comment", "comments", "reply", "replies"})
HEADER_NAMES = frozenset({"header", "banner"})
MAIN_NAMES = frozenset("article content main post entry story text body".split())
LAYOUT = frozenset({"with", "has", "no", "without"})  # "with-sidebar" is a wrapper, not a sidebar

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>"
    r"|<[!?][^>]*>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_NAME_WORD = re.compile(r"[a-z]+")
_SENTENCE = re.compile(r"[.!?…。！？][\"'”’»)\]]*\Z")
_RIGHTS = re.compile(r"©|\(c\)|copyright|all rights reserved", re.I)


@dataclass
class Element:
    tag: str
    parent: int
    depth: int
    score: float
    form: float  # the part of the score that a form around everything gives
    in_main: bool


@dataclass
class Block:
    element: int
    text: str
    linked: int


class Page:
    """The text blocks of a page in order, and the elements around them."""

    def __init__(self, source: str, costs: Costs) -> None:
        self.costs = costs
        self.elements = [Element("", 0, 0, 0.0, 0.0, False)]
        self.stack, self.open = [0], {}
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked, self.in_link = 0, False
        self._read(source)

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            token = _TOKEN.search(source, at)
            if token is None:
                self._text(source[at:])
                break
            if token.start() > at:
                self._text(source[at : token.start()])
            at = token.end()
            name = (token["name"] or token["name2"] or "").lower()
            if not name:
                continue
            if token["end"] or token["end2"]:
                self._close(name)
            elif name in RAW or name in HIDDEN:
                closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                if closing:
                    at = closing.end()
                elif name in RAW:
                    at = end
            else:
                self._open(name, token["rest"] or token["rest2"] or "")
        self._flush()

    def _text(self, text: str) -> None:
        if "&" in text:
            text = html.unescape(text)
        self.parts.append(text)
        if self.in_link:
            self.linked += len(text.strip())

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(self.stack[-1], text, self.linked))
            self.parts = []
        self.linked = 0

    def _pop(self) -> None:
        tag = self.elements[self.stack.pop()].tag
        self.open[tag] -= 1

    def _close(self, name: str) -> None:
        if name == "a":
            self.in_link = False
        if name in INLINE or name in VOID or not self.open.get(name):
            if name == "br":
                self.parts.append("\n")
            elif name == "p":  # an end without a beginning is an empty paragraph
                self._flush()
            return
        self._flush()
        self.in_link = False
        while self.elements[self.stack[-1]].tag != name:
            self._pop()
        self._pop()

    def _end_implied(self, tags: tuple[str, ...]) -> None:
        """End the open elements up to the outermost of ``tags`` within the present list or table."""
        found = None
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.elements[self.stack[k]].tag
            if tag in tags:
                found = k
            elif tag in SCOPES:
                break
        if found is not None:
            while len(self.stack) > found:
                self._pop()

    def _open(self, name: str, rest: str) -> None:
        if name == "br":
            self.parts.append("\n")
            return
        if name in INLINE:
            if name == "a":
                self.in_link = True
            return
        if name in VOID:
            if name == "hr":
                self._flush()
            return
        self._flush()
        if name in CLOSES_P and self.open.get("p"):
            self._end_implied(("p",))
        if name in CLOSES_OWN and any(self.open.get(t) for t in CLOSES_OWN[name]):
            self._end_implied(CLOSES_OWN[name])
        self.elements.append(self._element(name, rest))
        self.stack.append(len(self.elements) - 1)
        self.open[name] = self.open.get(name, 0) + 1

    def _element(self, name: str, rest: str) -> Element:
        costs, parent = self.costs, self.stack[-1]
        above = self.elements[parent]
        score, form, in_main = above.score, above.form, above.in_main
        attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)} if rest else {}
        role = attributes.get("role", "").lower()
        if name in ("article", "main") or role in ("main", "article"):
            score, form, in_main = score + costs.main - form, 0.0, True
        elif name == "form":
            score, form = score + costs.boilerplate, form + costs.boilerplate
        elif name in BOILER_ELEMENTS or role in BOILER_ROLES or (name == "header" and not in_main):
            score += costs.boilerplate
        if name not in ("html", "body"):
            words = []
            for key in ("class", "id"):
                if attributes.get(key):
                    words += _NAME_WORD.findall(_CAMEL.sub(" ", attributes[key]).lower())
            named = {w for before, w in zip(["", *words], words) if before not in LAYOUT}
            if name in ("article", "main"):  # their classes tell topics as often as roles
                named &= COMMENT_NAMES
            if named & BOILER_NAMES or (named & HEADER_NAMES and not in_main):
                score += costs.boilerplate
            elif named & MAIN_NAMES and not in_main:
                score += costs.name
        style = attributes.get("style", "").replace(" ", "").lower()
        if "display:none" in style or attributes.get("aria-hidden") == "true":
            score += costs.boilerplate
        return Element(name, parent, above.depth + 1, score, form, in_main)

    def score(self, block: Block) -> float:
        costs, element, text = self.costs, self.elements[block.element], block.text
        words = text.count(" ") + 1
        score = element.score + costs.base + costs.per_word * min(words, costs.most_words)
        score += costs.of_element.get(element.tag, 0.0) + costs.links * min(1.0, block.linked / len(text))
        if _SENTENCE.search(text, max(0, len(text) - 8)):
            score += costs.sentence
        if words < costs.most_words and _RIGHTS.search(text):
            score += costs.rights
        return score

    def distance(self, a: int, b: int, most: int = 8) -> int:
        """Steps between two elements of the tree, ``most`` at most."""
        steps = 0
        while a != b and steps < most:
            if self.elements[a].depth >= self.elements[b].depth:
                a = self.elements[a].parent
            else:
                b = self.elements[b].parent
            steps += 1
        return steps

    def graph(self) -> tuple[list[int], list[tuple[int, int, int]]]:
        """Scores of the blocks and weighted edges, in whole units."""
        scores = [round(UNIT * self.score(b)) for b in self.blocks]
        edges, last = [], {}
        for i, block in enumerate(self.blocks):
            if i:
                steps = max(2, self.distance(self.blocks[i - 1].element, block.element))
                edges.append((i - 1, i, round(UNIT * self.costs.neighbours / steps)))
            parent = self.elements[block.element].parent
            if parent in last:
                edges.append((last[parent], i, round(UNIT * self.costs.siblings)))
            last[parent] = i
        return scores, edges


class Flow:
    """Maximum flow by blocking flows in levels; paths are followed without recursion."""

    def __init__(self, n: int) -> None:
        self.edges: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []

    def add(self, a: int, b: int, there: int, back: int) -> None:
        self.edges[a].append(len(self.to))
        self.edges[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [there, back]

    def levels(self, source: int) -> list[int]:
        level = [-1] * len(self.edges)
        level[source], queue = 0, deque([source])
        while queue:
            v = queue.popleft()
            for e in self.edges[v]:
                w = self.to[e]
                if self.room[e] and level[w] < 0:
                    level[w] = level[v] + 1
                    queue.append(w)
        return level

    def run(self, source: int, sink: int) -> list[bool]:
        """Whether each node is on the source's side of the cut with the fewest such nodes."""
        while True:
            level = self.levels(source)
            if level[sink] < 0:
                return [x >= 0 for x in level]
            at, path, v = [0] * len(self.edges), [], source
            while True:
                if v == sink:
                    most = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= most
                        self.room[e ^ 1] += most
                    first = next(k for k, e in enumerate(path) if not self.room[e])
                    v = self.to[path[first] ^ 1]
                    del path[first:]
                    continue
                while at[v] < len(self.edges[v]):
                    e = self.edges[v][at[v]]
                    if self.room[e] and level[self.to[e]] == level[v] + 1:
                        break
                    at[v] += 1
                else:
                    if not path:
                        break
                    v = self.to[path.pop() ^ 1]
                    at[v] += 1
                    continue
                path.append(e)
                v = self.to[e]


def minimum_cut(scores: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The labelling of least cost; of several the one with the fewest blocks of content.

    The cost is the sum of ``|score|`` of the blocks whose label has the other sign, and of the weights of
    edges between different labels.
    """
    n, scores = len(scores), list(scores)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b and w:
            near[a][b] = near[a].get(b, 0) + w
            near[b][a] = near[b].get(a, 0) + w
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is not None or not (scores[i] > (weight := sum(near[i].values())) or -scores[i] >= weight):
            continue
        label[i] = scores[i] > 0
        for j, w in near[i].items():
            scores[j] += w if label[i] else -w
            del near[j][i]
            queue.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        number = {i: k for k, i in enumerate(rest)}
        flow = Flow(len(rest) + 2)
        source, sink = len(rest), len(rest) + 1
        for i in rest:
            if scores[i] > 0:
                flow.add(source, number[i], scores[i], 0)
            elif scores[i] < 0:
                flow.add(number[i], sink, -scores[i], 0)
            for j, w in near[i].items():
                if i < j:
                    flow.add(number[i], number[j], w, w)
        side = flow.run(source, sink)
        for i in rest:
            label[i] = side[number[i]]
    return [bool(x) for x in label]


def main_text(source: str | None, costs: Costs = Costs()) -> str:
    """The blocks labelled as content, in page order, joined by one space."""
    if not source:
        return ""
    page = Page(source, costs)
    kept = minimum_cut(*page.graph())
    return " ".join(b.text for b, keep in zip(page.blocks, kept) if keep)


def _extractor(costs: Costs):
    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 500):
                some = batch.slice(at, 500)
                raw = some.column("html").cast(pa.binary()).to_pylist()
                texts = [main_text((h or b"").decode("utf-8", "replace"), costs) for h in raw]
                yield pa.RecordBatch.from_arrays(
                    [some.column("page_id"), some.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
                )

    return run


def extract(pages: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    Character references are decoded after the markup is read; white space within a block, line
    breaks included, becomes one space; comments, scripts, styles, titles and other hidden elements
    are no text.  NULL and empty html, and pages of boilerplate alone, give empty text; NULL ids and
    urls stay; repeated rows give repeated rows; an empty table gives none; other columns are left
    out.  Pages of any length are taken whole.  Where two labellings cost the same, the one with less content is taken.
    """
    columns = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    found = columns.mapInArrow(_extractor(costs), "page_id long, url string, text string")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
