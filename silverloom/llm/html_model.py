"""Main text of web pages by a tree-structured graphical model.

A page's block elements are the nodes; each is main text or not. A node's own evidence is its tag, the tag it stands in, the
words of its class, id and role, and what text it holds; a potential ties each node to its parent. Sum-product messages up and down the tree
give every node's marginal. The weights maximise the likelihood of labelled pages, whose gradient needs the same messages.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.labelled_pages import PAGES

#: Elements that run within a line, that have no end, whose content is never text, that end open ones.
INLINE = frozenset((
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "map", "mark", "math", "nobr", "object", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
    "u", "var", "wbr",
))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
DROPPED = frozenset((
    "head", "script", "style", "noscript", "template", "svg", "iframe", "canvas", "audio", "video", "button", "select", "textarea",
    "datalist", "annotation", "annotation-xml",
))
BLOCKS = frozenset((
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
))
RAW = ("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp")  # no tags inside
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody"), "body": ("head",),
}
SCOPES = frozenset(("table", "ul", "ol", "dl", "article", "section", "div", "main", "aside", "nav", "body"))

_tag = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_attr = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*|=[^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)?))?")
_gap = re.compile(r"[\s/]*")
_raw_end = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in RAW}


def tokens(html: str) -> Iterator[tuple[str, str, list[tuple[str, str]]]]:
    """(text, start or end; text or name of the tag; attributes) of a page, each sign looked at a bounded number of times."""
    at, n = 0, len(html)
    said = 0  # up to here text was passed on
    while True:
        at = html.find("<", at)
        if at < 0 or at == n - 1:
            break
        tag = _tag.match(html, at)
        if tag is None:
            if html[at + 1] not in "!?/":
                at += 1
                continue
            if html.startswith("<!--", at):
                # a comment may end with its first dashes
                end = html.find("-->", at + 2)
                end = end if end < 0 else end + 3
            else:
                end = html.find(">", at) + 1 or -1
            if said < at:
                yield "text", unescape(html[said:at]), []
            said = at = n if end < 0 else end
            continue
        if said < at:
            yield "text", unescape(html[said:at]), []
        name = tag[2].lower()
        at, attrs = tag.end(), []
        while True:
            gap = _gap.match(html, at)
            at = gap.end()
            if at >= n or html[at] == ">":
                break
            attr = _attr.match(html, at)
            value = next((v for v in attr.groups()[1:] if v is not None), "")
            if attr.end() < n and html[attr.end()] in "\"'" and html[attr.end() - 1] in "= \t\n\r\f" and attr[2] is None and attr[3] is None:
                at = n  # a quote that nothing ends
                break
            attrs.append((attr[1].lower(), unescape(value)))
            at = attr.end()
        if at >= n:
            return  # the end of the page within a tag
        at += 1
        said = at
        yield ("end" if tag[1] else "start"), name, attrs
        if not tag[1] and gap[0].endswith("/"):
            yield "end", name, []
        elif not tag[1] and name in _raw_end:
            end = _raw_end[name].search(html, at)
            end = end.start() if end else n
            if at < end:
                yield "text", html[at:end] if name in ("script", "style") else unescape(html[at:end]), []
            said = at = end
    if said < n:
        yield "text", unescape(html[said:]), []


ROUNDS, RATE, RIDGE = 1_000, 0.5, 0.001
_word = re.compile(r"[a-z]+")


class Page:
    """The block elements of a page in order, parents first, and its text blocks with the element each belongs to.

    Any text is a page: what no tag can be is text, an unfinished tag or comment reaches to the end, as in browsers. Time
    grows in proportion to the length, however tags are nested or left open.
    """

    def __init__(self, html: str):
        self.parent, self.names, self.marks = [-1], [("tag=page",)], [None]
        self.letters, self.linked = [0], [0]
        self.blocks: list[tuple[int, str]] = []
        self._open: list[tuple[str, int]] = []  # (tag, node or -1 for what is not a block)
        self._places: dict[str, list[int]] = defaultdict(list)  # where in it each tag stands
        self._blocks: list[int] = []  # where in it blocks stand
        self._at = 0
        self._dropped = self._links = 0
        self._line: list[str] = []
        for kind, value, attrs in tokens(html):
            if kind == "text":
                self.handle_data(value)
            elif kind == "start":
                self.handle_starttag(value, attrs)
            else:
                self.handle_endtag(value)
        self._flush()

    def _flush(self) -> None:
        text = " ".join("".join(self._line).split())
        self._line = []
        if text:
            self.blocks.append((self._at, text))
            self.letters[self._at] += len(text)

    def _push(self, tag: str, node: int = -1) -> None:
        self._places[tag].append(len(self._open))
        if node >= 0:
            self._blocks.append(len(self._open))
        self._open.append((tag, node))

    def handle_starttag(self, tag, attrs):
        if self._dropped and not (tag == "body" and self._places["head"]):
            if tag not in VOID:
                self._push(tag)
                self._dropped += tag in DROPPED
            return
        if self._places["math"] and tag in BLOCKS:
            self._close(self._places["math"][-1])  # formulas hold no blocks
        inline = tag in INLINE or bool(self._places["math"]) and tag not in DROPPED
        if not inline and tag not in DROPPED:
            self._end_implied(tag)
        if tag in VOID:
            if inline:
                self._line.append(" " if tag in ("br", "wbr") else "")
            else:
                self._flush()
            return
        if tag in DROPPED:
            self._push(tag)
            self._dropped += 1
        elif inline:
            self._push(tag)
            self._links += tag == "a"
        else:
            self._flush()
            given = dict(reversed(attrs))  # the first of equal names counts
            words = _word.findall(" ".join(given.get(k, "") for k in ("class", "id", "role")).lower())
            self.parent.append(self._at)
            above = self.names[self._at][0].removeprefix("tag=")
            self.names.append((f"tag={tag}", f"in={above}>{tag}", *sorted({f"word={w}" for w in words})))
            self.marks.append(given.get("data-y"))
            self.letters.append(0)
            self.linked.append(0)
            self._at = len(self.parent) - 1
            self._push(tag, self._at)

    def _last(self, tags) -> int:
        """Where the innermost open one of the tags stands, -1 if none is open."""
        return max((self._places[t][-1] for t in tags if self._places.get(t)), default=-1)

    def _end_implied(self, tag: str) -> None:
        """A block ends an open paragraph; list items, cells and rows end their like within the nearest list or table."""
        ends = ENDS.get(tag, ())
        k = self._last((*ends, "p"))
        while k > self._last(SCOPES.difference(ends)):
            name = self._open[k][0]
            self._close(k)
            if name != "p" or not ends:
                return
            k = self._last((*ends, "p"))

    def handle_endtag(self, tag):
        k = self._last((tag,))
        if k < 0 or tag in INLINE and self._blocks and k < self._blocks[-1]:
            return  # an inline end does not reach over a block
        self._close(k)

    def _close(self, k: int) -> None:
        for name, node in reversed(self._open[k:]):
            self._places[name].pop()
            if node >= 0:
                self._flush()
                self._blocks.pop()
                self._at = self.parent[node]
            elif name in DROPPED:
                self._dropped -= 1
            elif name == "a" and not self._dropped:
                self._links = max(0, self._links - 1)
        del self._open[k:]

    def handle_data(self, data):
        if not self._dropped:
            self._line.append(data)
            if self._links:
                self.linked[self._at] += len(data)

    def features(self, node: int) -> tuple[str, ...]:
        n = self.letters[node]
        if not n:
            return (*self.names[node], "any")
        links = ("links",) if self.linked[node] > n / 2 else ()
        return (*self.names[node], "text", *links, "any")


class TreeModel:
    """Unary weights by feature and the parent-child potential ``pair[parent][child]``, all in logs."""

    def __init__(self, unary: dict[str, float], pair: tuple[tuple[float, float], tuple[float, float]]):
        self.unary, self.pair = unary, pair
        self._known: dict[tuple[str, ...], float] = {}

    def _own(self, features: tuple[str, ...]) -> float:
        if features not in self._known:
            if len(self._known) > 50_000:
                self._known.clear()
            self._known[features] = sum(self.unary.get(f, 0.0) for f in features)
        return self._known[features]

    def messages(self, page: Page) -> tuple[list[float], list[float], list[float]]:
        """For every node, as log-odds: its own evidence with its children's, what it tells its parent, what the parent
        tells it."""
        (p00, p01), (p10, p11) = ((math.exp(x) for x in row) for row in self.pair)
        parent = page.parent
        below = [self._own(page.features(k)) for k in range(len(parent))]
        up, down = [0.0] * len(parent), [0.0] * len(parent)
        for k in range(len(parent) - 1, 0, -1):
            odds = math.exp(max(-30.0, min(30.0, below[k])))
            up[k] = math.log((p11 * odds + p10) / (p01 * odds + p00))
            below[parent[k]] += up[k]
        for k in range(1, len(parent)):
            at = parent[k]
            odds = math.exp(max(-30.0, min(30.0, below[at] + down[at] - up[k])))
            down[k] = math.log((p11 * odds + p01) / (p10 * odds + p00))
        return below, up, down

    def marginals(self, page: Page) -> list[float]:
        below, _, down = self.messages(page)
        return [1 / (1 + math.exp(-max(-30.0, min(30.0, a + b)))) for a, b in zip(below, down)]

    def extract(self, html: str | None, least: float = 0.5) -> str:
        """The blocks whose element is main text with a probability of at least ``least``, one to a line."""
        if not isinstance(html, str) or not html:
            return ""
        page = Page(html)
        sure = self.marginals(page)
        return "\n".join(text for node, text in page.blocks if sure[node] >= least)


def _labels(page: Page) -> list[int]:
    out = [0]
    for k in range(1, len(page.parent)):
        out.append(out[page.parent[k]] if page.marks[k] is None else int(page.marks[k] == "1"))
    return out


def train(pages: tuple[str, ...] = PAGES) -> TreeModel:
    """Weights that maximise the labelled pages' likelihood, with a ridge, by gradient steps from zero. Deterministic."""
    known = [(p, _labels(p)) for p in map(Page, pages)]
    unary: dict[str, float] = defaultdict(float)
    pair = [[0.0, 0.0], [0.0, 0.0]]
    nodes = sum(len(p.parent) for p, _ in known)
    for _ in range(ROUNDS):
        model = TreeModel(unary, (tuple(pair[0]), tuple(pair[1])))
        grad: dict[str, float] = defaultdict(float)
        grad_pair = [[0.0, 0.0], [0.0, 0.0]]
        for page, y in known:
            below, up, down = model.messages(page)
            for k in range(len(y)):
                gap = y[k] - 1 / (1 + math.exp(-max(-30.0, min(30.0, below[k] + down[k]))))
                for f in page.features(k):
                    grad[f] += gap
                if k:
                    at = page.parent[k]
                    odds = (below[at] + down[at] - up[k], below[k])
                    both = [[math.exp(max(-60.0, min(60.0, pair[a][b] + a * odds[0] + b * odds[1]))) for b in (0, 1)] for a in (0, 1)]
                    whole = sum(map(sum, both))
                    grad_pair[y[at]][y[k]] += 1
                    for a in (0, 1):
                        for b in (0, 1):
                            grad_pair[a][b] -= both[a][b] / whole
        for f, g in grad.items():
            unary[f] += RATE * (g / math.sqrt(nodes) - RIDGE * unary[f])
        for a in (0, 1):
            for b in (0, 1):
                pair[a][b] += RATE * (grad_pair[a][b] / math.sqrt(nodes) - RIDGE * pair[a][b])
    return TreeModel(dict(unary), (tuple(pair[0]), tuple(pair[1])))


def extract_text(pages: DataFrame, model: TreeModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every row. Null and empty pages have an empty text; repeated rows stay as they are."""
    shared = pages.sparkSession.sparkContext.broadcast((model.unary, model.pair))

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = TreeModel(*shared.value)
        for batch in batches:
            yield pd.Series([own.extract(h) for h in batch], dtype="object")

    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), extracted(F.col(html_col)).alias("text"))
