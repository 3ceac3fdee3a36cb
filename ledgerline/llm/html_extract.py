"""Operator 5: main text of web pages by minimum-cut labelling.

A page is cut into blocks: text that no block-level tag parts, with the
elements it stands in.  Each block gets the log-odds of being content: a
logistic model over its text (length, punctuation, links, tag, place), trained
here on blocks whose elements say what they are, plus fixed evidence from the
elements around it (article, nav, footer, comment classes ...).  Words of class,
id and role weigh less than tags, and say nothing on html and body, on an
element that holds an article or main, and, in a page without these, on one
that holds most of the text.  The log-odds
are the capacities of the block's edge to the terminal content or boilerplate;
neighbouring blocks and siblings in the DOM are joined by smoothness edges that
weaken with their distance in the tree.  The minimum cut, found by maximum
flow, gives every block its label.  Blocks whose own capacity outweighs all
their smoothness edges keep their label in any minimum cut; they are settled
first, which leaves small graphs.

Elements that never hold page text (script, style, nav, head ...) are dropped,
without cutting a sentence that they stand in, and forms with less than ``FORM_CHARS`` of text to a visible control.  Kept blocks are joined by one line feed in page order; character
references are decoded and white space within a block becomes one space.

Training reads at most about ``TRAIN_PAGES`` pages (chosen by a hash of the
html) and ``TRAIN_BLOCKS`` blocks of each.

Defined results: null or empty html and pages without content give the empty
text; broken markup is read as far as it goes (unclosed elements end with the
page, stray end tags are ignored); pages of any length and nesting are read
whole, in time and memory that grow with their length; a block whose two labels
cost the same is boilerplate; repeated rows give a row each; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

TRAIN_PAGES = 600
TRAIN_BLOCKS = 100

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|[^<]+|<", re.S)
_ATTR = re.compile(r"([\w:-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")

#: Elements by their part in the page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes".split())
#: Dropped elements that may stand within a sentence, and those that end a block.
INLINE = RAW | set("template noscript svg iframe object canvas audio video map select button "
                   "datalist annotation annotation-xml".split())
DROPPED = INLINE | set("head dialog menu nav".split())
BLOCKS = set("address article aside blockquote body center dd details div dl dt fieldset "
             "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main ol "
             "p pre search section summary table caption tbody td tfoot th thead tr ul".split())
#: Start tags that end an open element of the given names.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
          "tfoot": {"tbody", "tr", "td", "th"}}
#: Words of class, id and role that name boilerplate or content.
BAD_WORDS = set("ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs "
                "comment comments complementary consent contentinfo cookie cookies disqus footer "
                "gdpr header masthead menu nav navbar navigation newsletter notice notices paywall "
                "popup promo promos promotion recommended related replies reply respond rss search "
                "share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
                "toc toolbar topbar widget widgets alert disclaimer copyright legal login outbrain "
                "taboola pagination pager discussion reactions feedback ".split())
GOOD_WORDS = set("article articlebody content entry main mainbody post story text body".split())

#: Words of BAD_WORDS that may also be a subject: in a compound they
#: count as its last word or beside words of layout (search-box, not search-theory).
SUBJECTS = set("ad alert banner copyright discussion feedback header legal login notice notices "
               "promotion reactions recommended related reply replies respond search share sharing "
               "skip social sponsor subscription disclaimer".split())
LAYOUT = set("area bar block bottom box button buttons col column container content footer form "
             "frame group icons inner input item items label left link links list main menu nav "
             "outer page panel placement post posts primary right row secondary section sidebar "
             "slot space text title top unit widget wrap wrapper".split())
#: Words that make a name the state of a page (has-sidebar, header-fixed).
STATE_FIRST = set("has with no without hide show".split())
STATE_LAST = set("fixed sticky enabled disabled".split())
CONTROLS = set("input select textarea button".split())

BAD, BAD_CLASS, INSIDE, MILD = -9.0, -5.0, 4.0, 1.5
FORM_CHARS = 200
#: Log-odds without a training row: (bias, log length, sentence marks, link share ...).
DEFAULT_WEIGHTS = (-2.2, 0.35, 1.0, -3.0, 0.8, 0.3, 0.0, -0.5)


class Block:
    __slots__ = ("text", "link", "element", "tag", "hint", "inside")

    def __init__(self, text, link, element):
        self.text, self.link, self.element = text, link, element
        self.tag, self.inside = (element.name, element.inside) if element else ("", False)
        self.hint = 0.0


class Element:
    """An open block-level or dropped element and what it says, in log-odds."""

    __slots__ = ("name", "parent", "number", "depth", "tag", "named", "inside", "holds", "chars",
                 "controls", "state")

    def __init__(self, name, parent, number, attrs):
        self.name, self.parent, self.number = name, parent, number
        self.depth = parent.depth + 1 if parent else 1
        inside = parent is not None and parent.inside
        self.inside = inside or name in ("article", "main")
        self.tag, self.named = _evidence(name, attrs, inside)
        # An article or main stands in it; its text; its visible controls.
        self.holds, self.chars, self.controls = False, 0, 0
        # What it and the elements around it say: see ``_carry``.
        self.state = None


def _comments(word: str) -> bool:
    """commentlist, usercomments ... but not commentary."""
    return (word.startswith("comment") and not word.startswith(("commentar", "commentat"))
            or word.endswith(("comment", "comments")))


def _bad(said: list[str]) -> bool:
    """A name of these words is one of boilerplate."""
    for k, word in enumerate(said):
        if word in BAD_WORDS or _comments(word):
            others = [w for w in said if w != word]
            if (word not in SUBJECTS or k + 1 == len(said)
                    or all(w in LAYOUT or w in BAD_WORDS for w in others)):
                return True
    return False


def _name_evidence(value: str, inside: bool) -> float:
    """What a class, id or role says."""
    good = bad = False
    for name in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().split():
        said = [w for w in re.split(r"[^a-z]+", name) if w]
        if len(said) > 1 and (said[0] in STATE_FIRST or said[-1] in STATE_LAST):
            continue
        words = set(said)
        if _bad(said) and not (inside and words & {"article", "entry", "post"}
                               and words & {"header", "text"}):
            bad = True
        elif words & GOOD_WORDS:
            good = True
    return 0.0 if good and bad else BAD_CLASS if bad else MILD if good else 0.0


def _evidence(name: str, attrs: str, inside: bool) -> tuple[float, float]:
    """What the tag and what class, id and role say about the text in it."""
    if name in ("html", "body"):
        return 0.0, 0.0
    if name in ("footer", "aside", "search", "fieldset", "legend"):
        return BAD, 0.0
    tag = INSIDE if name in ("article", "main") else 0.0
    if name == "header":
        tag = 0.0 if inside else BAD
    named = []
    if attrs and not attrs.isspace():
        for key, value in _ATTR.findall(attrs):
            key = key.lower()
            if key in ("class", "id", "role"):
                named.append(_name_evidence(value.strip("\"'"), inside))
            elif tag != INSIDE and (
                    key == "hidden" or key == "aria-hidden" and "true" in value.lower()
                    or key == "style" and re.search(
                        r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                return BAD, 0.0
    low, high = min(named, default=0.0), max(named, default=0.0)
    return tag, 0.0 if low < 0 < high else low or high


def _carry(e: Element, lost: bool) -> tuple:
    """(muted by a form, a tag speaks against it, the best evidence, the nearest
    bad name, the best name within that), from those of the parent."""
    muted, bad, high, low, better = e.parent.state if e.parent else (False, False, 0.0, 0.0, 0.0)
    if e.named < 0:
        low, better = e.named, 0.0
    else:
        better = max(better, e.named)
    return muted or lost, bad or e.tag < 0, max(high, e.tag, e.named), low, better


def _judge(found: list[Block], elements: list[Element]) -> list[Block]:
    """The blocks outside of forms to fill in, with their hints.  ``elements`` are
    in page order, parents first."""
    told = False
    for e in reversed(elements):            # children before their parents
        told = told or e.holds
        if e.parent:
            e.parent.chars += e.chars
            e.parent.controls += e.controls
            e.parent.holds = e.parent.holds or e.holds
    lost = {e.number for e in elements if e.name == "form" and not e.holds
            and e.chars < FORM_CHARS * e.controls}
    for e in elements:
        e.state = (bool(e.parent and e.parent.state[0]) or e.number in lost,)
    kept = [b for b in found if not (b.element and b.element.state[0])]
    most = sum(len(b.text) for b in kept) / 2
    for e in elements:
        if e.named < 0 and (e.tag == INSIDE or e.holds or not told and e.chars > most):
            e.named = 0.0
        e.state = _carry(e, e.number in lost)
    for b in kept:
        if b.element:
            _, bad, high, low, better = b.element.state
            b.hint = BAD if bad else low + better if low else high
    return kept


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order."""
    out: list[Block] = []
    stack: list[Element] = []               # open block-level or dropped elements
    elements: list[Element] = []
    opened: dict[str, int] = {}             # open elements by name
    dropped: list[int] = []                 # places of dropped elements on the stack
    text: list[str] = []
    link_chars, in_link = 0, 0

    def flush():
        nonlocal link_chars
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                if stack:
                    stack[-1].chars += len(joined)
                out.append(Block(joined, min(1.0, link_chars / len(joined)),
                                 stack[-1] if stack else None))
            text.clear()
        link_chars = 0

    def close(at: int):
        for e in stack[at:]:
            opened[e.name] -= 1
        while dropped and dropped[-1] >= at:
            dropped.pop()
        del stack[at:]

    pos, end = 0, len(page)
    while pos < end:
        m = _TOKEN.match(page, pos)
        pos = m.end()
        name = m["name"]
        if name is None:
            raw = m[0]
            if (raw[0] != "<" or raw == "<") and not dropped:
                text.append(raw)
                if in_link:
                    link_chars += len(raw)
            continue
        name = name.lower()
        if m["end"]:
            if name == "a":
                in_link = 0
            if name in BLOCKS or name in DROPPED:
                if not dropped:
                    flush()
                if opened.get(name):
                    at = len(stack) - 1
                    while stack[at].name != name:
                        at -= 1
                    close(at)
            continue
        attrs = m["attrs"]
        if name in CONTROLS and stack and not re.search(r"type\s*=\s*[\"']?hidden", attrs, re.I):
            stack[-1].controls += 1
        if name == "a":
            in_link = 1
        elif name == "br":
            text.append(" ")
        elif name == "hr" and not dropped:
            flush()
        if name in VOID or (name not in BLOCKS and name not in DROPPED):
            if name == "img" or name == "input":
                text.append(" ")
            continue
        # An element within a sentence that is dropped does not cut it.
        if name not in INLINE and not dropped:
            flush()
        if name in RAW:
            stop = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, pos)
            pos = stop.end() if stop else end
            continue
        if attrs.endswith("/") and name in DROPPED:
            continue
        if name not in INLINE:
            # A block-level start tag ends an open paragraph; items end items.
            if stack and stack[-1].name == "p":
                close(len(stack) - 1)
            ends = CLOSES.get(name)
            while ends and stack and stack[-1].name in ends:
                close(len(stack) - 1)
        if dropped and name in ("article", "main", "body"):
            # Content cannot stand in an element that was never closed.
            close(dropped[0])
            flush()
        new = Element(name, stack[-1] if stack else None, len(elements), attrs)
        elements.append(new)
        new.holds = new.tag == INSIDE and new.named >= 0
        if name in DROPPED:
            dropped.append(len(stack))
        opened[name] = opened.get(name, 0) + 1
        stack.append(new)
    flush()
    return _judge(out, elements)


def block_features(found: list[Block]) -> np.ndarray:
    n = len(found)
    return np.array([
        (1.0, math.log1p(len(b.text)), min(5, len(re.findall(r"[.!?,;:](?:\s|$)", b.text))) / 5,
         b.link, float(b.tag == "p"), float(b.tag[:1] == "h" and b.tag[1:].isdigit()),
         abs(2 * (i + 0.5) / n - 1), float(b.tag in ("li", "td", "th", "")))
        for i, b in enumerate(found)]).reshape(-1, 8)


def _distance(a: Block, b: Block) -> int:
    """Steps between two blocks in the tree of block-level elements.  From block
    to block in page order these are at most two for every element."""
    x, y, steps = a.element, b.element, 0
    while x is not y:
        if y is None or x is not None and x.depth >= y.depth:
            x = x.parent
        else:
            y = y.parent
        steps += 1
    return steps


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours in the page and nearest siblings in the DOM."""
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, 2.0 / (1 + _distance(found[i - 1], b))))
        parent = b.element.parent.number if b.element and b.element.parent else -1
        j = last.get(parent)
        if j is not None and j < i - 1:
            edges.append((j, i, 0.7))
        last[parent] = i
    return edges


def min_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) of least cost: a block against its log-odds pays
    their size, an edge between different labels its weight."""
    n = len(odds)
    odds = list(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    weight = [sum(d.values()) for d in near]
    todo = deque(range(n))
    while todo:             # settle blocks that no neighbours can outweigh
        i = todo.popleft()
        if label[i] is None and abs(odds[i]) >= weight[i]:
            label[i] = odds[i] > 0
            for j, w in near[i].items():
                if label[j] is None:
                    odds[j] += w if label[i] else -w
                    weight[j] -= w
                    del near[j][i]
                    todo.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        content = _reached_from_source(rest, odds, near, label)
        for i in rest:
            label[i] = i in content
    return label


def _reached_from_source(rest, odds, near, label) -> set[int]:
    """The blocks on the source's side of a minimum cut (shortest augmenting
    paths until none is left)."""
    cap: dict = {i: {} for i in rest}
    cap["s"], cap["t"] = {}, {}
    for i in rest:
        for j, w in near[i].items():
            if label[j] is None:
                cap[i][j] = w
        a, b, c = ("s", i, odds[i]) if odds[i] > 0 else (i, "t", -odds[i])
        cap[a][b] = cap[a].get(b, 0.0) + c
        cap[b].setdefault(a, 0.0)
    while True:
        came, queue = {"s": None}, deque(["s"])
        while queue and "t" not in came:
            u = queue.popleft()
            for v, c in cap[u].items():
                if c > 1e-9 and v not in came:
                    came[v] = u
                    queue.append(v)
        if "t" not in came:
            return {v for v in came if v != "s"}
        path, v = [], "t"
        while came[v] is not None:
            path.append((came[v], v))
            v = came[v]
        flow = min(cap[u][v] for u, v in path)
        for u, v in path:
            cap[u][v] -= flow
            cap[v][u] = cap[v].get(u, 0.0) + flow


def main_text(page: str | None, weights) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    odds = block_features(found) @ weights + np.array([b.hint for b in found])
    label = min_cut(odds.tolist(), smoothness(found))
    return "\n".join(b.text for b, keep in zip(found, label) if keep)


def fit(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> np.ndarray:
    """Weights of the text model, from blocks whose elements name their part:
    within article or main content, within footer, aside and the like not."""
    bounded_batches(pages.sparkSession)
    total = pages.count()
    draw = F.expr("shiftrightunsigned(xxhash64(43, html), 11)") / F.lit(float(2**53))

    @F.pandas_udf("array<binary>")
    def rows(htmls: pd.Series) -> pd.Series:
        out = []
        for page in htmls:
            found = blocks(page)
            x = block_features(found).astype("<f4")
            known = [i for i, b in enumerate(found) if b.hint <= BAD_CLASS or b.hint >= INSIDE]
            step = max(1, -(-len(known) // TRAIN_BLOCKS))
            out.append([np.r_[x[i], np.float32(found[i].hint > 0)].tobytes()
                        for i in known[::step]])
        return pd.Series(out)

    share = min(1.0, train_pages / total) if total else 0.0
    drawn = pages.where(F.col("html").isNotNull() & (draw < share)).select(rows("html").alias("r"))
    data = [np.frombuffer(r, "<f4") for row in drawn.collect() for r in row.r]
    weights = np.array(DEFAULT_WEIGHTS)
    if not data:
        return weights
    xy = np.unique(np.array(data, float), axis=0)
    x, y = xy[:, :-1], xy[:, -1]
    if y.min() == y.max():
        return weights
    cost = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y == 0).sum())
    start = weights.copy()
    for _ in range(400):                    # logistic loss, pulled to the start
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        weights = weights - 0.3 * ((cost * (p - y)) @ x + 0.02 * (weights - start))
    return weights


def extract(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    bounded_batches(pages.sparkSession)
    learned = fit(pages) if weights is None else weights

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield pd.Series([main_text(h, learned) for h in htmls], dtype=object)

    return (pages.select("page_id", "url", text(F.coalesce("html", F.lit(""))).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
