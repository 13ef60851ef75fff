"""HTML extraction: the article's text, separated from boilerplate by a minimum cut.

A page is cut into blocks: runs of text between the tags of block elements. Scripts, styles, form fields and embedded media hold no blocks; what a formula
says, what stands in for an embedded object and the words on a button are text. A small classifier gives each block a cost of being called boilerplate and one of being called content, from its elements,
their class, id and role, its length and the share of its links. The costs are the capacities from the source and to the sink;
neighbours are joined by smoothness edges, stronger the closer they stand in the document tree, and so are consecutive blocks of one parent.
The minimum cut, found by maximum flow, is the labelling of least cost; the blocks on the source's side are the main text.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined by a line feed.

Defined results: a null page is an empty one; a page without content has the empty text; a page that ends inside a tag loses that tag only, and one that ends inside an
element is read as if the element ended there; pages are read whole and one by one, so repeated rows repeat and an empty
table stays empty; only the named columns are read.
"""

from __future__ import annotations

import html
import re
from collections import deque
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from siftwright.llm.common import map_batches, texts_of

# Elements of HTML by kind.
_RAW = "script style noscript template textarea title iframe"  # up to their end tag, whatever stands between
_SILENT = set("svg select datalist audio video canvas".split())  # what is inside isn't text of the page
_ENDED_BY_BLOCKS = set("svg select datalist".split())  # those that no block can stand in
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = set("hr br img input meta link area base col embed source track wbr".split())
_CLOSED_BY = {  # an open element that a new one of these ends
    "p": _BLOCKS - {"p"} | {"p"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
}
_BOUNDS = set("article aside body div footer form header main nav section table ul ol dl td".split())

# Words in class, id and role that tell what an element holds.
_BAD_NAMES = set(
    "ad ads adv advert advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar aside footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search "
    "comment comments commentlist reply replies respond disqus discussion social share sharing related recommended widget toolbar pagination pager "
    "copyright skip hidden toc complementary contentinfo dialog form masthead topbar".split()
)
_GOOD_NAMES = set("article content main post entry story body text".split())
# Of the words above, those that tell wherever they stand in a name, and those that are words of articles too: inside one they are a hint only.
_STRONG_NAMES = set("comment comments commentlist disqus cookie cookies consent gdpr newsletter advert advertisement advertising adsense sponsored navbar breadcrumb breadcrumbs sidebar popup".split())
_WEAK_NAMES = set("discussion related social".split())
_PARTS = re.compile(r"[^\s_-]+")
_BAD_TAGS = {"nav": 9, "footer": 9, "aside": 9, "form": 9, "menu": 9, "dialog": 9, "label": 4, "legend": 4, "fieldset": 6, "head": 9, "search": 9}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(_RAW.split())})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>"
    r"|<[!?][^>]*(?:>|\Z)|<[a-zA-Z/][^<>]*\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Costs:
    """Of the classifier and of the edges, in hundredths."""

    in_main: int = 300
    good_name: int = 150
    bad_name: int = 800
    bad_hint: int = 250
    hidden: int = 1200
    heading: int = 100
    paragraph: int = 100
    list_item: int = -50
    links: int = 500  # times the share of the text that links hold
    words: int = 12  # for each word, up to 25
    none: int = -100
    neighbours: int = 40
    same_parent: int = 120


@dataclass
class _Element:
    tag: str
    parent: "_Element | None" = None
    good: int = 0  # evidence for content that holds for all inside
    bad: int = 0
    main: bool = False
    bound: "_Element | None" = None


@dataclass
class Block:
    text: str
    element: _Element
    linked: int = 0
    label: bool = field(default=False, compare=False)


def _names(attributes: str) -> tuple[set[str], set[str], bool]:
    """What names the element as a whole (a class, id or role that is one word, or its last word: ``site-nav``), other words of its names, and whether it is hidden."""
    whole: set[str] = set()
    words: set[str] = set()
    hidden = False
    for m in _ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind in ("class", "id", "role"):
            for name in value.split():
                found = [n.lower() for part in _PARTS.findall(name) for n in (part, *_NAME.findall(part)) if n.isascii()]
                last = (_PARTS.findall(name) or [""])[-1]
                whole.update((name.lower(), last.lower(), *(n.lower() for n in _NAME.findall(last)[-1:])))
                words.update(found)
        elif kind == "hidden" or kind == "aria-hidden" and value.lower() == "true" or kind == "style" and re.search(r"display\s*:\s*none", value, re.I):
            hidden = True
    return whole, words - whole, hidden


def _open(tag: str, attributes: str, parent: _Element, costs: Costs) -> _Element:
    e = _Element(tag, parent, parent.good, parent.bad, parent.main, parent.bound)
    if tag in ("article", "main"):
        e.main = True
        e.good = max(e.good, costs.in_main)
    elif tag == "header":
        if not e.main:
            e.bad = max(e.bad, 900)
    else:
        e.bad = max(e.bad, 100 * _BAD_TAGS.get(tag, 0))
    if attributes and tag not in ("html", "body", "main"):
        whole, words, hidden = _names(attributes)
        bad = (whole & _BAD_NAMES) - (_WEAK_NAMES if e.main else set()) | words & _STRONG_NAMES | (whole | words if not e.main else set()) & _BAD_NAMES
        if hidden:
            e.bad = max(e.bad, costs.hidden)
        elif tag != "article" and bad or not e.main and "header" in whole | words:
            e.bad = max(e.bad, costs.bad_name)
        elif tag != "article" and (whole | words) & _BAD_NAMES:  # a hint that words can outvote
            e.bad = max(e.bad, costs.bad_hint)
        elif (whole | words) & _GOOD_NAMES:
            e.good = max(e.good, costs.good_name)
    if tag in _BOUNDS:
        e.bound = e
    return e


def blocks(page: str | None, costs: Costs = Costs()) -> list[Block]:
    page = page or ""
    here = root = _Element("")
    root.bound = root
    out: list[Block] = []
    run: list[str] = []
    linked = pressed = 0  # characters of the run that links hold, and those on buttons
    in_link = in_button = in_option = False
    silent: list[str] = []  # open elements whose inside isn't text

    last_end: dict[str, int] = {}

    def ends(tag: str) -> int:
        """Where the last end tag of this kind stands, or -1."""
        if tag not in last_end:
            last_end[tag] = max((x.start() for x in re.finditer(rf"</{tag}\b", page, re.I)), default=-1)
        return last_end[tag]

    def end() -> None:
        nonlocal linked, pressed
        if run:
            text = "".join(run)
            run.clear()
            if pressed and len(text.strip()) <= pressed:  # nothing but buttons
                text = ""
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text:
                out.append(Block(text, here, linked))
        linked = pressed = 0

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            if not silent and not in_option:
                run.append(piece)
                if in_link:
                    linked += len(piece)
                if in_button:
                    pressed += len(piece)
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        in_option = tag in ("option", "optgroup") and not m[2]  # ends with the next tag of any kind
        if tag in _SILENT:
            if m[2]:
                if tag in silent:
                    del silent[silent.index(tag) :]
            elif not m[4].rstrip().endswith("/") and ends(tag) > at:  # one without an end holds nothing
                silent.append(tag)
            run.append(" ")
            continue
        if silent and tag in _BLOCKS:
            silent = [t for t in silent if t not in _ENDED_BY_BLOCKS]
        if silent:
            continue
        if tag not in _BLOCKS:
            if tag == "a":
                in_link = not m[2]
            elif tag == "button":
                in_button = not m[2]
            elif tag == "br":
                run.append(" ")
            continue
        end()
        in_link = in_button = False
        if m[2]:
            e = here
            while e is not root and e.tag != tag:
                e = e.parent
            if e is not root:
                here = e.parent
            continue
        while tag in _CLOSED_BY.get(here.tag, ()):
            here = here.parent
        if tag not in _VOID:
            here = _open(tag, m[4], here, costs)
    if at < len(page) and not silent and not in_option:
        run.append(page[at:])
    end()
    return out


def _evidence(b: Block, costs: Costs) -> int:
    """For content if positive, against it if negative."""
    e = b.element
    n = len(b.text)
    x = costs.none + e.good - e.bad + costs.words * min(25, b.text.count(" ") + 1) - costs.links * min(n, b.linked) // max(1, n)
    if e.tag in ("p", "blockquote", "pre"):
        x += costs.paragraph
    elif e.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        x += costs.heading
    elif e.tag == "li":
        x += costs.list_item
    return x


def source_side(evidence: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes a minimum cut leaves with the source. Positive evidence is capacity from the source, negative to the sink, edges go both
    ways. Shortest augmenting paths, level by level."""
    n = len(evidence)
    to: list[int] = []
    left: list[int] = []
    at: list[list[int]] = [[] for _ in range(n)]
    for a, b, w in edges:
        at[a].append(len(to))
        at[b].append(len(to) + 1)
        to += [b, a]
        left += [w, w]
    rest = evidence[:]  # what a node can still give to its neighbours, or take
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if rest[i] > 0)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            for e in at[i]:
                j = to[e]
                if left[e] and level[j] < 0:
                    level[j] = level[i] + 1
                    reached = reached or rest[j] < 0
                    queue.append(j)
        if not reached:
            return [x >= 0 for x in level]
        spot = [0] * n
        for start in range(n):
            while rest[start] > 0:
                path: list[int] = []
                i = start
                while rest[i] >= 0 or not path:
                    while spot[i] < len(at[i]):
                        e = at[i][spot[i]]
                        if left[e] and level[to[e]] == level[i] + 1:
                            break
                        spot[i] += 1
                    else:
                        if not path:
                            i = -1
                            break
                        e = path.pop()
                        i = to[e ^ 1]
                        spot[i] += 1
                        continue
                    path.append(e)
                    i = to[e]
                if i < 0:
                    break
                flow = min(rest[start], -rest[i], min(left[e] for e in path))
                rest[start] -= flow
                rest[i] += flow
                for e in path:
                    left[e] -= flow
                    left[e ^ 1] += flow


def label(found: list[Block], costs: Costs = Costs()) -> list[Block]:
    """The blocks with their labels: True for content."""
    edges: list[tuple[int, int, int]] = []
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        group = id(b.element.parent)
        if i:
            w = costs.neighbours
            if b.element.bound is not found[i - 1].element.bound:
                w //= 4
            edges.append((i - 1, i, w))
        if group in last:
            edges.append((last[group], i, costs.same_parent))
        last[group] = i
    if found:
        for b, side in zip(found, source_side([_evidence(b, costs) for b in found], edges)):
            b.label = side
    return found


def main_text(page: str | None, costs: Costs = Costs()) -> str:
    return "\n".join(b.text for b in label(blocks(page, costs), costs) if b.label)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", costs: Costs = Costs()) -> DataFrame:
    """``id_col, url_col, text, n_chars`` of each page."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p, costs) for p in texts_of(batch, "html")]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(df[id_col].alias("id"), df[url_col].alias("url"), df[html_col].alias("html"))
    return map_batches(rows, f, f"id {kind}, url string, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})
