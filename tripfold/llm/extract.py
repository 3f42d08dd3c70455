"""Main text of HTML pages by line-block distribution (operator 7).

Markup is stripped to lines: every block element starts a new one, and each
line knows its text and how much of it stands in links. Elements that never
hold article text (scripts, styles, navigation, headers, footers, sidebars,
forms, adverts, notices, comments; by tag, role, or a word of their class or
id) are stripped with the markup. Lengths of text outside links are summed
over windows of ``WINDOW`` lines. A window sum above ``SURGE`` is a surge; the
block runs until the sums dive to ``DIVE``. A block reaches back over the short
lines that touch it, so a headline or a byline is not lost.

Blocks may stand anywhere, so the article's place is found from them: the
innermost box (``div``, ``section`` and the like) that holds ``MAIN`` of their
text. Lines outside it go, surge and dive are looked for once more among its own
lines, and all of its blocks are joined in page order.

Where the page marks its article (an ``article`` or ``main`` element, or role
``main``), that is the box, and the first and last block reach to its ends.

Defined cases: null or empty html has an empty text. A page without any surge
(all lines short) gives its longest block of lines, if it marks an article,
else nothing. Unclosed elements end with their parent or the page; unknown
tags are inline. Character references are decoded after the markup is cut, so
``&lt;p&gt;`` stays text. Repeated rows are extracted one by one; other columns
are carried in ``doc``. Pages are handled one at a time, in time linear in
their length.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfold.llm.shared import named, prepare

#: Lines in a window; characters of a window that start a block and end it; share of the blocks' text that the article's box holds.
WINDOW = 3
SURGE = 80
DIVE = 0
MAIN = 0.75

# Element names of HTML.
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold a part of the page.
BOXES = frozenset("body div section article main center td".split())
#: Their content is not markup.
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes".split())
DROPPED = frozenset("head script style noscript template iframe svg math object canvas audio video nav header footer aside form button select textarea input label menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of class or id names of blocks that are not article text.
NAMES = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs header masthead footer foot sidebar aside rail widget related recommended share sharing social follow subscribe subscription newsletter signup login cookie cookies consent gdpr notice notices notification alert popup modal overlay comment comments commentlist respond disqus reply replies pager pagination toolbar tags copyright legal disclaimer skip hidden".split())
#: A class with one of these says how a page is laid out (``has-sidebar``), not what a block is.
LAYOUT = frozenset("has with without no".split())
#: A paragraph closes an open one; so do list items and table cells.
CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
CLOSES_P = BLOCKS - {"br", "body", "html", "title", "option", "caption", "tbody", "thead", "tfoot", "td", "th", "tr", "li", "dd", "dt"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_LETTERS = re.compile("[A-Za-z]+")
_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


class Line(NamedTuple):
    text: str
    linked: int
    article: bool
    box: int


def dropped(tag: str, attributes: str, article: bool = False) -> bool:
    """Whether an element never holds article text. The header of an article (not of the page) does."""
    if tag in DROPPED and not (article and tag == "header"):
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name in ("class", "id"):
            for word in value.split():
                named = {w.lower() for w in _PART.findall(word) + _LETTERS.findall(word)}
                if named & NAMES and not named & LAYOUT:
                    return True
    return False


def lines(page: str) -> tuple[list[Line], list[int]]:
    """The page's lines of text outside dropped elements, and for each box the one around it (box 0, the page, is in itself)."""
    out: list[Line] = []
    around, inner = [0], [0]
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, drops its content, is the article
    opened: Counter[str] = Counter()
    drops = articles = links = linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                out.append(Line(text, linked, articles > 0, inner[-1]))
            parts.clear()
        linked = 0

    def text(piece: str) -> None:
        nonlocal linked
        if piece and not drops:
            parts.append(piece)
            if links:
                linked += len(piece)

    def pop() -> None:
        nonlocal drops, articles, links
        tag, drop, article = stack.pop()
        opened[tag] -= 1
        drops -= drop
        links -= tag == "a"
        if article or tag in BOXES:
            flush()
        if tag in BOXES:
            inner.pop()
        articles -= article

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                text(html.escape(m[0][9:-3]))
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            flush()
        if m[1]:
            if opened[tag]:
                while stack:
                    last = stack[-1][0]
                    pop()
                    if last == tag:
                        break
            continue
        if tag in CLOSES:
            while stack and stack[-1][0] in CLOSES[tag]:
                pop()
        elif tag in CLOSES_P and stack and stack[-1][0] in ("p", "b", "i", "em", "strong", "span", "u", "a"):
            while stack and stack[-1][0] in ("p", "b", "i", "em", "strong", "span", "u", "a"):
                pop()
        if tag in VOID or m[3].rstrip().endswith("/"):
            continue
        drop = dropped(tag, m[3], articles > 0)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}[^>]*(?:>|\Z)", re.I).search(page, at)
            if not drop:
                text(html.escape(page[at : close.start() if close else n]))
                flush()
            at = close.end() if close else n
            continue
        article = not drop and not drops and (tag in ("article", "main") or 'role="main"' in m[3].lower())
        stack.append((tag, drop, article))
        if tag in BOXES:
            around.append(inner[-1])
            inner.append(len(around) - 1)
        opened[tag] += 1
        drops += drop
        articles += article
        links += tag == "a"
    flush()
    return out, around


def blocks(weights: list[int], window: int = WINDOW, surge: int = SURGE, dive: int = DIVE) -> list[tuple[int, int]]:
    """(first, stop) of the runs of lines between a surge and a dive of the sums over ``window`` lines from each line on."""
    n = len(weights)
    total = [0]
    for w in weights:
        total.append(total[-1] + w)
    sums = [total[min(n, i + window)] - total[i] for i in range(n)]
    out, first = [], None
    for i in range(n):
        if first is None:
            if sums[i] > surge and weights[i] > 0:
                first = i
        elif sums[i] <= dive:
            out.append((first, i))
            first = None
    if first is not None:
        out.append((first, n))
    return out


def reached(weights: list[int], surge: int = SURGE, dive: int = DIVE) -> list[tuple[int, int]]:
    """``blocks``, each reaching back over the lines with text that touch it."""
    out, before = [], 0
    for first, stop in blocks(weights, WINDOW, surge, dive):
        while first > before and weights[first - 1]:
            first -= 1
        out.append((first, stop))
        before = stop
    return out


def article_box(found: list[Line], weights: list[int], runs: list[tuple[int, int]], around: list[int]) -> list[bool]:
    """For each box, whether it is the innermost one that holds ``MAIN`` of the blocks' text, or lies in it."""
    size = [0] * len(around)
    for a, b in runs:
        for i in range(a, b):
            size[found[i].box] += weights[i]
    for box in range(len(around) - 1, 0, -1):  # a box stands after the one around it
        size[around[box]] += size[box]
    main = 0
    for box in range(1, len(around)):
        if around[box] == main and size[box] >= MAIN * size[0]:
            main = box
    inside = [False] * len(around)
    for box in range(main, len(around)):
        inside[box] = box == main or inside[around[box]]
    return inside


def main_text(page: str | None, surge: int = SURGE, dive: int = DIVE) -> str:
    found, around = lines(page or "")
    # text in links does not count, and a line of mostly links weighs nothing; in a marked article any text of its own does
    marked = any(x.article for x in found)
    weigh = lambda use: [max(0, len(x.text) - x.linked) if marked or 2 * x.linked < len(x.text) else 0 for x in use]
    if marked:
        use = [x for x in found if x.article]
        weights = weigh(use)
        runs = reached(weights, surge, dive)
        solid = [i for i, w in enumerate(weights) if w] or list(range(len(use)))
        runs = runs or [(solid[0], solid[-1] + 1)]
        runs[0] = (solid[0], runs[0][1])
        runs[-1] = (runs[-1][0], solid[-1] + 1)
    else:
        weights = weigh(found)
        inside = article_box(found, weights, blocks(weights, WINDOW, surge, dive), around)
        use = [x for x in found if inside[x.box]]
        runs = reached(weigh(use), surge, dive)
    return "\n".join(x.text for a, b in runs for x in use[a:b])


def extracted(pages: DataFrame, keep: list[str], html_column: str = "html") -> DataFrame:
    """doc (struct of the columns ``keep``), text, n_chars of every page."""
    prepare(pages.sparkSession)
    source = pages.select(F.struct(*[named(c) for c in keep]).alias("doc"), F.col(html_column).alias("html"))
    fields = T.StructType([T.StructField("doc", source.schema["doc"].dataType), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py()) for v in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["doc", "text", "n_chars"])

    return source.mapInArrow(run, fields)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc.page_id", "doc.url", "text", "n_chars")
