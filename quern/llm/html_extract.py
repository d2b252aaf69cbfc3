"""Main text of web pages by line-block distribution.

Markup is read in one pass and stripped into lines: a block element or a line break ends one. A line weighs its characters,
MARKED times as much where the page marks its article (article, main, role=main) around it. Lines inside containers that
are not article text by their element, role, class or id weigh nothing; so do lines outside a mark that are nearly all link
text. The weights of WINDOW lines from each line on are added up. Text surges where the sum reaches SURGE and
dives where it falls to nothing, below SURGE at the edge of a section, or at the edge of a mark; the lines between a surge and its dive are a span.
All lines with weight are kept in the least container that holds the heaviest span, or the outermost mark around it, and
outside it those of the spans that have a fair part of the heaviest one's weight."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, SURGE, LINKS, FAIR, MARKED = 3, 80, 0.6, 0.25, 80

# HTML element and attribute names.
_RAW = frozenset("script style noscript textarea iframe title xmp noembed noframes".split())
_BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NOISE = frozenset("head nav header footer aside form button dialog menu label input fieldset legend template svg math object select datalist canvas audio video".split())
_INLINE = frozenset("button label input svg math object select datalist canvas audio video template".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_NOISE_NAMES = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menus sidebar sidebars aside footer header masthead topbar toolbar breadcrumb breadcrumbs "
    "comment comments commentlist respond reply replies disqus cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended "
    "widget widgets pagination pager skip copyright legal disclaimer".split()
)
_LAYOUT = frozenset("no has with without is hide show".split())
_FORMATS = frozenset("a b big code em font i nobr s small strike strong tt u".split())
#: Blocks that may start inside an open p; any other ends it.
_IN_P = frozenset("body br caption tbody td tfoot th thead tr".split())
#: What the start of an element ends, and what hides an open one from it.
_IMPLIED = {
    "li": (("li",), _BLOCKS - {"address", "div", "p"}),
    **dict.fromkeys(("dd", "dt"), (("dd", "dt"), _BLOCKS - {"address", "div", "p"})),
    **dict.fromkeys(("td", "th"), (("td", "th"), frozenset(("table", "tr")))),
    "tr": (("tr",), frozenset(("table",))),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (("tbody", "thead", "tfoot"), frozenset(("table",)))),
}
_CELLS = frozenset("table td th caption".split())
#: What hides an open element from its end tag, for blocks that are no sections; _CELLS for others.
_HIDES = {"li": _CELLS | {"ul", "ol", "menu", "dir"}, **dict.fromkeys(("dd", "dt"), _CELLS | {"dl"}), **dict.fromkeys("caption td th tr tbody thead tfoot".split(), frozenset(("table",)))}
#: Elements that hold an article rather than a part of one.
_CONTAINERS = frozenset("body center div main article td th".split())
_SECTIONS = frozenset("article aside blockquote body div dl fieldset figure footer form header main menu nav ol section table ul details dialog".split())

_OPEN = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|!--|[!?/])")
#: The rest of a tag: a quoted value may hold its end, a quote that nothing closes is passed over. Nothing is read twice.
_REST = re.compile(r"""((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)>""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in _RAW}
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_MAIN = re.compile(r"\brole\s*=\s*[\"']?main\b", re.I)
_HEADER = re.compile(r"\b(?:class|id)\s*=\s*(?:\"[^\"]*header|'[^']*header|[^\s\"'>]*header)", re.I)
_NAME = re.compile(r"[a-z]+")
_BLANK = re.compile(r"\s+")


def _is_noise(tag: str, attributes: str) -> bool:
    if tag in _NOISE:
        return True
    if not attributes or tag in ("body", "html", "article", "main"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in _ROLES):
            return True
        if name in ("class", "id") and any(_names(v) for v in value.split()):
            return True
    return False


def _names(value: str) -> bool:
    """Whether one class or id stands for something beside the article: its first or last part is such a name. Names
    like no-sidebar tell how a page is laid out."""
    parts = _NAME.findall(value)
    return bool(parts) and parts[0] not in _LAYOUT and (parts[0] in _NOISE_NAMES or parts[-1] in _NOISE_NAMES)


def tags(page: str, text: Callable[[str], None], tag: Callable[[str, str, bool], None]) -> None:
    """Calls text with every run of text and tag with every tag (name in lower case, attributes, whether it ends an element),
    in page order. Comments, declarations and what stands in elements of raw text are passed over; what is left open ends
    with the page."""
    at = 0
    while m := _OPEN.search(page, at):
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0] == "<!--":
                if found := re.compile("-?>").match(page, at):
                    at = found.end()
                    continue
                ends = "-->"
            else:
                ends = "]]>" if page.startswith("[CDATA[", at) else ">"
            end = page.find(ends, at)
            if end < 0:
                return
            at = end + len(ends)
            continue
        rest = _REST.match(page, at)
        if not rest:
            return
        at, name = rest.end(), m[2].lower()
        if name in _RAW and not m[1]:
            if not rest[1].endswith("/"):
                end = _RAW_END[name].search(page, at)
                if not end:
                    return
                at = end.start()
        elif name not in _RAW:
            tag(name, rest[1], bool(m[1]))
    text(page[at:])


class _Line:
    __slots__ = ("parts", "links", "clean", "marked", "edge", "place")

    def __init__(self, marked: bool, edge: bool, place: int):
        self.parts, self.links, self.clean, self.marked, self.edge, self.place = [], 0, False, marked, edge, place

    def add(self, text: str, noise: int) -> None:
        """A line is noise if all of its text is."""
        self.parts.append(text)
        self.clean = self.clean or not (noise or text.isspace() or not text)


def lines_of(page: str) -> tuple[list[tuple[str, int, bool, bool, bool, int]], list[int], list[bool]]:
    """Text, link characters, noise, marked as article, first of a section and container, of each line with text; and of
    each container the one around it, whose number is less (0 is the page), and whether it is a mark. Within a mark a heading
    is text even where it stands in a header."""
    stack: list[tuple[str, bool, bool, int, bool]] = []
    around, is_mark = [0], [False]
    opened: Counter[str] = Counter()
    noise = marked = soft = 0
    links = 0
    out = [_Line(False, False, 0)]

    def innermost(tags: Iterable[str], hides: Iterable[str]) -> int:
        """Place of the last open element of tags, -1 if there is none or one of hides was opened since."""
        if any(opened[t] for t in tags):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in tags:
                    return k
                if stack[k][0] in hides:
                    return -1
        return -1

    def end(first: int, after: int | None = None) -> None:
        nonlocal noise, marked, soft
        if first >= 0:
            for t, n, a, _, h in stack[first:after]:
                noise, marked, soft = noise - n, marked - a, soft - h
                opened[t] -= 1
            del stack[first:after]

    def end_tag(tag: str) -> None:
        if tag in _SECTIONS or tag in _NOISE or tag == "p" or tag[0] == "h":
            end(innermost((tag,), ()))
        elif tag in _BLOCKS:
            end(innermost((tag,), _HIDES.get(tag, _CELLS)))
        elif tag in _FORMATS:  # ends alone where blocks were opened inside it
            k = innermost((tag,), _CELLS)
            end(k, k + 1 if any(t in _BLOCKS for t, *_ in stack[k + 1 :]) else None)
        else:
            end(innermost((tag,), _BLOCKS))

    def text(found: str) -> None:
        out[-1].add(found, noise - soft if soft and any(opened[t] for t in _HEADINGS) else noise)
        if links:
            out[-1].links += len(found.strip())

    def tag(name: str, attributes: str, ends: bool) -> None:
        nonlocal noise, marked, soft, links
        if ends:
            if name == "a":
                links = 0
            end_tag(name)
        else:
            if name == "a":
                links = 1
                end_tag(name)
            if name in ("body", "main"):  # neither stands inside a head, a menu or the like: what is open there was never closed
                stack.clear()
                noise = marked = soft = 0
                opened.clear()
            if name not in _VOID and not attributes.endswith("/"):
                if name in _BLOCKS and name not in _IN_P:
                    end(innermost(("p",), _BLOCKS))
                if name in _IMPLIED:
                    end(innermost(*_IMPLIED[name]))
                bad = _is_noise(name, attributes)
                good = name in ("article", "main") or (name in _SECTIONS and _MAIN.search(attributes) is not None)
                if bad or good or name in _BLOCKS or opened[name]:  # of other elements, those inside an open one of that name
                    place = stack[-1][3] if stack else 0
                    if name in _CONTAINERS or good:
                        around.append(place)
                        is_mark.append(good and not bad)
                        place = len(around) - 1
                    head = bad and marked > 0 and (name == "header" or (name in _CONTAINERS and _HEADER.search(attributes) is not None))
                    stack.append((name, bad, good, place, head))
                    opened[name] += 1
                    noise, marked, soft = noise + bad, marked + good, soft + head
        if name in _BLOCKS:
            out.append(_Line(marked > 0, name in _SECTIONS, stack[-1][3] if stack else 0))
        elif name in _NOISE and name not in _INLINE:
            out.append(_Line(marked > 0, False, stack[-1][3] if stack else 0))

    tags(page, text, tag)
    found = []
    edge = False
    for line in out:
        edge = edge or line.edge
        text = _BLANK.sub(" ", html.unescape("".join(line.parts))).strip()
        if text:
            found.append((text, line.links, not line.clean, line.marked, edge, line.place))
            edge = False
    return found, around, is_mark


def main_container(places: list[int], around: list[int], is_mark: list[bool]) -> list[bool]:
    """Of each container, whether it is the least one that holds all places, or the outermost mark around that, or lies in it."""
    held = [0] * len(around)
    for place in places:
        held[place] += 1
    for k in range(len(around) - 1, 0, -1):
        held[around[k]] += held[k]
    least = at = max(k for k, n in enumerate(held) if n == len(places))
    while at:
        least, at = (at if is_mark[at] else least), around[at]
    inside = [False] * len(around)
    for k in range(least, len(around)):
        inside[k] = k == least or inside[around[k]]
    return inside


def main_text(page: str | None) -> str:
    """Blocks of the main text, joined by line feeds; empty for null, empty or textless pages."""
    if not page:
        return ""
    lines, around, is_mark = lines_of(page)
    weights = [0 if noise else len(text) * MARKED if marked else 0 if links >= LINKS * len(text) else len(text) for text, links, noise, marked, *_ in lines]
    sums = [sum(weights[k : k + WINDOW]) for k in range(len(weights))]
    spans: list[list[int]] = []
    inside = False
    for k, total in enumerate(sums):
        if inside and (not total or (lines[k][4] and total < SURGE) or lines[k][3] != lines[k - 1][3]):
            inside = False
        if not inside and weights[k] and total >= SURGE:
            inside = True
            spans.append([])
        if inside and weights[k]:
            spans[-1].append(k)
    if not spans:  # a page of few words: its heaviest window
        if not any(weights):
            return ""
        k = sums.index(max(sums))
        spans = [[j for j in range(k, min(k + WINDOW, len(weights))) if weights[j]]]
    heavy = [sum(weights[k] for k in s) for s in spans]
    main = heavy.index(max(heavy))
    kept = {k for s, w in zip(spans, heavy, strict=True) if w >= FAIR * heavy[main] for k in s}
    held = main_container([lines[k][5] for k in spans[main]], around, is_mark)
    kept |= {k for k, w in enumerate(weights) if w and held[lines[k][5]]}
    return "\n".join(lines[k][0] for k in sorted(kept))


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars (code points), one row per row of pages.

    Null or empty html, and pages without text, give an empty text. Broken markup never fails: what is left open ends
    with the page. Repeated rows return each. An empty table gives an empty result; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                texts = [main_text(x) for x in piece.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [id_col, url_col, "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars bigint")
