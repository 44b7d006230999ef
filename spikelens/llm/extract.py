"""Main text of web pages by the distribution of text over lines and the surges and dives in it."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spikelens.llm.common import slices, table_of

WINDOW = 2
SURGE = 80
LINK_SHARE = 0.6

# HTML element names by their role, and words that name page furniture in class, id or role.
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "template")
CONTROLS = frozenset("head button select option datalist label object embed canvas audio video map".split())
LAYOUT = frozenset("nav header footer aside menu dialog".split())
ASIDE = frozenset(("noscript", "svg"))
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NAMED = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies discussion disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted related replies respond search share sharing sidebar sidenav signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
CONTENT = frozenset(("article", "main"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<(" + "|".join(RAW) + r")\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>|<[!?/][^>]*>",
    re.S | re.I,
)
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_NAMES = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_EXTRACTED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _may_be_furniture(tag: str, attributes: str, content: bool) -> bool:
    """A form or layout element, a picture's or fallback's text outside an article, or an element with a whole class, id or role that names furniture."""
    if tag in ("form", "fieldset") or tag in LAYOUT or tag in ASIDE and not content:
        return True
    if tag in ("html", "body") or tag in CONTENT or not attributes.strip():
        return False
    return any(not NAMED.isdisjoint("".join(m).lower().split()) for m in _NAMES.findall(attributes))


def lines_of(page: str) -> list[tuple[str, int, bool, bool, str]]:
    """(text, characters within links, inside an article, in a heading, text but for furniture) per line.

    A line ends where a block does. Scripts, styles, comments and form controls alone are taken out; all
    else is in the lines. What elements and names call furniture is only told apart, and not so in elements
    that hold an article, nor for forms and named elements that hold most of the page's text.
    """
    lines: list[tuple[list[tuple[str, bool, int]], bool, bool]] = []
    # name, skipped, in a link, in an article, in a heading, place in `doubtful`
    open_tags: list[tuple[str, bool, bool, bool, bool, int]] = [("", False, False, False, False, 0)]
    doubtful = [[0, False, 0, False]]  # [the one around it, holds an article, characters, by its element]; the first is the page
    parts: list[tuple[str, bool, int]] = []
    at = 0

    def add(text: str) -> None:
        parts.append((text, open_tags[-1][2], open_tags[-1][5]))
        doubtful[open_tags[-1][5]][2] += len(text.strip())

    def end_line() -> None:
        lines.append((parts[:], open_tags[-1][3], open_tags[-1][4]))
        parts.clear()

    for token in _TOKEN.finditer(page):
        if token.start() > at and not open_tags[-1][1]:
            add(page[at : token.start()])
        at = token.end()
        tag = (token[3] or "").lower()
        if not tag:
            continue
        if tag == "br":
            parts.append((" ", False, open_tags[-1][5]))
        if tag in BLOCKS:
            end_line()
        if token[2]:
            for i in range(len(open_tags) - 1, 0, -1):
                if open_tags[i][0] == tag:
                    del open_tags[i:]
                    break
        elif tag not in VOID:
            if tag in BLOCKS and open_tags[-1][0] in ("p", *HEADINGS) or tag == open_tags[-1][0] and tag in ("li", "dd", "dt", "tr", "td", "th", "option"):
                open_tags.pop()
            _, skipped, link, content, heading, within = open_tags[-1]
            skipped = skipped or tag in CONTROLS
            if not skipped and tag in CONTENT:
                doubtful[within][1] = True
            if not skipped and _may_be_furniture(tag, token[4], content):
                doubtful.append([within, False, 0, tag in LAYOUT or tag in ASIDE])
                within = len(doubtful) - 1
            open_tags.append((tag, skipped, link or tag == "a", content or tag in CONTENT, heading or tag in HEADINGS, within))
    if not open_tags[-1][1]:
        add(page[at:])
    end_line()
    for around, holds, size, _ in reversed(doubtful[1:]):  # an element comes after those around it
        doubtful[around][1] |= holds
        doubtful[around][2] += size
    furniture = [False]
    for around, holds, size, layout in doubtful[1:]:
        body = not layout and 2 * size > doubtful[0][2] and (size >= SURGE or not doubtful[0][1])  # beside an article, a few words are none
        furniture.append(furniture[around] or not (holds or body))
    out = []
    for own, content, heading in lines:
        text = _plain([t for t, *_ in own])
        left = _plain([t for t, _, within in own if not furniture[within]]) if any(furniture[within] for *_, within in own) else text
        out.append((text, sum(len(t) for t, link, _ in own if link), content, heading, left))
    return out


def _plain(parts: list[str]) -> str:
    return " ".join(html.unescape("".join(parts)).split())


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE, link_share: float = LINK_SHARE, trim: bool = True) -> str:
    """Text between the surges and dives of the line-block distribution, blocks joined by an empty line.

    Each line's block is the text of ``window`` lines up to it, menus and footers included; lines that are
    mostly links count as empty, but for headings. A run of lines opens where the block sum rises above zero
    and closes where it falls to zero: blocks side by side stay together, a step out of one element and into
    another parts them. Runs whose sum surges to ``surge`` characters are kept, and if none does, the run
    with the most text.

    ``trim`` corrects what was found. Article elements, if they hold half of it: short runs and link lines
    within them are kept too, and text beside them at the edge of a run goes if it doesn't surge by itself.
    Elements and names of furniture: their lines go from the runs that surged, which no distribution tells
    from an article (readers' comments, a long notice).
    """
    if not page:
        return ""
    lines = lines_of(page)
    left = [own if trim else t for t, *_, own in lines]
    named = [not x for x in left]
    held = [t if t and (heading or n < link_share * len(t)) else "" for t, n, _, heading, _ in lines]
    inside = [within and not name for (_, _, within, _, _), name in zip(lines, named, strict=True)]
    runs = _runs([len(t) for t in held], window)
    # If nothing surges, furniture can't be the longest.
    least = min(surge, max((r[2] for r in _runs([0 if x else len(t) for t, x in zip(held, named, strict=True)], window)), default=0))
    found = [i for first, last, top in runs if top >= least for i in range(first, last + 1) if not named[i]]
    trusted = trim and 2 * sum(len(held[i]) for i in found if inside[i]) >= sum(len(held[i]) for i in found) > 0
    if trusted:
        held = [t if within else own for (t, *_), within, own in zip(lines, inside, held, strict=True)]
        runs = _runs([len(t) for t in held], window)
    kept: list[str] = []
    for first, last, top in runs:
        own = [i for i in range(first, last + 1) if held[i] and inside[i]] if trusted else []
        if top >= least or own:
            if own:
                beside = lambda part: max((r[2] for r in _runs([len(t) for t in part], window)), default=0)
                first = first if beside(held[first : own[0]]) >= surge else own[0]
                last = last if beside(held[own[-1] + 1 : last + 1]) >= surge else own[-1]
            kept += [own for t, own in zip(held[first : last + 1], left[first : last + 1], strict=True) if t and own]
    return "\n\n".join(kept)


def _runs(sizes: list[int], window: int) -> list[list[int]]:
    """(first line, last line, highest block sum) of the runs between rises from zero and falls to it."""
    runs: list[list[int]] = []
    before = total = 0
    for i, n in enumerate(sizes):
        total += n - (sizes[i - window] if i >= window else 0)
        if total and not before:
            runs.append([i, i, 0])
        if total:
            runs[-1][1], runs[-1][2] = i, max(runs[-1][2], total)
        before = total
    return runs


def extract_pages(pages: DataFrame, page_html: str = "html", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, url, text`` of every page; a null or empty page, or one of furniture alone, has empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text=2):
            yield table_of(_EXTRACTED, [piece.column(0), piece.column(1), [main_text(p) for p in piece.column(2).to_pylist()]])

    return pages.select(F.col(page_id).cast("long"), F.col(url).cast("string"), F.col(page_html).cast("string")).mapInArrow(
        run, "page_id long, url string, text string"
    )
