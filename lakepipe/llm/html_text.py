"""Main text of web pages by two passes of block rules.

A page is cut into blocks at its block tags.  The first pass decides a block by
its place in the page, stop-word density, length and link density; what these
leave open (mostly short blocks) takes the label of the nearest decided blocks
of its part of the page in the second pass.

Every page is read whole in one walk over its tags; nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakepipe.llm.text import chunks

# Function words of four languages.
STOP_WORDS = frozenset(
    """
    a an and are as at be been by for from had has have he her his i in is it its not of on or she
    that the their they this to was we were which will with you
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par
    pas plus pour que qui sa se ses son sur un une vous
    als am auch auf aus bei das dem den der die ein eine einen er es für hat ich ihr im ist mit nach nicht
    oder sich sie sind und von war werden wie wir zu zum
    al como con del el ella entre esta este ha las lo los más muy no para pero por si sin sobre su sus también
    una y ya
    """.split()
)

# Element and attribute names of HTML.
_RAW = ("script", "style", "title", "textarea", "noscript", "iframe", "xmp")  # no tags inside
_SKIPPED = ("button", "select", "svg", "object", "canvas", "audio", "video", "template", "datalist")
_BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search
    section summary table tbody td tfoot th thead tr ul
    """.split()
)
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_NEVER = frozenset(("nav", "aside", "footer", "menu", "dialog", "search", "fieldset"))
_NEVER_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "form"))
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_SCOPES = frozenset(("ul", "ol", "dl", "table", "menu", "dir"))

# Words of class and id that name a part which is not the article.
_NAMES = frozenset(
    """
    ad adbox adcontainer ads adsense adslot adunit adv advert advertisement adverts affiliate alert alerts announcement
    aside banner banners breadcrumb breadcrumbs comment commentlist comments consent cookie cookies copyright dialog
    discussion disqus feedback footer gdpr login masthead menu menus modal nav navbar navi navigation newsletter notice
    notices notification overlay pager paging pagination paywall popup promo promoted promotion rail reader recommended
    recommendations related replies reply respond responses search share sharebar sharing side sidebar sidenav signup
    skip social sponsor sponsored subscribe subscription toc toolbar topbar widget widgets
    """.split()
)
# What a header belongs to when it is the article's own.
_OWN_HEADERS = frozenset(("article", "content", "entry", "post", "section", "story", "title"))
_NOT_OWN = frozenset(("has", "with", "without", "no", "is", "show", "hide", "js"))

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^\"'>]++|\"[^\"<]*\"|'[^'<]*'|[\"'])*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_CLOSERS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in _RAW + _SKIPPED}
_WORD = re.compile(r"\w+")
_PARTS = re.compile(r"[-_:]+|(?<=[a-z])(?=[A-Z])")

# Where a block stands; a larger place is nearer to the article.
NEVER, LOOSE, MAIN, ARTICLE = -1, 0, 1, 2
HEADER = 3  # said of an element: only headings inside an article count
BAD, OPEN, GOOD = -1, 0, 1


@dataclass(frozen=True)
class BlockRules:
    """Thresholds of the two passes, in characters and shares."""

    short: int = 70
    long: int = 200
    stop_low: float = 0.20
    stop_high: float = 0.30
    links: float = 0.4


class _Blocks:
    """The blocks of one page: text, characters in links, place, tag, and whether in a header or form."""

    def __init__(self):
        self.rows: list[tuple[str, int, int, str, bool]] = []
        self.pieces: list[str] = []
        self.linked: list[str] = []
        # Open elements: (name, place, in a header or form).
        self.stack: list[tuple[str, int, bool]] = [("", LOOSE, False)]
        self.count: Counter[str] = Counter()  # of the names on the stack
        self.link = -1  # depth of the stack where a link began

    def add(self, text: str) -> None:
        self.pieces.append(text)
        if self.link >= 0:
            self.linked.append(text)

    def flush(self) -> None:
        if self.pieces:
            text = " ".join(html.unescape("".join(self.pieces)).split())
            if text:
                name, place, soft = self.stack[-1]
                linked = sum(len(t.replace(" ", "")) for t in self.linked) if self.linked else 0
                self.rows.append((text, linked, place, name, soft))
            self.pieces, self.linked = [], []

    def cut(self, depth: int) -> None:
        self.count.subtract(name for name, _, _ in self.stack[depth:])
        del self.stack[depth:]
        if self.link > len(self.stack):
            self.link = -1

    def find(self, names, stop=frozenset()) -> int:
        """Depth of the innermost open element with one of the names, 0 if there is none before ``stop``."""
        if not any(self.count[name] for name in names):
            return 0
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] in names:
                return k
            if self.stack[k][0] in stop:
                return 0
        return 0

    def open(self, name: str, attributes: str) -> None:
        self.flush()
        if self.stack[-1][0] == "p":  # a block tag ends an open paragraph
            self.cut(len(self.stack) - 1)
        if name in _HEADINGS and self.stack[-1][0] in _HEADINGS:
            self.cut(len(self.stack) - 1)
        if (ends := _ENDS.get(name)) and (k := self.find(ends, _SCOPES)):
            # The outermost of the elements that this one ends.
            while (k2 := k - 1) and self.stack[k2][0] in ends:
                k = k2
            self.cut(k)
        if name in ("main", "article") and (k := self.find(("nav", "menu"))):
            self.cut(k)  # an unclosed menu
        if name == "hr":
            return
        _, place, soft = self.stack[-1]
        named = attributes and not attributes.isspace() and name not in ("html", "body")
        said = _place_by_name(attributes, name) if named else None
        if place == NEVER or name in _NEVER or said == NEVER:
            place = NEVER
        elif name == "article":
            place, soft = ARTICLE, False
        elif name == "main" or said == MAIN:
            place, soft = max(place, MAIN), False
        elif name in ("header", "form") or said == HEADER:
            soft = True
        self.stack.append((name, place, soft))
        self.count[name] += 1

    def close(self, name: str) -> None:
        self.flush()
        if k := self.find((name,)):
            self.cut(k)


def _place_by_name(attributes: str, name: str) -> int | None:
    """What class, id, role, hidden and style say about an element."""
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id") and name != "main":
            for token in value.split():
                words = [w.lower() for w in _PARTS.split(token) if w]
                if not words or words[0] in _NOT_OWN:
                    continue
                if words[0] in _NAMES or words[-1] in _NAMES:
                    return NEVER
                if words[-1] == "header" and words[0] not in _OWN_HEADERS:
                    return HEADER
        elif key == "role":
            if value.lower() in _NEVER_ROLES:
                return NEVER
            if value.lower() == "main":
                return MAIN
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return NEVER
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return NEVER
    return None


def page_blocks(page: str) -> list[tuple[str, int, int, str, bool]]:
    """The blocks of a page in order, in one walk; broken markup is read as browsers do, roughly."""
    out = _Blocks()
    at, breaks, no_end = 0, 0, set()
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            text = page[at : m.start()]
            out.add(text)
            if breaks and not text.isspace():
                breaks = 0
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name in _BLOCKS:
                out.close(name)
            elif name == "a":
                out.link = -1
            continue
        if name in _CLOSERS:
            end = None if name in no_end else _CLOSERS[name].search(page, at)
            if end:
                at = end.end()
            elif name in _RAW:
                at = len(page)
            else:
                no_end.add(name)
            out.add(" ")
        elif name in _BLOCKS:
            out.open(name, m[3])
            breaks = 0
        elif name == "br":
            breaks += 1
            out.add(" ")
            if breaks == 2:
                out.flush()
        elif name == "a":
            out.link = len(out.stack)
    if at < len(page):
        out.add(page[at:])
    out.flush()
    return out.rows


def label_blocks(rows: list[tuple[str, int, int, str, bool]], rules: BlockRules, stop_words: frozenset[str]) -> np.ndarray:
    """True for each block that belongs to the article."""
    n = len(rows)
    places = np.array([r[2] for r in rows])
    top = places.max()
    label = np.full(n, OPEN, np.int8)
    likely = np.zeros(n, bool)  # open, with stop words: in doubt it stays
    heading = np.zeros(n, bool)
    for i, (text, linked, place, name, soft) in enumerate(rows):
        heading[i] = name in _HEADINGS
        if place == NEVER or (soft and not (heading[i] and place >= MAIN)):
            label[i] = BAD
        elif place < top:
            # Beside an article only the title of the main part counts.
            if not (place == MAIN and name == "h1"):
                label[i] = BAD
        else:
            size = len(text)
            links = linked / size
            if links > rules.links:
                if place < MAIN or name in ("li", "dd", "dt"):
                    label[i] = BAD
                continue
            if place < MAIN and ((size < rules.short and linked) or (size < rules.long and "©" in text)):
                label[i] = BAD
                continue
            words = _WORD.findall(text.lower())
            density = sum(w in stop_words for w in words) / max(1, len(words))
            if size >= rules.long and density >= rules.stop_high:
                label[i] = GOOD
            elif size >= rules.short:
                likely[i] = density >= rules.stop_low
                if density < rules.stop_low and place < MAIN:
                    label[i] = BAD
    return _inherit(label, likely, heading, places, [r[3] for r in rows]) == GOOD


def _inherit(label: np.ndarray, likely: np.ndarray, heading: np.ndarray, places: np.ndarray, names: list[str]) -> np.ndarray:
    """Open blocks take the label of the nearest decided blocks before and after them.

    Inside an article or main part only its own blocks count, and without any
    decided one there a block belongs to it.  There only items of a list and
    subtitles go with dropped lists of links: text between two such lists stays.
    """
    out = label.copy()
    index = np.arange(len(label))
    for inside in (True, False):
        at = index[(places >= MAIN) == inside]
        if not (label[at] == OPEN).any():
            continue
        known = (label[at] != OPEN) & ((places[at] == places.max()) | (not inside))
        pos = np.arange(len(at))
        before = np.maximum.accumulate(np.where(known, pos, -1))
        after = np.minimum.accumulate(np.where(known, pos, len(at))[::-1])[::-1]
        for j in pos[label[at] == OPEN]:
            b, a = before[j], after[j]
            prev = label[at[b]] if b >= 0 else OPEN
            then = label[at[a]] if a < len(at) else OPEN
            mine = at[j]
            if prev == OPEN and then == OPEN:
                got = GOOD if inside or likely[mine] else BAD
            elif prev == then or then == OPEN:
                got = prev
            elif prev == OPEN:
                got = then
            elif heading[mine]:
                got = then  # a title belongs to what follows
            elif likely[mine] or inside:
                got = GOOD
            elif j - b == a - j:
                got = BAD
            else:
                got = prev if j - b < a - j else then
            if inside and got == BAD:
                title = names[mine] in _HEADINGS and names[mine] != "h1" and a == j + 1
                got = BAD if title or names[mine] in ("li", "dd", "dt") else GOOD
            out[mine] = got
    return out


def main_text(page: str | None, rules: BlockRules = BlockRules(), stop_words: frozenset[str] = STOP_WORDS) -> str:
    """The article of one page, blocks joined by an empty line; empty for a null, an empty page or one without text."""
    rows = page_blocks(page) if page else []
    if not rows:
        return ""
    keep = label_blocks(rows, rules, stop_words)
    return "\n\n".join(r[0] for r, k in zip(rows, keep) if k)


def extract_text(
    pages: DataFrame,
    rules: BlockRules = BlockRules(),
    stop_words: frozenset[str] = STOP_WORDS,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, with the names of the given columns.

    One row a row, repeated and null ids too.  A null, empty or markup-only
    page has an empty text.  ``n_chars`` counts code points.  Other columns
    are ignored; an empty table gives an empty result.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, html_col):
                texts = [main_text(p, rules, stop_words) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    [id_col, url_col, "text", "n_chars"],
                )

    used = pages.select(id_col, url_col, html_col)
    types = [f"`{c}` {used.schema[c].dataType.simpleString()}" for c in (id_col, url_col)]
    return used.mapInArrow(extract, ", ".join([*types, "text string", "n_chars long"]))
