"""Main text of web pages from the ratio of text to tags.

The standard library's parser reads a page in pieces. Its events make lines of text, one for each block, with the number
of tags in them. The ratios are smoothed by a Gaussian and split by a threshold; a part of the page (an article, or else the
nearest container) is content if the split finds text in it, and then counts whole, short lines and like sections beside it
included.

Elements whose tag says that they are no article never make lines. Names (class, id) only add to that: what is named after
comments or teasers goes, and what is named after notices or page furniture goes unless the page's article lies inside, or
in a page without one, for furniture, most of its text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewright.llm import common as c

#: Characters given to the parser at a time.
PIECE = 1 << 16
#: Lines that one standard deviation of the smoothing spans.
SIGMA = 1.0
#: Share of the mean ratio from which a line counts as text.
CUT = 0.5

# The elements of HTML by what they are for.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "head title script style noscript template nav footer aside button select textarea option label iframe object svg canvas "
    "audio video dialog menu".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article body div main section td".split())
ARTICLES = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
# A class or id is looked at as the words it is made of. Those of others' words and of teasers:
OTHERS = frozenset("comment comments disqus respond replies reply feedback".split())
# Notices, and page furniture that a layout may also be named after:
NOTES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promos promotion cookie cookies consent gdpr popup modal "
    "newsletter subscribe breadcrumb breadcrumbs pagination pager login signup".split()
)
FURNITURE = frozenset("sidebar menu navbar nav navigation footer masthead".split())
# Words that mean these things alone or with a plain noun, as in "social", "share-buttons" and "related-posts":
TEASERS = frozenset("related recommended recommend recommendations share sharing social widget widgets notice notices banner banners overlay".split())
NOUNS = frozenset("post posts article articles link links story stories content media button buttons icon icons bar box list area section block item items more reads".split())
# What only tells a state of the page, as in "has-sidebar" and "comments-open":
STATE = re.compile(r"^(?:has|no|is|with|without|show|hide|not)[-_]|[-_](?:open|opened|closed|enabled|disabled|on|off|active|visible|hidden|count|left|right)$", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
NOTHING, LAYOUT, NOTE, ALWAYS = range(4)


def _named(value: str) -> int:
    """Whether a class or id speaks of furniture (``LAYOUT``), notices (``NOTE``), others' words or teasers (``ALWAYS``), or of none."""
    found = NOTHING
    for token in value.split():
        if STATE.search(token):
            token = re.sub(r"[-_](?:left|right)$", "", token) if not re.match(r"(?i)(?:has|no|is|with|without|show|hide|not)[-_]", token) else ""
            if STATE.search(token):
                continue
        words = {w.lower() for w in _WORD.findall(token)}
        if words & OTHERS or words & TEASERS and words <= TEASERS | NOUNS:
            return ALWAYS
        if words & NOTES:
            found = NOTE
        elif words & FURNITURE or {"side", "bar"} <= words or words == {"site", "header"}:
            found = max(found, LAYOUT)
    return found


def _dropped(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> int:
    """How sure it is that an element is no part of the article."""
    if tag in DROPPED or tag == "header" and not in_article:
        return ALWAYS
    sure = LAYOUT if tag == "form" else NOTHING
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return ALWAYS
        if value and name == "role" and value.lower() in ROLES:
            return ALWAYS
        if value and name in ("class", "id") and tag not in ("html", "body"):
            sure = max(sure, _named(value))
    # The page's own article may be named after what stands beside it, but one of comments is not the page's own.
    return NOTHING if sure < ALWAYS and tag in ARTICLES and not in_article else sure


class Lines(HTMLParser):
    """Lines of a page: ``text``, the number of tags, the part of the page each stands in, and the furniture around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int, bool, int]] = []  # tag, part, depth of dropping, inside an article, furniture
        self.lines: list[tuple[str, int, int, int]] = []
        self.articles: set[int] = set()
        self.kin: dict[int, tuple] = {}  # what parts of one kind beside each other share
        self.parts = 0
        self.around: list[int] = [0]  # the furniture around each piece of furniture; 0 is none
        self.notes: set[int] = set()  # furniture that is a notice
        self.holds: set[int] = set()  # furniture around an article
        self.said: list[str] = []
        self.tags = 0

    @property
    def state(self) -> tuple[str, int, int, bool, int]:
        return self.open[-1] if self.open else ("", 0, 0, False, 0)

    def flush(self) -> None:
        if self.said and (text := " ".join("".join(self.said).split())):
            self.lines.append((text, self.tags, self.state[1], self.state[4]))
            self.tags = 0
        self.said = []

    def _close(self, tag: str, within: frozenset | tuple = ()) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return
            if self.open[i][0] in within:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
            self._close("p", CONTAINERS)
            if tag in ("li", "dd", "dt", "td", "tr"):
                self._close(tag, ("ul", "ol", "dl", "table"))
        elif tag == "br":
            self.said.append(" ")
        if tag in VOID:
            return
        _, part, dropping, inside, furniture = self.state
        sure = _dropped(tag, attrs, inside)
        if dropping or sure == ALWAYS:
            dropping += 1
        elif sure:
            self.around.append(furniture)
            furniture = len(self.around) - 1
            if sure == NOTE:
                self.notes.add(furniture)
        if not dropping and tag in CONTAINERS and not inside:
            self.parts += 1
            self.kin[self.parts] = (part, tag, dict(attrs).get("class")) if tag == "section" else (self.parts,)
            part = self.parts
            if tag in ARTICLES:
                self.articles.add(part)
                inside = True
                at = furniture
                while at:
                    self.holds.add(at)
                    at = self.around[at]
        self.open.append((tag, part, dropping, inside, furniture))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if not self.state[2]:
            self.said.append(data)

    def unknown_decl(self, data: str) -> None:
        """Marked sections are markup."""


def lines(html: str) -> Lines:
    parser = Lines()
    for at in range(0, len(html), PIECE):
        parser.feed(html[at : at + PIECE])
    if re.match("<[a-zA-Z/]", parser.rawdata):  # a tag that the page's end cuts off is no text
        parser.rawdata = ""
    parser.close()
    parser.flush()
    return parser


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian mean of each ratio and its neighbours; beyond the ends the last value goes on."""
    reach = max(1, int(3 * sigma))
    weight = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach, mode="edge"), weight / weight.sum(), mode="valid")


def _kept(found: Lines) -> list[tuple[str, int, int]]:
    """Lines outside furniture, and inside of what holds the article or, without one, most of the text."""
    size = [0] * len(found.around)
    for text, _, _, at in found.lines:
        while at:
            size[at] += len(text)
            at = found.around[at]
    whole = sum(len(text) for text, *_ in found.lines)
    spared = found.holds if found.articles else {at for at, n in enumerate(size) if 2 * n > whole} - found.notes

    def stays(at: int) -> bool:
        while at:
            if at not in spared:
                return False
            at = found.around[at]
        return True

    return [(text, tags, part) for text, tags, part, at in found.lines if stays(at)]


def main_text(html: str) -> str:
    """Blocks of the main text of a page, one a line; empty if there is none."""
    found = lines(html)
    kept = _kept(found)
    if not kept:
        return ""
    ratio = smoothed(np.array([len(text) / max(1, tags) for text, tags, _ in kept]))
    dense = ratio >= CUT * ratio.mean()
    parts = {part for (_, _, part), ok in zip(kept, dense, strict=True) if ok}
    articles = {part for _, _, part in kept if part in found.articles}
    if articles:
        parts = parts & articles or articles
    # Sections beside each other are parts of one text, however short some are.
    kin = {found.kin[part] for part in parts if part}
    return "\n".join(text for text, _, part in kept if part in parts or part and found.kin[part] in kin)


def _extract(html: str, text: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches, html):
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns[text] = pa.array([main_text(x) if x else "" for x in batch.column(html).to_pylist()], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Pages with their main text in ``text_col`` (replacing a column of that name).

    Null and empty pages, and pages without an article, give an empty text; broken markup is read as far as it goes;
    repeated rows give equal texts; an empty table gives an empty one.
    """
    html_col = c.named(pages, html_col)
    if text_col.lower() != html_col.lower():
        pages = pages.drop(text_col)
    schema = T.StructType([*pages.schema.fields, T.StructField(text_col, T.StringType())])
    return pages.mapInArrow(_extract(html_col, text_col), schema)
