"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams a page as events. Block elements break it into lines; each line has a count of
text characters and of tags. The ratios of text to tags are smoothed with a Gaussian kernel along the page, and lines above a
threshold (a share of the standard deviation over all lines) form clusters. The innermost element around all clusters is the
content region, and the lines inside it are the main text, so no clustered line is lost. Parts that are never content (navigation, scripts, forms,
adverts, notices, comments and the like) are left out before, by element, role, or name in class or id.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.arrays import slices, small_batches

# Element names of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("head title script style noscript template nav aside footer form button select textarea input svg math iframe object canvas audio video map menu dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar dialog alert alertdialog".split())
#: One of these as a class (or put together with others and with NEUTRAL words) or as the id of a container marks boilerplate.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pager pagination toc toolbar header masthead topbar footer foot sidebar side aside rail widget widgets "
    "cookie cookies consent gdpr notice notices banner alert popup modal overlay newsletter subscribe subscription signup login "
    "comment comments commentlist disqus respond reply replies share sharing social related recommended recommendations form search skip copyright legal".split()
)
NEUTRAL = frozenset("site area container wrapper box slot".split())
#: Those that no piece of content is called either; they count everywhere but in the TEXTS of an article.
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsored sponsors".split())
#: Those that also style parts of an article, and do not count inside it.
AMBIGUOUS = frozenset(
    "header banner side rail notice notices alert form search legal copyright foot footer overlay modal popup reply "
    "navigation pagination toolbar menu menus login signup subscribe subscription promotion".split()
)
#: Ids that mark boilerplate inside an article or on a section, where others are made from headings.
PLAIN_IDS = frozenset("ad ads adsense sidebar comments commentlist respond disqus disqus_thread".split())
#: Elements that make up the layout of a page.
CONTAINERS = frozenset("center details div dl fieldset figure li ol section table tbody td tfoot th thead tr ul".split())
#: Elements of running text, and headings; inside an article they are content whatever they are called.
TEXTS = frozenset("h1 h2 h3 h4 h5 h6 header hgroup p pre blockquote figcaption dt dd".split())
#: Elements whose names in class or id do not matter, as they hold the whole page.
OUTER = frozenset(["html", "body", "main", "article"])
#: Elements that a start tag closes when they are open, as the standard leaves their end tags out.
CLOSES = {t: frozenset(["p"]) for t in BLOCKS - {"body", "html", "tbody", "td", "th", "tr", "thead", "tfoot", "option", "optgroup", "legend", "summary", "dt", "dd", "li"}} | {
    "li": frozenset(["li", "p"]), "dt": frozenset(["dt", "dd", "p"]), "dd": frozenset(["dt", "dd", "p"]), "tr": frozenset(["tr", "td", "th", "p"]),
    "td": frozenset(["td", "th", "p"]), "th": frozenset(["td", "th", "p"]), "option": frozenset(["option"]),
}
#: Elements that may stand in a head; any other ends it, as its end tag may be left out.
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
#: Elements beyond which an implied end does not reach.
SCOPE = frozenset("ul ol dl table article section div main aside nav form footer header blockquote body td th".split())
#: Elements that hold a piece of text and are no content region.
PIECES = frozenset("h1 h2 h3 h4 h5 h6 p li pre td blockquote dt dd figcaption".split())
SIGMA, SHARE = 1.0, 0.5
NAME = re.compile(r"[a-z0-9]+")


def _named(tag: str, key: str, value: str, inside: bool) -> bool:
    """Whether a class or id marks boilerplate; ``inside`` an article or main element only the unambiguous ones do."""
    if tag in OUTER or inside and tag in TEXTS:
        return False
    if tag not in CONTAINERS:
        return not ADVERTS.isdisjoint(value.split())
    if key == "id":
        return value.strip() in (PLAIN_IDS if inside or tag == "section" else NAMES)
    names = NAMES - AMBIGUOUS if inside else NAMES
    for token in value.split():
        words = {w for w in NAME.findall(token) if not w.isdigit()} - NEUTRAL
        if words and words <= NAMES and not words.isdisjoint(names):
            return True
    return False


def _boilerplate(tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> bool:
    """Whether an element is left out by what it is called; ``inside``: an article or main element is open around it."""
    if tag in NEVER or tag == "header" and not inside:
        return True
    for key, value in attrs:
        value = (value or "").lower()
        if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
        if key in ("class", "id") and _named(tag, key, value, inside):
            return True
    return False


class Lines(HTMLParser):
    """Collects (innermost open block, text, tags) of each line of a page that may be content.

    Elements are numbered as they open; ``parents`` holds the number of the block around each (-1: none). Where each tag was opened
    last is kept, so that no step walks along the open elements and time is linear in the page.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        #: Open elements: tag, number, whether left out.
        self.open: list[tuple[str, int, bool]] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.scopes: list[int] = []
        self.blocks: list[int] = [-1]
        self.lines: list[tuple[int, str, int]] = []
        self.kinds: list[str] = []
        self.parents: list[int] = []
        self.skipped = 0
        self.text: list[str] = []
        self.tags = 0

    def updatepos(self, i: int, j: int) -> int:
        """Line numbers are not needed."""
        return j

    def flush(self) -> None:
        if not self.text:
            self.tags = 0
            return
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((self.blocks[-1], text, self.tags))
        self.text, self.tags = [], 0

    def _end_head(self, tag: str | None) -> None:
        """Close the head if text (None) or this start tag cannot stand in it; a first body also closes what stands before it."""
        if tag == "body" and not self.places["body"]:
            if not self.skipped:
                self.flush()
            self._close(next((i for i, (t, _, _) in enumerate(self.open) if t != "html"), len(self.open)))
        elif self.open and self.open[-1][0] == "head" and tag not in IN_HEAD:
            self._close(len(self.open) - 1)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._end_head(tag)
        if tag in BLOCKS and not self.skipped:
            self.flush()
        for closed in CLOSES.get(tag, ()):
            self._end(closed, True)
        if not self.skipped:
            self.tags += 1
            if tag == "br":
                self.text.append(" ")
        if tag in VOID:
            return
        skip = bool(self.skipped) or _boilerplate(tag, attrs, bool(self.places["article"] or self.places["main"]))
        if skip and not self.skipped and tag not in BLOCKS:
            self.text.append(" ")
        place, number = len(self.open), len(self.kinds)
        self.open.append((tag, number, skip))
        self.places[tag].append(place)
        if tag in SCOPE:
            self.scopes.append(place)
        self.kinds.append(tag)
        self.parents.append(self.blocks[-1])
        if tag in BLOCKS:
            self.blocks.append(number)
        self.skipped += skip

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def _end(self, tag: str, scoped: bool) -> None:
        """Close the last open element of this tag with all in it; ``scoped``: unless an element that bounds it opened since."""
        places = self.places[tag]
        if places and not (scoped and self.scopes and self.scopes[-1] > places[-1]):
            self._close(places[-1])

    def _close(self, place: int) -> None:
        while len(self.open) > place:
            tag, _, skip = self.open.pop()
            self.places[tag].pop()
            self.skipped -= skip
            if tag in SCOPE:
                self.scopes.pop()
            if tag in BLOCKS:
                self.blocks.pop()

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS and not self.skipped:
            self.flush()
        # An inline end tag does not close blocks.
        self._end(tag, tag not in BLOCKS and tag != "head")

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._end_head(None)
        if not self.skipped:
            self.text.append(data)


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing along the lines, weights renormalised at the ends."""
    reach = max(1, math.ceil(2 * sigma))
    kernel = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma**2))
    mass = np.convolve(np.ones(len(ratios)), kernel)[reach:-reach]
    return np.convolve(ratios, kernel)[reach:-reach] / mass


def main_text(html: str | None) -> str:
    """Lines of the content region in page order, joined by newlines; empty if the page has none."""
    if not html:
        return ""
    page = Lines()
    # Beyond the last end of a comment none ends, so what opens one there is no comment and the text after it stays.
    last = html.rfind("-->") + 1
    page.feed(html[:last] + html[last:].replace("<!--", ""))
    page.close()
    page.flush()
    if not page.lines:
        return ""
    ratios = np.array([len(text) / max(1, tags) for _, text, tags in page.lines])
    smooth = smoothed(ratios)
    content = smooth >= SHARE * smooth.std()
    # The innermost element around all clustered lines that is more than a piece of text; children have greater numbers than parents.
    held = [0] * len(page.kinds)
    for (block, _, _), clustered in zip(page.lines, content, strict=True):
        if clustered and block >= 0:
            held[block] += 1
    for n in range(len(held) - 1, -1, -1):
        if page.parents[n] >= 0:
            held[page.parents[n]] += held[n]
    total = int(content.sum())
    region = next((n for n in range(len(held) - 1, -1, -1) if held[n] == total and page.kinds[n] in BLOCKS and page.kinds[n] not in PIECES), None) if total else None
    if region is None:
        return "\n".join(text for _, text, _ in page.lines)
    within = [False] * len(page.kinds)
    for n, parent in enumerate(page.parents):
        within[n] = n == region or parent >= 0 and within[parent]
    return "\n".join(text for block, text, _ in page.lines if block >= 0 and within[block])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of (page_id, url, html); the whole page is parsed.

    A null or empty page, or one without content, has an empty text and 0 characters. Rows are independent; null or repeated
    page_ids are rows like others; other columns are ignored. Broken markup is read as far as its tags tell.
    """
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                found = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], names=["page_id", "url", "text", "n_chars"]
                )

    bare = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return bare.mapInArrow(run, "page_id long, url string, text string, n_chars long")
