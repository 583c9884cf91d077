"""Main text of web pages from a streaming parser's events.

Blocks are the parser's lines. Each has a text-to-tag ratio; the ratios are smoothed by a Gaussian along the page and split
at a threshold by two-mean clustering. Blocks belong to regions (the article, or else their nearest container), and
the regions that the cluster of high ratios reaches are the content. Elements that by name, role or class hold no
article text never make blocks.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_values, tune

# Element names of the HTML standard, and usual names for what isn't the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
OUTSIDE = frozenset("head title script style noscript template nav footer aside form button select option textarea iframe svg object canvas audio video dialog menu".split())
ARTICLE = frozenset("article main".split())
CONTAINER = frozenset("article main section div body td table".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
OUTSIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?<!has[_-])(?<!with[_-])(?<!no[_-])(?:ads?|adbox|adsense|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|sidebar|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|social|share|sharing|related|recommended|comments?|commentlist|disqus|respond|replies|widget|toolbar|pagination|pager|search)(?:$|\s|[_-](?!open|closed|free|enabled|disabled|layout|page))",
    re.IGNORECASE,
)
HEADER_NAMES = re.compile(r"(?:^|[\s_-])(?:header|topbar)(?:$|\s)", re.IGNORECASE)
#: A tag or comment that the page's end cuts off; it holds no text.
CUT_OFF = re.compile("<(?:/?[A-Za-z]|[!?])")

SIGMA = 1.0
REACH = 2
#: Characters fed to the parser at once.
FEED = 1 << 16


@lru_cache(maxsize=4096)
def kinds(tag: str) -> tuple:
    """What open elements are looked up by: the name, and the sets that it is in."""
    return (tag, *(k for k in (CONTAINER, OUTSIDE) if tag in k))


class Blocks(HTMLParser):
    """Collects (region, text, tags) for each block. Open elements are looked up by ``kinds``, however deep a page is."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, bool]] = [("", False, 0, False)]  # name, outside, region, in an article
        self.at: defaultdict = defaultdict(lambda: [0])
        self.regions = 0
        self.text: list[str] = []
        self.tags = 0
        self.blocks: list[tuple[int, str, int]] = []

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append((self.open[-1][2], text, self.tags))
        self.text, self.tags = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.flush()
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            return
        if tag in BLOCK:
            self.close_paragraph()
        _, outside, region, article = self.open[-1]
        given = dict(attrs)
        if tag in ARTICLE and not self.at[OUTSIDE][-1]:
            outside = False
            if not article:
                self.regions += 1
                region, article = self.regions, True
        elif tag in CONTAINER and not article:
            self.regions += 1
            region = self.regions
        if tag not in ("html", "body", "article", "main"):
            named = f"{given.get('class') or ''} {given.get('id') or ''}"
            outside |= tag in OUTSIDE or tag == "header" and not article or (given.get("role") or "").lower() in OUTSIDE_ROLES or "hidden" in given or given.get("aria-hidden") == "true" or bool(named.strip() and (OUTSIDE_NAMES.search(named) or not article and HEADER_NAMES.search(named)))
        for k in kinds(tag):
            self.at[k].append(len(self.open))
        self.open.append((tag, outside, region, article))

    def end(self, place: int) -> None:
        """The element at ``place`` and what it holds end."""
        while len(self.open) > place:
            for k in kinds(self.open.pop()[0]):
                self.at[k].pop()

    def close_paragraph(self) -> None:
        """A block begins, so an open paragraph and what it holds end."""
        if (place := self.at["p"][-1]) > max(self.at[CONTAINER][-1], self.at[OUTSIDE][-1]):
            self.end(place)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.flush()
        place = self.at[tag][-1]
        if place and (tag in BLOCK or place >= self.at[CONTAINER][-1]):
            self.end(place)

    def handle_data(self, data: str) -> None:
        if not self.open[-1][1]:
            self.text.append(data)

    def done(self) -> list[tuple[int, str, int]]:
        if CUT_OFF.match(self.rawdata):
            self.rawdata = ""
        self.close()
        self.flush()
        return self.blocks


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian mean over REACH neighbours each way; at the ends over those there are."""
    kernel = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)
    full = np.convolve(ratios, kernel)[REACH : REACH + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), kernel)[REACH : REACH + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """Where two-mean clustering of the values cuts; with one value all are content."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        cut = (low + high) / 2
        above = values >= cut
        if above.all():
            return cut
        new = float(values[~above].mean()), float(values[above].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def main_text(html: str) -> str:
    """The page's content blocks, joined by newlines; empty if it has none.

    Each region whose smoothed ratio reaches the threshold is content, articles and other containers alike.
    """
    parser = Blocks()
    for i in range(0, len(html), FEED):
        parser.feed(html[i : i + FEED])
    blocks = parser.done()
    if not blocks:
        return ""
    ratios = smoothed(np.array([len(text) / (tags + 1) for _, text, tags in blocks]))
    cut = threshold(ratios)
    dense = {region for (region, _, _), value in zip(blocks, ratios.tolist(), strict=True) if value >= cut}
    return "\n".join(text for region, text, _ in blocks if region in dense)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row.

    Character references are decoded, white space inside a block is one space, blocks keep the page's order. Null and empty
    pages and pages without content have an empty text; a tag or comment that a page's end cuts off holds none. Repeated rows stay; null ids and urls stay null; an empty table gives
    no rows; other columns are not read.
    """
    tune(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "html"):
                texts = [main_text(x.decode("utf-8", "replace")) for x in text_values(b.column("html"))]
                yield pa.record_batch([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
