"""Main text of web pages: parser events to lines, text-to-tag ratios, Gaussian smoothing, threshold clustering."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img script style template noscript".split()
)
#: Elements whose text is never part of an article.
_UNREAD = frozenset(
    "head title script style noscript template iframe object svg math canvas audio video map "
    "footer button select textarea menu dialog".split()
)
#: Elements that are no part of an article unless they hold one: server-made pages are one big form, and some are left open.
_HOLDERS = frozenset(("form", "aside", "nav"))
_ARTICLE = frozenset(("article", "main"))
#: Elements that are content whatever their names say.
_NEVER_NAMED = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
#: Names in class, id or role that mark other regions, alone or in a compound with each other and `_BOX_WORDS`.
_REGION_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice alert nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer comment comments "
    "disqus respond reply replies share sharing social related recommended newsletter subscribe subscription signup "
    "login popup modal overlay widget pagination pager toolbar complementary contentinfo".split()
)
_HEADER_WORDS = frozenset(("header", "masthead", "topbar"))
#: What the box of a region is called besides; other words make a name a slug or a topic.
_BOX_WORDS = frozenset(
    "area bar block body bottom box button buttons col column container content desktop fixed form group header icons inline "
    "inner item items left link links list main mobile outer page pane panel post posts article articles primary reader right "
    "row secondary section site slot space sticky top unit user widgets wrap wrapper zone".split()
)
#: A name that begins like this tells what the page has besides, as in has-sidebar.
_ABOUT_OTHERS = frozenset(("has", "with", "no", "without"))
_WORD = re.compile(r"[a-z]+")
#: A new block closes an open paragraph; an item closes an item before it.
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)


#: A line in a marked article needs the threshold divided by the first, any other the threshold times the second.
MARK_PRIOR, MARK_PRIOR_OUTSIDE = 64, 2
#: A region named as another one is the body with so many unlinked characters, and so many times those of the rest.
BODY_LEAST, BODY_SHARE = 200, 4


@dataclass
class Line:
    text: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0
    article: bool = False
    region: int = 0  # 1 + the place of its named region, 0 if it is in none


class LineParser(HTMLParser):
    """Lines of text with their tags, in page order; text of unread regions is left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # Tag, whether an unread region and an article begin, and the number of the named region that begins, or 0.
        self.open: list[tuple[str, bool, bool, int]] = []
        self.count: Counter[str] = Counter()  # open elements by tag
        self.unread = self.articles = self.links = 0
        self.regions: list[int] = []
        self.region_in_article: list[bool] = []
        self.holding: set[int] = set()  # holders in which an article begins
        self.bodies: set[int] = set()  # those that are the page's body therefore
        self.seen_article = self.endless_comment = False
        self.line = Line()

    def _end_line(self):
        if any(not t.isspace() for t in self.line.text):
            self.lines.append(self.line)
            self.line = Line()
        else:
            self.line = Line(tags=self.line.tags)  # tags before any text count with the next text
        self._place_line()

    def _place_line(self):
        self.line.article = self.articles > 0
        self.line.region = self.regions[-1] if self.regions else 0

    def _is_unread(self, tag: str, attrs) -> bool:
        if tag in _UNREAD:
            return True
        if tag == "header" and not self.articles:
            return True
        return any(name == "hidden" or name == "aria-hidden" and value == "true" for name, value in attrs)

    def _is_named(self, tag: str, attrs) -> bool:
        if tag in _NEVER_NAMED:
            return False
        regions = _REGION_WORDS if self.articles else _REGION_WORDS | _HEADER_WORDS
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                for found in map(_WORD.findall, value.lower().split()):
                    words = {w for w in found if len(w) > 1}
                    if words & regions and found[0] not in _ABOUT_OTHERS and words <= regions | _BOX_WORDS:
                        return True
        return False

    def _pop(self, closed: bool = False):
        tag, unread, article, region = self.open.pop()
        self.count[tag] -= 1
        self.unread -= unread
        self.articles -= article
        self.links -= tag == "a"
        if region:
            self.regions.pop()
            if region in self.holding and (tag == "form" or not closed):
                self.bodies.add(region)

    def parse_starttag(self, i):
        # Without a bracket to come no tag is whole; the parser would read the rest of the page for each of them.
        return super().parse_starttag(i) if self.rawdata.find(">", i) >= 0 else -1

    def parse_comment(self, i, report=1):
        """As the parser does, but a page whose comment never ends is searched for the end once."""
        end = -1 if self.endless_comment else super().parse_comment(i, report)
        self.endless_comment = end < 0
        return end

    def parse_marked_section(self, i, report=1):
        """Any section, known or not, is a comment up to its bracket, as in browsers."""
        end = self.rawdata.find(">", i + 3)
        return -1 if end < 0 else end + 1

    def handle_starttag(self, tag, attrs):
        if tag == "body" and self.count["head"]:
            while self.open[-1][0] != "html" and len(self.open) > 1:
                self._pop()
        article = tag in _ARTICLE
        if article and not self.seen_article and (self.unread or self.regions):
            # A page's first article does not stand in an advert or notice: that region was not closed.
            if not any(self.count[t] for t in (_UNREAD - {"head"}) | _HOLDERS):
                while self.unread or self.regions:
                    self._pop()
        if article and self.regions:
            self.holding.update(self.regions)
        self.seen_article |= article
        if tag not in _INLINE:
            if tag in _ENDS_PARAGRAPH and any(t == "p" for t, *_ in self.open[-4:]):
                while self.open[-1][0] in _INLINE or self.open[-1][0] == "p":
                    ended = self.open[-1][0] == "p"
                    self._pop()
                    if ended or not self.open:
                        break
            elif tag in ("li", "option", "dt", "dd", "tr", "td", "th") and self.open and self.open[-1][0] == tag:
                self._pop()
            self._end_line()
        self.line.tags += 1
        if tag in _VOID:
            return
        unread = tag not in ("html", "body") and self._is_unread(tag, attrs)
        named = not unread and (tag in _HOLDERS or self._is_named(tag, attrs))
        if named and tag in _INLINE:
            unread, named = True, False  # a part of a line has no ratio of its own
        if named:
            self.region_in_article.append(self.articles > 0)
            self.regions.append(len(self.region_in_article))
        self.open.append((tag, unread, article, self.regions[-1] if named else 0))
        self.count[tag] += 1
        self.unread += unread
        self.articles += article
        self.links += tag == "a"
        self._place_line()

    def handle_startendtag(self, tag, attrs):
        if tag not in _INLINE:
            self._end_line()
        self.line.tags += 1

    def handle_endtag(self, tag):
        if tag not in _INLINE:
            self._end_line()
        self.line.tags += 1
        # Elements that are passed are closed, too, so the search costs no more than they did; without an open one there is none.
        last = len(self.open) - 1 if self.count[tag] else -1
        for i in range(last, -1, -1):
            if self.open[i][0] == tag:
                while len(self.open) > i + 1:
                    self._pop()
                self._pop(closed=True)
                break
            if tag in _INLINE and self.open[i][0] not in _INLINE:
                break
        self._place_line()

    def handle_data(self, data):
        if not self.unread:
            self.line.text.append(data)
            if self.links:
                self.line.linked += len(data)

    def finish(self) -> list[Line]:
        """All lines but those of named regions that are none of the content by their text, too."""
        self.close()
        self._end_line()
        while self.open:
            self._pop()
        if not self.region_in_article:
            return self.lines
        kept = {0} | self.bodies | self._content_regions()
        return [x for x in self.lines if x.region in kept]

    def _content_regions(self) -> set[int]:
        """Named regions that are the body after all: long, few links, and next to no text besides.

        What a region is compared with is the text in no named region: that of the articles for a region in one, or all
        of it where no article has text. A region outside of the articles with the text is none. A region's own text is
        what stands in no region inside it.
        """
        count = len(self.region_in_article)
        sums = [[0, 0, 0] for _ in range(count + 1)]  # unlinked, linked, tags
        inside = [0, 0]  # unlinked and tags of articles, without their named regions
        for x in self.lines:
            unlinked = sum(map(len, x.text)) - x.linked
            total = sums[x.region]
            total[0], total[1], total[2] = total[0] + unlinked, total[1] + x.linked, total[2] + x.tags
            if x.article and (not x.region or x.region in self.bodies):
                inside = [inside[0] + unlinked, inside[1] + x.tags]
        found = set()
        for k, in_article in enumerate(self.region_in_article, 1):
            unlinked, linked, tags = sums[k]
            if inside[0] and not in_article or unlinked < max(BODY_LEAST, linked):
                continue
            others, other_tags = inside if in_article else (sums[0][0], sums[0][2])
            if unlinked >= BODY_SHARE * others and unlinked * max(1, other_tags) >= others * max(1, tags):
                found.add(k)
        return found


def smooth(values: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian mean over neighbours within two sigmas; weights are cut at the ends of the page."""
    radius = max(1, int(np.ceil(2 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weights = np.convolve(np.ones(len(values)), kernel, "full")[radius : radius + len(values)]
    return np.convolve(values, kernel, "full")[radius : radius + len(values)] / weights


def _stretches(flags: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the runs of equal flags."""
    edges = [0, *(np.flatnonzero(flags[1:] != flags[:-1]) + 1).tolist(), len(flags)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def select_lines(lines: list[Line], sigma: float = 1.0) -> list[Line]:
    """The lines of the content regions.

    The ratio of a line is its unlinked characters per tag. The clusters are the lines whose smoothed ratio reaches
    the threshold, the standard deviation of the smoothed ratios but at most their mean; a line of links alone is not
    content. Where the page marks an article, the mark is a prior: its lines need a small part of the threshold, others a
    multiple of it, and the mark's edges end the smoothing. A line of links alone may stay in a mark by the text around
    it, but smoothing doesn't lift three or more in a row.
    """
    if not lines:
        return []
    length = np.array([sum(map(len, x.text)) for x in lines], float)
    unlinked = length - np.array([x.linked for x in lines])
    ratio = unlinked / np.maximum(1, [x.tags for x in lines])
    marked = np.array([x.article for x in lines])
    if not marked.any():
        smoothed = smooth(ratio, sigma)
        threshold = min(float(smoothed.std()), float(smoothed.mean()))
        return [x for x, r, u in zip(lines, smoothed, unlinked, strict=True) if r >= threshold and u > 0]
    smoothed = np.zeros(len(lines))
    for a, b in _stretches(marked):
        smoothed[a:b] = smooth(ratio[a:b], sigma)
    for a, b in _stretches(unlinked > 0):
        if unlinked[a] == 0 and b - a > 2:
            smoothed[a:b] = 0
    threshold = min(float(smoothed.std()), float(smoothed.mean()))
    prior = np.where(marked, 1 / MARK_PRIOR, MARK_PRIOR_OUTSIDE)
    chosen = (smoothed >= threshold * prior) & (smoothed > 0) & (marked | (unlinked > 0))
    return [x for x, keep in zip(lines, chosen, strict=True) if keep]


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """Text of the selected lines, white space inside and between them as one blank; empty if there is none."""
    if not html:
        return ""
    parser = LineParser()
    parser.feed(html)
    return " ".join(" ".join("".join(x.text).split()) for x in select_lines(parser.finish(), sigma))


def _extract_batches(batches):
    for batch in batches:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        found = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *found], ["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, id_column="page_id", url_column="url", html_column="html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    A null or empty page, and one without text, gives an empty text. Unclosed and crossing tags are read as the
    parser meets them, and no malformed markup is an error: unknown declarations and sections are comments. Repeated rows are extracted each; null ids and URLs are kept; other columns are ignored.
    """
    rows = pages.select(F.col(id_column).cast("long"), F.col(url_column).cast("string"), F.col(html_column).cast("string"))
    return rows.mapInArrow(_extract_batches, "page_id long, url string, text string, n_chars long")
