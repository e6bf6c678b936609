"""Operator 8: main text of web pages by smoothed text-to-tag ratios.

The standard-library parser's events cut a page into lines: the text between
two block-level tags.  A line's ratio is its number of characters over the
number of tags in it.  The ratios are smoothed with a Gaussian kernel; lines
above the threshold (the smaller of mean and standard deviation of the
smoothed ratios) are content.  A section element that holds a content line of
its own is selected whole, so that a short paragraph between long ones stays.
Any other section (a list, table, quote or nested div of short lines) belongs
to the smallest section around it with content lines, and stays where it stands
between the first and the last of them.

An article or main element is a hint: where at least half of the selected text is in
such elements, what stands outside them goes.

Elements that cannot be article text are skipped while parsing: scripts,
styles, navigation, footers, forms, hidden ones and those of such a role.
An element with a class or id that is, as a whole word between blanks, the name
of an advert, notice, menu, sidebar, comment and the like goes as well, unless
it holds most of the page's text: a name alone deletes no page.

Edge cases: null or empty html gives an empty text; text outside any element
is a line of the body; unclosed and stray tags are tolerated; a null page_id or
url is carried; repeated rows give repeated results; extra columns are ignored.
Pages are parsed whole, fed to the parser in pieces.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEED = 1 << 18
SIGMA = 1.0
RADIUS = 2

#: Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "script style noscript template head title nav footer aside form button select option textarea "
    "iframe object svg canvas audio video dialog menu".split())
SECTIONS = frozenset("body article main section div td table ul ol dl blockquote figure header details".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "notice notices alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar side widget "
    "footer header masthead comment comments reply replies disqus respond share sharing social related recommended "
    "recommendations newsletter subscribe signup login search pagination pager toolbar hidden skip".split())
_SPACE = re.compile(r"\s+")


class _Lines(HTMLParser):
    """Collects lines: [text parts, tags, section number, in an article, named elements around it]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[list] = []
        self.open: list[tuple[str, int, int]] = [("body", 0, 0)]  # element, section, article
        self.sections = self.articles = 0
        self.parents = [0]  # of each section, the one around it
        self.named: list[list] = []  # open elements of a name: element, open ones of that kind, sections open, number
        self.names = 0
        self.skip: list[str] = []  # open elements from the outermost skipped one on
        self.heading_of_header = False
        self.broken = True

    def _break(self):
        self.broken = True

    def _skips(self, tag, attrs) -> bool:
        if tag in SKIPPED:
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        if tag == "header":
            return not self.open[-1][2]
        for key, value in attrs:
            if value and key == "role" and value.lower() in SKIPPED_ROLES:
                return True
            if key == "hidden" or key == "aria-hidden" and value == "true" or \
                    key == "style" and value and re.search(r"display\s*:\s*none", value):
                return True
        return False

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag in ("br", "hr") and not self.skip:
                self._break()
            elif not self.skip and self.lines and not self.broken:
                self.lines[-1][1] += 1
            return
        if self.skip and self.skip[0] in ("p", "li") and tag not in INLINE:
            self.skip.clear()  # their end tags may be left out
        if self.skip:
            if tag == self.skip[0]:
                self.skip.append(tag)
            return
        if tag not in INLINE:
            self._break()
        if self._skips(tag, attrs):
            self.skip.append(tag)
            return
        if tag == "body" and len(self.open) > 1:
            return
        if self.named and self.named[-1][0] in ("p", "li") and tag not in INLINE:
            self.named.pop()  # its end tag may be left out
        for entry in self.named:
            entry[1] += entry[0] == tag
        if tag not in ("html", "body", "main") and any(
                key in ("class", "id") and value and not NAMES.isdisjoint(value.lower().split()) for key, value in attrs):
            self.names += 1
            self.named.append([tag, 1, len(self.open), self.names])
        if tag in SECTIONS and tag != "body":
            self.sections += 1
            self.parents.append(self.open[-1][1])
            article = self.open[-1][2]
            if tag in ("article", "main") and not article:
                self.articles += 1
                article = self.articles
            self.open.append((tag, self.sections, article))
        elif not self.broken:
            self.lines[-1][1] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.skip:
            if tag == self.skip[0]:
                self.skip.pop()
            elif tag in ("body", "html") or tag in ("article", "main") and any(x[0] == tag for x in self.open):
                self.skip.clear()  # a skipped element was left open
            if self.skip or tag not in ("body", "html", "article", "main"):
                return
        if tag not in INLINE:
            self._break()
        if tag in SECTIONS and tag != "body":
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i][0] == tag:
                    del self.open[i:]
                    break
        for entry in self.named:
            entry[1] -= entry[0] == tag
        if self.named:  # closed, or left open in a section that is closed
            before = len(self.named)
            self.named = [e for e in self.named if e[1] > 0 and e[2] <= len(self.open)]
            if len(self.named) != before:
                self._break()

    def handle_data(self, data):
        if self.skip:
            return
        if self.broken:
            if data.isspace():
                return
            _, section, article = self.open[-1]
            self.lines.append([[], 1, section, article, tuple(e[3] for e in self.named)])
            self.broken = False
        self.lines[-1][0].append(data)


def smoothed(ratios: list[float]) -> list[float]:
    """The ratios under a Gaussian kernel, renormalised at the ends."""
    kernel = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-RADIUS, RADIUS + 1)]
    out, n = [], len(ratios)
    for i in range(n):
        near = [(kernel[d + RADIUS], ratios[i + d]) for d in range(-RADIUS, RADIUS + 1) if 0 <= i + d < n]
        out.append(sum(k * r for k, r in near) / sum(k for k, _ in near))
    return out


def main_text(html: str | None) -> str:
    """The article text of a page; empty if there is none."""
    if not html:
        return ""
    parser = _Lines()
    for at in range(0, len(html), FEED):
        parser.feed(html[at:at + FEED])
    parser.close()
    lines = [(_SPACE.sub(" ", "".join(parts)).strip(), *rest) for parts, *rest in parser.lines]
    lines = _without_named([x for x in lines if x[0]])
    if not lines:
        return ""
    smooth = smoothed([len(text) / tags for text, tags, _, _ in lines])
    mean = sum(smooth) / len(smooth)
    spread = math.sqrt(sum((s - mean) ** 2 for s in smooth) / len(smooth))
    least = min(mean, spread)
    content = [i for i, s in enumerate(smooth) if s >= least]
    own = {lines[i][2] for i in content}
    first, last = (_reached(order, lines, parser.parents) for order in (content, content[::-1]))
    kept, around = [], {}
    for i, (_, _, section, _) in enumerate(lines):
        path, at = [], section
        while at not in first and at not in around:
            path.append(at)
            at = parser.parents[at]
        at = around.get(at, at)
        around.update(dict.fromkeys(path, at))
        if section in own or first[at] <= i <= last[at]:
            kept.append(lines[i])
    inside = [x for x in kept if x[3]]
    if 2 * sum(len(x[0]) for x in inside) >= sum(len(x[0]) for x in kept):
        kept = inside
    return " ".join(x[0] for x in kept)


def _without_named(lines: list[tuple]) -> list[tuple]:
    """The lines outside the named elements that hold at most half of the text: (text, tags, section, article)."""
    total, chars = sum(len(x[0]) for x in lines), Counter()
    for text, *_, names in lines:
        for name in names:
            chars[name] += len(text)
    return [x[:4] for x in lines if all(2 * chars[name] > total for name in x[4])]


def _reached(order: list[int], lines: list[tuple], parents: list[int]) -> dict[int, int]:
    """For each section the first line of ``order`` that stands in it, at any depth."""
    out: dict[int, int] = {}
    for i in order:
        at = lines[i][2]
        while at not in out:
            out[at] = i
            at = parents[at]
    return out


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages(page_id, url, html)``."""

    def extract(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
            .mapInArrow(extract, "page_id long, url string, text string, n_chars long"))
