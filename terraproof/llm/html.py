"""Main text of HTML pages by text-to-tag ratio.

The standard library's streaming parser cuts a page into lines, one per block element. Each line knows its
characters, how many tags it took, how many characters are links, and the elements around it. The text-to-tag ratios
of the page's lines, 0 inside boilerplate, are smoothed by a Gaussian; lines above a threshold, ``level`` times the mean
of the smoothed ratios over the page's characters, are strong; the strong ones that are not mostly links are the seeds. Seeds are clustered by the containers they stand in (article,
main, section, div, td, body). Where an article or main is around the container whose seeds carry the most characters,
it and those of its kind and place that carry a fair share of it are the content regions. Elsewhere the innermost
container around all seeds is. A region's lines are kept, however short, apart from boilerplate and, outside article
and main, from weak lines that are mostly links: menus that nothing names.

Roles, names and forms only weigh as long as there is other text, and so do menus and the like that are never closed:
one that holds nearly all of a page's unlinked text, as a form around the page, is no boilerplate. A class name counts if each of its parts is a word of boilerplate or says nothing, an id only on containers and lists
outside articles. Every step is linear in the page.

Defined results: a null or empty page, and one without text outside boilerplate, has the empty text. Text stands
line by line, white space inside a line is one blank. A page without tags is one line per text. Repeated rows give
repeated results. An empty table gives an empty result. Input columns other than the ones named are not looked at.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraproof.llm.common import release_memory, slices

#: Fixed values of HTML: elements that begin a new line, have no end tag, or hold no text for readers.
BLOCKS = frozenset("address article aside blockquote body canvas center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template noscript annotation annotation-xml metadata desc object iframe head title select option datalist button textarea canvas audio video map".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog search".split())
CONTAINERS = frozenset("article main section div td body blockquote".split())
LISTS = frozenset("ul ol dl table".split())
#: p cannot hold these; their start closes an open p.
CLOSES_P = BLOCKS - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "dd", "dt", "legend", "summary", "figcaption"}
#: Parts of class names and ids that name boilerplate, and parts that say nothing of it.
NAMES = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored sponsors promo promos promotion nav navbar navigation navi menu menus breadcrumb breadcrumbs sidebar footer header masthead cookie cookies consent gdpr notice notices popup modal newsletter subscribe subscription share sharing social related recommended recommendations comment comments respond disqus pagination pager login signup search toolbar skip copyright disclaimer imprint".split())
PLAIN = frozenset("a and area bar block bottom box btn button buttons center col column container content div field fixed float form global group inner item items js l large layout left link links list main md mobile new now page panel post posts primary r right row secondary section side site slot sm small sticky sub text to top top2 ui user users widget wrap wrapper xs".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())


def names_boilerplate(names: str) -> bool:
    """Whether one of the names, blank-separated, is made of words of boilerplate and words that say nothing."""
    for name in names.lower().split():
        parts = [x for x in re.split(r"[^a-z]+", re.sub(r"side-?bar", "sidebar", name)) if x]
        if any(x in NAMES for x in parts) and all(x in NAMES or x in PLAIN for x in parts):
            return True
    return False


@dataclass
class Line:
    region: int
    junk: int
    parts: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0


class Lines(HTMLParser):
    """Collects a page's lines while the parser streams over it.

    ``regions`` are the containers, as (tag, parent), and ``junks`` the parents of the elements that look like
    boilerplate; number 0 of both is the page.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, int]] = []  # tag, silent, junk, region
        self.places: dict[str, list[int]] = defaultdict(list)  # where each tag stands open
        self.walls: list[int] = []  # where containers stand open
        self.regions: list[tuple[str, int]] = [("page", -1)]
        self.junks: list[int] = [-1]
        self.sure: list[bool] = [False]  # boilerplate by the element's kind, and closed by its own end tag
        self.lines: list[Line] = []
        self.line: Line | None = None
        self.pending = 0

    def _state(self) -> tuple[bool, int, int]:
        return self.open[-1][1:] if self.open else (False, 0, 0)

    def _pop_to(self, k: int) -> None:
        for at, (tag, _, junk, _) in enumerate(self.open[k:]):
            self.places[tag].pop()
            if at and junk:
                self.sure[junk] = False
            if tag in CONTAINERS:
                self.walls.pop()
        del self.open[k:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS or tag == "br":
            self.line = None
        wall = self.walls[-1] if self.walls else -1
        if tag in CLOSES_P and self.places["p"] and self.places["p"][-1] > wall:
            self._pop_to(self.places["p"][-1])
        if tag in ("li", "td", "th", "tr", "option", "dd", "dt") and self.open and self.open[-1][0] == tag:
            self._pop_to(len(self.open) - 1)
        if self.line is not None:
            self.line.tags += 1
        else:
            self.pending += 1
        if tag in VOID:
            return
        silent, junk, region = self._state()
        # an article may have a header of its own: its headline belongs to the article
        looks = tag in BOILERPLATE and not (tag == "header" and (self.places["article"] or self.places["main"]))
        if attrs:
            what = {k: v or "" for k, v in attrs}
            hidden = "hidden" in what or what.get("aria-hidden") == "true" or "display:none" in what.get("style", "").replace(" ", "").lower()
            named = what.get("class", "")
            # ids are often made from headings: one names its element only around text, and not within an article
            if tag in CONTAINERS | LISTS and not (self.places["article"] or self.places["main"]):
                named += f" {what.get('id', '')}"
            looks = looks or hidden or what.get("role", "").lower() in ROLES or tag not in ("body", "html") and names_boilerplate(named)
        if looks:
            self.junks.append(junk)
            self.sure.append(tag in BOILERPLATE and tag != "form")
            junk = len(self.junks) - 1
        if tag in CONTAINERS:
            self.regions.append((tag, region))
            region = len(self.regions) - 1
            self.walls.append(len(self.open))
        self.places[tag].append(len(self.open))
        self.open.append((tag, silent or tag in SILENT, junk, region))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.line = None
        if self.line is not None:
            self.line.tags += 1
        wall = self.walls[-1] if self.walls else -1
        if self.places[tag] and (self.places[tag][-1] >= wall or tag in CONTAINERS or tag in BOILERPLATE or tag in ("html", "body")):
            self._pop_to(self.places[tag][-1])

    def close(self) -> None:
        super().close()
        for _, _, junk, _ in self.open:
            self.sure[junk] = False

    def handle_data(self, data: str) -> None:
        silent, junk, region = self._state()
        if silent:
            return
        line = self.line
        if line is None or line.region != region or line.junk != junk:
            if not data.strip():
                return
            line = self.line = Line(region, junk, tags=self.pending)
            self.pending = 0
            self.lines.append(line)
        line.parts.append(data)
        if self.places["a"]:
            line.linked += len(data)


def smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing, each line weighing the neighbours there are."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = lambda x: np.convolve(x, kernel)[reach : reach + len(x)]
    return full(ratios) / full(np.ones(len(ratios)))


def _below(parents: list[int], own: np.ndarray) -> np.ndarray:
    """The sum of each node's own value and those of all below it; parents stand before their children."""
    out = own.astype(float)
    for k in range(len(parents) - 1, 0, -1):
        out[parents[k]] += out[k]
    return out


def _boilerplate(parser: Lines, lines: list[Line], free: np.ndarray, most: float) -> np.ndarray:
    """Which lines stand inside elements that look like boilerplate and hold no more than ``most`` of the unlinked text."""
    held = _below(parser.junks, np.bincount([x.junk for x in lines], free, len(parser.junks)))
    bad = np.zeros(len(held), bool)
    for k in range(1, len(held)):
        bad[k] = bad[parser.junks[k]] or parser.sure[k] or held[k] <= most * held[0]
    return bad[[x.junk for x in lines]]


def main_text(html: str | None, sigma: float = 1.0, level: float = 0.3, share: float = 0.35, most: float = 0.8) -> str:
    """The page's content regions, one line per block."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    found = [(x, text) for x in parser.lines if (text := " ".join("".join(x.parts).split()))]
    if not found:
        return ""
    lines = [x for x, _ in found]
    size = np.array([len(t) for _, t in found], float)
    linked = np.array([x.linked for x in lines])
    free = np.maximum(0, size - linked)
    junk = _boilerplate(parser, lines, free, most)
    ratio = np.where(junk, 0.0, free / np.maximum(1, [x.tags for x in lines]))
    even = smooth(ratio, sigma)
    strong, mostly_links = even >= level * np.average(even, weights=size), 2 * linked >= size
    seeds = ~junk & strong & ~mostly_links
    if not seeds.any():
        seeds = ~junk & (ratio > 0)
    if not seeds.any():
        return ""
    region, parents = np.array([x.region for x in lines]), [parent for _, parent in parser.regions]
    own = np.bincount(region[seeds], size[seeds], len(parents))
    weight = _below(parents, own)
    # the nearest article or main around the heaviest container speaks for all of its parts
    top = int(own.argmax())
    while top >= 0 and parser.regions[top][0] not in ("article", "main"):
        top = parents[top]
    named = top >= 0
    if not named:  # without one, the innermost container around all seeds
        counts = _below(parents, np.bincount(region[seeds], minlength=len(parents)))
        top = int(np.flatnonzero(counts == counts[0]).max())
    within = np.zeros(len(parents), bool)
    for k, (tag, parent) in enumerate(parser.regions):
        sibling = named and tag == parser.regions[top][0] and parent == parents[top] and weight[k] >= share * weight[top]
        within[k] = k == top or parent >= 0 and within[parent] or sibling
    menu = mostly_links & ~strong & (not named)
    kept = within[region] & ~junk & ~menu
    return "\n".join(t for (_, t), x in zip(found, kept, strict=True) if x)


def extract_main_text(df: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """One row per input row: id, url, text, n_chars."""
    rows = df.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))
    kinds = {x.name: x.dataType.simpleString() for x in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_html"):
            texts = [main_text(x) for x in part.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["_id", "_url", "text", "n_chars"])
        release_memory()

    out = rows.mapInArrow(run, f"_id {kinds['_id']}, _url {kinds['_url']}, text string, n_chars long")
    return out.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", "n_chars")
