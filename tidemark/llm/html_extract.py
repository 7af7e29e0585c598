"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

1. The standard library's parser streams events; its tag soup rules and character references are used as they are. Each
   block (what block-level tags and line breaks part) is a line, with the number of tags met in it, the characters of
   its text and of its links, and the region, that is the container element, that holds it.
2. Scripts, styles and other unseen elements have no lines. Lines of elements that are no article by their meaning
   (`nav`, `footer`, `aside`, `form`, a role such as banner) are set aside. Names are weaker evidence: regions whose class
   or id is made of names for page furniture alone (`comment-list`, `ad`, not `related-work`) are set aside only as
   long as other text is left.
3. A line's ratio is its text, links not counted, over its tags. The ratios are smoothed by a Gaussian; runs of lines above
   a share of their spread are clusters. The heaviest cluster, all of at least HEAVY of its weight, and those in regions
   built like theirs (of the same parent, element and names; if named, also lines outside of clusters) mark where the
   article is: in the least region that encloses them, or the `article` or `main`
   around it. If half of their weight is in such elements, those alone mark it.
4. All of that region's lines are the text, short ones too, but for its own regions that no cluster touches and that are
   furniture by their place or links: outside of where the clusters begin and end, or made of links. Inside an
   `article` or `main` nothing is left out.

Defined results: null and empty pages and pages without content have the text ''. Pages are used whole. A page of one
unbroken text without tags is its own main text. Declarations of any kind are skipped. Each row gives one result row,
also for repeated ids; an empty table an empty result. Other columns are ignored. White space in a block becomes one
space; blocks are joined by a newline.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Standard deviation, in lines, of the smoothing.
SIGMA = 1.0
#: A smoothed ratio counts as content above this share of the ratios' standard deviation.
SHARE = 0.5
#: Clusters of this share of the heaviest one's weight say where the article is; it leaves out no line of it.
HEAVY = 0.1
#: A region whose text is links to this share is a menu, if nothing speaks against it.
LINKED = 0.5

# Element names of HTML by what they do here.
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
_UNSEEN = frozenset("script style template noscript title head iframe object embed svg canvas audio video textarea select button datalist noframes applet map".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr param keygen frame basefont bgsound".split())
_BOILER = frozenset("nav footer aside form menu dialog fieldset search".split())
_CONTENT = frozenset("article main".split())
_CONTAINER = frozenset("article main section div nav header footer aside form menu dialog body td center fieldset search".split())
_REGION = _CONTAINER | frozenset("table ul ol dl p blockquote figure details".split())
_CLOSES_P = _BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "select", "legend"}
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# Words that name page furniture, and words that say nothing beside them.
_FURNITURE = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside widget widgets header footer masthead topbar toolbar banner ad ads advert adverts advertisement advertising "
    "sponsor sponsored promo promoted promotion outbrain taboola comment comments commentlist replies reply respond disqus discussion cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations pagination pager copyright legal disclaimer search "
    "searchbox skip hidden tags paywall".split()
)
_NEUTRAL = frozenset(
    "list item items body box block section wrapper wrap container content inner outer area bar top bottom left right main page site global user reader form links link posts articles "
    "stories news text group row col column panel slot unit zone primary secondary first last bottom head foot post article the on to in and a s js".split()
)
_PART = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def names_furniture(names: str) -> bool:
    """Whether one of the class names or ids is made of words for page furniture, and others that say nothing, alone."""
    for name in names.split():
        parts = {x.lower() for x in _PART.split(name) if x}
        if parts & _FURNITURE and parts <= _FURNITURE | _NEUTRAL and not (parts & {"no", "has", "with"}):
            return True
    return False


@dataclass(slots=True)
class Region:
    parent: int
    tag: str
    names: str = ""
    unseen: bool = False
    #: Furniture by its element or role, by its names, a header, (in) an announced article.
    aside: bool = False
    named: bool = False
    header: bool = False
    announced: bool = False


class _Reader(HTMLParser):
    """Collects `lines`, (text, tags, link characters, region), and `regions`; a region's parent comes before it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.regions = [Region(0, "")]
        self.stack: list[tuple[str, int]] = []  # tag, region
        self.open: Counter[str] = Counter()
        self.region = self.links = 0
        self.text: list[str] = []
        self.tags = self.linked = 0

    def flush(self) -> None:
        if self.text:
            line = " ".join("".join(self.text).split())
            if line:
                self.lines.append((line, self.tags, self.linked, self.region))
                self.tags = self.linked = 0
            self.text.clear()

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)  # as browsers do; the base class gives up on those that it doesn't know

    def _pop(self, at: int) -> None:
        if any(tag in _BLOCK for tag, _ in self.stack[at:]):
            self.flush()
        for tag, _ in self.stack[at:]:
            self.links -= tag == "a"
            self.open[tag] -= 1
        del self.stack[at:]
        self.region = self.stack[-1][1] if self.stack else 0

    def _find(self, tags: frozenset[str] | set[str], stop: frozenset[str] | set[str]) -> int | None:
        if not any(self.open[tag] for tag in tags):
            return None
        for k in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[k][0]
            if tag in tags:
                return k
            if tag in stop:
                return None
        return None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in _CLOSES_P and (at := self._find({"p"}, _REGION - {"p", "blockquote"})) is not None:
            self._pop(at)
        elif tag == "li" and (at := self._find({"li"}, {"ul", "ol", "menu", "dir"})) is not None:
            self._pop(at)
        elif tag in ("dt", "dd") and (at := self._find({"dt", "dd"}, {"dl"})) is not None:
            self._pop(at)
        elif tag in ("td", "th", "tr") and (at := self._find({"td", "th"} if tag != "tr" else {"tr"}, {"table"})) is not None:
            self._pop(at)
        elif tag == "body" and (at := self._find({"head"}, set())) is not None:
            self._pop(at)
        if tag in _BLOCK:
            self.flush()
        if tag in _VOID:
            return
        here = self.regions[self.region]
        new = Region(self.region, tag, "", here.unseen or tag in _UNSEEN, here.aside or tag in _BOILER, here.named, here.header, here.announced)
        new.header |= tag == "header" and not here.announced
        if attrs and tag not in ("html", "body"):
            own = dict(attrs)
            new.names = f"{own.get('class') or ''} {own.get('id') or ''}".strip()
            new.named |= bool(new.names) and names_furniture(new.names)
            role = (own.get("role") or "").lower()
            new.aside |= role in _ROLES
            new.announced |= role in ("main", "article")
            new.unseen |= "hidden" in own or own.get("aria-hidden") == "true" or bool(_HIDDEN.search(own.get("style") or ""))
        if tag == "main":  # it may stand in a wrapper that is named for its layout
            new.named = False
        new.announced = (new.announced or tag in _CONTENT) and not (new.aside or new.named)
        changed = (new.unseen, new.aside, new.named, new.header) != (here.unseen, here.aside, here.named, here.header)
        if changed or tag in _REGION and tag != "p" or new.announced and not here.announced:
            self.regions.append(new)
            self.region = len(self.regions) - 1
        self.links += tag == "a"
        self.open[tag] += 1
        self.stack.append((tag, self.region))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash closes nothing but void elements in HTML

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in _VOID:
            if tag == "br":
                self.flush()
            return
        stop = set() if tag in _REGION and tag != "p" or tag in ("html", "head", "body") else _REGION - {tag, "p", "blockquote"}
        at = self._find({tag}, stop)
        if at is not None:
            self._pop(at)
        elif tag in _BLOCK:
            self.flush()

    def handle_data(self, data: str) -> None:
        if self.regions[self.region].unseen:
            return
        self.text.append(data)
        if self.links:
            self.linked += len(data)


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel)[reach : reach + len(values)]
    return np.convolve(values, kernel)[reach : reach + len(values)] / weight


def ratios(lines: list[tuple[str, int, int, int]]) -> np.ndarray:
    """Text outside links over tags, for each line."""
    return np.asarray([max(0, len(text) - linked) / max(1, tags) for text, tags, linked, _ in lines], float)


def clusters(lines: list[tuple[str, int, int, int]]) -> list[tuple[int, int]]:
    """Runs of lines whose smoothed ratio is above the threshold: where each begins and ends."""
    smoothed = smooth(ratios(lines))
    dense = np.concatenate(([False], (smoothed > 0) & (smoothed >= SHARE * float(smoothed.std())), [False])).astype(np.int8)
    steps = np.diff(dense)
    return list(zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist()))


def _enclosing(regions: list[Region], some: set[int]) -> int:
    """The least region that encloses all of `some`."""
    heap = [-r for r in some]
    heapq.heapify(heap)
    while True:
        low = -heapq.heappop(heap)
        while heap and heap[0] == -low:
            heapq.heappop(heap)
        if not heap:
            return low
        heapq.heappush(heap, -regions[low].parent)


def choose(lines: list[tuple[str, int, int, int]], regions: list[Region]) -> list[str]:
    """The lines of the content regions."""
    seen = [x for x in lines if not regions[x[3]].aside]
    rest = [x for x in seen if not regions[x[3]].named]
    seen = rest or seen
    body = [x for x in seen if not regions[x[3]].header] or seen
    if not body:
        return []
    weight = lambda x: max(0, len(x[0]) - x[2])
    runs = [body[a:b] for a, b in clusters(body)]
    if not runs:
        return []
    heaviest = max(sum(map(weight, run)) for run in runs)
    heavy = [run for run in runs if sum(map(weight, run)) >= HEAVY * heaviest]
    kind = lambda r: (regions[r].parent, regions[r].tag, regions[r].names)
    like = {kind(x[3]) for run in heavy for x in run if x[3]}
    chosen = [run for run in runs if run in heavy or any(x[3] and kind(x[3]) in like for x in run)]
    chosen.append([x for x in body if regions[x[3]].names and kind(x[3]) in like])
    said = [x for run in chosen for x in run if regions[x[3]].announced]
    if 2 * sum(map(weight, said)) >= sum(map(weight, [x for run in chosen for x in run])) and said:
        chosen = [said]
    marked = {x[3] for run in chosen for x in run}
    root = _enclosing(regions, marked)
    while regions[root].tag not in _CONTAINER and root:
        root = regions[root].parent
    announced = regions[root].announced
    while announced and regions[regions[root].parent].announced:
        root = regions[root].parent
    # the region below the root that each region is in: the root for itself, -1 outside
    below = [-1] * len(regions)
    below[root] = root
    for r in range(1, len(regions)):
        if r != root and below[regions[r].parent] >= 0:
            below[r] = r if regions[r].parent == root else below[regions[r].parent]
    inside = [x for x in seen if below[x[3]] >= 0]
    if announced:
        return [x[0] for x in inside]
    touched = {below[r] for r in marked}
    places = [k for k, x in enumerate(inside) if x[3] in marked]
    total, linked = Counter(), Counter()
    for text, _, links, r in inside:
        total[below[r]] += len(text)
        linked[below[r]] += links
    out = []
    for k, x in enumerate(inside):
        part = below[x[3]]
        if part != root and part not in touched:
            between = places[0] < k < places[-1] or regions[part].tag not in _CONTAINER or regions[part].header and root and regions[root].tag != "body"
            if not between or linked[part] > LINKED * total[part]:
                continue
        elif regions[x[3]].header and (not root or regions[root].tag == "body"):
            continue
        out.append(x[0])
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return "\n".join(choose(reader.lines, reader.regions))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars) for each row; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], names=["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "id long, url string, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})
