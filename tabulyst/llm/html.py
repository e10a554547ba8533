"""Main text of web pages by composite text density.

A page becomes a tree without elements that never carry an article (menus, scripts, forms, and adverts and
the like by class or id, unless such an element is a wrapper, as it holds a main element, an article element of at least half of the
text of the longest, or most of the page's unlinked characters: then density decides). Every node has characters, tags, characters in links and link tags, and from
them a link-adjusted density of characters per tag. The node with the greatest sum of child densities
is the article; the least density between it and the body is the threshold above which other parts
of the page add the best node below them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.frames import pick

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split())
#: Elements that end an open paragraph when they start.
ENDS_PARAGRAPH = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "legend"}
#: Start tags that end an open element of their kind, up to the container named.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
SCOPES = frozenset("html body table td th caption button object applet marquee".split())
NOISE = frozenset(
    "head nav footer aside form script style noscript template iframe svg canvas button select textarea input menu "
    "dialog object embed audio video map title".split())
_NOISE_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|banner\w*|sponsor\w*|promo\w*|sidebar\w*|menu\w*|nav|navbar|navigation|footer|"
    r"masthead|breadcrumbs?|comments?|comment-\w+|replies|disqus|share|sharing|social|related|recommended|newsletter|"
    r"subscribe|subscription|cookies?|consent|gdpr|notice|notification|alert|popup|modal|widget|toolbar|pagination|pager|"
    r"login|signup|search|copyright|skip-link)(?:$|[\s_-])", re.I)
_KEPT = frozenset("html body article main".split())
#: Blocks that are a part of an article, never all of it.
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 hgroup li dt dd pre blockquote address caption figcaption summary legend tr".split())
_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_SCOPE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())


class Page:
    """Tree of a page: per node parent, name, whether it is noise; text and block breaks in page order."""

    def __init__(self, html: str):
        self.parent, self.name, self.noise, self.named = [-1], ["#page"], [False], [False]
        self.events: list[tuple[int, str | None]] = []
        self.open = [0]
        self.count: dict[str, int] = {}
        self._parse(html)
        self._discard_named()

    def _start(self, name: str, attributes: str) -> int:
        parent = self.open[-1]
        noise, named = self.noise[parent] or name in NOISE, False
        if not noise and name == "header":
            noise = not any(self.name[i] in ("article", "main") for i in self.open)
        if not noise and attributes and name not in _KEPT:
            for key, value in _NAMED.findall(attributes):
                value = value.strip("\"'")
                if key.lower() == "role":
                    noise |= value.lower() in _SCOPE_ROLES
                else:
                    named |= bool(_NOISE_NAME.search(value))
        self.parent.append(parent)
        self.name.append(name)
        self.noise.append(noise)
        self.named.append(named)
        return len(self.parent) - 1

    def _discard_named(self) -> None:
        """Make noise of named elements and all below them, but for wrappers of the main part."""
        if not any(self.named):
            return
        n = len(self.parent)
        plain, linked = [0] * n, [False] * n
        for i in range(1, n):
            linked[i] = linked[self.parent[i]] or self.name[i] == "a"
        for node, text in self.events:
            if text and not linked[node]:
                plain[node] += len(" ".join(text.split()))
        for i in range(n - 1, 0, -1):
            if not self.noise[i]:
                plain[self.parent[i]] += plain[i]
        # Comments and teasers are article elements too, shorter than what they belong to.
        longest = max((plain[i] for i in range(n) if self.name[i] == "article"), default=0)
        holds = [x == "main" or x == "article" and 2 * plain[i] >= longest for i, x in enumerate(self.name)]
        for i in range(n - 1, 0, -1):
            if not self.noise[i]:
                holds[self.parent[i]] |= holds[i]
        for i in range(1, n):
            wraps = holds[i] or 2 * plain[i] > plain[0]
            self.noise[i] |= self.noise[self.parent[i]] or self.named[i] and not wraps
        self.events = [(node, text) for node, text in self.events if text is None or not self.noise[node]]

    def _close(self, names: set[str] | frozenset[str], until: set[str] | frozenset[str]) -> None:
        """End the innermost open element of these names, and all in it, unless a container lies between."""
        if not any(self.count.get(x) for x in names):
            return
        for at in range(len(self.open) - 1, 0, -1):
            name = self.name[self.open[at]]
            if name in names:
                for node in self.open[at:]:
                    self.count[self.name[node]] -= 1
                if name in BLOCK or any(self.name[x] in BLOCK for x in self.open[at:]):
                    self.events.append((0, None))
                del self.open[at:]
                return
            if name in until:
                return

    def _text(self, text: str) -> None:
        node = self.open[-1]
        if text and not self.noise[node]:
            self.events.append((node, unescape(text)))

    def _parse(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            tag = html.find("<", at)
            if tag < 0:
                self._text(html[at:])
                return
            if tag > at:
                self._text(html[at:tag])
            after = html[tag + 1 : tag + 2]
            if after == "!" or after == "?":
                end = html.find("-->", tag + 4) + 2 if html.startswith("<!--", tag) else html.find(">", tag)
                at = end + 1 if end > tag else n
                continue
            match = _TAG.match(html, tag)
            if not match:
                if not (after.isalpha() or after == "/"):
                    self._text("<")
                    at = tag + 1
                    continue
                end = html.find(">", tag)  # a tag with an open quote ends at the next bracket
                at = end + 1 if end > 0 else n
                continue
            at, name = match.end(), match[1].lower()
            if after == "/":
                self._end(name)
                continue
            if name in ENDS_PARAGRAPH:
                self._close({"p"}, SCOPES)
            if name in SIBLINGS:
                self._close(*SIBLINGS[name])
            node = self._start(name, match[2])
            if name in BLOCK:
                self.events.append((0, None))
            elif name == "br":
                self._text(" ")
            if name in VOID:
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(html, at)
                if not end:
                    return
                close = html.find(">", end.start())
                at = close + 1 if close > 0 else n
                continue
            self.open.append(node)
            self.count[name] = self.count.get(name, 0) + 1

    def _end(self, name: str) -> None:
        if name not in ("html", "body"):  # what follows them still belongs to the body
            self._close({name}, SCOPES - {name} if name not in SCOPES else frozenset())


def _densities(page: Page) -> tuple[list[float], list[float], int]:
    """(density, sum of child densities) of every node, and the body."""
    n = len(page.parent)
    own, chars, links = [0] * n, [0] * n, [0] * n
    tags, link_tags, linked = [0] * n, [0] * n, [False] * n
    for i in range(1, n):
        linked[i] = linked[page.parent[i]] or page.name[i] == "a"
    for node, text in page.events:
        if text:
            size = len(" ".join(text.split()))
            own[node] += size
            if linked[node]:
                links[node] += size
    for i in range(n):
        chars[i] = own[i]
    for i in range(n - 1, 0, -1):
        if not page.noise[i]:
            up = page.parent[i]
            chars[up] += chars[i]
            links[up] += links[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + (page.name[i] == "a")
    body = next((i for i in range(n) if page.name[i] == "body"), 0)
    share = links[body] / chars[body] if chars[body] else 0.0
    density, sums = [0.0] * n, [float(x) for x in own]
    for i in range(n - 1, -1, -1):
        if chars[i] and not page.noise[i]:
            c, t, lc, lt = chars[i], max(tags[i], 1), max(links[i], 1), max(link_tags[i], 1)
            base = math.log(c / max(c - links[i], 1) * lc + share * c + math.e)
            density[i] = c / t * math.log(c / lc * t / lt) / math.log(base)
            if i:
                sums[page.parent[i]] += density[i]
    return density, sums, body


def _marked(page: Page) -> list[bool]:
    """Which nodes are content."""
    density, sums, body = _densities(page)
    n = len(page.parent)
    inside = [False] * n
    inside[body] = True
    for i in range(body + 1, n):
        inside[i] = inside[page.parent[i]] and not page.noise[i]
    best = list(range(n))  # node of the greatest sum at or below each
    for i in range(n - 1, body, -1):
        whole = page.name[best[i]] in BLOCK and page.name[best[i]] not in PARTS
        if inside[i] and whole and sums[best[i]] > sums[best[page.parent[i]]]:
            best[page.parent[i]] = best[i]
    threshold, at = math.inf, best[body]
    while at >= 0:
        threshold = min(threshold, density[at])
        if at == body:
            break
        at = page.parent[at]
    content = [False] * n
    for i in range(body, n):
        if i == best[body] or inside[i] and density[i] >= threshold and density[i] > 0:
            content[best[i]] = True
    for i in range(1, n):
        content[i] = (content[i] or content[page.parent[i]]) and not page.noise[i]
    return content


def main_text(html: str) -> str:
    """Article text of a page, a line per block; empty if there is none."""
    page = Page(html)
    content = _marked(page)
    blocks, parts = [], []
    for node, text in [*page.events, (0, None)]:
        if text is None:
            if line := " ".join("".join(parts).split()):
                blocks.append(line)
            parts = []
        elif content[node]:
            parts.append(text)
    return "\n".join(blocks)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    A null or empty page has an empty text, as has one without content; a page without tags is its own text. Repeated
    pages are each extracted. Extra columns are ignored, whatever their names. No shuffle.
    """
    plain = pick(pages, {"page_id": page_id, "url": url, "html": html})
    kinds = {x.name: x.dataType.simpleString() for x in plain.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "") for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    found = plain.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
