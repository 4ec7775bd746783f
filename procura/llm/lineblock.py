"""Main text of web pages by the distribution of text over lines.

Markup is stripped first: each block element starts and ends a line, elements that
are never the article (menus, forms, scripts, adverts, comments ...) leave a blank
line, and character references are decoded.  The lengths of WINDOW neighbouring lines
are summed; where the sums rise to a surge a region of text begins, where they dive to
nothing it ends, and the text between is kept.

Text in links does not count, and a surge takes SURGE characters; so on every page.
The surging text then tells the article's element, and what surges beside it (notices)
goes.  Where the page names its articles (``article``, else ``main``), it is the one
with most surging text (of equal ones that with most text), and its lines that lie
outside the regions, such as short lines set apart, are put back: they are the
article's.  Elsewhere it is the element that holds most of the surging text.

Defined cases: null and empty html, and pages without text, give an empty text.
Unclosed elements end with their parent, an unclosed dropped one also where an article
begins; an unclosed comment or script runs to the end of the page.  Pages are read
whole, in one pass, whatever their length; repeated pages are rows of their own.
"""

from __future__ import annotations

import html
import re
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procura.llm.common import per_text

WINDOW = 3
SURGE = 80
#: elements nest no deeper than in browsers; beyond, one only ends a line
DEEPEST = 512
#: an element holds "most" of the surging text from this share on
MOST = 0.6

BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody tfoot thead tr ul".split())
SPACES = frozenset("br td th wbr img input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: one that is open ends where the next of its name begins
ENDED = frozenset("p li dd dt option tr".split())
#: their content is not markup
RAW = frozenset("script style title textarea noscript iframe template xmp noembed noframes".split())
DROPPED = frozenset("head nav footer aside form menu button select option dialog svg canvas object audio video".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar tablist toolbar".split())
#: words of a class or id
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored promo promoted promotion "
                    "banner".split())
COMMENTS = frozenset("comment comments commentlist disqus respond replies reply".split())
NAMES = ADVERTS | COMMENTS | frozenset(
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login sidebar menu menus nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager masthead topbar footer share sharing social related recommended recommendations widget "
    "widgets toolbar skip".split())
#: a class that tells what else is on the page
ELSEWHERE = frozenset("has with without no".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*+>""", re.S)
_PLAIN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?/][^>]*+>""", re.S)
_NAMED = re.compile(r"""(?<![^\s"'/])(class|id|role|style|aria-hidden|hidden)(?![^\s=/])(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _words(name: str) -> set[str]:
    return {w.lower() for w in _WORD.findall(name)}


def never_article(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is none of the article's text; ``inside`` an article."""
    if tag in DROPPED or tag == "header" and not inside:
        return True
    if tag in ("html", "body", "main") or not attributes.strip():
        return False
    for key, value in _NAMED.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value, re.I) or key == "role" and value.lower() in ROLES:
            return True
        if key in ("class", "id"):
            for name in value.split():
                words = _words(name)
                if words & ELSEWHERE:
                    continue
                if words & (ADVERTS | COMMENTS if tag == "article" else NAMES):
                    return True
                if "header" in words and not inside and not words & {"article", "entry", "post", "content", "story"}:
                    return True
    return False


class _Page:
    """Lines of a page: text, characters outside links, and the elements around."""

    def __init__(self, page: str):
        self.lines: list[tuple[str, int, tuple]] = []
        self.buffer: list[str] = []
        self.free = 0
        self.open: list[tuple[str, int]] = []      # block elements around, numbered
        self.around: tuple | None = ()             # their numbers; None: changed
        self.scopes: dict[int, str] = {}           # articles and mains
        self.links = self.number = 0
        self.dropped = None                        # depth at which a dropped element began
        self.read(page)

    def text(self, raw: str) -> None:
        if self.dropped is None and raw:
            self.buffer.append(raw)
            if not self.links:
                self.free += len(html.unescape(raw).strip()) if "&" in raw else len(raw.strip())

    def end_line(self) -> None:
        if self.dropped is None:
            line = " ".join(html.unescape("".join(self.buffer)).split())
            if self.around is None:
                self.around = tuple(n for _, n in self.open)
            self.lines.append((line, self.free if line else 0, self.around))
            self.buffer, self.free = [], 0

    def start(self, tag: str, attributes: str) -> None:
        inside = bool(self.scopes) and any(n in self.scopes for _, n in self.open)
        drop = never_article(tag, attributes, inside)
        if self.dropped is not None and tag in ("article", "main") and not drop and self.open[self.dropped][0] not in DROPPED:
            # an unclosed notice does not swallow the article
            self.close(self.dropped)
        if tag in BLOCKS or drop or self.dropped is not None:
            self.end_line()
            if tag in ENDED and self.open and self.open[-1][0] == tag:
                self.close(len(self.open) - 1)
            if tag not in VOID and len(self.open) < DEEPEST:
                self.number += 1
                self.open.append((tag, self.number))
                self.around = None
                if drop and self.dropped is None:
                    self.dropped = len(self.open) - 1
                elif self.dropped is None and tag in ("article", "main"):
                    self.scopes[self.number] = tag
        elif tag == "a":
            self.links = 1
        elif tag in SPACES:
            self.text(" ")

    def close(self, depth: int) -> None:
        del self.open[depth:]
        self.around = None
        if self.dropped is not None and depth <= self.dropped:
            self.dropped = None

    def end(self, tag: str) -> None:
        if tag == "a":
            self.links = 0
        elif tag in SPACES:
            self.text(" ")
        depth = next((i for i in reversed(range(len(self.open))) if self.open[i][0] == tag), None)
        if depth is not None:
            self.end_line()
            self.close(depth)
            self.links = 0

    def read(self, page: str) -> None:
        at, token = 0, _TOKEN
        while True:
            begin = page.find("<", at)
            if begin < 0:
                break
            found = token.match(page, begin)
            if found is None and token is _TOKEN:
                # a quote that never ends: from here on quotes mean nothing
                if page[begin + 1:begin + 2].isalpha() or page[begin + 1:begin + 2] == "/":
                    token = _PLAIN
                    found = token.match(page, begin)
            if found is None:
                # no markup: the sign is text, or the page ends inside a tag
                if (page[begin + 1:begin + 2].isalpha() or page[begin + 1:begin + 2] in ("/", "!", "?")) and page.find(">", begin) < 0:
                    self.text(page[at:begin])
                    at = len(page)
                    break
                self.text(page[at:begin + 1])
                at = begin + 1
                continue
            self.text(page[at:begin])
            at = found.end()
            if found[2] is None:
                continue
            tag = found[2].lower()
            if found[1]:
                self.end(tag)
                continue
            if tag in RAW:
                close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
                self.end_line()
                at = len(page) if close is None else close.start()
                if close is not None:
                    gt = page.find(">", at)
                    at = len(page) if gt < 0 else gt + 1
                continue
            self.start(tag, found[3])
        self.text(page[at:])
        self.end_line()


def between(lengths: list[int], surge: int) -> list[bool]:
    """Which lines lie between the point where the sums of WINDOW lines rise from
    nothing and the dive back to nothing, for surges that reach ``surge``."""
    total = [0, *accumulate(lengths)]
    n, kept, begin, peak = len(lengths), [False] * len(lengths), 0, 0
    for i in range(n + 1):
        window = total[min(i + WINDOW, n)] - total[i]
        if window == 0:
            kept[begin:i] = [peak >= surge] * (i - begin)
            begin, peak = i + 1, 0
        peak = max(peak, window)
    return kept


def main_text(page: str | None) -> str:
    """The article of a page: its blocks joined by an empty line."""
    if not page:
        return ""
    read = _Page(page)
    lines = read.lines
    surges = between([x[1] for x in lines], SURGE)
    for kind in ("article", "main"):
        size: dict[int, tuple[int, int]] = {}
        for (text, free, around), surge in zip(lines, surges):
            # of nested ones the outer
            scope = next((n for n in around if read.scopes.get(n) == kind), None)
            if scope is not None and text:
                surging, whole = size.get(scope, (0, 0))
                size[scope] = surging + free * surge, whole + len(text)
        if size:
            best = max(size, key=lambda n: (size[n], -n))
            # kept regions and, put back, the element's lines outside of them
            return "\n\n".join(x[0] for x in lines if best in x[2] and x[0])
    kept = inner = [x for x, k in zip(lines, surges) if k and x[0]]
    for depth in range(DEEPEST):
        size = {}
        for _, free, around in inner:
            if len(around) > depth:
                size[around[depth]] = size.get(around[depth], 0) + free
        best = max(size, key=lambda n: (size[n], -n), default=None)
        if best is None or size[best] < MOST * sum(x[1] for x in inner):
            break
        beside = [x for x in inner if best not in x[2]]
        if any(between([x[1] for x in beside], SURGE)):
            # short lines (a title) stay
            kept = [x for x in kept if best in x[2]]
        inner = [x for x in inner if best in x[2]]
    return "\n\n".join(x[0] for x in kept)


def extract(pages: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``pages`` with ``text`` (its main text) and
    ``n_chars`` (code points); kept columns of these names give way."""
    keep = [k for k in keep if k not in ("text", "n_chars")]

    def start():
        def run(texts):
            made = [main_text(t) for t in texts]
            return made, [len(t) for t in made]
        return run

    renamed = pages.select(*keep, F.col("html").alias("text"))
    done = per_text(renamed, keep, {"_main": "string", "n_chars": "long"}, start)
    return done.withColumnRenamed("_main", "text")
