"""Main-text extraction: flat text blocks, classified by a decision tree.

A page becomes a flat list of text blocks, cut at block-level tags. A block's features are its own word count and link
density, those of the blocks before and after it, and what the open containers say of it. The tree is
grown (Gini, at most ``MAX_DEPTH`` levels) on the small labelled table ``LABELLED`` below, in which the blocks that
belong to the article are marked. It is grown once for a worker, in milliseconds.

Rows: null or empty html gives an empty text; unclosed tags, truncated pages and very long ones are read to
their end; repeated rows keep a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm._shared import text_batches

FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after", "in_main", "in_boiler", "in_heading")
MAX_DEPTH = 5

_TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_PLAIN_END, _QUOTED_END = re.compile("[^>\"']*+>"), re.compile("(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
_SPECIAL = re.compile("[>\"']")
#: Elements whose content is no text of the page.
_HIDDEN_TAGS = frozenset("script style noscript template svg iframe textarea select title button object canvas audio video".split())
_HIDDEN_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in _HIDDEN_TAGS}
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden|itemprop)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[A-Za-z]+")
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input link meta".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BOILER_TAGS = frozenset("nav header footer aside form menu dialog fieldset head".split())
_MAIN_TAGS = frozenset("article main".split())
_VOID = frozenset("br hr img input link meta wbr area base col embed source track param".split())
#: Words of a container's class, id or role that speak against or for it.
_BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent contentinfo cookie cookies copyright disqus dialog disclaimer footer "
    "form gdpr header hidden login masthead menu menubar modal nav navbar navigation newsletter notice notices outbrain overlay pagination paywall popup privacy promo promoted promotion related "
    "reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola tags teaser toolbar topbar widget complementary".split()
)
_MAIN_WORDS = frozenset("article content entry main post story articlebody body text maincontent".split())


def _hints(tag: str, attrs: str) -> tuple[bool, bool]:
    """Whether a container is boilerplate, and whether it is the article's. What the whole page is called says neither."""
    if tag in ("html", "body"):
        return False, False
    boiler, main = tag in _BOILER_TAGS, tag in _MAIN_TAGS
    if attrs:
        for name, value in _ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                boiler = True
            elif name != "itemprop" or value == "articlebody":
                words = _WORD.findall(value)
                boiler = boiler or any(w in _BOILER_WORDS for w in words)
                main = main or any(w in _MAIN_WORDS for w in words)
    return boiler, main and not boiler


class Tags:
    """The tags of a page, each found by looking at no part of the page more than a few times, however broken it is.

    A tag ends at the first ``>`` outside quotes, or, if its quotes leave none, at the first ``>`` at all.
    """

    def __init__(self, page: str):
        self.page, self.last_end, self.last_start = page, page.rfind(">"), page.rfind("<")
        self.spots: list[int] | None = None

    def _end(self, at: int) -> int:
        """The place after the tag whose name ends at ``at``; some ``>`` follows."""
        if m := _PLAIN_END.match(self.page, at):
            return m.end()
        if self.spots is None:
            if m := _QUOTED_END.match(self.page, at):
                return m.end()
            self._index()
        i = bisect_left(self.spots, at)
        end = self.ends[i] if i < len(self.spots) else -1
        return end + 1 if end >= 0 else self.page.index(">", at) + 1

    def _index(self) -> None:
        """For each ``>`` and quote, read from outside quotes, the ``>`` that ends a tag (or -1): one pass from the back."""
        self.spots = [m.start() for m in _SPECIAL.finditer(self.page)]
        self.ends, after = [-1] * (len(self.spots) + 1), {}
        for i in range(len(self.spots) - 1, -1, -1):
            c = self.page[self.spots[i]]
            if c == ">":
                self.ends[i] = self.spots[i]
            else:
                self.ends[i] = self.ends[after[c] + 1] if c in after else -1
                after[c] = i

    def __iter__(self) -> Iterator[tuple[int, int, bool, str | None, str]]:
        """(start, end, closing, name or None where there is nothing but markup to skip, attributes)."""
        page, at = self.page, 0
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start) or page.startswith("<![CDATA[", start):
                close, skip = ("-->", 4) if page[start + 2] == "-" else ("]]>", 9)
                end = page.find(close, start + skip)
                at = len(page) if end < 0 else end + 3
                yield start, at, False, None, ""
                continue
            m = _TAG.match(page, start)
            if m is None:
                if page[start + 1 : start + 2] in ("!", "?"):
                    at = page.index(">", start) + 1 if start < self.last_end else len(page)
                    yield start, at, False, None, ""
                else:
                    at = start + 1
                continue
            if m.end() > self.last_end:
                # A tag that the page's end cuts off; with more of them behind it, plain text.
                if start < self.last_start:
                    at = start + 1
                    continue
                yield start, len(page), False, None, ""
                return
            name, closing, at = m[1].lower(), page[start + 1] == "/", self._end(m.end())
            if name in _HIDDEN_TAGS and not closing:
                found = _HIDDEN_END[name].search(page, at)
                at = found.end() if found else len(page)
                yield start, at, False, None, ""
            else:
                yield start, at, closing, name, page[m.end() : at - 1]


def blocks(page: str | None) -> list[tuple[str, float, bool, bool, bool]]:
    """(text, link density, in main, in boilerplate, heading) of each block, in page order."""
    page = page or ""
    found: list[tuple[str, float, bool, bool, bool]] = []
    open_tags: list[tuple[str, bool, bool]] = []
    opened: Counter[str] = Counter()
    boiler = main = links = 0
    heading = False
    pieces: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        if pieces:
            raw = "".join(pieces)
            pieces.clear()
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                found.append((text, min(1.0, linked / max(1, len(text))), main > 0, boiler > 0, heading))
        linked = 0

    at = 0
    for start, end, closing, tag, attrs in Tags(page):
        if start > at:
            piece = page[at:start]
            pieces.append(piece)
            if links:
                linked += len(piece.strip())
        at = end
        if tag is None:
            continue
        if tag in _INLINE:
            if tag == "a":
                links = 0 if closing else 1
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        close()
        if tag in _HEADINGS:
            heading = not closing
        elif tag == "p":
            heading = False
        elif tag in _VOID or attrs.endswith("/"):
            continue
        elif not closing:
            b, a = _hints(tag, attrs)
            open_tags.append((tag, b, a))
            opened[tag] += 1
            boiler += b
            main += a
        elif opened[tag]:
            links = 0
            while open_tags:
                t, b, a = open_tags.pop()
                opened[t] -= 1
                boiler -= b
                main -= a
                if t == tag:
                    break
    if at < len(page):
        pieces.append(page[at:])
    close()
    return found


def features(found: list[tuple[str, float, bool, bool, bool]]) -> np.ndarray:
    out = np.zeros((len(found), len(FEATURES)))
    if found:
        words = np.array([b[0].count(" ") + 1 for b in found], dtype=float)
        links = np.array([b[1] for b in found])
        out[:, 0], out[:, 1] = words, links
        out[1:, 2], out[1:, 3] = words[:-1], links[:-1]
        out[:-1, 4], out[:-1, 5] = words[1:], links[1:]
        out[:, 6:] = [b[2:] for b in found]
    return out


_P = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
#: The labelled table: a page, and by hand for each of its blocks in order whether it belongs to the article (+) or not (-).
LABELLED: list[tuple[str, str]] = [
    (f"<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav><article><h1>Title</h1><p>{_P}</p><p>Short.</p></article><footer>Imprint and terms</footer>", "--+++-"),
    (f"<div class=ad>Buy the best {_P}</div><main><h2>Head</h2><p>{_P}</p><p>Ok.</p><p>See <a href=x>this</a> too.</p></main><aside><p>{_P}</p></aside>", "-++++-"),
    (f"<header><p>Site name</p><p>{_P}</p></header><div><h1>Plain page</h1><p>{_P}</p><p>{_P}</p></div><div><a href=a>one</a> <a href=b>two</a></div>", "--+++-"),
    (f"<div><p>{_P}</p><p>{_P * 2}</p><p>A few words.</p><p>{_P}</p></div><ul><li><a href=a>More</a></li><li><a href=b>Also this one</a></li></ul>", "++++--"),
    (f"<article><p>{_P}</p><form><p>Sign up for mail</p></form><div class=comments><p>{_P}</p><p>Nice.</p></div></article>", "+---"),
    (f"<article><h1>With remarks</h1><p>{_P * 3}</p><div id=sidebar><p>{_P}</p></div><blockquote>Said well.</blockquote><ul><li>First point</li><li>Second point here</li></ul></article>", "++-+++"),
    ("<ul><li><a href=a>A</a></li><li><a href=b>B</a></li><li><a href=c>C d</a></li></ul><p><a href=z>All of these links in a long row of words that goes on and on</a></p>", "----"),
    (f"<div class=cookie-notice><p>{_P}</p></div><div class=post-content><p>Hi.</p><p><a href=x>A link of its own</a></p><p>{_P}</p></div><div class=related><p>{_P}</p></div>", "-+++-"),
    (f"<nav><a href=a>Top</a></nav><article><h1>Ends</h1><p>{_P}</p><p>Be.</p></article><footer>Imprint</footer>", "-+++-"),
    ("<aside>Ad</aside><article><h1>Tiny</h1><p>Of it.</p><p>Yes.</p></article><footer>Bye</footer>", "-+++-"),
    ("<main><p>Go.</p><p>On.</p></main><div class=banner>Deal</div>", "++-"),
    ("<article><p>Only this.</p></article>", "+"),
    ("<p>Menu</p><div><a href=a>x</a></div><div>Copyright</div>", "---"),
    (f"<footer><p>{_P * 2}</p></footer><nav>{_P}</nav><form>{_P}</form>", "---"),
]


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    x, y = [], []
    for page, marks in LABELLED:
        found = blocks(page)
        if len(found) != len(marks):
            raise ValueError(f"{len(marks)} labels for {len(found)} blocks of {page[:40]!r}")
        x.append(features(found))
        y.append(np.array([m == "+" for m in marks]))
    return np.vstack(x), np.concatenate(y)


def grow_tree(x: np.ndarray, y: np.ndarray, depth: int = MAX_DEPTH):
    """A nested (feature, cut, tree at or below, tree above) or the share of article blocks in a leaf."""
    share = float(y.mean()) if len(y) else 0.0
    if depth == 0 or share in (0.0, 1.0):
        return share
    best = (2 * share * (1 - share) * len(y) - 1e-9, None, None)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            low = x[:, f] <= cut
            loss = sum(2 * p * (1 - p) * n for p, n in ((y[low].mean(), low.sum()), (y[~low].mean(), (~low).sum())))
            if loss < best[0]:
                best = (loss, f, cut)
    if best[1] is None:
        return share
    low = x[:, best[1]] <= best[2]
    return best[1], best[2], grow_tree(x[low], y[low], depth - 1), grow_tree(x[~low], y[~low], depth - 1)


def decide(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree > 0.5)
    out, low = np.zeros(len(x), dtype=bool), x[:, tree[0]] <= tree[1]
    out[low], out[~low] = decide(tree[2], x[low]), decide(tree[3], x[~low])
    return out


@lru_cache(maxsize=1)
def trained_tree():
    return grow_tree(*labelled_table())


def main_text(page: str | None) -> str:
    found = blocks(page)
    kept = decide(trained_tree(), features(found))
    return "\n".join(b[0] for b, k in zip(found, kept) if k)


def extract(pages: DataFrame, markup: str = "html", url: str = "url", key: str = "page_id") -> DataFrame:
    """page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_batches(batch, "html", 16 << 20):
                rows = batch.slice(lo, hi - lo)
                texts = [main_text(x) for x in rows.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())], names=["page_id", "url", "text", "n_chars"])

    plain = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(markup).cast("string").alias("html"))
    return plain.mapInArrow(run, "page_id long, url string, text string, n_chars long")
