"""Main text of web pages: article blocks, and per host a suffix array against boilerplate."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floatlake.llm.common import Workspace, blocks, record_batch
from floatlake.llm.urls import url_host
from floatlake.llm.wordtable import WordTable, windows

#: Pages and characters that one suffix array is built over. Larger hosts are dealt to several.
CHUNK_PAGES = 512
CHUNK_CHARS = 8 << 20
#: Repeats shorter than this many tokens are no boilerplate, but for whole blocks that a name has nominated.
REPEAT_TOKENS = 8
#: Distinct pages a repeat must be on, and the share of the host's pages.
REPEAT_PAGES = 5
REPEAT_SHARE = 0.02
#: Inside an article also copies of articles repeat; there a repeat must be on this share of the pages.
ARTICLE_SHARE = 0.5
#: In a block nominated by a name, fewer pages do.
NOMINATED_PAGES = 3
#: A nominated element goes if this share of its text is in links.
LINK_SHARE = 0.5
#: Repeats that are broadcast at once; more are applied in several passes, each to its own hosts.
MOST_REPEATS = 1_000_000

_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_VALUE = re.compile(r"""=\s*(["'])""")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)
_UNFINISHED = re.compile(r"<[a-zA-Z/!][^<]*\Z")

# Elements by their role.
_DROPPED = {"nav", "aside", "footer", "form", "dialog", "menu"}
_BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup",
    "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody",
    "td", "tfoot", "th", "thead", "tr", "ul",
}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# What is left out up to the end tag; the first are text to a browser, and without an end tag go on to the page's end.
_RAW = {"script", "style", "noscript", "textarea", "title", "iframe"}
_SKIPPED = _RAW | {"template", "svg", "select", "button"}
# Roles that say what an element is.
_SIDE_ROLES = {"alertdialog", "banner", "complementary", "contentinfo", "dialog", "menu", "menubar", "navigation", "search"}
# Parts of class and id names. The first name nothing but side elements, also inside an article;
# the second are everyday words too; the third say nothing.
_SURE_NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "advertising", "breadcrumb", "breadcrumbs",
    "comment", "comments", "commentlist", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "masthead",
    "navbar", "newsletter", "pagination", "popup", "promo", "recommended", "related", "replies", "respond", "sidebar", "signup", "sponsor",
    "sponsored", "subscribe", "teaser", "toolbar", "topbar", "widget",
}
_EVERYDAY_NAMES = {
    "banner", "copyright", "disclaimer", "hidden", "login", "menu", "modal", "nav", "navigation", "notice", "notification", "overlay",
    "promotion", "search", "share", "sharing", "skip", "social",
}
_NEUTRAL_NAMES = {
    "area", "bar", "bottom", "box", "buttons", "container", "content", "area", "inner", "item", "items", "left", "links", "list", "main",
    "note", "outer", "page", "post", "posts", "right", "section", "site", "thread", "top", "wrap", "wrapper",
}
_SURE_STARTS = ("advert", "adsby", "breadcrumb", "cookie", "navbar", "newsletter", "promo", "sidebar", "sponsor", "subscri")
_CONTAINERS = {"article", "center", "details", "div", "dl", "header", "li", "main", "ol", "section", "table", "ul"}
# On a paragraph inside an article, a name counts only if it starts like this, or is that of adverts.
_NOTICE_STARTS = ("advert", "adsby", "cookie", "newsletter", "sponsor", "subscri")

#: What an element is: text, one that a name nominates, or one that is left out.
TEXT, NOMINATED, SIDE = range(3)


def _named(tag: str, value: str, inside: bool) -> int:
    """What one class, or the id, makes of an element.

    A name says what an element is if all its parts do (or say nothing): `comment-list`, `adBox`. With
    other words beside them (`share-price`, `ad-free-post`) parts only nominate, and so do, inside an article, everyday
    words. Inside an article only elements that hold others are judged, and paragraphs of notices.
    """
    parts = [x.lower() for x in _NAME_PART.findall(value)]
    sure = [x in _SURE_NAMES or x.startswith(_SURE_STARTS) for x in parts]
    side = [a or x in _EVERYDAY_NAMES for a, x in zip(sure, parts, strict=True)]
    if not any(side):
        return TEXT
    if inside and tag == "p":
        return SIDE if any(x in ("ad", "ads") or x.startswith(_NOTICE_STARTS) for x in parts) else TEXT
    if inside and tag not in _CONTAINERS:
        return TEXT
    counted = sure if inside else side
    return SIDE if all(a or x in _NEUTRAL_NAMES for a, x in zip(counted, parts, strict=True)) else NOMINATED


def _kind(tag: str, attributes: str, inside: bool = False) -> int:
    """What the attributes make of an element."""
    if not attributes or attributes == "/":
        return TEXT
    if tag in ("html", "body", "article", "main") and "comment" not in attributes.lower():
        return TEXT
    found = TEXT
    for match in _ATTRIBUTE.finditer(attributes):
        name, value = match[1].lower(), match[2] or match[3] or match[4] or ""
        if name == "class":
            found = max([found, *(_named(tag, x, inside) for x in value.split())])
        elif name == "id" and not (inside and tag == "p"):
            found = max(found, _named(tag, value, inside))
        elif name == "role" and value.strip().lower() in _SIDE_ROLES:
            return SIDE
        elif (name == "aria-hidden" and "true" in value.lower()) or (name == "style" and "display:none" in value.replace(" ", "").lower()):
            return SIDE
    return SIDE if "hidden" in attributes.lower() and _HIDDEN.search(attributes) else found


def _tag_end(source: str, at: int) -> int:
    """Where the `>` of a tag is, -1 if there is none. Quotes count right after `=` only, and if they are closed."""
    end = source.find(">", at)
    while end >= 0 and (quote := _VALUE.search(source, at, end)):
        at = source.find(quote[1], quote.end()) + 1
        if not at:
            return end
        if at > end:
            end = source.find(">", at)
    return end


def markup(source: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """`(start, end, tag, closing, attributes)` of each piece of markup, in one pass; comments have no tag.

    A script, style or the like is one piece, up to its end tag. A `<` that starts no tag is text.
    """
    at, never = 0, set()
    while (start := source.find("<", at)) >= 0:
        at = start + 1
        if source.startswith("!--", at):
            end = source.find("-->", at + 1)
            end = len(source) if end < 0 else end + 3
        elif source.startswith(("!", "?"), at):
            end = source.find(">", at) + 1
            if not end:
                return
        elif not (match := _TAG.match(source, start)):
            continue
        else:
            close = _tag_end(source, match.end())
            if close < 0:
                return
            tag, closing, end = match[2].lower(), bool(match[1]), close + 1
            attributes = source[match.end() : close]
            if closing or tag not in _SKIPPED or attributes.endswith("/") and tag not in _RAW or tag in never:
                yield start, end, tag, closing, attributes
                at = end
                continue
            found = _END_TAGS[tag].search(source, end)
            if found:
                end = found.end()
            elif tag in _RAW:
                end = len(source)
            else:
                never.add(tag)
                yield start, end, tag, closing, attributes
                at = end
                continue
        yield start, end, "", False, ""
        at = end


_END_TAGS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _SKIPPED}


@dataclass
class _Nominated:
    """An element that a name has nominated: where its blocks start, and how much of its text is in links."""

    tag: str
    first: int
    depth: int = 1
    chars: int = 0
    linked: int = 0


@dataclass
class _Page:
    """Blocks as they are read."""

    found: list[tuple[str, bool, bool]] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    articles: int = 0
    links: int = 0
    nominated: _Nominated | None = None

    def text(self, text: str) -> None:
        if text:
            self.parts.append(text)
            if self.nominated:
                own = len(text.split()) and len(text)
                self.nominated.chars += own
                self.nominated.linked += own if self.links else 0

    def close(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        self.parts.clear()
        if text:
            self.found.append((text, self.articles > 0, self.nominated is not None))

    def end_nominated(self) -> None:
        own = self.nominated
        self.close()
        self.nominated = None
        if own and own.linked and own.linked >= LINK_SHARE * own.chars:
            del self.found[own.first :]


def parse_page(source: str) -> list[tuple[str, bool, bool]]:
    """`(text, in an article, nominated)` of each block of visible text in page order, side elements left out.

    An article is an `article` or `main` element. Unclosed elements end with the next end tag of
    an element around them, or with the page. An element that looks like a side one by name but
    holds the page's first article is none. A nominated element mostly of links is a side one.
    """
    page = _Page()
    side, depth, named = "", 0, False
    seen_article = False
    at = 0
    for start, end, tag, closing, attributes in markup(source):
        if not side:
            page.text(source[at:start])
        at = end
        if not tag:
            continue
        if side:
            if tag == side:
                depth += -1 if closing else 0 if attributes.endswith("/") else 1
            ends = tag in ("article", "main", "body", "html") and closing and tag != side
            if depth > 0 and side == "p" and tag in _BLOCKS:
                ends = True
            if named and not seen_article and not closing and tag in ("article", "main") and _kind(tag, attributes) != SIDE:
                ends = True
            if depth <= 0 or ends:
                side = ""
                if depth <= 0:
                    continue
            else:
                continue
        if tag in _BLOCKS:
            page.close()
        elif tag == "br":
            page.text(" ")
        elif tag == "a":
            page.links = 0 if closing else 1
        if page.nominated:
            own = page.nominated
            if tag == own.tag:
                own.depth += -1 if closing else 0 if attributes.endswith("/") else 1
            opens_article = not closing and not seen_article and tag in ("article", "main")
            if own.depth <= 0 or opens_article or (closing and tag in ("article", "main", "body", "html")):
                page.end_nominated()
        if closing:
            if tag in ("article", "main"):
                page.articles = max(0, page.articles - 1)
            continue
        if tag in _VOID:
            continue
        kind = _kind(tag, attributes, page.articles > 0)
        if tag in _DROPPED or (tag == "header" and not page.articles) or kind == SIDE:
            page.close()
            side, depth, named = tag, 1, tag not in _DROPPED and tag != "header"
            continue
        if tag in ("article", "main"):
            page.articles += 1
            seen_article = True
        if kind == NOMINATED and not page.nominated and tag in _BLOCKS:
            page.nominated = _Nominated(tag, len(page.found))
    if not side and at < len(source):
        # A tag that never ends is no text.
        page.text(_UNFINISHED.sub("", source[at:]) if source.rfind("<", at) >= 0 else source[at:])
    page.end_nominated() if page.nominated else page.close()
    return page.found


def page_blocks(source: str) -> list[tuple[str, bool]]:
    """`(text, in an article)` of each block of parse_page."""
    return [(text, inside) for text, inside, _ in parse_page(source)]


def repeated_tokens(tokens: np.ndarray, page_of: np.ndarray, length: int) -> np.ndarray:
    """For each position, on how many distinct pages its `length` tokens stand; 0 at a page's end.

    Prefix doubling: the suffixes of all pages, end to end, are ranked by their first 1, 2, 4, ...
    tokens until `length` tokens are told apart; equal ranks are neighbours in the suffix array.
    """
    n = len(tokens)
    counts = np.zeros(n, np.int64)
    if n < length:
        return counts
    _, rank = np.unique(tokens, return_inverse=True)
    rank = rank.astype(np.int64)
    span = 1
    while span < length:
        step = min(span, length - span)
        after = np.full(n, -1, np.int64)
        after[: n - step] = rank[step:]
        _, rank = np.unique(rank * (n + 2) + after + 1, return_inverse=True)
        span += step
    whole = np.zeros(n, bool)
    whole[: n - length + 1] = page_of[: n - length + 1] == page_of[length - 1 :]
    places = np.flatnonzero(whole)
    suffixes = places[np.lexsort((page_of[places], rank[places]))]
    group = np.cumsum(np.concatenate(([False], rank[suffixes][1:] != rank[suffixes][:-1]))) if len(suffixes) else suffixes
    new_page = np.ones(len(suffixes), bool)
    new_page[1:] = (group[1:] != group[:-1]) | (page_of[suffixes][1:] != page_of[suffixes][:-1])
    if len(suffixes):
        counts[suffixes] = np.bincount(group, weights=new_page).astype(np.int64)[group]
    return counts


#: How a token is judged, by the block it is in.
PLAIN, INSIDE, BY_NAME = range(3)


def pages_needed(pages: int) -> np.ndarray:
    """Distinct pages of a host a repeat must be on, by how the block is judged."""
    return np.array([
        max(REPEAT_PAGES, math.ceil(REPEAT_SHARE * pages)), max(REPEAT_PAGES, math.ceil(ARTICLE_SHARE * pages)),
        max(NOMINATED_PAGES, math.ceil(REPEAT_SHARE * pages)),
    ])


@dataclass
class Streams:
    """Token streams of pages, end to end."""

    table: WordTable
    page_of: np.ndarray
    judged: np.ndarray
    block_of: np.ndarray
    #: Hash of the window at each token (0: it leaves the page), and of short nominated blocks at their first token.
    runs: np.ndarray
    lengths: np.ndarray


def streams(pages: list[list[tuple[str, int]]]) -> Streams:
    """Streams of `(text, judged)` blocks of pages. A window is REPEAT_TOKENS tokens of a page."""
    texts = [text.encode("utf-8", "surrogatepass") for page in pages for text, _ in page]
    table = WordTable(texts)
    block_of = table.text_of
    page_of_block = np.repeat(np.arange(len(pages)), [len(page) for page in pages])
    judged_block = np.array([kind for page in pages for _, kind in page], np.int64)
    page_of, judged = page_of_block[block_of], judged_block[block_of]
    n = len(block_of)
    hashes = table.hashes()
    runs, lengths = np.zeros(n, np.uint64), np.full(n, REPEAT_TOKENS)
    if n >= REPEAT_TOKENS:
        whole = page_of[: n - REPEAT_TOKENS + 1] == page_of[REPEAT_TOKENS - 1 :]
        runs[: n - REPEAT_TOKENS + 1] = np.where(whole, windows(hashes, REPEAT_TOKENS), 0)
    short = np.flatnonzero((table.count > 0) & (table.count < REPEAT_TOKENS) & (judged_block == BY_NAME))
    for block in short.tolist():
        at, size = int(table.first[block]), int(table.count[block])
        runs[at], lengths[at] = windows(hashes[at : at + size], size, 1)[0], size
    return Streams(table, page_of, judged, block_of, runs, lengths)


def host_repeats(pages: list[list[tuple[str, int]]], needed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs (as hashes) on enough distinct pages, and on how many, by the suffix array of the pages' streams."""
    own = streams(pages)
    n = len(own.page_of)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    counts = repeated_tokens(own.table.hashes(), own.page_of, REPEAT_TOKENS)
    at = np.flatnonzero((own.lengths < REPEAT_TOKENS) & (own.runs != 0))
    if len(at):
        # Short blocks are compared as wholes; a block counts once a page.
        pairs = np.unique(np.stack([own.runs[at], own.page_of[at].astype(np.uint64)]), axis=1)
        names, times = np.unique(pairs[0], return_counts=True)
        counts[at] = times[np.searchsorted(names, own.runs[at])]
    often = (counts >= needed[own.judged]) & (own.runs != 0)
    runs, first = np.unique(own.runs[often], return_index=True)
    return runs, counts[often][first]


def without_repeats(
    pages: list[list[tuple[str, int]]], runs: np.ndarray, counts: np.ndarray, needed: np.ndarray
) -> list[list[str]]:
    """Blocks of each page without the tokens that repeats cover; a page of nothing but repeats stays."""
    if not len(runs):
        return [[text for text, _ in page if text] for page in pages]
    own = streams(pages)
    n = len(own.page_of)
    place = np.minimum(np.searchsorted(runs, own.runs), len(runs) - 1)
    found = np.where((runs[place] == own.runs) & (own.runs != 0), counts[place], 0)
    gone = np.zeros(n, bool)
    for kind in (PLAIN, INSIDE, BY_NAME):
        starts = np.flatnonzero(found >= needed[kind])
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + own.lengths[starts], -1)
        gone |= (np.cumsum(change[:-1]) > 0) & (own.judged == kind)
    all_gone = np.ones(len(pages), bool)
    np.logical_and.at(all_gone, own.page_of, gone)
    gone &= ~all_gone[own.page_of]
    touched = set(own.page_of[gone].tolist())
    result, block = [], 0
    for number, page in enumerate(pages):
        kept = []
        for text, _ in page:
            if number in touched:
                at = int(own.table.first[block])
                stay = ~gone[at : at + int(own.table.count[block])]
                text = text if stay.all() else " ".join(w for w, x in zip(text.split(), stay, strict=True) if x)
            block += 1
            if text:
                kept.append(text)
        result.append(kept)
    return result


def chosen_blocks(page: Iterable[tuple]) -> list[tuple[str, int]]:
    """`(text, judged)` of a page's blocks in articles, or of all blocks if there is no article."""
    page = list(page)
    some = [b for b in page if b[1]] or page
    return [(b[0], BY_NAME if len(b) > 2 and b[2] else INSIDE if b[1] else PLAIN) for b in some]


def _content(page: list[tuple[str, int]]) -> int:
    """What pages of the same words, judged alike, have in common."""
    text = "".join(f"{kind}{text}\n" for text, kind in page)
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 3) - (1 << 63)


def chunk_texts(pages: list[list[tuple]]) -> list[list[str]]:
    """Blocks of each page's main text, without repeats across the pages of one host, all given.

    A page with an article gives its blocks, others all blocks; tokens covered by a repeat go.
    Pages of the same words are one page to the counts, and a page of nothing but repeats stays.
    """
    chosen = [chosen_blocks(page) for page in pages]
    distinct = list({_content(page): page for page in chosen}.values())
    needed = pages_needed(len(distinct))
    runs, counts = host_repeats(distinct, needed)
    return without_repeats(chosen, runs, counts, needed)


_STREAM = pa.schema([("host", pa.string()), ("content", pa.int64()), ("texts", pa.list_(pa.string())), ("judged", pa.list_(pa.int8()))])
_RUNS = pa.schema([("host", pa.string()), ("run", pa.int64()), ("n", pa.int64())])
_SEEN = pa.schema([("host", pa.string()), ("run", pa.int64()), ("content", pa.int64())])
_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("blocks", pa.list_(pa.string()))])
#: Contents a task remembers so as to pass on one copy of each.
_REMEMBERED = 1_000_000


def _parsed(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[list[tuple[str, int]]]]]:
    """The chosen blocks of the pages of a batch, a range of them at a time."""
    sources = batch.column("html").to_pylist()
    for a, b in blocks(sources):
        yield a, b, [chosen_blocks(parse_page(x or "")) for x in sources[a:b]]


def _to_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[tuple[str, int]] = set()
    for batch in batches:
        hosts = batch.column("host").to_pylist()
        for a, b, pages in _parsed(batch):
            kept = []
            for host, page in zip(hosts[a:b], pages, strict=True):
                key = host, _content(page)
                if page and key not in seen:
                    if len(seen) >= _REMEMBERED:
                        seen.clear()
                    seen.add(key)
                    kept.append((*key, page))
            yield record_batch(
                _STREAM, host=[h for h, _, _ in kept], content=[c for _, c, _ in kept],
                texts=[[t for t, _ in page] for _, _, page in kept], judged=[[k for _, k in page] for _, _, page in kept],
            )


def _chunk_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats of each chunk, from rows sorted by chunk and content. A chunk holds its distinct pages only.

    A repeat on enough of the host's pages is, in one of the host's chunks, on its share of them.
    """
    held: list[list[tuple[str, int]]] = []
    chunk = last = None

    def repeats() -> pa.RecordBatch:
        host, _, pages, parts = chunk
        needed = np.maximum(2, -(-pages_needed(pages) // parts))
        runs, counts = host_repeats(held, needed)
        return record_batch(_RUNS, host=[host] * len(runs), run=runs.view(np.int64), n=counts)

    for batch in batches:
        columns = [batch.column(x).to_pylist() for x in ("host", "part", "pages", "parts", "content", "texts", "judged")]
        for *own, content, texts, judged in zip(*columns, strict=True):
            if own != chunk:
                if len(held) > 1:
                    yield repeats()
                held, chunk, last = [], own, None
            if content != last:
                held.append(list(zip(texts, judged, strict=True)))
                last = content
    if len(held) > 1:
        yield repeats()


@dataclass
class HostRepeats:
    """Sorted runs per host, on how many pages each is, and how many pages the host has."""

    hosts: dict[str, tuple[np.ndarray, np.ndarray, int]]

    @classmethod
    def of(cls, rows: list) -> HostRepeats:
        by_host: dict[str, list] = {}
        for r in rows:
            by_host.setdefault(r["host"], []).append((r["run"] % (1 << 64), r["n"], r["pages"]))
        hosts = {}
        for host, own in by_host.items():
            own.sort()
            hosts[host] = np.array([x for x, _, _ in own], np.uint64), np.array([n for _, n, _ in own], np.int64), own[0][2]
        return cls(hosts)


def _host_counts(shared):
    """`host, run, content` of every page that a run of its host is on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.hosts
        for batch in batches:
            hosts = batch.column("host").to_pylist()
            for a, b, pages in _parsed(batch):
                rows: set[tuple[str, int, int]] = set()
                for host, page in zip(hosts[a:b], pages, strict=True):
                    if host in known and page:
                        found = np.intersect1d(streams([page]).runs, known[host][0])
                        content = _content(page)
                        rows.update((host, x, content) for x in found.view(np.int64).tolist())
                if rows:
                    yield record_batch(_SEEN, **dict(zip(_SEEN.names, zip(*rows, strict=True), strict=True)))

    return run


def _texts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.hosts
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        for batch in batches:
            hosts = batch.column("host").to_pylist()
            for a, b, pages in _parsed(batch):
                by_host: dict[str, list[int]] = {}
                for i, host in enumerate(hosts[a:b]):
                    by_host.setdefault(host if host in known else "", []).append(i)
                texts: list[list[str]] = [[]] * (b - a)
                for host, members in by_host.items():
                    runs, counts, n = known.get(host, none)
                    for i, kept in zip(members, without_repeats([pages[i] for i in members], runs, counts, pages_needed(n)), strict=True):
                        texts[i] = kept
                yield record_batch(_TEXTS, page_id=batch.column("page_id")[a:b], url=batch.column("url")[a:b], blocks=texts)

    return run


def main_texts(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """`page_id, url, blocks` of every row: the blocks of the main text, white space made one space.

    Scripts, styles, comments, menus, headers, footers, sidebars, notices, adverts, forms and
    reader comments are left out by element and role, and by class and id where these say nothing
    else. If a page has an article, only its blocks count. Then the streams of a host's distinct pages
    are laid end to end, in chunks of CHUNK_PAGES and CHUNK_CHARS at most, and a suffix array gives
    the runs of tokens that repeat on them. Hosts of several chunks have their runs counted over
    all their pages; runs on enough pages of the host go from all of them.

    Pages are read, not moved, to count and to remove; the streams move once, one copy of a content
    from a task. Null and empty pages give no block; a page without a usable URL has the empty host;
    repeated rows and copies are one page to the counts, and rows of their own in the result; null ids stay
    null; an empty table gives no row; broken markup takes one pass like any other.
    """
    spark = pages.sparkSession
    workspace = Workspace(spark, "html")
    source = F.coalesce(F.col(html_column).cast("string"), F.lit(""))
    url = F.col(url_column).cast("string")
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), url.alias("url"), url_host(url).alias("host"), source.alias("html"))
    distinct = rows.groupBy("host", F.xxhash64("html").alias("h")).agg(F.max(F.char_length("html")).alias("chars"))
    sizes = distinct.groupBy("host").agg(F.count("*").alias("pages"), F.sum("chars").alias("chars"))
    parts = F.greatest(F.ceil(F.col("pages") / CHUNK_PAGES), F.ceil(F.col("chars") / CHUNK_CHARS), F.lit(1)).cast("int")
    several = workspace.save(sizes.filter(f"pages >= {NOMINATED_PAGES}").select("host", "pages", parts.alias("parts")), "hosts")

    moved = rows.select("host", "html").mapInArrow(_to_streams, "host string, content long, texts array<string>, judged array<tinyint>")
    dealt = moved.join(several, "host").withColumn("part", F.pmod("content", F.col("parts")).cast("int"))
    key = ["host", "part"]
    sorted_chunks = dealt.repartition(*key).sortWithinPartitions(*key, "content").select("host", "part", "pages", "parts", "content", "texts", "judged")
    runs = workspace.save(sorted_chunks.mapInArrow(_chunk_repeats, "host string, run long, n long"), "runs")
    found = runs.groupBy("host", "run").agg(F.max("n").alias("n")).join(several, "host")
    found = workspace.save(found, "found")

    # All chunks of a host together: every page that holds a run counts, copies once.
    open_hosts = found.filter("parts > 1")
    counted = None
    for shard, shared in _shards(open_hosts):
        part = rows.filter(shard).select("host", "html").mapInArrow(_host_counts(shared), "host string, run long, content long").distinct()
        part = workspace.save(part.groupBy("host", "run").agg(F.count("*").alias("n")), f"counts{0 if counted is None else len(counted)}")
        counted = [*(counted or []), part]
    known = found.filter("parts = 1").select("host", "run", "n", "pages")
    for part in counted or []:
        known = known.unionByName(part.join(several, "host").select("host", "run", "n", "pages"))
    least = F.greatest(F.lit(NOMINATED_PAGES), F.ceil(F.col("pages") * REPEAT_SHARE))
    known = workspace.save(known.filter(F.col("n") >= least), "known")

    result: DataFrame | None = None
    for shard, shared in _shards(known, always=True):
        part = rows.filter(shard).mapInArrow(_texts(shared), "page_id long, url string, blocks array<string>")
        result = part if result is None else result.unionByName(part)
    return result


def _shards(repeats: DataFrame, always: bool = False) -> Iterator[tuple]:
    """`(which rows, their hosts' repeats, broadcast)`: MOST_REPEATS at once, by a hash of the host.

    A host has fewer runs than one page has tokens for each REPEAT_SHARE of its pages, so its own are bounded too.
    """
    n = repeats.count()
    if not n and not always:
        return
    shards = max(1, math.ceil(1.5 * n / MOST_REPEATS))
    number = F.pmod(F.xxhash64("host"), F.lit(shards))
    for k in range(shards):
        rows = repeats.filter(number == k).select("host", "run", "n", "pages").collect() if n else []
        yield (number == k if shards > 1 else F.lit(True)), repeats.sparkSession.sparkContext.broadcast(HostRepeats.of(rows))
