"""Main text of pages: host suffix arrays find boilerplate, markup settles what it names.

Pages are cut into blocks of text. The token streams of the pages of a host are put one after
another and sorted as a suffix array. Pages that share most of what is rare on the host are
copies and count once; runs of at least eight tokens are boilerplate if they stand on a fair
share of the differing pages, so copied articles and quotations are kept. A block that markup
names as content (inside ``article`` or ``main``) stays unless all of it is boilerplate of most
pages, three or more, and one that markup names as something else goes; of all other blocks, which
count only on pages without named content, the boilerplate is removed and the rest kept.

A host with more markup than one task should hold is judged by the same rule over the same
windows, counted in Spark by their hashes instead of by an array. The hashes of many pages of a
host travel as one row, sorted and as gaps, and one task compares those of a range; in several
rounds that each take the windows of one residue: so the shuffle of a round is gone before the next
begins. Pages are told apart by a hash of their row, in both forms; the texts do not depend on the
form.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.llm.store import written
from contactloom.llm.words import Words, mix, runs, split_words, window_hashes

SHARD_BYTES = 4 << 20
RUN_TOKENS = 8
ROUNDS = 4
PARSED_PAGES = 256
# Windows of so many pages are dealt together (page numbers have 16 bits), and so many of a host
# are compared in one task.
DEALT_PAGES = 8192
TASK_WINDOWS = 1 << 19
# Boilerplate stands on this share of a host's differing pages, and on three at least, or on
# both if there are only two. Copies share this part of their rare windows.
FAIR_PERCENT, FEWEST, COPY_PERCENT = 30, 3, 80
# Where markup names the content, boilerplate stands on this share and on three pages at least.
MOST_PERCENT = 50

# Elements by their part in a page.
CONTENT_TAGS = {"article", "main"}
OTHER_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select",
              "textarea", "fieldset", "label"}
SILENT_TAGS = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object",
               "head", "title", "canvas", "datalist"}
RAW_TAGS = {"script", "style", "textarea", "title", "noscript", "iframe", "template"}
INLINE_TAGS = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del",
               "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small",
               "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
ITEM_TAGS = {"li", "dt", "dd", "tr", "td", "th", "option"}
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
             "param", "source", "track", "wbr"}
OTHER_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner",
               "sponsored", "sponsor", "promo", "sidebar", "side", "menu", "nav", "navbar",
               "navigation", "breadcrumb", "breadcrumbs", "header", "masthead", "footer",
               "notice", "notices", "cookie", "cookies", "consent", "gdpr", "popup", "modal",
               "newsletter", "subscribe", "signup", "login", "form", "search", "share",
               "sharing", "social", "related", "recommended", "comment", "comments",
               "disqus", "reply", "replies", "respond", "widget", "toolbar", "pagination",
               "pager", "alert", "disclaimer", "copyright", "legal"}
BESIDE = {"no", "not", "with", "without", "has", "layout"}
# Words that also tell what a page or an article is about (``search-page``, ``legal-article``),
# and containers that may hold the article itself.
SUBJECTS = {"search", "form", "legal", "alert", "notice", "notices", "copyright", "social",
            "disclaimer", "login", "signup"}
PAGE_WORDS = {"page", "article", "story", "post", "entry"}
WORK_WORDS = {"work", "works"}
HEADING_OF = PAGE_WORDS | {"header", "section", "title", "content"}
CONTAINER_NAMES = {"search", "form", "header"}
CONTAINER_ROLES = {"search", "form"}
HEADING_TAGS = {"header", "label"}
FRAME_TAGS = {"html", "body", "article", "main"}
OTHER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form",
               "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^<>]*+)>"
    r"|</?[A-Za-z][^>]*\Z", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\""
                       r"|'([^']*)'|([^\s\"'>]+)))?", re.I)
SPACES = re.compile(r"\s+")
# CONTAINER is something else, but an article inside it is content again.
OPEN, CONTENT, CONTAINER, OTHER = 0, 1, 2, 3


def named(attributes: str, inside: bool) -> int:
    """What class, id and role say of an element, ``inside`` an article or not."""
    level = OPEN
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value, name = (a or b or c).lower(), name.lower()
        if name == "role":
            role = value.strip()
            if role in OTHER_ROLES:
                level = max(level, CONTAINER if role in CONTAINER_ROLES else OTHER)
        elif name == "aria-hidden":
            if value == "true":
                return OTHER
        elif name == "hidden":
            return OTHER
        else:
            level = max([level, *(named_by(word, inside) for word in value.split())])
    return level


def named_by(word: str, inside: bool) -> int:
    """What one word of a class or id says: words like ``with-sidebar`` say what stands beside
    an element, ``search-page`` what it is about, and an article has a header of its own."""
    parts = re.split(r"[_-]+", word)
    found = OTHER_NAMES.intersection(parts)
    if not found or BESIDE.intersection(parts):
        return OPEN
    if found <= SUBJECTS and parts[-1] in PAGE_WORDS:
        return OPEN
    if found == {"related"} and parts[-1] in WORK_WORDS:
        return OPEN
    if inside and found == {"header"} and HEADING_OF.issuperset(parts):
        return OPEN
    return CONTAINER if found <= CONTAINER_NAMES else OTHER


def kind_inside(kind: int, tag: str, attributes: str) -> int:
    """What the text in an element is, where the element stands in text of ``kind``."""
    if kind == OTHER:
        return OTHER
    if tag in CONTENT_TAGS:
        return CONTENT
    inside, level = kind == CONTENT, OPEN
    if tag in OTHER_TAGS and not (inside and tag in HEADING_TAGS):
        level = CONTAINER if tag == "form" else OTHER
    if attributes and tag not in FRAME_TAGS and level != OTHER:
        level = max(level, named(attributes, inside))
    return max(kind, level)


def implied_end(stack: list[tuple[str, int, bool]], tag: str) -> int | None:
    """The open element that a start tag ends: a paragraph, or an item of the same kind."""
    if tag in INLINE_TAGS:
        return None
    for depth in range(len(stack) - 1, -1, -1):
        if stack[depth][0] not in INLINE_TAGS:
            ended = stack[depth][0] == "p" or stack[depth][0] == tag and tag in ITEM_TAGS
            return depth if ended else None
    return None


def blocks(page: str) -> list[tuple[str, int]]:
    """Blocks of text in page order, each with what the markup says of it."""
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, int, bool]] = []
    kind, silent, at = OPEN, False, 0

    def end_block() -> None:
        text = SPACES.sub(" ", references.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            out.append((text, kind))

    raw_end = None
    for found in TOKEN.finditer(page):
        if found.start() < at:
            continue
        if not silent:
            parts.append(page[at:found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag not in INLINE_TAGS or tag in SILENT_TAGS:
            end_block()
        if found[1]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    if tag in INLINE_TAGS and any(
                            s[0] not in INLINE_TAGS for s in stack[depth + 1:]):
                        break
                    end = stack[depth]
                    if end[1] != kind or end[2] != silent:
                        end_block()
                    _, kind, silent = end
                    del stack[depth:]
                    break
        elif tag not in VOID_TAGS and not found[3].endswith("/"):
            depth = implied_end(stack, tag)
            if depth is not None:
                _, kind, silent = stack[depth]
                del stack[depth:]
            inner, hush = kind_inside(kind, tag, found[3]), silent or tag in SILENT_TAGS
            if inner != kind or hush != silent:
                end_block()
            stack.append((tag, kind, silent))
            kind, silent = inner, hush
            if tag in RAW_TAGS:
                raw_end = re.compile(rf"</{tag}\b", re.I).search(page, at)
                if silent or raw_end is None:
                    at = raw_end.start() if raw_end else len(page)
    if not silent:
        parts.append(page[at:])
    end_block()
    return out


def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and kinds of the blocks of each page."""
    for batch in batches:
        for start in range(0, batch.num_rows, PARSED_PAGES):
            part = batch.slice(start, PARSED_PAGES)
            found = [blocks(h) if h else [] for h in part.column("html").to_pylist()]
            yield pa.record_batch(
                {n: part.column(n) for n in part.schema.names if n != "html"}
                | {"texts": pa.array([[t for t, _ in f] for f in found],
                                     pa.list_(pa.string())),
                   "kinds": pa.array([[k for _, k in f] for f in found],
                                     pa.list_(pa.int32()))})


def suffix_array(symbols: np.ndarray, depth: int = RUN_TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` symbols (a power of two), by prefix doubling, equal
    ones by place; and their ranks."""
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.uint64) + np.uint64(1)
    span = 1
    while span < depth:
        after = np.zeros(len(rank), np.uint64)
        after[:len(rank) - span] = rank[span:]
        rank = np.unique((rank << np.uint64(32)) | after, return_inverse=True)[1].astype(
            np.uint64) + np.uint64(1)
        span *= 2
    return np.argsort(rank, kind="stable"), rank.astype(np.int64)


def fair_share(pages: int) -> int:
    """On how many of ``pages`` differing pages a run must stand to be boilerplate."""
    return max(2, min(FEWEST, pages), -(-pages * FAIR_PERCENT // 100))


def most_of(pages: int) -> int:
    """On how many of ``pages`` differing pages a run in named content must stand."""
    return max(FEWEST, -(-pages * MOST_PERCENT // 100))


def page_groups(window: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For distinct pairs of windows and pages, sorted: the pages, and the groups of copies.

    A window that is on less than a fair share of the pages is rare. Its first page is its hub;
    a page is a copy of the hub that has most of the rare windows of both. Pages without rare
    windows hold nothing of their own and form one group.
    """
    pages, at = np.unique(page, return_inverse=True)
    begins = np.flatnonzero(np.concatenate(([True], window[1:] != window[:-1])))
    sizes = np.diff(np.append(begins, len(window)))
    rare = np.repeat(sizes < fair_share(len(pages)), sizes)
    hub = np.repeat(at[begins], sizes)[rare]
    own = at[rare]
    n_rare = np.bincount(own, minlength=len(pages))
    pairs, shared = np.unique(own * len(pages) + hub, return_counts=True)
    copy, first = pairs // len(pages), pairs % len(pages)
    linked = shared * 100 >= np.maximum(n_rare[copy], n_rare[first]) * COPY_PERCENT
    group = np.where(n_rare > 0, np.arange(len(pages)), -1)
    group[copy[linked]] = first[linked]
    return pages, group


def repeated_positions(symbols: np.ndarray, page: np.ndarray, marks: np.ndarray
                       ) -> tuple[np.ndarray, np.ndarray]:
    """Symbols inside a run of at least ``RUN_TOKENS`` that is boilerplate of the pages, and of
    most of them; runs do not hold the ``marks`` after pages.

    Neighbours in the suffix array share the longest prefixes; suffixes with the same first
    ``RUN_TOKENS`` symbols stand together, and the pages of such a stretch are counted. Numbers
    in ``page`` do not fall.
    """
    covered = np.zeros(len(symbols), bool)
    at = whole_windows(symbols, marks)
    if not len(at):
        return covered, covered
    order, rank = suffix_array(symbols)
    whole = np.zeros(len(symbols), bool)
    whole[at] = True
    order = order[whole[order]]
    window, where = rank[order], page[order]
    new = np.concatenate(([True], (window[1:] != window[:-1]) | (where[1:] != where[:-1])))
    window, where = window[new], where[new]
    pages, group = page_groups(window, where)
    n_groups = len(np.unique(group))
    # Groups are numbered from -1, and no number reaches that of pages.
    held = np.unique(window * (len(pages) + 1) + group[np.searchsorted(pages, where)] + 1)
    counts = np.bincount(held // (len(pages) + 1), minlength=int(rank.max()) + 1)

    def inside(least: int) -> np.ndarray:
        return covered_by(at[counts[rank[at]] >= least], len(symbols))

    return inside(fair_share(n_groups)), inside(most_of(n_groups))


def streams(texts: pa.ListArray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words, np.ndarray]:
    """One symbol stream of all pages: the words, a shared mark after each block and a mark
    of its own after each page. Returns symbols, their pages, the places of the words, words,
    and which symbols are marks after pages.
    """
    flat = texts.values.slice(texts.offsets[0].as_py(),
                              texts.offsets[-1].as_py() - texts.offsets[0].as_py())
    per_page = np.diff(texts.offsets.to_numpy())
    w = split_words(flat)
    sizes = np.diff(w.first)
    block_page = np.repeat(np.arange(len(per_page)), per_page)
    last = np.zeros(len(sizes), bool)
    ends = np.cumsum(per_page)
    last[ends[per_page > 0] - 1] = True
    width = sizes + 1 + last
    at = np.concatenate(([0], np.cumsum(width)))
    block = np.repeat(np.arange(len(sizes)), width)
    symbols = np.full(at[-1], 1, np.uint64)
    place = np.arange(len(w.hashes)) + np.repeat(at[:-1] - w.first[:-1], sizes)
    symbols[place] = w.hashes | np.uint64(2)
    marks = np.zeros(at[-1], bool)
    marks[at[1:][last] - 1] = True
    symbols[marks] = (np.flatnonzero(last) * 4).astype(np.uint64)
    return symbols, block_page[block], place, w, marks


def whole_windows(symbols: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Starts of the windows that hold no mark after a page."""
    after_mark = np.concatenate(([0], np.cumsum(marks)))
    at = np.arange(max(0, len(symbols) - RUN_TOKENS + 1))
    return at[after_mark[at + RUN_TOKENS] == after_mark[at]]


def covered_by(starts: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` symbols lie in a window that begins at one of ``starts``."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + RUN_TOKENS, -1)
    return np.cumsum(steps[:-1]) > 0


def first_words(texts: pa.ListArray, w: Words) -> np.ndarray:
    """Number of the first word of each page, and of the end."""
    return w.first[texts.offsets.to_numpy() - texts.offsets[0].as_py()]


def marked_words(table: pa.Table) -> Iterator[
        tuple[list[str], list[int], np.ndarray, np.ndarray]]:
    """For each page of a host: blocks, kinds, and which words are boilerplate of a fair share
    and of most of its pages. Equal rows are one page; rows are sorted by their keys."""
    texts = table.column("texts").combine_chunks()
    symbols, row, place, w, marks = streams(texts)
    page = np.unique(table.column("page_key").to_numpy(), return_inverse=True)[1][row]
    fair_runs, most_runs = (c[place] for c in repeated_positions(symbols, page, marks))
    starts = first_words(texts, w)
    for i in range(table.num_rows):
        yield (texts[i].as_py(), table.column("kinds")[i].as_py(),
               fair_runs[starts[i]:starts[i + 1]], most_runs[starts[i]:starts[i + 1]])


def settle(table: pa.Table) -> pa.Table:
    """The text of each page of a host that one task holds."""
    whole = table.take(np.argsort(table.column("page_key").to_numpy())).combine_chunks()
    return pa.table({"page_id": whole.column("page_id"), "url": whole.column("url"),
                     "text": pa.array([main_text(*page) for page in marked_words(whole)],
                                      pa.string())})


def page_windows(part: pa.RecordBatch, symbols: np.ndarray, row: np.ndarray, marks: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows of all pages, their pages, and hashes that differ by host."""
    at = whole_windows(symbols, marks)
    salt = part.column("salt").to_numpy().view(np.uint64)[row[at]]
    return at, row[at], mix(window_hashes(symbols, RUN_TOKENS)[at] ^ salt)


def hashed_windows(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Pages and hashes of the windows, in page order."""
    symbols, row, _, _, marks = streams(part.column("texts"))
    return page_windows(part, symbols, row, marks)[1:]


def parse_large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``parse``, with the number of different windows of each page."""
    for part in parse(batches):
        row, window = hashed_windows(part)
        bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
        n = [len(np.unique(window[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield part.append_column("n_windows", pa.array(n, pa.int64()))


def planes(values: np.ndarray) -> bytes:
    """First the lowest byte of every number, then the next ones: what is zero everywhere stands
    together and costs nothing once it is compressed."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


DEALT = pa.schema([("host", pa.string()), ("part", pa.int64()), ("least", pa.int64()),
                   ("keys", pa.binary()), ("pages", pa.binary()), ("gaps", pa.binary())])


def deal(turn: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows whose hashes leave ``turn``, of many pages in one row for each host and range
    of hashes: keys of the pages, and for each window its page and the gap to the one before."""
    for batch in batches:
        for start in range(0, batch.num_rows, DEALT_PAGES):
            part = batch.slice(start, DEALT_PAGES)
            host = part.column("host").dictionary_encode().indices.to_numpy()
            _, first = np.unique(part.column("page_key").to_numpy(), return_index=True)
            part = part.take(pa.array(first[np.argsort(host[first], kind="stable")]))
            yield pa.RecordBatch.from_pylist(list(dealt_rows(part, turn)), DEALT)


def dealt_rows(part: pa.RecordBatch, turn: int) -> Iterator[dict]:
    """The rows of ``deal`` for pages that stand together by host."""
    pages, windows = [], []
    for start in range(0, part.num_rows, PARSED_PAGES):
        row, window = hashed_windows(part.slice(start, PARSED_PAGES))
        taken = window % np.uint64(ROUNDS) == turn
        pages.append(row[taken] + start)
        windows.append(window[taken])
    page, window = np.concatenate(pages), np.concatenate(windows)
    host = part.column("host").dictionary_encode().indices.to_numpy()
    edges = np.flatnonzero(np.diff(host, prepend=-1, append=-1)).tolist()
    key = part.column("page_key").to_numpy()
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        mine = slice(*np.searchsorted(page, [a, b]))
        order = np.argsort(window[mine], kind="stable")
        w, p = window[mine][order], page[mine][order]
        new = np.ones(len(w), bool)
        new[1:] = (w[1:] != w[:-1]) | (p[1:] != p[:-1])
        w, p = w[new], p[new]
        n = part.column("parts")[a].as_py()
        limits = np.array([(k << 64) // n for k in range(1, n)], np.uint64)
        cuts = [0, *np.searchsorted(w, limits).tolist(), len(w)]
        for k, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if low < high:
                present, number = np.unique(p[low:high], return_inverse=True)
                gaps = np.diff(w[low:high], prepend=np.uint64(0))
                yield {"host": part.column("host")[a].as_py(), "part": k,
                       "least": part.column("least")[a].as_py(), "keys": key[present].tobytes(),
                       "pages": planes(number.astype(np.uint16)), "gaps": planes(gaps)}


def compare(table: pa.Table) -> pa.Table:
    """Windows of one host and range that stand on two pages or more: ``n`` pages, the first of
    them as ``hub``, whether they are ``rare``, and whether the page is ``near`` the hub: has
    enough of its rare windows of this range there, as a copy must in one range at least."""
    windows, keys, present, sizes = [], [], [], []
    for row in table.select(["keys", "pages", "gaps"]).to_pylist():
        number = from_planes(row["pages"], np.uint16)
        present.append(np.frombuffer(row["keys"], np.int64))
        sizes.append(np.bincount(number, minlength=len(present[-1])))
        keys.append(present[-1][number])
        windows.append(np.cumsum(from_planes(row["gaps"], np.uint64), dtype=np.uint64))
    window, key = np.concatenate(windows), np.concatenate(keys)
    pages, at = np.unique(np.concatenate(present), return_inverse=True)
    order = np.argsort(window, kind="stable")
    window, key = window[order], key[order]
    same = window[1:] == window[:-1]
    twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
    window, key = window[twice], key[twice]
    order = np.lexsort((key, window))
    window, page = window[order], np.searchsorted(pages, key[order])
    # Equal rows of other slices have equal keys; the first counts.
    new = np.ones(len(window), bool)
    new[1:] = (window[1:] != window[:-1]) | (page[1:] != page[:-1])
    again = np.bincount(page[~new], minlength=len(pages))
    window, page = window[new], page[new]
    begins = np.flatnonzero(np.concatenate(([True], window[1:] != window[:-1]))[:len(window)])
    counts = np.diff(np.append(begins, len(window)))
    n, hub = np.repeat(counts, counts), np.repeat(page[begins], counts)
    rare = n < table.column("least")[0].as_py()
    n_rare = (np.bincount(at, np.concatenate(sizes), len(pages)).astype(np.int64) - again
              - np.bincount(page[~rare], minlength=len(pages)))
    away = rare & (hub != page)
    _, pair, shared = np.unique(page[away] * len(pages) + hub[away], return_inverse=True,
                                return_counts=True)
    near = np.zeros(len(window), bool)
    near[away] = shared[pair] * 100 >= n_rare[page[away]] * COPY_PERCENT
    kept = n > 1
    return pa.table({"host": pa.array([table.column("host")[0].as_py()] * int(kept.sum()),
                                      pa.string()),
                     "page_key": pages[page[kept]], "window": window[kept].view(np.int64),
                     "n": n[kept], "hub": pages[hub[kept]], "rare": rare[kept],
                     "near": near[kept]})


def main_text(texts: list[str], kinds: list[int], repeated: np.ndarray, most: np.ndarray
              ) -> str:
    """Blocks that markup names as content, without those that are all boilerplate of most
    pages; if none are so named, the others without boilerplate."""
    out, at, named = [], 0, CONTENT in kinds
    for text, kind in zip(texts, kinds, strict=True):
        words = text.encode().split()
        gone = (most if named else repeated)[at:at + len(words)]
        at += len(words)
        if named:
            if kind == CONTENT and not (words and gone.all()):
                out.append(text)
        elif kind == OPEN:
            if not gone.any():
                out.append(text)
            else:
                out += [b" ".join(words[a:b]).decode() for a, b in runs(~gone)]
    return " ".join(out)


def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each page, without the runs whose windows are in ``found``."""
    for batch in batches:
        for start in range(0, batch.num_rows, PARSED_PAGES):
            part = batch.slice(start, PARSED_PAGES)
            texts, kinds, found = (part.column(c) for c in ("texts", "kinds", "found"))
            symbols, row, place, w, marks = streams(texts)
            at, row, window = page_windows(part, symbols, row, marks)
            bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
            hit = np.zeros(len(at), bool)
            for i in range(part.num_rows):
                if found[i].is_valid:
                    mine = slice(bounds[i], bounds[i + 1])
                    hit[mine] = np.isin(window[mine],
                                        found[i].values.to_numpy().view(np.uint64))
            gone = covered_by(at[hit], len(symbols))[place]
            first = first_words(texts, w)
            out = []
            for i in range(part.num_rows):
                words = gone[first[i]:first[i + 1]]
                out.append(main_text(texts[i].as_py(), kinds[i].as_py(), words, words))
            yield pa.record_batch({"page_id": part.column("page_id"),
                                   "url": part.column("url"),
                                   "text": pa.array(out, pa.string())})


def fair(pages: str) -> Column:
    """``fair_share`` of a column."""
    n = F.col(pages)
    return F.greatest(F.lit(2), F.least(F.lit(FEWEST), n),
                      F.ceil(n * FAIR_PERCENT / 100))


def shared_windows(joint: DataFrame, held: DataFrame) -> DataFrame:
    """The rows of ``compare`` for all pages of ``joint``; ``held`` has ``host, parts, least``."""
    dealt = joint.select("host", "page_key", "salt", "texts").join(F.broadcast(held), "host")
    return reduce(DataFrame.unionByName, [
        written(dealt.mapInArrow(
                    partial(deal, turn), "host string, part long, least long, keys binary, "
                                         "pages binary, gaps binary")
                .groupBy("host", "part").applyInArrow(
                    compare, "host string, page_key long, window long, n long, hub long, "
                             "rare boolean, near boolean"), "windows", "zstd")
        for turn in range(ROUNDS)])


def boilerplate(joint: DataFrame) -> DataFrame:
    """``host, window, most`` of the boilerplate on the pages of ``joint``, as ``page_groups`` and
    ``repeated_positions`` find it. Only large hosts come here, so tables by host are small.
    Windows of one page alone are rare and count by their number."""
    pages = written(joint.where("n_windows > 0").select("host", "page_key", "n_windows")
                    .distinct(), "large")
    held = (pages.groupBy("host").agg(F.count("*").alias("pages"), F.ceil(
                F.sum("n_windows") / (ROUNDS * TASK_WINDOWS)).alias("parts"))
            .select("host", "parts", fair("pages").cast("long").alias("least")))
    windows = shared_windows(joint, written(held, "held"))
    others = windows.where("NOT rare").groupBy("page_key").agg(F.count("*").alias("others"))
    n_rare = written(
        pages.join(others, "page_key", "left").select("host", "page_key", (
            F.col("n_windows") - F.coalesce("others", F.lit(0))).alias("n_rare")), "rare")
    first = n_rare.select(F.col("page_key").alias("hub"), F.col("n_rare").alias("n_hub"))
    # Written, so that Spark knows how few they are and leaves the windows where they lie.
    near = written(windows.where("near").select("page_key", "hub").distinct(), "near")
    linked = (windows.where("rare").join(near, ["page_key", "hub"], "left_semi")
              .groupBy("page_key", "hub").agg(F.count("*").alias("shared"))
              .join(n_rare, "page_key").join(first, "hub")
              .where(F.col("shared") * 100 >= F.greatest("n_rare", "n_hub") * COPY_PERCENT)
              .select("page_key", "hub"))
    groups = written(
        n_rare.join(linked, "page_key", "left").select(
            "host", "page_key", F.when(F.col("n_rare") == 0, F.lit(""))
            .otherwise(F.coalesce("hub", "page_key").cast("string")).alias("group")), "groups")
    differing = written(
        groups.groupBy("host").agg(F.countDistinct("group").alias("differing")), "differing")
    # No window stands on more groups than pages.
    return (windows.join(F.broadcast(differing), "host").where(F.col("n") >= fair("differing"))
            .select("host", "page_key", "window").join(groups.drop("host"), "page_key")
            .select("host", "window", "group")
            .distinct().groupBy("host", "window").count().join(F.broadcast(differing), "host")
            .where(F.col("count") >= fair("differing")).select("host", "window", (
                F.col("count") >= F.greatest(F.lit(FEWEST), F.ceil(
                    F.col("differing") * MOST_PERCENT / 100))).alias("most")))


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.lower(found)


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages(page_id, url, html)``.

    Character references are decoded, white space inside a block becomes one space, blocks are
    joined in page order by one space. A null or empty html, or one without text, has the
    empty text. Pages with a null address, or without ``://``, form one host. Rows with equal
    page_id are pages of their own. Extra columns are ignored; no rows give none.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.col("html").cast("string").alias("html"),
                        host_of(F.col("url")).alias("host"))
    # One row for each SHARD_BYTES of the input at most: small enough to be broadcast, so the pages
    # stay where they are.
    large = F.broadcast(written(
        rows.groupBy("host").agg(F.sum(F.length("html")).alias("size"))
        .where(F.col("size") > SHARD_BYTES).select("host", F.lit(True).alias("large")), "large"))
    parts = rows.join(large, "host", "left").select(
        "page_id", "url", "host", F.xxhash64("page_id", "url", "html").alias("page_key"),
        "large", "html")
    schema = "page_id long, url string, host string, page_key long, {}"
    parsed = "texts array<string>, kinds array<int>"
    alone = (parts.where("large IS NULL").drop("large")
             .mapInArrow(parse, schema.format(parsed)).groupBy("host"))
    settled = alone.applyInArrow(settle, "page_id long, url string, text string")

    settled = settled.withColumn("n_chars", F.length("text").cast("long"))
    if large.isEmpty():
        return settled

    joint = written(
        parts.where("large").select(
            "page_id", "url", "host", "page_key", F.xxhash64("host").alias("salt"), "html")
        .mapInArrow(parse_large, schema.format(f"salt long, {parsed}, n_windows long")),
        "joint", "zstd")
    sets = written(
        boilerplate(joint).groupBy("host").agg(
            F.collect_list("window").alias("fair"),
            F.collect_list(F.when(F.col("most"), F.col("window"))).alias("most")), "sets")
    named = F.array_contains("kinds", F.lit(CONTENT))
    late = (joint.join(F.broadcast(sets), "host", "left")
            .select("page_id", "url", "salt", "texts", "kinds",
                    F.when(named, F.col("most")).otherwise(F.col("fair")).alias("found"))
            .mapInArrow(finish, "page_id long, url string, text string"))
    return settled.union(late.withColumn("n_chars", F.length("text").cast("long")))
