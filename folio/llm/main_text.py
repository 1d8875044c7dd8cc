"""Main text of web pages: structure first, then the host's runs (operator 5).

A page is read into blocks of text with the elements that hold them.  Markup
that declares itself decides first: scripts, styles, forms and the like carry
no text; menus, headers, footers, sidebars, adverts, notices and reader
comments are left out by element, role, class or id.

All blocks that structure leaves are judged by the host's pages together, those
of pages with an ``article`` or ``main`` too: every token within a run of
``MIN_RUN`` tokens that occurs on ``MIN_PAGES`` distinct pages of the host is
covered.  Blocks that are covered are boilerplate; unique runs stay.  Pages are
dealt to parts by a hash of the row, hosts mixed; each part counts the pages of its runs, and the counts
of all parts are added by the run's hash (which holds the host) before
``MIN_PAGES`` is asked for, so that neither the parts nor the size of a host
bear on the decision.

Articles may quote or copy each other, so a block inside one goes only for runs
that also stand on ``ARTICLE_SHARE`` of the host's pages, and only where such
blocks hold less than half of the page's article text: else it is a copy, and
stays whole.
"""

from __future__ import annotations

import html as html_entities
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_RUN = 8                     # tokens
MIN_PAGES = 3
COVERED = 0.8                   # share of a block's tokens
ARTICLE_SHARE = 0.5             # of the host's pages, for a block inside an article
MIN_PARTS = 12
PART_CHARS = 4_000_000          # of html; aimed at
RANGE_CHARS = 32_000_000        # of html whose runs meet in a task; aimed at
SPARE_BITS = 17                 # of a run's hash, beyond those that number the input's characters

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
    search section select summary table tbody td tfoot th thead title tr ul""".split())
CLOSES_P = BLOCK - frozenset("body caption dd dt head html legend li option summary tbody td tfoot th thead title tr".split())
SKIPPED = frozenset("""nav header footer aside form script style noscript template iframe object embed svg math canvas
    audio video button select textarea input label dialog menu head title fieldset noframes applet map datalist
    search""".split())
ARTICLE = frozenset("article main".split())
ROLES = frozenset("""navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar
    toolbar status""".split())
# Words that name boilerplate in a class or an id.
MARKS = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsense banner breadcrumb
    breadcrumbs comment comments comentarios kommentare commentaires consent cookie cookies disclaimer disqus footer
    gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices overlay pagination
    pager popup promo promotion promoted reactions related reply replies respond share sharing sidebar sidenav signup
    skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets alert signin copyright
    legal""".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD_BREAK = re.compile(r"[^a-z0-9]+")


def _is_boilerplate(tag: str, attributes: str) -> bool:
    if tag in SKIPPED:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name == "role" and value in ROLES:
            return True
        if name in ("class", "id") and tag not in ARTICLE:
            value = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", m[2] or m[3] or m[4] or "").lower()
            if MARKS & set(_WORD_BREAK.split(value)):
                return True
    return False


def blocks(page: str) -> list[tuple[bool, str]]:
    """(inside an article, text) of every block that structure keeps.

    A block ends at every block-level tag; white space inside is one space.
    """
    out: list[tuple[bool, str]] = []
    stack: list[tuple[str, bool, bool]] = []        # element, left out, article
    parts: list[str] = []
    skipping = articles = 0

    def end_block():
        text = " ".join(html_entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append((articles > 0, text))

    def close(tag):
        nonlocal skipping, articles
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == tag:
                break
            # An end tag does not reach out of the article or a cell.
            if stack[k][0] in ("article", "main", "table") and tag not in ("body", "html", "article", "main", "table", "section", "div"):
                return
        else:
            return
        if tag in BLOCK:
            end_block()
        for _, left_out, article in stack[k:]:
            skipping -= left_out
            articles -= article
        del stack[k:]

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        text = page[at: m.start() if m else n]
        if text and not skipping:
            parts.append(text)
        if not m:
            break
        at = m.end()
        closing, tag = m[1], (m[2] or "").lower()
        if not tag:
            continue
        if closing:
            close(tag)
            if tag == "p" and not skipping:
                end_block()
            continue
        if tag in BLOCK:
            end_block()
        if tag in CLOSES_P:
            close_p = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in ("p", "article", "div", "td", "li", "body")), -1)
            if close_p >= 0 and stack[close_p][0] == "p":
                close("p")
        if tag == "li":
            near = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in ("li", "ul", "ol", "menu")), -1)
            if near >= 0 and stack[near][0] == "li":
                close("li")
        if tag == "br":
            if not skipping:
                parts.append(" ")
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            stop = page.find(">", end.start()) + 1 if end else n
            at = stop or n
            continue
        left_out, article = _is_boilerplate(tag, m[3]), tag in ARTICLE
        skipping += left_out
        articles += article
        stack.append((tag, left_out, article))
    if not skipping:
        end_block()
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit numbers spread over all 64 bits (the finalizer of splitmix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _runs(tokens: np.ndarray, sizes: np.ndarray, salts: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, page, hash) of every run of ``run`` tokens within a page.

    ``tokens``: the pages' tokens one after another, ``sizes`` of them a page;
    ``salts``: a number of each page's host, so that hosts share no run.
    """
    page = np.repeat(np.arange(len(sizes)), sizes)
    start = np.arange(len(tokens))
    start = start[start + run <= np.cumsum(sizes)[page]] if len(tokens) else start
    wide = _mix(tokens)
    found = np.zeros(len(start), np.uint64)
    for k in range(run):
        found = found * np.uint64(0x9E3779B97F4A7C15) + wide[start + k]
    return start, page[start], _mix(found ^ salts[page[start]])


def _count_pages(found: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct ``found``, the distinct pages of each, and the place of
    every element of ``found`` among them.  ``page`` ascends."""
    if not len(found):
        return found, np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(found, kind="stable")
    ordered, of = found[order], page[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    starts = np.flatnonzero(new)
    pages = np.add.reduceat((new | np.concatenate(([True], of[1:] != of[:-1]))).astype(np.int64), starts)
    place = np.empty(len(found), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[starts], pages, place


def _cover(n: int, starts: np.ndarray, run: int) -> np.ndarray:
    """Which of ``n`` tokens lie in a run that begins at ``starts``."""
    turns = np.zeros(n + 1, np.int64)
    np.add.at(turns, starts, 1)
    np.add.at(turns, starts + run, -1)
    return np.cumsum(turns)[:-1] > 0


def repeated_tokens(streams: list[np.ndarray], min_run: int = MIN_RUN, min_pages: int = MIN_PAGES) -> list[np.ndarray]:
    """For each page's tokens whether a run of ``min_run`` tokens that occurs
    on ``min_pages`` distinct pages covers them."""
    if not streams:
        return []
    sizes = np.array([len(s) for s in streams])
    start, page, found = _runs(np.concatenate(streams), sizes, np.zeros(len(streams), np.uint64), min_run)
    _, pages, place = _count_pages(found, page)
    covered = _cover(sizes.sum(), start[pages[place] >= min_pages], min_run)
    return np.split(covered, np.cumsum(sizes)[:-1])


class _Part:
    """The pages of one part: blocks, and the runs of the host's pages."""

    def __init__(self, salts: np.ndarray, bodies: list, bits: int):
        self.blocks = [[(x[0] == "a", x[1:]) for x in zlib.decompress(b).decode("utf-8", "surrogatepass").split("\n") if x]
                       for b in bodies]
        words = [[t.split() for _, t in page] for page in self.blocks]
        self.block_sizes = [[len(w) for w in page] for page in words]
        self.sizes = np.array([sum(x) for x in self.block_sizes], np.int64)
        tokens = _hashes([x for page in words for w in page for x in w])
        start, page, found = _runs(tokens, self.sizes, salts, MIN_RUN)
        # A page with text also counts for its host.
        own = np.flatnonzero(self.sizes)
        all_pages = np.concatenate((page, own))
        order = np.argsort(all_pages, kind="stable")
        found = np.concatenate((found, _mix(salts[own] + np.uint64(1))))[order] >> np.uint64(64 - bits)
        self.found, self.pages, place = _count_pages(found, all_pages[order])
        back = np.empty(len(order), np.int64)
        back[order] = place
        self.start, self.page, self.place = start, page, back[:len(start)]
        self.host = np.full(len(self.sizes), -1)
        self.host[own] = back[len(start):]

    def kept(self, totals: np.ndarray) -> list[str]:
        """The text of each page, by the host's pages of each run."""
        on = totals[self.place]
        here = np.where(self.host < 0, 0, totals[self.host])[self.page] if len(totals) else on
        n = self.sizes.sum()
        covered = _cover(n, self.start[on >= MIN_PAGES], MIN_RUN)
        common = _cover(n, self.start[(on >= MIN_PAGES) & (on >= ARTICLE_SHARE * here)], MIN_RUN)
        out, at = [], 0
        for page, sizes in zip(self.blocks, self.block_sizes):
            ends = at + np.cumsum(sizes)
            repeated = [(common if a else covered)[e - k: e].mean() >= COVERED for (a, _), e, k in zip(page, ends, sizes)]
            inside = sum(k for (a, _), k in zip(page, sizes) if a)
            doubtful = sum(k for (a, _), k, r in zip(page, sizes, repeated) if a and r)
            copied = 2 * doubtful >= inside
            out.append("\n".join(t for (a, t), r in zip(page, repeated) if not r or a and copied))
            at += sum(sizes)
        return out


def _hashes(words: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, dtype=object)) if words else np.zeros(0, np.uint64)


def _pack_sorted(values: np.ndarray) -> bytes:
    """Ascending numbers as differences, lowest bytes first."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return zlib.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Blocks stand in page order, one to a line.  Null or empty html, or a page
    of boilerplate only, gives an empty text.  A null or odd url is a host of
    its own kind.  Rows that repeat are pages of their own.  An empty table
    gives an empty frame; other columns are ignored.
    """
    import pyarrow as pa

    host = F.lower(F.regexp_extract(F.coalesce(url_col, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    chars = pages.agg(F.sum(F.length(html_col))).first()[0] or 0
    parts = max(MIN_PARTS, -(-chars // PART_CHARS))
    bits = min(64, chars.bit_length() + SPARE_BITS)
    range_bits = max(5, (chars // RANGE_CHARS).bit_length())
    part = F.pmod(F.xxhash64(id_col, url_col, html_col), F.lit(parts)).cast("int")
    parsed = pages.select(part.alias("part"), F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.xxhash64(host).alias("salt"),
                          _parse(F.col(html_col)).alias("body"))

    def part_of(table):
        return _Part(table["salt"].to_numpy().astype(np.uint64), table["body"].to_pylist(), bits)

    def cuts(found):
        return np.searchsorted(found, np.arange(1, 1 << range_bits, dtype=np.uint64) << np.uint64(bits - range_bits))

    def gather(table):
        own, rows = part_of(table), []
        for k, (found, n) in enumerate(zip(np.split(own.found, cuts(own.found)), np.split(own.pages, cuts(own.found)))):
            if len(found):
                rows.append((table["part"][0].as_py(), k, _pack_sorted(found), zlib.compress(n.astype("<u4").tobytes(), 1)))
        return pa.table(list(zip(*rows)) or [[]] * 4, schema=pa.schema(
            [("part", pa.int32()), ("range", pa.int32()), ("runs", pa.binary()), ("pages", pa.binary())]))

    def total(table):
        """Pages of the whole host for each part's runs, 0 under MIN_PAGES."""
        runs = [_unpack_sorted(x) for x in table["runs"].to_pylist()]
        found, place = np.unique(np.concatenate(runs), return_inverse=True)
        sums = np.bincount(place, np.concatenate([_numbers(x) for x in table["pages"].to_pylist()])).astype(np.int64)
        each = np.split(np.where(sums < MIN_PAGES, 0, sums)[place], np.cumsum([len(x) for x in runs])[:-1])
        return pa.table([table["part"], table["range"], pa.array([zlib.compress(x.astype("<u4").tobytes(), 1) for x in each], pa.binary())],
                        names=["part", "range", "totals"])

    def decide(table, totals):
        own = part_of(table)
        order = np.argsort(totals["range"].to_numpy())
        all_totals = totals["totals"].to_pylist()
        texts = own.kept(np.concatenate([np.zeros(0, np.int64)] + [_numbers(all_totals[k]) for k in order]))
        return pa.table([table["page_id"], table["url"], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    schema = T.StructType([T.StructField("page_id", pages.schema[id_col].dataType), T.StructField("url", pages.schema[url_col].dataType),
                           T.StructField("text", T.StringType())])
    runs = parsed.groupBy("part").applyInArrow(gather, "part int, range int, runs binary, pages binary")
    totals = runs.groupBy("range").applyInArrow(total, "part int, range int, totals binary")
    return (parsed.groupBy("part").cogroup(totals.groupBy("part")).applyInArrow(decide, schema)
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))


def _parse(html):
    """Kept blocks of a page, a line each behind a letter: in an article, open."""
    @F.pandas_udf("binary")
    def parse(pages: pd.Series) -> pd.Series:
        return pd.Series([zlib.compress("\n".join("oa"[a] + t for a, t in blocks(x or "")).encode("utf-8", "surrogatepass"))
                          for x in pages], dtype=object)

    return parse(html)
