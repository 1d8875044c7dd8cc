"""Exact removal of repeated byte strings by merged suffix runs (operator 7).

Removes every byte covered by a string of ``length`` bytes that starts at two
or more places of the corpus.  A string is found by its anchor: the position
of the smallest ``GRAM``-byte hash among the grams that lie within it.  Equal
strings have their anchors at equal offsets, so it is enough to compare the
surroundings of anchors -- one position in about ``(length - GRAM) / 2`` --
instead of all suffixes:

1. every document is scanned once for its anchors; an anchor carries a digest
   of its gram and one of its whole context, the bytes from ``length - GRAM``
   before it to ``length`` behind it (cut at the document's ends);
2. an anchor whose gram occurs nowhere else is in no repeated string.  Contexts
   that occur twice are repeated as a whole.  Only grams with several different
   contexts are open: one copy of each such context goes on;
3. a task sorts the suffixes at its open anchors, front-codes the sorted run
   (length of the common prefix, then the rest) and deals it to ranges by the
   gram.  A range merges its runs with a loser tree whose nodes keep the common
   prefix with the last winner, so a known prefix is never compared again; the
   merge yields the suffix array of the range with its common-prefix lengths;
4. within an interval of the suffix array whose members share r bytes to the
   right of their anchors, the longest common left context decides which
   strings of ``length`` bytes around an anchor occur twice;
5. repeated strings become byte intervals of the documents that hold them.

A gram with more than ``HOT_CONTEXTS`` different contexts (a passage that very
many documents share) is not gathered: its strings are counted by digest.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import partitions, stage
from folio.llm.textscan import mix, powers
from folio.operators.joins import salted_join

LENGTH = 400
GRAM = 100
HOT_CONTEXTS = 16_384
RUN_ROWS = 20_000               # suffixes sorted at a time within a task
_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


# -- scanning ---------------------------------------------------------------

BLOCK = 1 << 19                 # bytes scanned together
_POS_BITS = 21


class Scanner:
    """Anchors of documents, many at a time, long ones in overlapping parts."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram, self.left = length, gram, length - gram
        self.pows: list = [np.zeros(0, _U)] * 4

    def _tables(self, n: int):
        if len(self.pows[0]) < n:
            bases = [*_BASES, *(pow(b, -1, 1 << 64) for b in _BASES)]
            self.pows = [powers(max(n, 2 * BLOCK), b) for b in bases]
        return self.pows

    def _parts(self, docs: list[bytes]):
        """(document, first byte, end, first string start, end of those)."""
        for k, data in enumerate(docs):
            starts = len(data) - self.length + 1
            for low in range(0, max(starts, 0), BLOCK):
                high = min(starts, low + BLOCK)
                yield k, max(0, low - self.left), min(len(data), high + 2 * self.length), low, high

    def anchors(self, docs: list[bytes]):
        """Batches of (document, position, gram digest, context digest, bytes
        of context before, behind)."""
        held, size, known = [], 0, np.zeros(0, np.int64)
        parts = list(self._parts(docs))
        for k, part in enumerate(parts):
            held.append(part)
            size += part[2] - part[1]
            if size < BLOCK and k + 1 < len(parts):
                continue
            found = self._scan(docs, held)
            # Parts of a document overlap: an anchor counts once.
            keys, first = np.unique(found[0] * (1 << 40) + found[1], return_index=True)
            first = first[~np.isin(keys, known)]
            known = keys[keys >> 40 == part[0]]
            yield tuple(x[first] for x in found)
            held, size = [], 0

    def _digests(self, buf: np.ndarray):
        tables = self._tables(len(buf) + 1)
        wide = buf.astype(_U) + _U(1)
        sums = [np.concatenate((np.zeros(1, _U), np.cumsum(wide * t[: len(wide)]))) for t in tables[:2]]

        def digest(begin, end, which):
            return mix((sums[which][end] - sums[which][begin]) * tables[2 + which][begin] + (end - begin).astype(_U), 7 + which)
        return digest

    def _scan(self, docs, parts):
        buf = np.frombuffer(b"".join(docs[k][a:b] for k, a, b, _, _ in parts), np.uint8)
        digest = self._digests(buf)
        at = np.arange(len(buf) - self.gram + 1)
        key = digest(at, at + self.gram, 0) >> _U(_POS_BITS) << _U(_POS_BITS) | at.astype(_U)
        # Smallest key of w grams, by minima over doubling widths.
        w, width = self.left + 1, 1
        while width * 2 <= w:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if w > width:
            key = np.minimum(key[: len(key) - (w - width)], key[w - width:])
        base = np.concatenate(([0], np.cumsum([b - a for _, a, b, _, _ in parts])))[:-1]
        first = np.array([x + low - a for x, (_, a, _, low, _) in zip(base, parts)])
        count = np.array([high - low for _, _, _, low, high in parts])
        inside = np.arange(count.sum()) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])), count)
        smallest = key[np.repeat(first, count) + inside] & _U((1 << _POS_BITS) - 1)
        at = np.unique(smallest).astype(np.int64)
        part = np.searchsorted(base, at, "right") - 1
        doc = np.array([p[0] for p in parts])[part]
        shift = np.array([p[1] for p in parts])[part] - base[part]      # place in the document - place here
        whole = np.array([len(docs[p[0]]) for p in parts])[part]
        before = np.minimum(at + shift, self.left)
        behind = np.minimum(whole - at - shift, self.length)
        context = digest(at - before, at + behind, 1) ^ mix(before.astype(_U), 9)
        return doc, at + shift, digest(at, at + self.gram, 0), context, before, behind

    def strings(self, data: bytes, positions: np.ndarray):
        """128-bit digests of all strings around ``positions`` of a document,
        each string once: (start, digest, digest)."""
        out, done = [], 0
        for p in sorted(positions.tolist()):
            low, high = max(done, p - self.left), min(p, len(data) - self.length)
            if high < low:
                continue
            done = high + 1
            digest = self._digests(np.frombuffer(data, np.uint8)[low: high + self.length])
            at = np.arange(high - low + 1)
            out.append((at + low, digest(at, at + self.length, 0), digest(at, at + self.length, 1)))
        return out


# -- sorted runs --------------------------------------------------------------

def common_prefix(x: bytes, y: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    n = min(len(x), len(y))
    if x[known:n] == y[known:n]:
        return n
    low, high = known, n                    # they differ within [low, high)
    while high - low > 1:
        middle = (low + high) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_code(items: list[bytes]) -> list[tuple[int, bytes]]:
    """Sorted strings as (common prefix with the one before, rest)."""
    out, last = [], b""
    for x in items:
        k = common_prefix(last, x)
        out.append((k, x[k:]))
        last = x
    return out


def merge_runs(runs: list[list[tuple[int, bytes, object]]]):
    """Loser-tree merge of front-coded runs of (common prefix, rest, payload).

    Yields (common prefix with the string before, string, payload).  Every
    competitor keeps its common prefix with the last winner of its node: of two
    competitors the one with the longer prefix is smaller, without comparing;
    equal prefixes are compared only beyond them.
    """
    k = len(runs)
    size = 1
    while size < k:
        size *= 2
    text: list = [None] * size              # None: the run has ended
    lcp = [0] * size
    load: list = [None] * size
    at = [0] * size

    def advance(r):
        if r >= k or at[r] >= len(runs[r]):
            text[r] = None
            return
        p, rest, load[r] = runs[r][at[r]]
        text[r] = (text[r] or b"")[:p] + rest
        lcp[r] = p
        at[r] += 1

    def play(x, y):
        """(winner, loser) of two competitors whose prefixes refer to the same
        string; the loser's then refers to the winner."""
        if text[x] is None or text[y] is None:
            return (y, x) if text[x] is None else (x, y)
        if lcp[x] != lcp[y]:
            return (x, y) if lcp[x] > lcp[y] else (y, x)
        a, b = text[x], text[y]
        n = common_prefix(a, b, lcp[x])
        first, second = (x, y) if n == len(a) or (n < len(b) and a[n] < b[n]) else (y, x)
        if n == len(a) == len(b) and y < x:
            first, second = y, x
        lcp[second] = n
        return first, second

    for r in range(size):
        advance(r)
    loser = [0] * size
    winner = [0] * (2 * size)
    for r in range(size):
        winner[size + r] = r
    for node in range(size - 1, 0, -1):
        winner[node], loser[node] = play(winner[2 * node], winner[2 * node + 1])
    top = winner[1] if size > 1 else 0
    while text[top] is not None:
        yield lcp[top], text[top], load[top]
        advance(top)                        # prefix with the string just given
        node = (size + top) // 2
        while node:
            top, loser[node] = play(top, loser[node])
            node //= 2


# -- strings around anchors -----------------------------------------------------

def repeated_offsets(lefts: list[bytes], rights: list[bytes], lcps: list[int], length: int, gram: int) -> list[list[tuple[int, int]]]:
    """For each member of a gram's group, sorted by ``rights``, the byte ranges
    (before the anchor, behind it) covered by strings that occur twice.

    ``lcps[i]`` is the common prefix of rights[i - 1] and rights[i].  A string
    with o bytes before the anchor is repeated if another member shares
    length - o bytes to the right and o to the left.  The members that share r
    bytes are neighbours in ``rights``; within them the best left partner is a
    neighbour in the order of the reversed lefts.
    """
    n = len(rights)
    order = sorted(range(n), key=lambda i: lefts[i][::-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    back = [lefts[i][::-1] for i in order]
    near = np.array([0] + [common_prefix(back[i - 1], back[i]) for i in range(1, n)], np.int64)
    # Sparse table of minima: common left context of any two ranks.
    table = [near]
    while (1 << len(table)) <= n:
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][: n - 2 * half + 1], table[-1][half: n - half + 1]))

    def left_common(a, b):                  # ranks a < b, arrays
        k = np.floor(np.log2(np.maximum(b - a, 1))).astype(np.int64)
        out = np.empty(len(a), np.int64)
        for level in np.unique(k):
            m = k == level
            out[m] = np.minimum(table[level][a[m] + 1], table[level][b[m] - (1 << level) + 1])
        return out

    lcps = np.array(lcps, np.int64)
    turns = np.zeros((n, length - gram + 2), np.int32)     # +1 where hits begin, -1 where they end
    levels = np.unique(lcps[1:][lcps[1:] >= gram]) if n > 1 else []
    for r in levels:                        # the intervals change at these depths only
        group = np.cumsum(lcps < r)
        by = np.lexsort((rank, group))
        g, k = group[by], rank[by]
        same = g[1:] == g[:-1]
        common = np.full(n - 1, -1, np.int64)
        common[same] = left_common(k[:-1][same], k[1:][same])
        best = np.full(n, -1, np.int64)
        best[by[1:]] = common
        best[by[:-1]] = np.maximum(best[by[:-1]], common)
        # o bytes before the anchor need length - o <= r behind it and o <= best.
        low = max(0, length - int(r))
        hit = np.flatnonzero((best >= low) & (low <= length - gram))
        turns[hit, low] += 1
        turns[hit, np.minimum(best[hit], length - gram) + 1] -= 1
    hits = np.cumsum(turns, axis=1)[:, :-1] > 0
    out = []
    for i in range(n):
        o = np.flatnonzero(hits[i])
        if not len(o):
            out.append([])
            continue
        # Strings with o bytes before the anchor cover [-o, length - o).
        cut = np.flatnonzero(np.diff(o) >= length)
        heads, tails = np.concatenate(([0], cut + 1)), np.concatenate((cut, [len(o) - 1]))
        out.append([(int(o[t]), int(length - o[h])) for h, t in zip(heads, tails)])
    return out


# -- the job ------------------------------------------------------------------

_HEAD = "<HHHqqb"                            # prefix, rest, left, document, position, alone


def _encode_run(entries: list[tuple[bytes, bytes, int, int, int]]) -> bytes:
    """A sorted run of (suffix, left, document, position, alone), front-coded."""
    out = []
    for (k, rest), (_, left, doc, pos, alone) in zip(front_code([e[0] for e in entries]), entries):
        out += [struct.pack(_HEAD, k, len(rest), len(left), doc, pos, alone), rest, left]
    return b"".join(out)


def _decode_run(data: bytes) -> list[tuple[int, bytes, tuple]]:
    out, at = [], 0
    while at < len(data):
        k, n, m, doc, pos, alone = struct.unpack_from(_HEAD, data, at)
        at += struct.calcsize(_HEAD)
        out.append((k, data[at: at + n], (data[at + n: at + n + m], doc, pos, alone)))
        at += n + m
    return out


def _merge_range(pdf: pd.DataFrame, length: int, gram: int) -> pd.DataFrame:
    """Merge a range's runs and decide every group of equal grams."""
    found: list[tuple[int, int, int]] = []
    lefts, rights, lcps, who = [], [], [], []

    def decide():
        if len(rights) > 1:
            for (doc, pos, alone), spans in zip(who, repeated_offsets(lefts, rights, lcps, length, gram)):
                if alone:
                    found.extend((doc, pos - before, pos + behind) for before, behind in spans)
        for x in (lefts, rights, lcps, who):
            x.clear()

    for k, right, (left, doc, pos, alone) in merge_runs([_decode_run(x) for x in pdf["run"]]):
        if k < gram:
            decide()
        lefts.append(left)
        rights.append(right)
        lcps.append(k)
        who.append((doc, pos, alone))
    decide()
    return pd.DataFrame(found, columns=["uid", "low", "high"])


def repeated_spans(docs: DataFrame, uid: str, text_col: str, length: int = LENGTH, gram: int = GRAM,
                   hot: int = HOT_CONTEXTS) -> DataFrame:
    """(uid, low, high): byte ranges of documents covered by repeated strings;
    ranges may overlap."""
    spark = docs.sparkSession
    texts = docs.select(F.col(uid).alias("uid"), F.col(text_col).alias("text"))

    def scan(batches):
        scanner = Scanner(length, gram)
        for pdf in batches:
            ids = pdf["uid"].to_numpy()
            data = [t.encode("utf-8", "surrogatepass") if t else b"" for t in pdf["text"]]
            for doc, pos, g, c, before, behind in scanner.anchors(data):
                yield pd.DataFrame({"gram": g.view(np.int64), "context": c.view(np.int64), "uid": ids[doc], "pos": pos,
                                    "before": before.astype(np.int32), "behind": behind.astype(np.int32)})

    anchors = stage(texts.filter(F.octet_length("text") >= length).mapInPandas(
        scan, "gram long, context long, uid long, pos long, before int, behind int"), "suffix-anchors")
    # Most grams occur once and leave first, so that little else moves on.  The
    # counts are stored: they tell which grams are dealt over several tasks.
    # Merge hints elsewhere keep one plan at every size: those sides grow.
    several = stage(anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1"), "suffix-grams")
    anchors = stage(salted_join(anchors, several.select("gram"), "gram", several, how="inner"), "suffix-repeated")
    # A context digest covers its extent, so equal contexts have equal extents.
    classes = stage(anchors.groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("uid", "pos")).alias("who")), "suffix-classes")
    kinds = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")

    # An anchor stems from a string within its context, so all of it is covered.
    whole = classes.filter("n > 1").select(F.struct("gram", "context").alias("_class"), F.col("n").alias("_rows"))
    full = salted_join(anchors.withColumn("_class", F.struct("gram", "context")), whole.select("_class"), "_class", whole, how="inner") \
        .select("uid", (F.col("pos") - F.col("before")).alias("low"), (F.col("pos") + F.col("behind")).alias("high"))

    open_ = stage(classes.join(kinds.hint("merge"), "gram").select("gram", "kinds", "who.uid", "who.pos", (F.col("n") == 1).alias("alone")),
                  "suffix-open")
    some = open_.filter(F.col("kinds") <= hot)
    rows = some.agg(F.count(F.lit(1))).first()[0]
    ranges = max(partitions(spark), int(rows / RUN_ROWS))
    wanted = some.groupBy("uid").agg(F.collect_list(F.struct(
        "pos", F.pmod("gram", F.lit(ranges)).cast("int").alias("range"), "alone")).alias("marks"))

    def runs(batches):
        held: dict[int, list] = {}
        count = 0

        def flush():
            out = pd.DataFrame([(r, _encode_run(sorted(e, key=lambda x: x[0]))) for r, e in held.items()], columns=["range", "run"])
            held.clear()
            return out

        for pdf in batches:
            for uid_, text, marks in zip(pdf["uid"].tolist(), pdf["text"], pdf["marks"]):
                data = text.encode("utf-8", "surrogatepass")
                for m in marks:
                    p = m["pos"]
                    held.setdefault(m["range"], []).append(
                        (data[p: p + length], data[max(0, p - (length - gram)): p], uid_, p, bool(m["alone"])))
                    count += 1
                if count >= RUN_ROWS:
                    yield flush()
                    count = 0
        yield flush()

    merged = texts.join(wanted.hint("merge"), "uid").mapInPandas(runs, "range int, run binary").groupBy("range").applyInPandas(
        lambda pdf: _merge_range(pdf, length, gram), "uid long, low long, high long")

    # Grams with very many contexts: count the strings around them instead.
    common = open_.filter(F.col("kinds") > hot)
    spans = [full, merged]
    if not common.isEmpty():
        places = common.groupBy("uid").agg(F.collect_list("pos").alias("marks"))

        def strings(batches):
            scanner = Scanner(length, gram)
            for pdf in batches:
                for uid_, text, marks in zip(pdf["uid"].tolist(), pdf["text"], pdf["marks"]):
                    data = text.encode("utf-8", "surrogatepass")
                    for low, a, b in scanner.strings(data, np.asarray(marks, np.int64)):
                        yield pd.DataFrame({"uid": uid_, "low": low, "a": a.view(np.int64), "b": b.view(np.int64)})

        counted = stage(texts.join(places.hint("merge"), "uid").mapInPandas(strings, "uid long, low long, a long, b long"), "suffix-strings")
        twice = counted.groupBy("a", "b").count().filter("count > 1").select("a", "b")
        spans.append(counted.join(twice, ["a", "b"]).select("uid", "low", (F.col("low") + length).alias("high")))
    out = spans[0]
    for more in spans[1:]:
        out = out.union(more)
    return stage(out, "suffix-spans")


def remove_repeated_strings(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, kept (the remaining bytes).

    Texts are UTF-8 bytes; null is empty; matches never cross documents and
    are judged on the input.  A text shorter than ``length`` keeps all.  Rows
    that repeat an id and its text are copies of each other; a row without an
    id is a document like others.  An empty table gives an empty frame; other
    columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(id_col, text_col, F.lit(7)).alias("uid"))
    spans = repeated_spans(rows, "uid", "text", length, GRAM if length == LENGTH else length * 2 // 5)
    by_doc = spans.groupBy("uid").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))

    def keep(batches):
        for pdf in batches:
            out = []
            for doc, text, lows, highs in zip(pdf["doc_id"], pdf["text"], pdf["lows"], pdf["highs"]):
                data = text.encode("utf-8", "surrogatepass") if text else b""
                kept, at, spans = [], 0, 0
                for low, high in sorted(zip(lows, highs)) if lows is not None else ():
                    if low > at or not spans:
                        kept.append(data[at:low])
                        spans += 1
                    at = max(at, high)
                kept = b"".join([*kept, data[at:]])
                out.append((doc, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            result = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            yield result.astype({"doc_id": "Int64"})

    return rows.join(by_doc.hint("merge"), "uid", "left").select("doc_id", "text", "lows", "highs").mapInPandas(
        keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
