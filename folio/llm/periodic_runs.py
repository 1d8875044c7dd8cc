"""Periodic word runs (operator 11): a phrase repeated again and again.

A run is a stretch of consecutive words of a text with smallest period ``q``
that no neighbouring word extends keeping that period.  They are found with an
enhanced suffix array over the words of a text (suffixes, their inverse, and
the common prefix of neighbours), without a tree:

* every interval of suffixes that share a prefix of ``d`` words and then part
  is read off the prefix lengths as a pair of bounds; its children are the
  stretches between the prefix lengths that equal ``d``;
* for the suffixes ``i`` of all children but the largest, the inverse array
  tells whether ``i + d`` and ``i - d`` lie in the interval, in another child:
  then a square of period ``d`` starts there that its next word breaks;
* a square is rotated to the left while the words agree; squares that end at
  one place and lie inside a run of a period dividing theirs are that run's.

Texts are independent rows, so there is no shuffle: the texts of an Arrow
batch share one suffix array in stretches of about ``CHUNK_WORDS`` words (a
longer text is alone in its own), and no match leaves its text.  A text of n
words takes about 4 * log2(longest repeat) + 100 bytes a word in its task.

Null and empty texts and texts without words have no runs and an empty
remainder; a null id is an id like any other; equal rows give equal results; an
empty table gives an empty table.  Only the id and the text column are read,
so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 6
MIN_EXPONENT = 4
CHUNK_WORDS = 300_000
_MEMBERS = 2_000_000     # suffixes of children looked at together
_JUMPS = 48              # rounds of pointer jumping before the rest is walked
_STEPS = 16              # single steps to the left before comparing stretches


def suffix_array(key: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order and, for t = 0, 1, .., their ranks by 2**t symbols.

    ``key`` orders the symbols (texts have symbols of their own); ``end`` is
    the end of each position's text.  Only suffixes still tied are sorted
    again as the prefix doubles.
    """
    n = len(key)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    heads = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    size = np.diff(np.append(heads, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(heads, size)
    levels = [rank.astype(np.int32)]
    tied = np.flatnonzero(np.repeat(size > 1, size))
    width = 1
    while len(tied):
        at = order[tied]
        after = at + width
        inside = after < end[at]
        follow = np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
        both = rank[at] * (n + 1) + follow
        turn = np.argsort(both, kind="stable")
        at, both = at[turn], both[turn]
        order[tied] = at
        heads = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
        size = np.diff(np.append(heads, len(at)))
        rank[at] = np.repeat(tied[heads], size)
        levels.append(rank.astype(np.int32))
        tied = tied[np.repeat(size > 1, size)]
        width *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """``out[k]``: words that suffixes ``k - 1`` and ``k`` share; 0 at both ends."""
    out = np.zeros(len(order) + 1, np.int64)
    at = np.flatnonzero(levels[0][order[:-1]] == levels[0][order[1:]])
    x, y = order[at].copy(), order[at + 1].copy()
    shared = np.zeros(len(at), np.int64)
    for t in reversed(range(len(levels))):
        rank = np.append(levels[t], np.int32(-1))
        step = (rank[x] == rank[y]).astype(np.int64) << t
        x += step
        y += step
        shared += step
    out[at + 1] = shared
    return out


def previous_smaller(value: np.ndarray) -> np.ndarray:
    """For every k with value > 0 the last place before it that holds less
    (``value[0]`` is 0).  Pointers jump over what their target jumped over;
    the few that need more rounds walk, each place passed once."""
    n = len(value)
    back = np.maximum(np.arange(n) - 1, 0)
    open_ = np.flatnonzero(value > 0)
    for _ in range(_JUMPS):
        open_ = open_[value[back[open_]] >= value[open_]]
        if not len(open_):
            return back
        back[open_] = back[back[open_]]
    open_ = open_[value[back[open_]] >= value[open_]]
    for k in open_.tolist():
        own, j = value[k], k - 1
        while value[j] >= own:
            j = back[j]
        back[k] = j
    return back


def _squares(order: np.ndarray, prefix: np.ndarray, end: np.ndarray, first: np.ndarray,
             min_exponent: int) -> np.ndarray:
    """Rows (start, period) of all squares that the next word breaks and whose
    period can occur ``min_exponent`` times in their text."""
    n = len(order)
    low = previous_smaller(prefix)
    high = n - previous_smaller(prefix[::-1])[::-1]
    cuts = np.flatnonzero(prefix[:n] > 0)
    cuts = cuts[min_exponent * prefix[cuts] <= (end - first)[order[cuts]]]
    if not len(cuts):
        return np.zeros((0, 2), np.int64)
    cuts = cuts[np.lexsort((cuts, high[cuts], low[cuts]))]
    lo, hi, depth = low[cuts], high[cuts], prefix[cuts]
    opens = np.concatenate(([True], (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
    closes = np.append(opens[1:], True)
    # The children of an interval: from its bound or a cut to the next one.
    group = np.cumsum(opens) - 1
    child_group = np.concatenate((group[opens], group))
    child_lo = np.concatenate((lo[opens], cuts))
    child_hi = np.concatenate((cuts[opens], np.where(closes, hi, np.append(cuts[1:], 0))))
    child_depth = np.concatenate((depth[opens], depth))
    bound_lo = np.concatenate((lo[opens], lo))
    bound_hi = np.concatenate((hi[opens], hi))
    size = child_hi - child_lo
    # All children but one largest of each interval.
    by_size = np.lexsort((-size, child_group))
    sorted_group = child_group[by_size]
    small = by_size[np.concatenate(([False], sorted_group[1:] == sorted_group[:-1]))]
    inverse = np.full(n + 1, -1, np.int64)
    inverse[order] = np.arange(n)
    found = []
    total = np.cumsum(size[small])
    start = 0
    while start < len(small):
        base = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, base + _MEMBERS, side="right")))
        part = small[start:stop]
        width = size[part]
        place = np.repeat(child_lo[part] - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
        own = np.repeat(part, width)
        i, d = order[place], child_depth[own]
        for j, begin in ((np.minimum(i + d, n), i), (np.where(i >= d, i - d, n), i - d)):
            at = inverse[j]
            hit = (at >= bound_lo[own]) & (at < bound_hi[own]) & ((at < child_lo[own]) | (at >= child_hi[own]))
            found.append(np.column_stack((begin[hit], d[hit])))
        start = stop
    return np.unique(np.concatenate(found), axis=0)


def _rotate(words: np.ndarray, first: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How far each square's start moves left while the words keep its period."""
    start = start.copy()
    lowest = first[start]
    going = np.arange(len(start))
    for _ in range(_STEPS):
        s = start[going]
        more = (s > lowest[going]) & (words[s - 1] == words[s - 1 + period[going]])
        going = going[more]
        start[going] -= 1
        if not len(going):
            return start
    for k in going.tolist():
        s, low, p, width = int(start[k]), int(lowest[k]), int(period[k]), 64
        while s > low:
            a = max(low, s - width)
            differ = np.flatnonzero(words[a:s] != words[a + p:s + p])
            if len(differ):
                s = a + int(differ[-1]) + 1
                break
            s, width = a, min(2 * width, 1 << 16)
        start[k] = s
    return start


def runs_of(words: np.ndarray, lengths: np.ndarray, min_length: int = MIN_LENGTH,
            min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and then period.

    ``words`` are the numbered words of several texts one after another,
    ``lengths`` the texts' word counts; positions count over all texts.
    ``min_exponent`` is at least 2.
    """
    n = len(words)
    if n == 0:
        return np.zeros((0, 3), np.int64)
    ends = np.cumsum(lengths)
    end = np.repeat(ends, lengths)
    first = np.repeat(ends - lengths, lengths)
    # Texts have symbols of their own, so nothing is shared between them.
    order, levels = suffix_array(first * (int(words.max()) + 1) + words, end)
    prefix = common_prefixes(order, levels)
    squares = _squares(order, prefix, end, first, min_exponent)
    stop = squares[:, 0] + 2 * squares[:, 1]
    squares = squares[np.lexsort((squares[:, 1], stop))]
    runs = []
    while len(squares):
        stop = squares[:, 0] + 2 * squares[:, 1]
        leads = np.concatenate(([True], stop[1:] != stop[:-1]))
        lead = np.cumsum(leads) - 1
        period = squares[leads, 1]
        start = _rotate(words, first, squares[leads, 0], period)
        runs.append(np.column_stack((start, stop[leads], period)))
        inside = (squares[:, 1] % period[lead] == 0) & (squares[:, 0] >= start[lead])
        squares = squares[~inside & ~leads]
    if not runs:
        return np.zeros((0, 3), np.int64)
    out = np.concatenate(runs)
    length = out[:, 1] - out[:, 0]
    out = out[(length >= min_length) & (length >= min_exponent * out[:, 2])]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _chunks(texts: list):
    """(first row, words of the rows) in stretches of about CHUNK_WORDS."""
    at, held, size = 0, [], 0
    for k, text in enumerate(texts):
        words = text.encode("utf-8").split() if text else []
        if held and size + len(words) > CHUNK_WORDS:
            yield at, held
            at, held, size = k, [], 0
        held.append(words)
        size += len(words)
    if held:
        yield at, held


def _collapse(texts: list, min_length: int, min_exponent: int):
    """For each text its runs and what is left without their repeats."""
    for _, docs in _chunks(texts):
        numbers: dict = {}
        lengths = np.array([len(d) for d in docs], np.int64)
        words = np.fromiter((numbers.setdefault(w, len(numbers)) for d in docs for w in d), np.int64, int(lengths.sum()))
        runs = runs_of(words, lengths, min_length, min_exponent)
        firsts = np.cumsum(lengths) - lengths
        split = np.searchsorted(runs[:, 0], np.append(firsts, len(words)))
        for k, doc in enumerate(docs):
            own = runs[split[k]:split[k + 1]]
            if not len(own):
                yield [], b" ".join(doc).decode("utf-8")
                continue
            own = own - np.array([firsts[k], firsts[k], 0])
            # Ups and downs of "inside a repeat" over the text's words.
            depth = np.zeros(len(doc) + 1, np.int64)
            np.add.at(depth, own[:, 0] + own[:, 2], 1)
            np.add.at(depth, own[:, 1], -1)
            kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
            rows = [{"start": s, "length": e - s, "period": p} for s, e, p in own.tolist()]
            yield rows, b" ".join([doc[i] for i in kept.tolist()]).decode("utf-8")


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``id, runs, collapsed`` of every row: its runs of at least
    ``min_length`` words and ``min_exponent`` periods (word number of the
    start, words, period; by start and period), and its words without those
    that a run holds after its first period, joined by one space."""
    if min_exponent < 2:
        raise ValueError("min_exponent is at least 2")
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    id_type = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def collapse(batches):
        for batch in batches:
            runs, left = [], []
            for r, text in _collapse(batch.column(1).to_pylist(), min_length, min_exponent):
                runs.append(r)
                left.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(runs, run_type), pa.array(left, pa.string())], names=[id_col, "runs", "collapsed"])

    return rows.mapInArrow(collapse, schema)
