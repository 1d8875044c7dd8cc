"""Mixture-controlled packing by deficit round-robin (operator 2).

Documents become token ids with an end token, and wait in one queue per
source.  The token stream is filled window by window (``WINDOW`` tokens): each
window credits every source with its target share of the window, and sources
are visited in turn; a source whose deficit covers its next packet (at most
``QUANTUM`` tokens, never beyond the end of a document) serves it.  What a
source is owed or has overdrawn at the end of a window stays in its deficit,
so proportions hold within about a packet per source over any stretch.

Partitions of equal length are packed side by side.  Token totals per source
give the share of every source up to each partition's first window; the queues,
in the order of a hash of the document, are cut at these places (a cut may fall
inside a document), so that each partition holds the tokens its windows need
and no queue runs dry before its source does.  Windows therefore have no
padding; only the last one of all can be short.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from bisect import bisect_right
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import stage

WINDOW = 1024
QUANTUM = 128
END_ID = 0
PARTITION_TOKENS = 2_000_000    # aimed at; a task holds one partition's ids
LOOK_AHEAD = r"\s+(?!\S)|"      # of the tokenizer's pattern
PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long, source string")


def _tokenizer(vocabulary: str):
    """(tokenizer of any text, tokenizer of texts without double white space)
    of a rank file, kept for the worker's life.

    The rank file is the same vocabulary and merges as the JSON file of the
    ``tokenizers`` library and gives the same ids, at a fraction of the time.
    Only white space before white space needs the pattern's look-ahead, which
    takes a slower matcher.  The special token, of an id that is free, is never
    allowed, so its letters are read as text.
    """
    import base64

    import public_tokenizers
    import tiktoken

    held = sys.modules.setdefault("_folio_tokenizers", types.ModuleType("_folio_tokenizers")).__dict__
    if vocabulary not in held:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary, "rb"))}
        special = {"<|endoftext|>": max(ranks.values()) + 1}
        held[vocabulary] = [
            tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
            for pattern in (public_tokenizers.PATTERN, public_tokenizers.PATTERN.replace(LOOK_AHEAD, ""))]
    return held[vocabulary]


def encode_texts(texts: list, vocabulary: str) -> list[bytes]:
    """Token ids as little-endian 16-bit numbers, without the end token."""
    whole, single = _tokenizer(vocabulary)
    double = re.compile(r"\s\s").search      # Python's white space holds that of the pattern
    out = []
    for text in texts:
        if not text:
            out.append(b"")
            continue
        found = (whole if double(text) else single).encode_to_numpy(text, disallowed_special=())
        out.append(found.astype("<u2").tobytes())
    return out


def tokenize(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(key, row, doc_id, source, n_tokens, ids) with the end token included.

    Queues are in the order of ``key``; ``row`` orders equal rows only.
    """
    def run(batches):
        end = np.array([END_ID], "<u2").tobytes()
        for pdf in batches:
            ids = [x + end for x in encode_texts(pdf["text"].tolist(), vocabulary)]
            yield pd.DataFrame({"key": pdf["key"], "row": pdf["row"], "doc_id": pdf["doc_id"], "source": pdf["source"],
                                "n_tokens": [len(x) // 2 for x in ids], "ids": ids})

    rows = docs.select(F.shiftrightunsigned(F.xxhash64(id_col, text_col, F.lit(2)), 1).alias("key"),
                       F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "key long, row long, doc_id long, source string, n_tokens long, ids binary")


class _Schedule:
    """What each source has been served where the stream is cut, if served at
    its share of the sources that still have tokens."""

    def __init__(self, totals: dict[str, int], shares: dict[str, float]):
        self.totals = totals
        self.segments: list[tuple[float, dict, dict]] = []      # position, served, rates
        at, served, left = 0.0, dict.fromkeys(totals, 0.0), {s for s, n in totals.items() if n}
        while left:
            weights = {s: shares.get(s, 0.0) for s in left}
            if not any(weights.values()):       # sources without a share come last
                weights = {s: float(totals[s]) for s in left}
            size = sum(weights.values())
            rates = {s: w / size for s, w in weights.items() if w}
            self.segments.append((at, dict(served), rates))
            lasts = {s: (totals[s] - served[s]) / rate for s, rate in rates.items()}
            step = min(lasts.values())
            at += step
            for s, rate in rates.items():
                served[s] += rate * step
                if lasts[s] <= step * (1 + 1e-9):
                    served[s] = float(totals[s])
                    left.discard(s)
        self.starts = [x[0] for x in self.segments]

    def served(self, source: str, position: int) -> float:
        at, served, rates = self.segments[max(0, bisect_right(self.starts, position) - 1)]
        return min(served[source] + rates.get(source, 0.0) * (position - at), float(self.totals[source]))

    def cuts(self, length: int) -> list[dict[str, int]]:
        """Whole tokens of every source before each partition of ``length``."""
        total = sum(self.totals.values())
        found = [dict.fromkeys(self.totals, 0)]
        for position in range(length, total + length, length):
            position, last = min(position, total), found[-1]
            ideal = {s: self.served(s, position) for s in self.totals}
            now = {s: max(last[s], int(x)) for s, x in ideal.items()}
            spare = position - sum(now.values())
            while spare:
                sign = 1 if spare > 0 else -1
                free = [s for s in now if (now[s] < self.totals[s] if spare > 0 else now[s] > last[s])]
                for s in sorted(free, key=lambda s: (-sign * (ideal[s] - now[s]), s))[:abs(spare)]:
                    now[s] += sign
                    spare -= sign
            found.append(now)
        return found


def _serve(queues: dict, shares: dict, deficits: dict, position: int, window: int, quantum: int, credit=None):
    """Deficit round-robin over ``queues`` (source -> deque of (doc, size)).

    Yields (source, doc, start, length, position): pieces that never cross a
    window.  ``deficits`` are carried in and updated.  ``credit``: what a source
    is due between two positions, if not its share of them.
    """
    credit = credit or (lambda s, start, stop: shares[s] * (stop - start))
    order = sorted(queues)
    served = {s: 0 for s in order}                  # tokens gone of the first document of a queue
    turn = 0
    while order:
        room = window - position % window
        for s in order:
            deficits[s] = deficits.get(s, 0.0) + credit(s, position, position + room)
        while room and order:
            # The next source in turn that its deficit allows; if none, the
            # one owed most (queues that have run dry leave their share).
            for k in range(len(order)):
                s = order[(turn + k) % len(order)]
                doc, size = queues[s][0]
                packet = min(quantum, size - served[s])
                if deficits[s] >= packet:
                    break
            else:
                k, s = max(enumerate(order), key=lambda x: (deficits[x[1]], -x[0]))
                k = (k - turn) % len(order)
                doc, size = queues[s][0]
                packet = min(quantum, size - served[s])
            length = min(room, max(packet, min(size - served[s], int(deficits[s]))))
            yield s, doc, served[s], length, position
            position += length
            room -= length
            deficits[s] -= length
            served[s] += length
            turn = (turn + k) % len(order)
            if served[s] == size:
                queues[s].popleft()
                served[s] = 0
                if not queues[s]:
                    order.remove(s)
                    turn = turn % len(order) if order else 0
                    continue
            elif deficits[s] < min(quantum, size - served[s]):
                turn = (turn + 1) % len(order)


def pack(docs: DataFrame, vocabulary: str, shares: dict[str, float] | None = None, window: int = WINDOW,
         quantum: int = QUANTUM, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, source.

    ``shares`` are target token proportions by source; by default the sources'
    shares of all tokens, so that every window has the corpus's proportions to
    the end (with other shares a source that runs dry leaves its part to the
    others).  Null and empty texts are the end token alone; a null source is a
    queue of its own; rows that repeat an id, and rows without one, are packed
    each.  An empty table gives an empty frame; other columns are ignored.
    """
    tokens = stage(tokenize(docs, vocabulary, id_col, text_col, source_col), "pack-tokens")
    queue = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")).alias("queue")
    totals = {r["queue"]: r["n"] for r in tokens.groupBy(queue).agg(F.sum("n_tokens").alias("n")).collect()}
    total = sum(totals.values())
    if shares is None:
        weights = {s: float(n) for s, n in totals.items()}
    else:
        weights = {"-" if s is None else "=" + s: float(w) for s, w in shares.items()}
    schedule = _Schedule(totals, weights)
    parts = max(1, total // PARTITION_TOKENS)
    length = max(1, -(-total // (parts * window))) * window
    cuts = schedule.cuts(length)
    places = _places(tokens.select(queue, "key", "row", "n_tokens"), cuts, totals, parts)

    @F.pandas_udf("array<struct<part: int, first: long, n: long>>")
    def deal(queues: pd.Series, keys: pd.Series, rows: pd.Series, sizes: pd.Series) -> pd.Series:
        found = []
        for q, key, row, n in zip(queues, keys, rows, sizes):
            firsts = places[q]
            part, stop = bisect_right(firsts, (key, row, 0)), bisect_right(firsts, (key, row, n - 1))
            edges = [0] + [x[2] for x in firsts[part:stop]] + [n]
            found.append([{"part": part + k, "first": a, "n": b - a} for k, (a, b) in enumerate(zip(edges, edges[1:])) if a < b])
        return pd.Series(found, dtype=object)

    def run(key, rows):
        if rows.empty:
            return pd.DataFrame()
        part = int(key[0])
        position = part * length
        rows = rows.sort_values(["key", "row", "first"]).reset_index(drop=True)
        queue = ["-" if s is None else "=" + s for s in rows["source"]]
        lines: dict = {}
        for k, (q, n) in enumerate(zip(queue, rows["n_tokens"].tolist())):
            lines.setdefault(q, deque()).append((k, n))
        deficits = {q: schedule.served(q, position) - cuts[part][q] for q in lines}
        ids = rows["ids"].tolist()
        wide: dict = {}
        found = []
        for q, doc, start, length_, at in _serve(lines, {}, deficits, position, window, quantum,
                                                 lambda s, a, b: schedule.served(s, b) - schedule.served(s, a)):
            data = wide.get(q)
            if data is None or data[0] != doc:
                data = wide[q] = (doc, np.frombuffer(ids[doc], "<u2").astype("<u4").tobytes())
            found.append((doc, start, length_, zlib.crc32(memoryview(data[1])[4 * start: 4 * (start + length_)]),
                          at // window, at % window))
        out = pd.DataFrame(found, columns=["doc", "start", "length", "ids_crc32", "sequence_id", "offset"])
        of = out["doc"].to_numpy()
        out["start"] += rows["first"].to_numpy()[of]
        out["doc_id"] = rows["doc_id"].to_numpy()[of] if rows["doc_id"].notna().all() else rows["doc_id"].astype("Int64").iloc[of].array
        out["doc_tokens"] = rows["doc_tokens"].to_numpy()[of]
        out["source"] = rows["source"].to_numpy()[of]
        return out[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]]

    # Only places go through Python here; ids are cut where they lie.
    dealt = (tokens.withColumn("cut", F.explode(deal(queue, "key", "row", "n_tokens")))
             .select("cut.part", "key", "row", "doc_id", "source", F.col("n_tokens").alias("doc_tokens"), "cut.first",
                     F.col("cut.n").alias("n_tokens"), F.expr("substring(ids, int(2 * cut.first + 1), int(2 * cut.n))").alias("ids")))
    return dealt.groupBy("part").applyInPandas(run, PIECE_SCHEMA)


def _places(index: DataFrame, cuts: list[dict], totals: dict, parts: int) -> dict[str, list[tuple[int, int, int]]]:
    """Where partitions 1, 2, ... begin in each queue: (key, row, token).

    Queues are summed by cells, ranges of the key; only the cells' sums and the
    places come to the driver, both a number of partitions times sources.
    """
    bits = max(6, int(parts).bit_length() - 2)
    cells = index.withColumn("cell", F.shiftrightunsigned("key", 63 - bits).cast("int"))
    before: dict = {q: [] for q in totals}
    for r in sorted(cells.groupBy("queue", "cell").agg(F.sum("n_tokens").alias("n")).collect()):
        before[r["queue"]].append((r["cell"], r["n"]))
    wanted, end = {}, (1 << 63, 0, 0)
    places = {q: [end] * (len(cuts) - 2) for q in totals}
    for q, sums in before.items():
        ends = np.cumsum([n for _, n in sums])
        for p, cut in enumerate(cuts[1:-1]):
            if cut[q] < totals[q]:
                k = int(np.searchsorted(ends, cut[q], "right"))
                wanted.setdefault((q, sums[k][0]), []).append((p, int(cut[q] - ends[k] + sums[k][1])))
    if not wanted:
        return places

    def find(cell, docs):
        places = np.array(wanted.get((cell[0], int(cell[1])), []), np.int64).reshape(-1, 2)
        part, token = places[:, 0], places[:, 1]
        docs = docs.sort_values(["key", "row"])
        ends = docs["n_tokens"].cumsum().to_numpy()
        k = np.searchsorted(ends, token, "right")
        return pd.DataFrame({"queue": cell[0], "part": part, "key": docs["key"].to_numpy()[k], "row": docs["row"].to_numpy()[k],
                             "token": token - ends[k] + docs["n_tokens"].to_numpy()[k]})

    rows = cells.groupBy("queue", "cell").applyInPandas(find, "queue string, part int, key long, row long, token long")
    for r in rows.collect():
        places[r["queue"]][r["part"]] = (r["key"], r["row"], r["token"])
    return places
