"""Document fingerprints by context-triggered piecewise hashing (operator 6).

A rolling hash over seven bytes cuts a text where it hits a multiple of the
block size; every piece gives one character, so an edit changes the characters
of the pieces it touches and leaves the others.  A fingerprint holds the block
size and the signatures at that size and at twice that size.  Two fingerprints
are comparable if they share a block size; their likeness is one minus the
edit distance (insertions and deletions) of the signatures over their length,
and 0 without a run of equal characters that chance does not explain.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.textscan import mix, powers

ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
ROLL = 7                        # bytes a boundary depends on
SMALLEST = 3                    # smallest block size; others are doubled from it
PIECES = 64                     # characters a signature has at most
COMMON_RUN = 7                  # equal characters in a row that likeness needs
PART = 1 << 20                  # bytes hashed at a time
RANGE_CHARS = 16_000_000        # characters a stretch of the order aims at
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def _boundaries(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the pieces at the smallest block size, and for each the power
    of two by which the size may grow while it remains a boundary."""
    found = []
    for low in range(0, len(data), PART):
        begin = max(0, low - ROLL + 1)
        buf = np.frombuffer(data, np.uint8)[begin: low + PART].astype(_U) + _U(1)
        h = np.zeros(len(buf), _U)
        for k in range(min(ROLL, len(buf))):
            h[k:] += buf[: len(buf) - k] * _U(pow(_BASE, k + 1, 1 << 64))
        h = mix(h[low - begin:], 11)
        at = np.flatnonzero(h % _U(SMALLEST) == 0)
        found.append((at + low + 1, h[at] // _U(SMALLEST)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, h = (np.concatenate(x) for x in zip(*found))
    h |= _U(1 << 62)
    return at, np.log2((h & (~h + _U(1))).astype(np.float64)).astype(np.int64)


class Fingerprinter:
    """Fingerprints of texts; keeps a worker's power tables."""

    def __init__(self):
        self.pows, self.inverse = powers(1), powers(1)

    def fingerprint(self, data: bytes) -> str:
        """``block size:signature:signature at twice the size``."""
        n = len(data)
        if len(self.pows) < n + 1:
            size = max(2 * len(self.pows), n + 1, 1 << 16)
            self.pows, self.inverse = powers(size), powers(size, pow(_BASE, -1, 1 << 64))
        wide = np.frombuffer(data, np.uint8).astype(_U)
        wide += _U(1)
        wide *= self.pows[:n]
        sums = np.concatenate((np.zeros(1, _U), np.cumsum(wide)))
        at, level = _boundaries(data)
        size = 0
        while (level >= size).sum() >= PIECES:
            size += 1
        one, two = (self._signature(sums, at[level >= k], n) for k in (size, size + 1))
        return f"{SMALLEST << size}:{one}:{two}"

    def _signature(self, sums: np.ndarray, ends: np.ndarray, n: int) -> str:
        """A character for each piece, the rest behind the last boundary too."""
        if n == 0:
            return ""
        if not len(ends) or ends[-1] < n:
            ends = np.append(ends, n)
        begins = np.concatenate(([0], ends[:-1]))
        h = mix((sums[ends] - sums[begins]) * self.inverse[begins] + (ends - begins).astype(_U), 12)
        return ALPHABET[(h >> _U(58)).astype(np.int64)].tobytes().decode()


def _common_run(x: str, y: str) -> bool:
    """Whether the signatures share a long enough run; short signatures need
    a run of a quarter of the shorter one."""
    n = min(COMMON_RUN, -(-min(len(x), len(y)) // 4))
    grams = {x[k: k + n] for k in range(len(x) - n + 1)}
    return any(y[k: k + n] in grams for k in range(len(y) - n + 1))


def _distances(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Insert-delete distances of many pairs of signatures side by side."""
    m = max(len(x) for x, _ in pairs)
    n = max(len(y) for _, y in pairs)
    a, b = np.zeros((m, len(pairs)), np.uint8), np.full((n, len(pairs)), 1, np.uint8)
    for k, (x, y) in enumerate(pairs):
        a[: len(x), k] = np.frombuffer(x.encode(), np.uint8)
        b[: len(y), k] = np.frombuffer(y.encode(), np.uint8)
    la = np.array([len(x) for x, _ in pairs])
    lb = np.array([len(y) for _, y in pairs])
    # Longest common subsequence; the padding of the two sides never agrees.
    row = np.zeros((n + 1, len(pairs)), np.int16)
    for i in range(m):
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[1:], (row[:-1] + 1) * (b == a[i]))
        row = np.maximum.accumulate(new, axis=0)
    return la + lb - 2 * row[-1].astype(np.int64)


def likeness(pairs: list[tuple[str, str]]) -> np.ndarray:
    """0 to 1 for pairs of fingerprints; equal ones 1, two empty texts 1."""
    out = np.zeros(len(pairs))
    work, of = [], []
    for k, (x, y) in enumerate(pairs):
        if x == y:
            out[k] = 1
            continue
        (bx, x1, x2), (by, y1, y2) = x.split(":"), y.split(":")
        bx, by = int(bx), int(by)
        same = [(x1, y1), (x2, y2)] if bx == by else [(x1, y2)] if bx == 2 * by else [(x2, y1)] if by == 2 * bx else []
        for one, two in same:
            if one and two and _common_run(one, two):
                work.append((one, two))
                of.append(k)
    for low in range(0, len(work), 512):
        part = work[low: low + 512]
        total = np.array([len(x) + len(y) for x, y in part])
        np.maximum.at(out, of[low: low + 512], 1 - _distances(part) / total)
    return out


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text of a document ends with the beginning of the next one in
    descending order of ids (then of texts); rows without an id come last; the
    last document is followed by the first, a single one by itself.  Null
    texts are empty.  Equal texts have equal fingerprints.  An empty table
    gives an empty frame; other columns are ignored.

    Texts move once: ids are cut into ranges of about equal counts, a range is
    one stretch of the order, and the first document of every range is also
    sent to the end of the range before it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.md5(text).alias("tie"))
    size = rows.agg(F.sum(F.length("text")), F.count(F.lit(1))).first()
    parts = int(max(1, min((size[0] or 0) // RANGE_CHARS, size[1] // 2)))
    cuts = rows.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 10 * parts + 1000).alias("c")) \
        .first()["c"] if parts > 1 else None
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def stretch(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.full(len(ids), -1, np.int32)
        out[known] = len(cuts) - np.searchsorted(cuts, ids[known].astype("int64").to_numpy(), "right")
        return pd.Series(out)

    # Stretch 0 holds the largest ids; rows without an id come after all, in
    # 16 stretches by their digest.
    place = stretch("doc_id")
    place = F.when(place < 0, F.lit(len(cuts) + 1) + F.conv(F.left("tie", F.lit(1)), 16, 10).cast("int")).otherwise(place)
    order = F.struct(F.bitwise_not("doc_id").alias("id"), F.col("tie"))
    heads = rows.select("doc_id", "tie", place.alias("stretch")).groupBy("stretch").agg(F.min(order).alias("head"))
    heads = sorted((r["stretch"], r["head"]["id"], r["head"]["tie"]) for r in heads.collect())
    ends = [(h[1], h[2], heads[k - 1][0]) for k, h in enumerate(heads)]        # the first goes behind the last
    ends = docs.sparkSession.createDataFrame(ends, "head_id long, head_tie string, ahead int")
    placed = rows.withColumn("stretch", place).join(
        F.broadcast(ends), F.bitwise_not("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie")), "left")
    own = F.struct(F.col("stretch"), F.lit(False).alias("after"))
    also = F.struct(F.col("ahead").alias("stretch"), F.lit(True).alias("after"))
    dealt = placed.withColumn("at", F.explode(F.when(F.col("ahead").isNull(), F.array(own)).otherwise(F.array(own, also)))) \
        .select("at.stretch", "at.after", "doc_id", "tie", "text")
    return dealt.groupBy("stretch").applyInPandas(_fingerprint_stretch, SCHEMA)


def _fingerprint_stretch(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.assign(late=pdf["doc_id"].isna(), back=-pdf["doc_id"].fillna(0))
    pdf = pdf.sort_values(["after", "late", "back", "tie"], kind="stable")
    own = int((~pdf["after"].astype(bool)).sum())
    texts = pdf["text"].tolist()
    if len(texts) == own:                   # no following document: a repeated first row
        texts.append(texts[0])
    worker, known = Fingerprinter(), {}

    def print_of(text, data):
        if text not in known:
            known[text] = worker.fingerprint(data)
        return known[text]

    prints = [print_of(t, t.encode("utf-8", "surrogatepass")) for t in texts[: own + 1]]
    digests, edited = [], []
    for k in range(own):
        text = _edited(texts[k], texts[k + 1])
        data = text.encode("utf-8", "surrogatepass")
        digests.append(hashlib.sha256(data).hexdigest())
        edited.append(print_of(text, data) if text in known else worker.fingerprint(data))
    return pd.DataFrame({
        "doc_id": pdf["doc_id"].iloc[:own].astype("Int64").array, "n_chars": [len(t) for t in texts[:own]],
        "edited_sha256": digests, "fingerprint": prints[:own], "edited_fingerprint": edited,
        "near_edited": likeness(list(zip(prints, edited))), "near_next": likeness(list(zip(prints[:own], prints[1:]))),
    })
