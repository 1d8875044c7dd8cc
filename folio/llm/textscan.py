"""Vectorised word and shingle hashing over batches of texts (numpy)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 2_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser, seeded."""
    x = x + _U((seed * 0x9E3779B97F4A7C15 + 0x7F4A7C15F39CC060) & (2**64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


def chunks(texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts as UTF-8 bytes, about ``limit`` bytes at a time (a
    longer text comes alone); null is empty."""
    first, held, size = 0, [], 0
    for k, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass") if text else b""
        if held and size + len(data) > limit:
            yield first, held
            first, held, size = k, [], 0
        held.append(data)
        size += len(data)
    if held:
        yield first, held


def word_hashes(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``docs`` (A-Z lower-cased) and, per document, the
    index of its first word (one entry more at the end)."""
    data = b" ".join(docs).lower() + b" "
    buf = np.frombuffer(data, np.uint8)
    blank = _SPACE[buf]
    turn = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        turn = np.concatenate(([0], turn))
    starts, ends = turn[0::2], turn[1::2]
    doc_at = np.concatenate(([0], np.cumsum([len(d) + 1 for d in docs])))
    first = np.searchsorted(starts, doc_at)
    if len(starts) == 0:
        return np.zeros(0, _U), first
    length = ends - starts
    keep = buf[~blank].astype(_U) + _U(1)
    at = np.concatenate(([0], np.cumsum(length)[:-1]))
    inside = np.arange(len(keep)) - np.repeat(at, length)
    keep *= powers(int(length.max()))[inside]
    return mix(np.add.reduceat(keep, at) + length.astype(_U), 1), first


def shingles(docs: list[bytes], n: int) -> list[np.ndarray]:
    """For each document its sorted distinct hashes of ``n`` consecutive words;
    a document of fewer words has one, of all its words; without words none."""
    words, first = word_hashes(docs)
    out = []
    rows = np.zeros(0, _U)
    if len(words) >= n:
        rows = words[: len(words) - n + 1].copy()
        for k in range(1, n):
            rows = rows * _U(0xD6E8FEB86659FD93) + words[k: len(words) - n + 1 + k]
        rows = mix(rows, 2)
    for s, e in zip(first[:-1], first[1:]):
        if e - s >= n:
            out.append(np.unique(rows[s: e - n + 1]))
        elif e > s:
            short = np.array([e - s], _U)
            for w in words[s:e]:
                short = mix(short * _U(0xD6E8FEB86659FD93) + w, 3)
            out.append(short)
        else:
            out.append(np.zeros(0, _U))
    return out
