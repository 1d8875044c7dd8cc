"""Operator 13: ranking by pruned inner products against scoring everything."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from folio.llm import ranked_search
from folio.llm.ranked_search import rank_documents
from tests.llm.helpers import DOCS, docs_frame, odd_rows, rows_of

ITEMS = "item_id long, text string"


def plain_terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def brute(docs, items, k=20):
    """Rows (item, rank, id, score) by the formula, every document scored."""
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    holders = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, bag in bags:
            m = 75 + (25 * sum(bag.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m))
                        for t in plain_terms(text) if bag[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def ranked(spark, docs, items, **more):
    frame = docs_frame(spark, [(i, t) for i, t in docs])
    return sorted((tuple(r.values()) for r in rows_of(rank_documents(frame, spark.createDataFrame(items, ITEMS), **more))), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    weights = [1 / (k + 1) for k in range(400)]
    docs = [(k, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 5, 40, 300])))) for k in range(n)]
    items = [(k, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 3, 30])))) for k in range(30)]
    # Passages of some documents, whole and in part, and copies.
    items += [(100 + k, " ".join(docs[7 * k][1].split()[:30])) for k in range(10)]
    docs += [(n + k, docs[3 * k][1]) for k in range(40)]
    return docs, items


@pytest.mark.parametrize("seeds, block, bucket", [(20_000, 1_000, 256), (60, 1_000, 4), (60, 7, 16)])
def test_as_scoring_every_document(spark, monkeypatch, seeds, block, bucket):
    monkeypatch.setattr(ranked_search, "SEEDS", seeds)
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", block)
    monkeypatch.setattr(ranked_search, "BUCKET", bucket)
    docs, items = corpus(600, seeds + block)
    assert ranked(spark, docs, items, k=5) == brute(docs, items, 5)


def test_ties_and_repeated_rows(spark):
    docs = [(k % 13, "same words here") for k in range(60)] + [(None, "same words here"), (99, "other Words")]
    items = [(1, "WORDS same"), (1, "WORDS same"), (None, "here"), (2, "absent"), (3, None), (4, "")]
    assert ranked(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    items = [(k, t) for k, (_, t) in enumerate(rows) if t is None or len(t) < 1000] + [(50, "žluťoučký ŽLU and 日本語 word5, word5")]
    frame = docs_frame(spark, rows).withColumnRenamed("lang", "score").withColumnRenamed("source", "item_id")
    got = rank_documents(frame, spark.createDataFrame(items, ITEMS).withColumn("doc_id", ranked_search.F.lit(1)))
    assert sorted((tuple(r.values()) for r in rows_of(got)), key=str) == brute(rows, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a word")], ITEMS)
    for d, i in ((docs, items), (docs, some), (docs_frame(spark, [(1, "a word")]), items)):
        out = rank_documents(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and rows_of(out) == []


def test_bounds_pass_over_most_documents():
    """With a threshold most rows are pruned by length or coordinates, and no
    row at or above it is lost."""
    rng = np.random.default_rng(4)
    n_rows, n_terms = 4000, 300
    weight = rng.integers(1, 9000, n_terms)
    size = rng.integers(1, 60, n_rows)
    row = np.repeat(np.arange(n_rows), size)
    term = rng.integers(0, n_terms, len(row))
    key = np.unique(row * n_terms + term)
    row, term = key // n_terms, key % n_terms
    impact = rng.integers(1, 10**6, len(row))
    index = ranked_search._Lengths(row, term, impact, weight, n_rows)
    scored = 0
    for q in range(40):
        item = ranked_search._Item({int(t): int(c) for t, c in zip(rng.choice(n_terms, 12, replace=False), rng.integers(1, 3, 12))}, weight)
        dense = np.zeros(n_terms, np.int64)
        dense[item.term] = item.value
        full = np.bincount(row, dense[term] * impact, minlength=n_rows).astype(np.int64)[index.order]
        least = int(np.sort(full)[-20])
        rows, scores, seen = item.search(index, weight, least)
        assert rows.tolist() == np.flatnonzero(full >= least).tolist() and scores.tolist() == full[rows].tolist()
        scored += seen["scored"]
    assert scored < 0.15 * 40 * n_rows


def test_large_counts_stay_exact():
    n = np.array([3 * 10**9, 5], np.int64)
    got = ranked_search._impacts(n, np.array([0, 1]), np.array([2 * 10**9, 1]), 10**11, 7 * 10**12)
    want = [(10**9 * c) // (1000 * c + 12 * (75 + (25 * x * 10**11) // (7 * 10**12))) for x, c in zip(n.tolist(), (2 * 10**9, 1))]
    assert got.tolist() == want


def test_batches_without_rows():
    batch = pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.list_(pa.int32())),
                                        pa.array([], pa.list_(pa.int32()))], names=["id", "n", "terms", "counts"])
    held, work = ranked_search.search_batches([batch], [ranked_search._Item({0: 1}, np.array([5]))], np.array([5]), [1], 1, 1, 3)
    assert held == [([], [])] and not work
