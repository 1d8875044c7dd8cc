"""Operator 11: runs of repeated words against a brute-force search."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm import periodic_runs, registry
from tests.llm.helpers import DOCS, WORD, docs_frame, odd_rows, rows_of


def brute_runs(words, min_length=6, min_exponent=4):
    """(start, length, period) of all runs: for every period the islands of
    equal words that far apart; the smallest period of a stretch counts."""
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(min_length, min_exponent * q):
                found.setdefault((start, i + q - start), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def brute_left(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


periodic = st.lists(st.tuples(st.lists(st.integers(0, 3), max_size=6), st.integers(0, 9)), max_size=6).map(
    lambda parts: [w for block, times in parts for w in block * times])


@settings(max_examples=300, deadline=None)
@given(st.lists(periodic, min_size=1, max_size=4), st.sampled_from([2, 3, 4]))
def test_runs_of_several_texts(texts, exponent):
    words = np.array([w for t in texts for w in t], np.int64)
    got = periodic_runs.runs_of(words, np.array([len(t) for t in texts], np.int64), 6, exponent)
    want, base = [], 0
    for t in texts:
        want += [[base + s, base + s + length, q] for s, length, q in brute_runs(t, 6, exponent)]
        base += len(t)
    assert got.tolist() == sorted(want, key=lambda r: (r[0], r[2]))


def test_long_staircases_and_large_children():
    # Prefix lengths that rise for long need the walk behind the jumps.
    for words in ([0] * 3000, [0, 1] * 1500, [0, 1, 0, 2, 0, 3, 0] * 300, list(range(500)) * 5):
        got = periodic_runs.runs_of(np.array(words), np.array([len(words)]))
        assert [(s, e - s, q) for s, e, q in got.tolist()] == brute_runs(words)


def test_previous_smaller():
    rng = random.Random(3)
    for _ in range(200):
        value = [0] + [rng.choice([0, 1, 2, 5, k]) for k in range(rng.randrange(400))]
        back = periodic_runs.previous_smaller(np.array(value))
        for k, v in enumerate(value):
            if v > 0:
                assert back[k] == max(j for j in range(k) if value[j] < v)


def test_odd_rows_and_general_interface(spark):
    rows = odd_rows() + [(20, "go on " * 9 + "and stop", "en", "a"), (21, "a a a a a", "en", "a"), (22, "tick\ttock\n" * 4, "en", "a")]
    out = rows_of(periodic_runs.periodic_runs(docs_frame(spark, rows).withColumnRenamed("lang", "runs")))
    assert len(out) == len(rows)
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append(WORD.findall(r[1] or ""))
    for row in out:
        words = next(t for t in texts[row["doc_id"]] if brute_left(t, brute_runs(t)) == row["collapsed"]) if len(texts[row["doc_id"]]) > 1 \
            else texts[row["doc_id"]][0]
        if len(words) < 5000:
            assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == brute_runs(words)
            assert row["collapsed"] == brute_left(words, brute_runs(words))
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[20]["collapsed"] == "go on and stop" and by_id[22]["collapsed"] == "tick tock"
    assert by_id[21]["runs"] == [] and by_id[1]["collapsed"] == ""
    assert [r["period"] for r in by_id[7]["runs"]] == [977 * 4]
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs_frame(spark, rows), min_exponent=1)


def test_empty_table(spark):
    assert rows_of(periodic_runs.periodic_runs(spark.createDataFrame([], DOCS))) == []


def test_query_on_whole_documents(spark):
    """Every column of the query against the contract written out in Python."""
    sf_dir = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r.asDict() for r in registry.op11_periodic_runs(spark, sf_dir).collect()}
    for doc in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        words = WORD.findall(doc["text"] or "")
        h, n = zlib.crc32(str(doc["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        row = got.pop(doc["doc_id"])
        assert row["n_runs"] == len(runs)
        top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        assert (row["start"], row["length"], row["period"]) == (top or (None, None, None))
        assert row["exponent_milli"] == (1000 * top[1] // top[2] if top else None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(brute_left(words, runs).encode()).hexdigest()
    assert not got
