import os
import random

import numpy as np

from folio.llm import minhash
from folio.llm.common import shared_dir
from folio.llm.components import connected_components
from folio.llm.minhash import drop_near_duplicates
from tests.llm.helpers import WORD, components, docs_frame, odd_rows, rows_of


def shingle_set(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[k:k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()


def brute(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, components(ids, links)


def test_components_on_random_graphs(spark):
    rng = random.Random(1)
    for n, m in ((40, 30), (60, 60)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(k, k + 1) for k in range(100, 120)]
        got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
        nodes = {x for e in edges if e[0] != e[1] for x in e}
        want = components({x for e in edges for x in e}, edges)
        assert got == {x: want[x] for x in nodes}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketch_fills_every_bin_and_estimates_similarity():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    sets = [base[:3000], base[1000:], base[:1], base[:0]]
    sketch = minhash.fast_similarity_sketch(sets)
    assert (sketch[:3] != np.uint64(2**64 - 1)).all()
    assert abs((sketch[0] == sketch[1]).mean() - 0.5) < 0.12
    alone = minhash.fast_similarity_sketch([sets[1]])
    assert (alone[0] == sketch[1]).all()


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"w{k}" for k in range(300)]
    rows, base = [], []
    for k in range(60):
        words = [rng.choice(vocab) for _ in range(rng.randrange(1, 80))]
        base.append(words)
        rows.append((len(rows), " ".join(words)))
        for _ in range(rng.randrange(0, 6)):
            copy = list(base[rng.randrange(len(base))])
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab).upper()
            rows.append((len(rows), "  ".join(copy)))
    sets, want = brute(rows)
    got = {r["doc_id"]: r for r in rows_of(minhash.near_duplicates(docs_frame(spark, rows)))}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())


def test_odd_rows(spark):
    docs = docs_frame(spark, odd_rows()).selectExpr("*", "1 as n_shingles", "'x' as component_id", "true as kept")
    got = rows_of(minhash.near_duplicates(docs))
    assert len(got) == len(odd_rows())
    by_id = {r["doc_id"]: r for r in got if r["doc_id"]}
    assert [by_id[k]["component_id"] for k in (1, 2, 3, 4, 5, 6, 10)] == [1, 2, 3, 4, 4, 4, 10]
    assert by_id[1]["n_shingles"] == by_id[3]["n_shingles"] == 0
    assert all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in rows_of(kept)) == [0, 0, 1, 2, 3, 4, 7, 8, 9, 10]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_small_tables_of_ids_are_few_files(spark):
    folder = f"{shared_dir(spark)}/folio-llm".removeprefix("file:")
    names = ("cc", "minhash-classes", "minhash-bands", "minhash-buckets", "minhash-pairs", "minhash-open", "minhash-marked")
    tables = lambda: {f"{folder}/{x}" for x in (os.listdir(folder) if os.path.isdir(folder) else []) if x[:-33] in names}
    rows = [(k, " ".join(f"w{k // 3}x{i}" for i in range(60)) + f" end {k % 3 % 2}") for k in range(120)]
    before, settings = tables(), {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        kept = drop_near_duplicates(docs_frame(spark, rows)).select("doc_id").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(r["doc_id"] for r in kept) == list(range(0, 120, 3))
    files = {x: sum(f.endswith(".parquet") for f in os.listdir(x)) for x in tables() - before}
    assert sum(n > 1 for n in files.values()) <= 2 < len(files)       # the links as they come, twice, before they are counted
