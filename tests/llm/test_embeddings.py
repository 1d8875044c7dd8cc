import numpy as np

from folio.llm import embeddings
from tests.llm.helpers import components, rows_of

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows, threshold=embeddings.THRESHOLD):
    usable = {}
    for i, v, label, _ in rows:
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[i] = (np.array(v, np.float32).astype(float), label)
    ids = sorted(usable)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            (x, p), (y, q) = usable[a], usable[b]
            if p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links.append((a, b))
    return links, components([r[0] for r in rows], links)


def test_quantised_bounds_hold():
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal((200, 24)), rng.standard_normal((150, 24))
    b[:100] = a[:100] + rng.standard_normal((100, 24)) * rng.uniform(0, 0.6, (100, 1))
    unit = lambda x: x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    want = unit(a) @ unit(b).T >= 0.93
    assert (embeddings.links_between(a, b, False) == want).all() and want.any()
    (p, s, e), (q, t, f) = embeddings.quantise(unit(a)), embeddings.quantise(unit(b))
    near = (p.astype(float) @ q.astype(float).T) * s[:, None] * t
    assert (np.abs(unit(a) @ unit(b).T - near) <= e[:, None] * (1 + f) + f).all()


def test_against_brute_force_with_small_tiles(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(240):
        if k % 3 and rows:
            v = np.array(rows[int(rng.integers(len(rows)))][1]) + rng.standard_normal(8) * rng.choice([0, 0.1, 0.3])
        else:
            v = rng.standard_normal(8)
        rows.append((k, v.astype(np.float32).astype(float).tolist(), int(k % 2) if k % 11 else 0, "x"))
    links, want = brute(rows)
    got = {r["vec_id"]: r for r in rows_of(embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA), tile=16))}
    degree = {k: 0 for k, *_ in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    assert {k: r["n_links"] for k, r in got.items()} == degree
    assert {k: r["component_id"] for k, r in got.items()} == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0, ""), (2, [], 0, ""), (3, [0.0, 0.0], 0, ""), (4, [1.0, None], 0, ""), (5, [nan, 1.0], 0, ""),
            (6, [inf, 1.0], 0, ""), (7, [1.0, 0.0], None, None), (8, [1.0, 0.0], 0, ""), (9, [2.0, 0.0], 0, ""),
            (10, [1.0, 0.0], 1, ""), (11, [1.0, 0.0, 0.0], 0, ""), (12, [1.0, 0.0], 0, ""), (12, [1.0, 0.0], 0, ""),
            (None, [1.0, 0.0], 0, "")]
    got = rows_of(embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(((r["vec_id"] or 0), r["n_links"], r["component_id"]) for r in got) == sorted(
        [(0, 0, None)] + [(k, 0, k) for k in (1, 2, 3, 4, 5, 6, 7, 10, 11)] + [(8, 3, 8), (9, 3, 8), (12, 3, 8), (12, 3, 8)])
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
