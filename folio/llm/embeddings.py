"""Near-duplicate embeddings by int8 tile products (operator 1).

Unit vectors are quantised to ``scale * int8`` with the exact norm of their
quantisation error beside them.  For two vectors with errors e and f

    | <x, y> - s t <p, q> |  <=  e (1 + f) + f

so an integer tile product (exact in float32 arithmetic up to 2**24) bounds
every cosine of a tile pair from both sides.  Pairs certainly above or below
the threshold are decided by the bound; only the others are computed in double
precision.

Equal vectors of a label form one class first.  The classes of a label are
cut into tiles by the signs of fixed projections and, within, by a hash, so a
tile holds about ``TILE`` vectors however common a direction is.  A tile keeps
its centre and the largest angle to it; a pair of tiles is compared only if
the triangle inequality on angles allows a link.  Blocks of vectors meet in
tile pairs -- pairs of vectors are never rows -- and a tile pair returns link
counts per vector and a spanning forest of its links, so its output is linear.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import stage
from folio.llm.components import connected_components

THRESHOLD = 0.93
TILE = 1024
PLANES = 12
SLACK = 1e-6                    # float32 rounding of the scaled products
EXACT_ROWS = 100_000            # pairs computed in double precision at a time


def _unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales and the norms of what quantisation loses."""
    scale = np.abs(unit).max(axis=1) / 127
    rows = np.rint(unit / scale[:, None]).astype(np.int8)
    return rows, scale, np.sqrt(((unit - rows * scale[:, None]) ** 2).sum(axis=1)) + 1e-12


def links_between(a: np.ndarray, b: np.ndarray, same: bool, threshold: float = THRESHOLD,
                  qa=None, qb=None) -> np.ndarray:
    """Boolean matrix of the pairs of rows of ``a`` and ``b`` (raw float64)
    with cosine >= threshold; ``same``: only pairs i < j."""
    ua, ub = _unit(a), _unit(b)
    (pa, sa, ea), (pb, sb, eb) = qa or quantise(ua), qb or quantise(ub)
    near = (pa.astype(np.float32) @ pb.astype(np.float32).T) * sa[:, None] * sb[None, :]
    bound = ea[:, None] * (1 + eb[None, :]) + eb[None, :] + SLACK
    sure = near - bound >= threshold
    open_ = (near + bound >= threshold) & ~sure
    if same:
        upper = np.triu(np.ones(near.shape, bool), 1)
        sure &= upper
        open_ &= upper
    i, j = np.nonzero(open_)
    na, nb = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
    for k in range(0, len(i), EXACT_ROWS):
        x, y = i[k: k + EXACT_ROWS], j[k: k + EXACT_ROWS]
        cosine = (a[x] * b[y]).sum(axis=1) / (na[x] * nb[y])
        sure[x, y] = cosine >= threshold
    return sure


def _forest(links: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Links that connect what ``links`` connects: fewer than vectors."""
    if same:
        ids, joined = ids_a, links | links.T
    else:
        ids, n = np.concatenate((ids_a, ids_b)), len(ids_a)
        joined = np.zeros((len(ids), len(ids)), bool)
        joined[:n, n:], joined[n:, :n] = links, links.T
    fresh, out = joined.any(axis=1), []
    for first in np.flatnonzero(fresh):
        if not fresh[first]:
            continue
        fresh[first], waiting = False, [first]
        while waiting:
            x = waiting.pop()
            new = np.flatnonzero(joined[x] & fresh)
            fresh[new] = False
            out += [(int(ids[x]), int(y)) for y in ids[new]]
            waiting += new.tolist()
    return out


def _tile_rows(key, pdf):
    pdf = pdf.sort_values("rep")
    raw = np.array(pdf["embedding"].tolist(), np.float64)
    unit = _unit(raw)
    rows, scale, error = quantise(unit)
    centre = unit.sum(axis=0)
    norm = np.sqrt((centre * centre).sum())
    centre = centre / norm if norm > 0 else unit[0]
    radius = float(np.arccos(np.clip((unit @ centre).min(), -1, 1)))
    return pd.DataFrame([{
        "tile": key[3], "label": key[0], "dim": key[1], "n": len(pdf), "centre": centre, "radius": radius,
        "ids": pdf["rep"].to_numpy(np.int64).tobytes(), "copies": pdf["copies"].to_numpy(np.int64).tobytes(),
        "raw": raw.astype(np.float32).tobytes(), "rows": rows.tobytes(),
        "scale": scale.tobytes(), "error": error.tobytes()}])


def _pair_rows(batches, threshold):
    for pdf in batches:
        out = []
        for r in pdf.itertuples():
            side = []
            for x in ("a", "b"):
                get = lambda name: getattr(r, f"{name}_{x}")
                raw = np.frombuffer(get("raw"), np.float32).reshape(-1, r.dim).astype(np.float64)
                side.append((np.frombuffer(get("ids"), np.int64), np.frombuffer(get("copies"), np.int64), raw,
                             (np.frombuffer(get("rows"), np.int8).reshape(-1, r.dim),
                              np.frombuffer(get("scale"), np.float64), np.frombuffer(get("error"), np.float64))))
            (ia, ca, a, qa), (ib, cb, b, qb) = side
            links = links_between(a, b, r.tile_a == r.tile_b, threshold, qa, qb)
            for ids, n in ((ia, links @ cb), (ib, ca @ links)):
                hit = np.flatnonzero(n)
                out += [(int(x), int(y), True) for x, y in zip(ids[hit], n[hit])]
            out += [(x, y, False) for x, y in _forest(links, ia, ib, r.tile_a == r.tile_b)]
        yield pd.DataFrame(out, columns=["a", "b", "counts"])


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors are compared within a label (and length).  A null label, and a
    vector that is null, empty, zero or holds null or non-finite components,
    links with nothing, as does a row without an id (its component is null
    and it is kept).  Rows that repeat an id are vectors of their own.  An
    empty table gives an empty frame; other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<float>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("embedding", lambda x: x != 0)
    usable = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()) \
        .filter(fine)
    classes = stage(usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")),
                    "vectors-classes")

    def coded(batches):
        for pdf in batches:
            codes = np.zeros(len(pdf), np.int64)
            dims = pdf["embedding"].map(len).to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                planes = np.random.default_rng(int(d)).standard_normal((int(d), PLANES))
                signs = np.array(pdf["embedding"].iloc[at].tolist(), np.float64) @ planes > 0
                codes[at] = signs @ (1 << np.arange(PLANES - 1, -1, -1))
            yield pdf.assign(dim=dims.astype(np.int32), code=codes.astype(np.int32))

    kind = dict(classes.dtypes)["label"]
    marked = stage(classes.mapInPandas(coded, f"label {kind}, embedding array<float>, rep long, copies long, dim int, code int"),
                   "vectors-coded")
    # As many sign bits as bring a label's tiles to TILE vectors on average;
    # a code that holds more is cut by a hash.
    bits = marked.groupBy("label", "dim").agg(F.greatest(F.lit(0), F.least(
        F.lit(PLANES), F.floor(F.log2(F.count(F.lit(1)) / tile)).cast("int"))).alias("bits"))
    coarse = marked.join(bits, ["label", "dim"]).withColumn("code", F.expr(f"shiftright(code, {PLANES} - bits)"))
    cuts = coarse.groupBy("label", "dim", "code").agg(F.ceil(F.count(F.lit(1)) / tile).alias("cuts"))
    cut = coarse.join(cuts, ["label", "dim", "code"]) \
        .withColumn("cut", F.pmod(F.xxhash64("rep"), F.col("cuts")).cast("int")) \
        .withColumn("tile", F.concat_ws("/", "code", "cut"))
    tiles = stage(cut.groupBy("label", "dim", "code", "tile").applyInPandas(
        _tile_rows, f"tile string, label {kind}, dim int, n long, centre array<double>, radius double, ids binary, "
                    "copies binary, raw binary, rows binary, scale binary, error binary"), "vectors-tiles")
    one = tiles.select("label", "dim", F.col("tile").alias("tile_a"), F.col("centre").alias("centre_a"), F.col("radius").alias("radius_a"))
    two = tiles.select("label", "dim", F.col("tile").alias("tile_b"), F.col("centre").alias("centre_b"), F.col("radius").alias("radius_b"))
    inner = F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), inner)))
    reach = float(np.arccos(threshold)) + 1e-6
    pairs = one.join(two, ["label", "dim"]).filter("tile_a <= tile_b") \
        .filter((F.col("tile_a") == F.col("tile_b")) | (apart <= F.col("radius_a") + F.col("radius_b") + reach)) \
        .select("label", "dim", "tile_a", "tile_b")
    blobs = ["ids", "copies", "raw", "rows", "scale", "error"]
    side = lambda x: tiles.select("label", "dim", F.col("tile").alias(f"tile_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in blobs])
    work = stage(pairs, "vectors-pairs").repartition("label", "tile_a", "tile_b") \
        .join(side("a"), ["label", "dim", "tile_a"]).join(side("b"), ["label", "dim", "tile_b"])
    found = stage(work.mapInPandas(lambda batches: _pair_rows(batches, threshold), "a long, b long, counts boolean"),
                  "vectors-links")
    degree = found.filter("counts").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("linked"))
    components = connected_components(found.filter("not counts").select("a", "b"))

    facts = (classes.join(degree, "rep", "left").join(components.withColumnRenamed("id", "rep"), "rep", "left")
             .select("label", "embedding", F.coalesce("component", "rep").alias("component_id"),
                     (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")))
    own = usable.join(facts, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine,
                                    F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return own.union(alone).withColumn("kept", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)))
