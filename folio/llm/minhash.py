"""Near-duplicate documents by fast similarity sketching (operator 8).

A document is the set of its distinct 5-word shingles.  Its sketch has
``BANDS * ROWS`` coordinates.  In round r every shingle x is hashed to a bin
and a value, and a bin keeps the smallest ``r + value`` it has met; a document
leaves the rounds once all its bins are filled.  After as many rounds as there
are bins, round ``t + k`` throws every shingle into bin k, so every coordinate
fills however small the set.  Two documents agree on a coordinate with
probability J, their similarity, and the count of agreeing coordinates is
concentrated around ``t * J``.

Bands of five coordinates propose pairs: at J = 0.75 a pair is missed with
probability (1 - 0.75**5)**50 < 2e-6, at J = 0.85 < 1e-12.  Every proposal is
confirmed on the full sets.  Work stays linear where copies are many:

* equal sets are one class (a digest of the set), so copies never meet;
* a band bucket first proposes only (smallest member, member) pairs;
* pairs inside one component of the links found so far cannot change any
  component; only buckets that still hold several components are compared in
  full, in blocks: a task multiplies the incidence matrices of two blocks of a
  bucket's sets and returns links that join components, so the pairs are never
  rows.

The joins that move texts, sets and band keys carry a merge hint: their sides
grow with the input, and the plan is the same at every size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import stage
from folio.llm.components import connected_components
from folio.llm.textscan import chunks, mix, shingles

SHINGLE_WORDS = 5
BANDS, ROWS = 50, 5
BINS = BANDS * ROWS
BLOCK_DOCS = 512                # members of a bucket compared as one block
BLOCK_ITEMS = 400_000           # shingles of a block
MATRIX_COLUMNS = 4096
PERCENT = 75                    # link when 100 * intersection >= PERCENT * union
SKETCH_SCHEMA = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"
_U = np.uint64


def fast_similarity_sketch(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """``len(sets) x bins`` sketch; rows of empty sets hold the largest value."""
    empty = _U(2**64 - 1)
    out = np.full(len(sets) * bins, empty, _U)
    sizes = np.array([len(s) for s in sets], np.int64)
    rows = np.repeat(np.arange(len(sets)), sizes)
    items = np.concatenate(sets) if len(sets) else np.zeros(0, _U)
    for r in range(2 * bins):
        if not len(rows):
            break
        h = mix(items, 1000 + r)
        low = (_U(r) << _U(32)) | (h & _U(0xFFFFFFFF))
        if r < bins:
            at = rows * bins + ((h >> _U(32)) * _U(bins) >> _U(32)).astype(np.int64)
        else:
            at = rows * bins + (r - bins)
        np.minimum.at(out, at, low)
        full = (out.reshape(-1, bins) != empty).all(axis=1)
        open_rows = ~full[rows]
        if not open_rows.all():
            rows, items = rows[open_rows], items[open_rows]
    return out.reshape(-1, bins)


def _band_keys(sketch: np.ndarray) -> np.ndarray:
    parts = sketch.reshape(len(sketch), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=_U), parts.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key * _U(0xD6E8FEB86659FD93) + parts[:, :, k], 4)
    return key.view(np.int64)


def _sketch_batches(batches):
    for pdf in batches:
        ids, texts = pdf["doc_id"].tolist(), pdf["text"].tolist()
        for first, docs in chunks(texts):
            sets = shingles(docs, SHINGLE_WORDS)
            sketch = fast_similarity_sketch(sets)
            keys = _band_keys(sketch)
            sums = [(int(s.sum(dtype=_U)), int(np.bitwise_xor.reduce(mix(s, 6))) if len(s) else 0) for s in sets]
            yield pd.DataFrame({
                "doc_id": ids[first: first + len(docs)],
                "n_shingles": [len(s) for s in sets],
                "set_a": np.array([a for a, _ in sums], _U).view(np.int64),
                "set_b": np.array([b for _, b in sums], _U).view(np.int64),
                "bands": [k if len(s) else k[:0] for k, s in zip(keys, sets)],
            })


def _set_batches(batches):
    for pdf in batches:
        ids, texts = pdf["doc_id"].tolist(), pdf["text"].tolist()
        for first, docs in chunks(texts):
            yield pd.DataFrame({"doc_id": ids[first: first + len(docs)],
                                "items": [s.tobytes() for s in shingles(docs, SHINGLE_WORDS)]})


def _confirm_batches(batches):
    for pdf in batches:
        keep = np.zeros(len(pdf), bool)
        for k, (x, y) in enumerate(zip(pdf["items_a"], pdf["items_b"])):
            x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
            both = np.concatenate((x, y))
            both.sort(kind="stable")
            same = int((both[1:] == both[:-1]).sum())
            keep[k] = 100 * same >= PERCENT * (len(x) + len(y) - same)
        yield pdf.loc[keep, ["a", "b"]]


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of ``pairs(a, b)`` whose full shingle sets are similar enough."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("items_a")).hint("merge")
    two = sets.select(F.col("doc_id").alias("b"), F.col("items").alias("items_b")).hint("merge")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "items_a", "items_b") \
        .mapInPandas(_confirm_batches, "a long, b long")


def _blocks_linked(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Boolean matrix: which sets of ``a`` and ``b`` are similar enough."""
    items = np.concatenate([*a, *b])
    row = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in [*a, *b]])
    column = np.unique(items, return_inverse=True)[1]
    often = np.bincount(column) > 1         # others are in no intersection
    column, row = (np.cumsum(often) - 1)[column[often[column]]], row[often[column]]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    same = np.zeros((len(a), len(b)), np.float32)
    last = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, last, MATRIX_COLUMNS):
        s, e = np.searchsorted(column, [low, low + MATRIX_COLUMNS])
        has = np.zeros((len(a) + len(b), MATRIX_COLUMNS), np.float32)
        has[row[s:e], column[s:e] - low] = 1
        same += has[: len(a)] @ has[len(a):].T
    size = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None, :]
    return 100 * same.astype(np.int64) >= PERCENT * (size - same.astype(np.int64))


def _compare_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between different components in one pair of blocks: enough of
    them to join what the block's links join."""
    same = pdf["one"].iloc[0] == pdf["two"].iloc[0]
    left = pdf[pdf["block"] == pdf["one"]]
    right = left if same else pdf[pdf["block"] == pdf["two"]]
    sets = lambda part: [np.frombuffer(x, _U) for x in part["items"]]
    linked = _blocks_linked(sets(left), sets(right))
    ids, others = left["doc_id"].tolist(), right["doc_id"].tolist()
    part, other_part = left["component"].to_numpy(), right["component"].to_numpy()
    linked &= part[:, None] != other_part[None, :]
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i in np.flatnonzero(linked.any(axis=1)):
        for j in np.flatnonzero(linked[i]):
            x, y = root(part[i]), root(other_part[j])
            if x != y:
                parent[x] = y
                out.append((ids[i], others[j]))
    return pd.DataFrame(out, columns=["a", "b"])


def _links_across(open_rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) links between components within the buckets of ``open_rows(key,
    doc_id, component, n_shingles)``."""
    cuts = open_rows.groupBy("key").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / BLOCK_DOCS, F.sum("n_shingles") / BLOCK_ITEMS)).cast("int").alias("cuts"))
    placed = open_rows.join(cuts, "key").withColumn("block", F.pmod(F.xxhash64("doc_id"), "cuts").cast("int"))
    # A block meets every block of its bucket, itself included, once.
    met = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    met = met.select("key", "doc_id", "component", "block", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("two"))
    return (met.join(sets.hint("merge"), "doc_id").groupBy("key", "one", "two")
            .applyInPandas(_compare_blocks, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Null and blank texts have an empty set, link with nothing and are their
    own component.  A row without an id has a null component and is kept.
    Rows that repeat an id must repeat its text; each gets its row.  Ties do
    not arise: a component is named by its smallest id.  An empty table gives
    an empty frame; other columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketched = stage(texts.mapInPandas(_sketch_batches, SKETCH_SCHEMA), "minhash-sketch")
    total = sketched.count()        # bounds the tables of ids made from it
    linkable = sketched.filter("n_shingles > 0 and doc_id is not null")
    classes = linkable.groupBy("n_shingles", "set_a", "set_b").agg(F.min("doc_id").alias("rep"))
    member = stage(linkable.select("doc_id", "n_shingles", "set_a", "set_b").distinct()
                   .join(classes.hint("merge"), ["n_shingles", "set_a", "set_b"]).select("doc_id", "n_shingles", "rep"), "minhash-classes", total)
    reps = member.filter("doc_id = rep").select("doc_id")
    rows = sketched.select("doc_id", "bands").join(reps.hint("merge"), "doc_id", "left_semi") \
        .select("doc_id", F.explode("bands").alias("key"))
    rows = stage(rows, "minhash-bands", BANDS * total)
    shared = rows.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")) \
        .filter("low < high").select("key", "low")
    buckets = stage(rows.join(shared.hint("merge"), "key"), "minhash-buckets", BANDS * total)
    met = buckets.count()

    # Links to the smallest member of each bucket.
    first = stage(buckets.filter("doc_id > low").select(F.col("low").alias("a"), F.col("doc_id").alias("b"))
                  .distinct(), "minhash-pairs", met)
    wanted = first.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = stage(texts.join(wanted.hint("merge"), "doc_id", "left_semi").mapInPandas(_set_batches, "doc_id long, items binary")
                 .dropDuplicates(["doc_id"]), "minhash-sets")
    links = stage(_confirm(first, sets), "minhash-links")
    found = connected_components(links)

    # Buckets that still hold several components, in full.
    named = (buckets.select("key", "doc_id").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
             .select("key", "doc_id", F.coalesce("component", "doc_id").alias("component")))
    mixed = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")) \
        .filter("x < y").select("key")
    open_rows = stage(named.join(mixed, "key").join(member.select("doc_id", "n_shingles").distinct(), "doc_id"), "minhash-open", met)
    more = _links_across(open_rows, sets)
    final = connected_components(links.select("a", "b").union(more))

    named = (member.join(final.withColumnRenamed("id", "rep"), "rep", "left")
             .select("doc_id", F.coalesce("component", "rep").alias("component_id")))
    out = sketched.select("doc_id", "n_shingles").join(named, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row kept per component (all columns as they were).

    Of rows that repeat an id one is kept; rows without an id are all kept.
    """
    marked = near_duplicates(docs, id_col, text_col).filter("doc_id is not null")
    marked = stage(marked, "minhash-marked", docs.count())
    kept = docs.join(marked.filter("not kept").select(F.col("doc_id").alias(id_col)).distinct(), id_col, "left_anti")
    kept = kept.select(*docs.columns)
    if marked.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return kept
    none = kept.filter(F.col(id_col).isNull())
    return kept.filter(F.col(id_col).isNotNull()).dropDuplicates([id_col]).unionByName(none)
