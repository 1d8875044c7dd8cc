"""Ranked lexical search (operator 13): the best documents for every item.

A document is a vector of impacts, one coordinate for each term, and an item
one of term counts; the score is their weighted inner product, in integers.
The largest inner products are found as maximum-inner-product search does it,
with vectors ordered by length:

* ``vectors`` counts the items' terms in every document in one pass (a term no
  item holds adds to no score, but to the document's size);
* every task orders the vectors of a batch by length and cuts them into
  buckets.  Item length times bucket length bounds each score of a bucket
  (Cauchy-Schwarz), so an item passes over all buckets below its threshold;
* inside the other buckets the item's strongest coordinates are added up, and
  what the rest can add is bounded by their largest impacts and by the lengths
  that are left of both vectors;
* documents that can still reach the threshold are scored in full, in 64-bit
  integers.  Bounds are doubles, loosened by ``SLACK`` so that rounding loses
  nothing.

The thresholds start from the exact scores of ``SEEDS`` documents chosen by a
hash; the k-th best of any documents is no higher than that of all, so they
change the work and not the result.  Tasks keep k documents an item, which are
joined by windows in two steps.  Nothing but the vectors is written, and only
the last windows shuffle: k rows an item and task.

Items are taken in blocks of at most ``BLOCK_ITEMS`` rows and ``BLOCK_TERMS``
terms (a larger item is alone): what is sent to tasks and what the driver
holds, its statistics included, has that bound at every size.

Null and empty texts hold no term: such a document is not counted and never
found, such an item finds nothing.  Repeated documents are documents of their
own; equal scores are in the order of the id, nulls last.  Repeated items and
null item ids are ranked like others.  An empty table on either side gives an
empty result.  Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from folio.llm.common import stage

# Fixed values of the score: one term is a stretch of these bytes.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
TOP = 20
BLOCK_ITEMS = 1_000
BLOCK_TERMS = 200_000
SEEDS = 20_000
BUCKET = 256
FOCUS = 0.4         # coordinates are added up until the rest adds less than this share
SLACK = 1e-9
FAN_IN = 256
_SLICE = 2_000_000


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, A-Z lower-cased."""
    return TERM.findall(text.encode("utf-8").lower()) if text else []


def _item_blocks(items: DataFrame, item_col: str, text_col: str):
    """Blocks of (item id, term counts), read one block at a time."""
    block, size = [], 0
    for row in items.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        counts = Counter(terms(row["t"]))
        if not counts:
            continue
        if block and (len(block) >= BLOCK_ITEMS or size + len(counts) > BLOCK_TERMS):
            yield block
            block, size = [], 0
        block.append((row["i"], counts))
        size += len(counts)
    if block:
        yield block


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``id, n, terms, counts``: a document's terms in all, and the numbers and
    counts of those in the vocabulary."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n bigint, terms array<int>, counts array<int>"
    width = max(len(vocabulary), 1)

    def run(batches):
        get = vocabulary.get
        for batch in batches:
            texts = batch.column(1).to_pylist()
            lo = 0
            while lo < len(texts):
                sizes, found, held, hi = [], [], 0, lo
                while hi < len(texts) and (hi == lo or held < _SLICE):
                    words = terms(texts[hi])
                    sizes.append(len(words))
                    held += len(texts[hi] or "")
                    found.append(np.array([get(w, -1) for w in words], np.int64))
                    hi += 1
                rows_of = np.repeat(np.arange(hi - lo), sizes)
                flat = np.concatenate(found)
                known = flat >= 0
                key, counts = np.unique(rows_of[known] * width + flat[known], return_counts=True)
                bounds = pa.array(np.searchsorted(key, np.arange(hi - lo + 1) * width).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(bounds, pa.array((key % width).astype(np.int32))),
                     pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int32)))],
                    names=["id", "n", "terms", "counts"])
                lo = hi

    return rows.mapInArrow(run, schema)


def _impacts(n: np.ndarray, row: np.ndarray, count: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Integer impacts of the entries (row, count) of documents of n terms."""
    if len(n) and 25 * int(n.max()) * documents >= 2 ** 62:
        scaled = np.array([(25 * x * documents) // total for x in n.tolist()], np.int64)
    else:
        scaled = (25 * n * documents) // total
    return (1_000_000_000 * count) // (1000 * count + 12 * (75 + scaled)[row])


class _Lengths:
    """The vectors of a batch in the order of their lengths."""

    def __init__(self, row, term, impact, weight, n_rows):
        square = weight[term] * impact.astype(float) ** 2
        squared = np.bincount(row, square, minlength=n_rows)
        self.order = np.argsort(-squared, kind="stable")
        self.squared = squared[self.order]
        place = np.empty(n_rows, np.int64)
        place[self.order] = np.arange(n_rows)
        row = place[row]
        by_row = np.argsort(row, kind="stable")
        self.term, self.impact = term[by_row], impact[by_row]
        self.row_at = np.searchsorted(row[by_row], np.arange(n_rows + 1))
        by_term = np.lexsort((row, term))
        self.post_row, self.post_impact, self.post_square = row[by_term], impact[by_term], square[by_term]
        sorted_terms = term[by_term]
        self.term_at = np.searchsorted(sorted_terms, np.arange(len(weight) + 1))
        self.largest = np.zeros(len(weight), np.int64)
        if len(term):
            np.maximum.at(self.largest, term, impact)
        self.n_rows = n_rows

    def postings(self, term, rows):
        lo, hi = self.term_at[term], self.term_at[term + 1]
        hi = lo + np.searchsorted(self.post_row[lo:hi], rows)
        return self.post_row[lo:hi], self.post_impact[lo:hi], self.post_square[lo:hi]

    def scores(self, rows, query):
        """Exact scores of some rows for a dense query of integer weights."""
        lo, hi = self.row_at[rows], self.row_at[rows + 1]
        width = hi - lo
        at = np.repeat(lo - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
        total = np.concatenate(([0], np.cumsum(query[self.term[at]] * self.impact[at])))
        ends = np.cumsum(width)
        return total[ends] - total[ends - width]


class _Item:
    """One item's coordinates, strongest first by what they may add."""

    def __init__(self, counts: dict[int, int], weight: np.ndarray):
        self.term = np.array([t for t in counts if weight[t] > 0], np.int64)
        self.count = np.array([counts[t] for t in self.term.tolist()], np.int64)
        self.value = self.count * weight[self.term]
        self.squared = float((self.count.astype(float) ** 2 * weight[self.term]).sum())

    def search(self, index: _Lengths, weight: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, dict]:
        """Rows (in order of length) that score ``least`` or more, their
        scores, and how many rows each step left."""
        none = np.zeros(0, np.int64)
        heads = index.squared[::BUCKET]
        buckets = int(np.count_nonzero(np.sqrt(heads * self.squared) * (1 + SLACK) >= least)) if len(self.term) else 0
        rows = min(buckets * BUCKET, index.n_rows)
        seen = {"rows": index.n_rows, "in_buckets": rows, "scored": 0}
        if not rows:
            return none, none, seen
        may_add = self.value * index.largest[self.term]
        turn = np.argsort(-may_add, kind="stable")
        rest = np.append(np.cumsum(may_add[turn][::-1])[::-1], 0)
        focus = int(np.argmax(rest < FOCUS * least))
        rest_squared = float((self.count[turn[focus:]].astype(float) ** 2 * weight[self.term[turn[focus:]]]).sum())
        partial, used = np.zeros(rows, np.int64), np.zeros(rows)
        for k in turn[:focus].tolist():
            row, impact, square = index.postings(int(self.term[k]), rows)
            partial[row] += self.value[k] * impact
            used[row] += square
        left = np.sqrt(np.maximum(index.squared[:rows] * (1 + SLACK) - used, 0) * rest_squared)
        bound = partial + np.minimum(float(rest[focus]), left)
        survivors = np.flatnonzero((partial > 0) & (bound * (1 + SLACK) >= least))
        seen["scored"] = len(survivors)
        if not len(survivors):
            return none, none, seen
        query = np.zeros(len(weight), np.int64)
        query[self.term] = self.value
        score = index.scores(survivors, query)
        good = score >= least
        return survivors[good], score[good], seen


def _best(ids: list, scores: list, k: int) -> tuple[list, list]:
    turn = sorted(range(len(ids)), key=lambda x: (-scores[x], ids[x] is None, ids[x] if ids[x] is not None else 0))[:k]
    return [ids[x] for x in turn], [scores[x] for x in turn]


def search_batches(batches, items: list[_Item], weight: np.ndarray, least: list[int], documents: int, total: int, k: int):
    """Per item the k best (ids, scores) over Arrow batches of vectors, and
    how many rows each step left in all."""
    held = [([], []) for _ in items]
    least, work = list(least), Counter()
    for batch in batches:
        ids, n = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        lists, counts = batch.column(2), batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
        term = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(term):
            continue
        index = _Lengths(row, term, _impacts(n, row, counts, documents, total), weight, len(n))
        for q, item in enumerate(items):
            rows, scores, seen = item.search(index, weight, least[q])
            work.update(seen)
            if not len(rows):
                continue
            found = ids.take(pa.array(index.order[rows])).to_pylist()
            held[q] = _best(held[q][0] + found, held[q][1] + scores.tolist(), k)
            if len(held[q][0]) == k:
                least[q] = max(least[q], held[q][1][-1])
    return held, work


def _top(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _candidates(found: DataFrame, items: list[_Item], weight, least, documents, total, k) -> DataFrame:
    """``q, rank, id, score``: the k best of the vectors in ``found``."""
    schema = f"q int, id {found.schema['id'].dataType.simpleString()}, score bigint"
    id_type = None

    def run(batches):
        nonlocal id_type

        def typed():
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field(0).type
                yield batch

        held, _ = search_batches(typed(), items, weight, least, documents, total, k)
        if id_type is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([q for q, (ids, _) in enumerate(held) for _ in ids], pa.int32()),
                 pa.array([x for ids, _ in held for x in ids], id_type),
                 pa.array([s for _, scores in held for s in scores], pa.int64())], names=["q", "id", "score"])

    rows = found.mapInArrow(run, schema)
    # Few tasks' rows meet before all of an item's do.
    part = _top(rows.withColumn("_part", F.spark_partition_id() % FAN_IN), ["q", "_part"], k)
    return _top(part.select("q", "id", "score"), ["q"], k)


def _search_block(docs, block, item_type, k, id_col, text_col):
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    for _, counts in block:
        for term in counts:
            vocabulary.setdefault(term, len(vocabulary))
    found = stage(vectors(docs, vocabulary, id_col, text_col), "op13-vectors")
    documents, total = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One count for each term of the block: bounded by BLOCK_TERMS.
    holders = found.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weight = np.zeros(len(vocabulary), np.int64)
    for row in holders:
        weight[row["term"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * row["count"] + 1)))
    items = [_Item({vocabulary[t]: c for t, c in counts.items()}, weight) for _, counts in block]
    found = found.filter(F.size("terms") > 0)
    least = [1] * len(items)
    if documents > SEEDS:
        cells = 1 << 30
        share = max(1, cells * SEEDS // documents)
        seeds = found.filter(F.pmod(F.xxhash64("id", F.lit(29)), F.lit(cells)) < share)
        # k rows an item of the block.
        for row in _candidates(seeds, items, weight, least, documents, total, k).filter(F.col("rank") == k).collect():
            least[row["q"]] = row["score"]
    ranked = _candidates(found, items, weight, least, documents, total, k)
    named = StructType([StructField("q", IntegerType()), StructField("item", item_type)])
    names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(block)], named)
    return ranked.join(F.broadcast(names), "q")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item, rank, id, score``: the k best documents of every item, with a
    score above 0, equal scores by id."""
    item_type, id_type = items.schema[item_col].dataType, docs.schema[id_col].dataType
    out = None
    for block in _item_blocks(items, item_col, item_text_col):
        part = _search_block(docs, block, item_type, k, id_col, text_col).select(
            F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"),
            F.col("id").alias(id_col), "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        fields = f"`{item_col}` {item_type.simpleString()}, rank int, `{id_col}` {id_type.simpleString()}, score bigint"
        out = docs.sparkSession.createDataFrame([], fields)
    return out
