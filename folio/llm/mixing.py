"""Mixing sources to target weights by a low-discrepancy schedule (operator 10).

Slot s of the mix has the point ``frac(s * golden ratio)``; the cumulative
target weights cut [0, 1) into one interval per source, so the slots of every
prefix follow the weights with an error that grows only with the logarithm of
its length.  Each source's documents are laid end to end in a shuffled (hash)
order and cut into blocks of equal numbers of words; the r-th slot of a source
takes its r-th block, starting anew when the blocks are used up.  The last
block of a source is cut at its target.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5                     # the mix holds this multiple of all words
MOST = 2                        # no source, hence no document, beyond this multiple
MAX_BLOCK = 1024                # words a block holds at most
MIN_SLOTS = 65536               # smaller inputs get smaller blocks
SLACK = 1.01                    # slots dealt, over those needed
RUN = 4096                      # slots ranked together
BUCKET_ROWS = 50_000            # documents ordered together
GOLDEN = 0.6180339887498949
UID = "_uid"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sizes(source, source_size)`` with ``weight``, ``target`` and the
    cumulative interval [low, high) of the target shares.

    Sources in code point order, null last, take the weights in turn.  The
    target of a source is ``min(most * size, level * weight)``; the level that
    spends the whole share follows from the sources in the order of
    ``size / weight``: those below it are full.  One row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    turn = F.row_number().over(by_name) - 1
    rows = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                   (turn % len(weights) + 1).cast("int")))
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    up_to = fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    cap = most * F.col("source_size")
    total = F.sum("source_size").over(every) * F.lit(share)
    rows = (rows.withColumn("_full", F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
            .withColumn("_open", F.sum("weight").over(every) - F.sum("weight").over(up_to) + F.col("weight"))
            .withColumn("_level", (total - F.col("_full")) / F.col("_open")))
    # The first source that the level does not fill fixes it for all the others.
    level = F.max(F.when(F.col("_level") * F.col("weight") < cap, F.col("_level"))).over(every)
    rows = rows.withColumn("target", F.least(cap.cast("double"), F.coalesce(level * F.col("weight"), cap.cast("double"))))
    spent = F.sum("target").over(every)
    line = by_name.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("high", F.when(spent > 0, F.sum("target").over(line) / spent).otherwise(F.lit(0.0)))
    return (rows.withColumn("low", F.coalesce(F.lag("high").over(by_name), F.lit(0.0)))
            .select("source", "source_size", "weight", "target", "low", "high"))


def _streams(rows: DataFrame) -> DataFrame:
    """``rows`` with ``begin``: words of the source before the document, in its
    shuffled order.  A source is cut into buckets by the hash, buckets are
    summed first, and only a bucket's rows are ordered together."""
    buckets = max(16, int(rows.agg(F.count(F.lit(1))).first()[0] / BUCKET_ROWS * 16))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(buckets)))
    sums = rows.groupBy("_source", "_bucket").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_source", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_source", "_bucket").orderBy(F.xxhash64("doc_id"), "doc_id", "size", "_row") \
        .rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(sums, ["_source", "_bucket"])
            .withColumn("begin", F.col("_base") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .drop("_bucket", "_base"))


def schedule(plan: DataFrame, block: int) -> DataFrame:
    """(slot, _source, rank, words): the mix, one block of a source per slot.

    ``rank`` counts a source's slots from 0.  Slots are ranked within runs of
    consecutive slots and the runs' counts are summed, so no source's slots
    meet in one task.  A source that the finished schedule leaves short gets
    its few missing slots at the end; slots beyond its target go to nobody.
    """
    spark = plan.sparkSession
    totals = plan.agg(F.sum("target").alias("t"), F.count(F.lit(1)).alias("n")).first()
    slots = int((totals["t"] or 0) / block * SLACK) + (16 * totals["n"] if totals["t"] else 0)
    goal = F.floor(F.col("target") + 0.5).cast("long")
    plan = plan.select("_source", "low", "high", goal.alias("goal"), F.ceil(goal / F.lit(block)).cast("long").alias("need"))
    # The interval table by cells of [0, 1): an equi-join finds a slot's source.
    cells = max(1024, 4 * totals["n"])
    grid = plan.filter("high > low").withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") * cells).cast("long"), F.least(F.floor(F.col("high") * cells).cast("long"), F.lit(cells - 1)))))
    dealt = spark.range(slots).select(F.col("id").alias("slot"))
    dealt = dealt.withColumn("point", F.col("slot") * F.lit(GOLDEN) - F.floor(F.col("slot") * F.lit(GOLDEN)))
    dealt = (dealt.withColumn("cell", F.floor(F.col("point") * cells).cast("long")).join(grid, "cell")
             .filter("point >= low and point < high").withColumn("run", F.floor(F.col("slot") / RUN))
             .select("slot", "_source", "run", "goal", "need"))
    counts = dealt.groupBy("_source", "run").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_source", "run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_source", "run").orderBy("slot")
    ranked = (dealt.withColumn("_k", F.row_number().over(inside) - 1).join(bases, ["_source", "run"])
              .select("slot", "_source", (F.col("_base") + F.col("_k")).alias("rank"), "goal", "need").filter("rank < need"))
    have = counts.groupBy("_source").agg(F.sum("_n").alias("_n"))
    short = (plan.join(have, "_source", "left").withColumn("_n", F.coalesce("_n", F.lit(0))).filter("_n < need")
             .select(F.explode(F.sequence("_n", F.col("need") - 1)).alias("rank"), "_source", "goal", "need"))
    short = short.select((F.col("rank") + slots).alias("slot"), "_source", "rank", "goal", "need")
    words = F.least(F.lit(block), F.col("goal") - F.col("rank") * block)
    return ranked.union(short).select("slot", "_source", "rank", words.cast("long").alias("words"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mix: ``(rows, pieces)``.

    ``rows`` has one row per row of ``docs``: _uid, doc_id, source, size,
    source_size, target and its place in its source's stream.  ``pieces`` is
    the mix itself: slot, _uid, _round (0, 1: which pass over the source),
    start and words, the words [start, start + words) of a document.  A null source is a source of its own, after the others.
    Null and blank texts have size 0 and are never taken.  Rows that repeat an
    id, ids that are null and equal sizes are ordered by all they hold; equal
    rows are interchangeable.  An empty table gives an empty frame.
    """
    uid = F.col(UID) if UID in docs.columns else F.monotonically_increasing_id()
    rows = docs.select(uid.alias(UID), F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       word_count(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("_text"))
    # Null must join: a source's key is its text behind a mark.
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    rows = rows.withColumn("_source", key)
    rows = rows.withColumn("_row", F.xxhash64("doc_id", "source", "size", "_text")).drop("_text")
    rows = stage(rows, "mix-sizes")
    sizes = rows.groupBy("_source").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    plan = stage(targets(sizes.drop("_source"), weights, share, most).withColumn("_source", key), "mix-plan")
    total = plan.agg(F.sum("target")).first()[0] or 0.0
    block = int(max(1, min(MAX_BLOCK, total // MIN_SLOTS)))
    laid = stage(_streams(rows), "mix-streams").join(plan.select("_source", "source_size", "target"), "_source")
    laid = stage(laid, "mix-laid")

    # The r-th slot of a source takes block r of its endless repetition: words
    # [r * block, r * block + words) of rounds of source_size words each.
    used = F.col("size") > 0
    rounds = F.ceil(F.col("target") / F.col("source_size")).cast("long")
    spans = (laid.filter(used & (F.col("target") >= 0.5))
             .withColumn("_round", F.explode(F.sequence(F.lit(0).cast("long"), rounds - 1)))
             .withColumn("_from", F.col("_round") * F.col("source_size") + F.col("begin"))
             .withColumn("_to", F.col("_from") + F.col("size"))
             .withColumn("rank", F.explode(F.sequence(F.floor(F.col("_from") / block), F.floor((F.col("_to") - 1) / block)))))
    pieces = (spans.join(schedule(plan, block), ["_source", "rank"])
              .withColumn("_a", F.greatest("_from", F.col("rank") * block))
              .withColumn("_b", F.least("_to", F.col("rank") * block + F.col("words")))
              .filter("_b > _a")
              .select("_uid", "slot", "_round", (F.col("_a") - F.col("_from")).alias("start"), (F.col("_b") - F.col("_a")).alias("words")))
    return laid, pieces


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``docs`` as the mix takes them, all columns kept: a row for each pass
    over the source that takes the document.  Where the target cuts it, its
    text is the words taken, joined by a space.  Documents without words, or
    beyond their source's target, do not appear."""
    rows = stage(docs.withColumn(UID, F.monotonically_increasing_id()), "mix-documents")
    _, pieces = mix_sources(rows, id_col, text_col, source_col, weights, share, most)
    passes = pieces.groupBy(UID, "_round").agg(F.min("start").alias("_start"), F.sum("words").alias("_words"))
    words = F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0))
    cut = F.array_join(F.slice(words, (F.col("_start") + 1).cast("int"), F.col("_words").cast("int")), " ")
    taken = rows.join(passes, UID)
    text = F.when(F.col("_words") >= word_count(F.col(text_col)), F.col(text_col)).otherwise(cut)
    return taken.withColumn(text_col, text).select(*docs.columns)


def taken_words(docs: DataFrame, **columns) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken."""
    laid, pieces = mix_sources(docs, **columns)
    taken = pieces.groupBy("_uid").agg(F.sum("words").alias("taken"))
    return (laid.join(taken, "_uid", "left")
            .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))

