"""Removal of repeated line runs by distributed prefix doubling (operator 9).

The corpus is the sequence of all lines in document order.  The rank of a
position at depth 1 is the first position (document, line) holding an equal
line; at depth 2h it is the first position whose two halves have the same
ranks, found from the rank ``h`` lines further on.  Ranks at depth h name the
longest-common-prefix intervals of depth h of the suffix array: two positions
share a rank when their next h lines are equal.  Only positions whose interval
holds several members go on to the next depth, so the work shrinks to what
repeats.

Depths 1 and ``min_lines`` are enough to decide removal: a line is removed
when it lies in a run of at least ``min_lines`` lines, or is itself a line of
at least ``min_chars`` characters, of which an equal copy starts earlier.
Neighbouring windows make the maximal runs.  Everything is judged on the
input, so the first copy of every run stays.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import digest, stage
from folio.operators.joins import salted_join

MIN_LINES = 3
MIN_CHARS = 40


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_positions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, line, key, n_chars) for every line of every document with an id."""
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.posexplode(_lines(F.col(text_col))).alias("line", "t"))
            .filter("doc_id is not null")
            .select("doc_id", "line", digest(F.col("t")).alias("key"), F.length("t").alias("n_chars")))


def _first_positions(rows: DataFrame, keys: list[str], most: int | None = None) -> DataFrame:
    """Ranks: each row with the first position among rows of equal ``keys``;
    rows alone in their interval are left out.  ``most``: a bound on the rows."""
    rows = rows.withColumn("_key", F.struct(*keys))
    # Stored, as its counts tell which keys are hot: a line that very many
    # documents hold is dealt over several tasks.
    groups = stage(rows.groupBy("_key").agg(F.min(F.struct("doc_id", "line")).alias("rank"), F.count(F.lit(1)).alias("_rows"))
                   .filter("_rows > 1"), "line-groups", most)
    return salted_join(rows, groups.select("_key", "rank"), "_key", groups.select("_key", "_rows"), how="inner").drop("_key")


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, line, lines) of windows that start earlier elsewhere, to remove."""
    ranked = _first_positions(line_positions(docs, id_col, text_col), ["key"]).drop("key")
    ranked = stage(ranked, "line-ranks")
    own = F.struct("doc_id", "line")
    found = (ranked.filter((F.col("n_chars") >= min_chars) & (F.col("rank") < own))
             .select("doc_id", "line", F.lit(1).alias("lines")))
    depth, current = 1, ranked.select("doc_id", "line", "rank")
    most = ranked.count()
    while depth < min_lines:
        step = min(depth, min_lines - depth)
        ahead = Window.partitionBy("doc_id").orderBy("line").rangeBetween(step, step)
        pairs = current.withColumn("next", F.first("rank").over(ahead)).filter("next is not null")
        pairs = pairs.withColumnRenamed("rank", "half")
        current = stage(_first_positions(pairs, ["half", "next"], most).select("doc_id", "line", "rank"), "line-ranks", most)
        depth += step
    if min_lines > 1:
        found = found.union(current.filter(F.col("rank") < own).select("doc_id", "line", F.lit(min_lines).alias("lines")))
    elif min_chars > 0:
        found = ranked.filter(F.col("rank") < own).select("doc_id", "line", F.lit(1).alias("lines"))
    return found


def remove_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with later copies of repeated line runs taken out of the text.

    Adds ``n_lines``, ``n_removed`` (lines) and ``n_runs`` (maximal removed
    runs).  Order among documents is by id; lines are split at ``\\n``.  A null
    text has one empty line and stays null; a text whose lines all go becomes
    empty.  Rows without an id stay as they are and are nobody's copy.  Rows
    that repeat an id must repeat its text: they count as one document.  An empty table gives an empty frame.  Columns called n_lines,
    n_removed or n_runs are replaced, all others pass through.
    """
    marks = (repeated_windows(docs, id_col, text_col, min_lines, min_chars)
             .select("doc_id", F.explode(F.sequence("line", F.col("line") + F.col("lines") - 1)).alias("line"))
             .groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("_gone"))
             .withColumnRenamed("doc_id", "_id"))
    clash = [c for c in ("n_lines", "n_removed", "n_runs", "_gone", "_id") if c in docs.columns]
    rows = docs.drop(*clash).join(marks, F.col(id_col).cast("long") == F.col("_id"), "left").drop("_id")
    lines = _lines(F.col(text_col))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    starts = F.array_except(F.col("_gone"), F.transform("_gone", lambda x: x + 1))
    rebuilt = F.array_join(F.transform(kept, lambda k: F.get(F.col("_lines"), k)), "\n")
    return (rows.withColumn("_lines", lines)
            .withColumn(text_col, F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(rebuilt))
            .withColumn("n_lines", F.size("_lines").cast("long"))
            .withColumn("n_removed", F.coalesce(F.size("_gone"), F.lit(0)).cast("long"))
            .withColumn("n_runs", F.coalesce(F.size(starts), F.lit(0)).cast("long"))
            .drop("_lines", "_gone"))
