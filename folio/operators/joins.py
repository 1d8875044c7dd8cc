"""Join building blocks shared by the operators.

* ``checked_broadcast`` broadcasts a side only after counting that it holds at
  most ``max_rows`` rows; beyond that the join is left to the planner
  (sort-merge, re-planned by AQE from real shuffle sizes, skew split on).
* ``salted_join`` joins rows to a side of unique keys and deals a key that many
  rows hold over several tasks, whatever the size thresholds of AQE.
* ``unique_dimension`` makes a dimension provably unique on its key before an
  enrichment join, so the fact's row count cannot change, and raises an error
  in the plan when a key repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Broadcast only dimensions proven to hold at most this many rows.  Dimension
# sides are projected to a key and one or two short columns first.
DEFAULT_BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_ROWS_CONF = "folio.broadcast.maxRows"


def broadcast_max_rows(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(BROADCAST_MAX_ROWS_CONF, None)
    return int(value) if value else DEFAULT_BROADCAST_MAX_ROWS


def have_at_most(frames: list[DataFrame], max_rows: int) -> list[bool]:
    """For each frame, True when it holds at most ``max_rows`` rows.

    All frames are counted in one job by a partial count (one row per task
    and frame reaches the driver's side); nothing is remembered between calls,
    so a table that has grown is seen to have grown.
    """
    union = None
    for i, df in enumerate(frames):
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("frame"), "n")
        union = one if union is None else union.unionByName(one)
    counts = {r["frame"]: r["n"] for r in union.collect()}
    return [counts[i] <= max_rows for i in range(len(frames))]


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` holds at most ``max_rows`` rows (see ``have_at_most``)."""
    return have_at_most([df], max_rows)[0]


def checked_broadcast(df: DataFrame, max_rows: int | None = None, measured: DataFrame | None = None) -> DataFrame:
    """``broadcast(df)`` when its size is proven small, else ``df`` unchanged.

    ``measured`` is a frame with at least as many rows as ``df`` that is
    cheaper to count -- e.g. the dimension's scan before a de-duplicating
    aggregate.
    """
    limit = broadcast_max_rows(df) if max_rows is None else max_rows
    if limit > 0 and has_at_most(measured if measured is not None else df, limit):
        return F.broadcast(df)
    return df


def checked_broadcasts(pairs: list[tuple[DataFrame, DataFrame]], max_rows: int | None = None) -> list[DataFrame]:
    """``checked_broadcast`` for several (frame, measured) pairs in one check job."""
    if not pairs:
        return []
    limit = broadcast_max_rows(pairs[0][0]) if max_rows is None else max_rows
    if limit <= 0:
        return [df for df, _ in pairs]
    fits = have_at_most([m for _, m in pairs], limit)
    return [F.broadcast(df) if ok else df for (df, _), ok in zip(pairs, fits)]


# A key with this share of the rows or more is dealt over several tasks; there
# are at most so many such keys, which bounds the broadcast of their names.
HOT_SHARES = 200


def salted_join(rows: DataFrame, side: DataFrame, key: str, counts: DataFrame | None = None,
                how: str = "left", shares: int = HOT_SHARES) -> DataFrame:
    """``rows`` joined to ``side`` (unique on ``key``) by ``key``, ``how`` being
    left or inner.

    Keys are counted first (``counts``: a frame ``key, _rows`` that holds these
    counts already, best a stored one; partial counts, so a hot key is one row
    per map task).  An inner join needs the counts of the side's keys only.  A
    key with a ``shares``-th of the rows or more is cut into slices of that
    size by a hash of the whole row, and its row of ``side`` is copied to every
    slice; no task gets more than about a ``shares``-th of the rows beside its
    share of the ordinary keys.  Null keys meet nothing and are dealt likewise.
    Equal whole rows fall into one slice.
    """
    if counts is None:
        counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    least = max(2, -(-total // shares))
    # At most ``shares`` keys hold a shares-th of the rows each.
    hot = counts.where(F.col("_rows") >= least).select(
        F.col(key).alias("_hot"), F.ceil(F.col("_rows") / least).cast("int").alias("_slices"))
    plain = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    dealt = rows.join(F.broadcast(hot), rows[key] == hot["_hot"], "left").withColumn(
        "_slice", F.when(F.col("_slices").isNotNull(), F.pmod(F.xxhash64(*plain), F.col("_slices")))
        .when(F.col(key).isNull(), F.pmod(F.xxhash64(*plain), F.lit(shares))).otherwise(F.lit(0)).cast("int"))
    dealt = dealt.drop("_hot", "_slices")
    copied = side.join(F.broadcast(hot), side[key] == hot["_hot"], "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1))).drop("_hot", "_slices")
    return dealt.join(copied, [key, "_slice"], how).drop("_slice")


def unique_dimension(dim: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """``dim`` reduced to one row per ``key`` with ``columns`` renamed.

    A key held by several rows makes the query fail with an error naming the
    key, instead of silently multiplying the fact rows it joins to.  The
    aggregate also leaves the dimension hash-partitioned on ``key``, which a
    sort-merge join on that key reuses without another shuffle.
    """
    grouped = dim.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.any_value(F.col(src)).alias(src) for src in columns],
    )
    message = F.concat(F.lit(f"duplicate dimension key {key}="), F.col(key).cast("string"))
    return grouped.select(
        F.col(key),
        *[
            F.when(F.col("_rows") > 1, F.raise_error(message)).otherwise(F.col(src)).alias(dst)
            for src, dst in columns.items()
        ],
    )


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """Driver-side uniqueness check (one aggregation job); raises on a repeat."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"key {keys} is not unique: {dup[0].asDict()}")
