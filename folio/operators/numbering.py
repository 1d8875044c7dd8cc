"""Dense row numbering (W1) and new-id assignment (D1) without a global window.

``row_number().over(Window.orderBy(k))`` sends every row to one task.  Here
Spark's own range partitioning deals the rows out by the order key -- and, for
equal keys, by the tie-breakers and a hash of the row, so that a key value
holding a third of the rows is cut like any other stretch of the order.  Each
partition is sorted, every row gets its place in its partition, and the result
is checkpointed into the cluster's shared folder.  Counting the rows of each
partition gives its offset (one row per partition), and number = offset +
place.  Works for every type Spark can order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.session import shared_checkpoint_dir

# monotonically_increasing_id keeps the partition above this many bits.
_PLACE_BITS = 33


def number_rows(
    df: DataFrame,
    order_col: str,
    out_col: str = "row_no",
    by: list[str] | None = None,
    tie_breakers: list[str] | None = None,
) -> DataFrame:
    """Add ``out_col`` = 1..n in ``order_col`` order (per ``by`` group).

    Equal to ``row_number() over (partition by <by> order by <order_col>)``,
    nulls first, when the order is total (add ``tie_breakers`` otherwise; rows
    that remain equal are numbered in any order).
    """
    shared_checkpoint_dir(df.sparkSession)
    by = list(by or [])
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    keys = [F.col(c).asc_nulls_first() for c in [*by, order_col, *(tie_breakers or [])]]
    order = [*keys, F.col("_tie").asc()]
    placed = (
        df.withColumn("_tie", F.xxhash64(*plain))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .drop("_tie")
        .checkpoint()
    )
    part = F.shiftright("_at", _PLACE_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).alias("_offset"))
    # One row per partition of the range partitioning above: a fixed bound.
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    place = F.col("_at") - F.shiftleft("_part", _PLACE_BITS)
    numbered = numbered.withColumn(out_col, (F.col("_offset") + place).cast("long"))
    if by:
        firsts = numbered.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(F.min(out_col).alias("_first"))
        same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
        numbered = numbered.join(firsts, same).withColumn(out_col, F.col(out_col) - F.col("_first") + 1)
    return numbered.select(*df.columns, out_col)


def max_key(df: DataFrame, key: str) -> int:
    """Largest key in use (0 for an empty table): one aggregate, one scalar."""
    value = df.agg(F.max(key)).first()[0]
    return int(value) if value is not None else 0


def assign_ids(new_rows: DataFrame, base: DataFrame, order_col: str, id_col: str = "id",
               start_after: int | None = None) -> DataFrame:
    """Ids for inserted rows, as a store with an identity column gives
    them: after the largest id in ``base``, dense, in request order."""
    start = max_key(base, id_col) if start_after is None else start_after
    numbered = number_rows(new_rows, order_col, out_col="_n")
    return numbered.withColumn(id_col, (F.col("_n") + F.lit(start)).cast("long")).drop("_n")
