"""Connected components of an edge table by alternating star contraction.

Each round replaces a node's neighbours by links to the smallest of them
(first over all larger neighbours, then over the smaller ones), which halves
the depth of every chain; the rounds needed grow with the logarithm of a
component's diameter.  A node's neighbours are never gathered: its minimum is
a partial aggregate and is joined back.  The join streams a node's links past
that one row, so a node with a third of all edges makes one long task, not a
large one.  Every round is written to the shared folder, few links in few
files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import stage


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every node of ``edges(a, b)``.

    ``component`` is the smallest node reachable.  Edges with a null end and
    self loops say nothing and are ignored; repeated and reversed edges count
    once; no edges give an empty frame.  Nodes without edges do not appear.
    """
    current = stage(
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    seen = _signature(current)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = current.union(current.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stage(large, "cc", seen[0])
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(
                    F.struct("a", F.col("m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").filter("a <> b").distinct())
        current = stage(small, "cc", 2 * seen[0])
        now = _signature(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return nodes.union(current.select("b", "b")).distinct()
