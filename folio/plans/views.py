"""The catalogue as SQL views, for callers who query with ``spark.sql``.

Registers temp views over the same lazy plans the DataFrame API builds, so
``spark.sql("SELECT * FROM catalog WHERE id = ?", args=[12])`` binds its
parameter and Catalyst pushes the filter into the scan as before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folio.operators.enrich import enrich


def register_catalog_views(spark: SparkSession, books: DataFrame, authors: DataFrame,
                           categories: DataFrame, prefix: str = "") -> list[str]:
    """Temp views ``books``, ``authors``, ``categories`` and the enriched
    ``catalog`` (J1 + P1), optionally prefixed.  Returns the view names."""
    views = {
        "books": books,
        "authors": authors,
        "categories": categories,
        "catalog": enrich(books, authors, categories),
    }
    names = []
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
