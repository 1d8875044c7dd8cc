"""Exact counts of the catalogue (A1-A3) and the distinct name set.

All counts are computed by one aggregate over a union of the inputs, tagged by
source, instead of joining one-row results: no cross join, one job.  Distinct
counts are exact (``count(DISTINCT ..)``); map-side partial aggregation keeps
a hot value to one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _tagged(df: DataFrame, tag: str, value: str | None = None) -> DataFrame:
    v = F.col(value).cast("string") if value else F.lit(None).cast("string")
    return df.select(F.lit(tag).alias("_src"), v.alias("_v"))


def entity_counts(books: DataFrame, authors: DataFrame, categories: DataFrame) -> DataFrame:
    """A1: rows in each table, in one row."""
    tagged = _tagged(books, "book").unionByName(_tagged(authors, "author")).unionByName(
        _tagged(categories, "category"))
    return tagged.agg(
        F.count_if(F.col("_src") == "book").alias("n_books"),
        F.count_if(F.col("_src") == "author").alias("n_authors"),
        F.count_if(F.col("_src") == "category").alias("n_categories"),
    )


def catalog_stats(catalog: DataFrame, categories: DataFrame, author_col: str = "author") -> DataFrame:
    """A2 + A3: the reader's stats strip over all books (filters ignored):
    total books, distinct non-empty author names (case-sensitive), and rows
    in the category table."""
    tagged = _tagged(catalog, "book", author_col).unionByName(_tagged(categories, "category"))
    return tagged.agg(
        F.count_if(F.col("_src") == "book").alias("total_books"),
        F.count_distinct(
            F.when((F.col("_src") == "book") & (F.col("_v") != ""), F.col("_v"))
        ).alias("distinct_authors"),
        F.count_if(F.col("_src") == "category").alias("total_categories"),
    )


def referenced_names(facts: DataFrame, dimension: DataFrame, fk: str, key: str, name: str,
                     out: str | None = None) -> DataFrame:
    """Distinct non-empty ``name`` values of the dimension rows the facts refer
    to -- the names an enriched fact table shows -- without joining every
    fact row: the facts' distinct keys (partially aggregated on the map side)
    semi-join the dimension, and only then are names de-duplicated.  Equal to
    ``distinct_names(enrich(...), name)`` when the dimension key is unique."""
    keys = facts.select(F.col(fk).alias("_fk")).where(F.col("_fk").isNotNull()).distinct()
    used = dimension.join(keys, dimension[key] == keys["_fk"], "left_semi")
    return distinct_names(used, name, out)


def catalog_stats_by_keys(books: DataFrame, authors: DataFrame, categories: DataFrame) -> DataFrame:
    """A2 + A3 like ``catalog_stats``, with the distinct author names taken
    through ``referenced_names`` instead of the enriched fact table."""
    names = referenced_names(books, authors, "author_id", "id", "full_name", "_v")
    tagged = (
        books.select(F.lit("book").alias("_src"), F.lit(None).cast("string").alias("_v"))
        .unionByName(names.select(F.lit("name").alias("_src"), F.col("_v")))
        .unionByName(_tagged(categories, "category"))
    )
    return tagged.agg(
        F.count_if(F.col("_src") == "book").alias("total_books"),
        F.count_if(F.col("_src") == "name").alias("distinct_authors"),
        F.count_if(F.col("_src") == "category").alias("total_categories"),
    )


def distinct_names(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """The set of non-empty values of a column (``new Set(..filter(Boolean))``)."""
    c = F.col(column)
    return df.where(c.isNotNull() & (c != "")).select(c.alias(out or column)).distinct()
