"""Counts and the enriched view, kept current by what changed.

The tables are stored by key (``sources.keyed``).  ``keyed.differences`` of
two versions gives the changed rows before and after; from these

* counted multisets (value, n) take the plus and minus rows, so that exact
  distinct counts need no new scan: a value whose count falls to 0 goes;
* the names that the catalogue shows follow from two small joins, because
  names = references x authors: the changed references meet the authors as
  they were, and the references as they are now meet the changed authors;
* the view re-enriches the changed books and those of changed authors and
  categories, and only the folders that hold one of them are rewritten.

Work grows with the changes and with the folders they touch, besides one pass
over the view's three key columns where a dimension has changed.  Hot keys are
counts here, not lists: a name that a third of the books show is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.enrich import enrich
from folio.operators.joins import checked_broadcast
from folio.sources import keyed


def counted(df: DataFrame, value: str, key: str) -> DataFrame:
    """The multiset ``(key, n)`` of a column's values; nulls are left out."""
    return df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias(key)).agg(F.count(F.lit(1)).alias("n"))


def counted_changes(changes: DataFrame, value: str, key: str) -> DataFrame:
    """``(key, n)``: by how much each value's count changes with the rows of
    ``differences``; values whose count stays are left out."""
    def signed(side: str, sign: int) -> DataFrame:
        rows = changes.where(F.col(side).isNotNull())
        return rows.select(F.col(side)[value].alias(key), F.lit(sign).cast("bigint").alias("n"))

    both = signed("after", 1).unionByName(signed("before", -1)).where(F.col(key).isNotNull())
    return both.groupBy(key).agg(F.sum("n").alias("n")).where(F.col("n") != 0)


def add_counts(spark: SparkSession, root: str, delta: DataFrame) -> keyed.Version:
    """Add ``(key, n)`` changes to a stored multiset; a count of 0 goes, one
    below 0 is an error (the change does not fit the state)."""
    delta = delta.checkpoint()
    key = delta.columns[0]
    held = keyed.read_matching(spark, root, delta.select(key)).select(F.col(key).alias("_held"), F.col("n").alias("_n"))
    after = delta.join(held, delta[key] == held["_held"], "left").select(
        key, (F.coalesce("_n", F.lit(0)) + F.col("n")).alias("n"))
    checked = after.withColumn("n", F.when(F.col("n") < 0, F.raise_error(
        F.concat(F.lit(f"count below 0 for {key}="), F.col(key).cast("string")))).otherwise(F.col("n"))).checkpoint()
    return keyed.merge(spark, root, checked.where("n > 0"), checked.where("n = 0").select(key))


def _shown(name: Column) -> Column:
    return name.isNotNull() & (name != "")


def catalog_names(books: DataFrame, authors: DataFrame) -> DataFrame:
    """``(name, n)``: the names the catalogue shows and how many books show
    each (A3/U2 in full); books count by author before they meet the names."""
    refs = counted(books, "author_id", "_ref")
    shown = authors.where(_shown(F.col("full_name"))).select(F.col("id").alias("_id"), F.col("full_name").alias("name"))
    return refs.join(shown, refs["_ref"] == shown["_id"]).groupBy("name").agg(F.sum("n").alias("n"))


def name_changes(ref_changes: DataFrame, author_changes: DataFrame, authors_before: DataFrame, refs_after: DataFrame) -> DataFrame:
    """``(name, n)`` changes of ``catalog_names``.

    ``ref_changes`` are the counted changes of author ids among the books,
    ``author_changes`` the differences of the authors, ``authors_before`` the
    authors of the changed references as they were, ``refs_after`` the new
    references of the changed authors.
    """
    old = authors_before.select(F.col("id").alias("_id"), F.col("full_name").alias("name"))
    by_refs = ref_changes.join(old, F.col(ref_changes.columns[0]) == F.col("_id")).select("name", "n")
    refs = refs_after.select(F.col(refs_after.columns[0]).alias("_ref"), F.col("n").alias("_n"))

    def renamed(side: str, sign: int) -> DataFrame:
        rows = author_changes.where(F.col(side).isNotNull()).select(F.col("id"), F.col(side)["full_name"].alias("name"))
        return rows.join(refs, F.col("id") == F.col("_ref")).select("name", (F.lit(sign) * F.col("_n")).alias("n"))

    both = by_refs.unionByName(renamed("after", 1)).unionByName(renamed("before", -1))
    return both.where(_shown(F.col("name"))).groupBy("name").agg(F.sum("n").alias("n")).where(F.col("n") != 0)


def keep_counts(spark: SparkSession, books_root: str, authors_root: str, refs_root: str, names_root: str,
                books: tuple[int, int], authors: tuple[int, int]) -> None:
    """Bring the stored references and names from the old versions of books
    and authors to the new ones."""
    book_changes = keyed.differences(spark, books_root, *books).checkpoint()
    changed_authors = keyed.differences(spark, authors_root, *authors).checkpoint()
    ref_changes = counted_changes(book_changes, "author_id", "author_id").checkpoint()
    add_counts(spark, refs_root, ref_changes)
    before = keyed.read_matching(spark, authors_root, ref_changes.select("author_id"), authors[0])
    after = keyed.read_matching(spark, refs_root, changed_authors.select("id"))
    add_counts(spark, names_root, name_changes(ref_changes, changed_authors, before, after))


def refresh_view(spark: SparkSession, view_root: str, books_root: str, authors_root: str, categories: DataFrame,
                 books: tuple[int, int], authors: tuple[int, int], category_changes: DataFrame | None = None) -> keyed.Version:
    """J1 kept current: bring the stored view from the old versions of books
    and authors to the new ones.

    ``categories`` is the whole table as it is now; ``category_changes`` the
    ids (column ``id``) of changed categories, if any.
    """
    book_changes = keyed.differences(spark, books_root, *books).select("id", "change").checkpoint()
    changed_authors = keyed.differences(spark, authors_root, *authors).select("id").checkpoint()
    view = keyed.read(spark, view_root).select("id", "author_id", "category_id")
    concerned = book_changes.where("change <> 'delete'").select("id")
    for column, ids in (("author_id", changed_authors), ("category_id", category_changes)):
        if ids is not None:
            changed = checked_broadcast(ids.select(F.col("id").alias("_dim")).distinct(), measured=ids)
            concerned = concerned.unionByName(view.join(changed, view[column] == F.col("_dim"), "left_semi").select("id"))
    concerned = concerned.distinct().checkpoint()
    rows = keyed.read_matching(spark, books_root, concerned, books[1]).checkpoint()
    names = keyed.read_matching(spark, authors_root, rows.select("author_id"), authors[1])
    fresh = enrich(rows, names, categories).checkpoint()
    return keyed.merge(spark, view_root, fresh, book_changes.where("change = 'delete'").select("id"))
