"""Enrichment of the fact table and the catalogue's row projections.

J1 joins books to authors and categories (left outer: a book keeps its row
when its author or category is missing).  The projections P1-P8 are the rows
each client page shows, with the page's own default rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions import values as V
from folio.operators.joins import checked_broadcasts, unique_dimension

CATALOG_COLUMNS = [
    "id", "title", "author", "category", "published_year",
    "description", "quantity", "category_id", "author_id",
]
EDIT_COLUMNS = ["id", "title", "author_id", "category_id", "published_year", "description", "quantity"]


def enrich(
    books: DataFrame,
    authors: DataFrame,
    categories: DataFrame,
    broadcast_max_rows: int | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """J1 + P1: the 9-column catalogue view.

    Each dimension is cut to (key, name), made unique on its key (an error if
    a key repeats) and broadcast only when counted small; otherwise the join
    shuffles both sides on the key and AQE splits a hot key's partition.
    """
    a_raw = authors.select(F.col("id").alias("_author_key"), F.col("full_name").alias("author"))
    c_raw = categories.select(F.col("id").alias("_category_key"), F.col("name").alias("category"))
    if check_unique:
        a = unique_dimension(a_raw, "_author_key", {"author": "author"})
        c = unique_dimension(c_raw, "_category_key", {"category": "category"})
    else:
        a, c = a_raw, c_raw
    a, c = checked_broadcasts([(a, a_raw), (c, c_raw)], broadcast_max_rows)
    joined = (
        books.join(a, books["author_id"] == a["_author_key"], "left")
        .join(c, books["category_id"] == c["_category_key"], "left")
    )
    return joined.select(*CATALOG_COLUMNS)


def edit_projection(books: DataFrame) -> DataFrame:
    """The 7 columns of the edit form, read from books alone (no join)."""
    return books.select(*EDIT_COLUMNS)


def admin_cells(catalog: DataFrame, number_col: str = "row_no") -> DataFrame:
    """P5: the admin table's visible cells.  Title, author and category are
    printed by a template (null -> ``null``); year and quantity use falsy
    defaults (``—`` and 0)."""
    return catalog.select(
        "id",
        F.col(number_col),
        V.template_text("title").alias("title_text"),
        V.template_text("author").alias("author_text"),
        V.template_text("category").alias("category_text"),
        V.falsy_text("published_year", V.DASH, numeric=True).alias("year_text"),
        V.falsy_default("quantity", 0, numeric=True).cast("int").alias("quantity_shown"),
    )


def reader_cards(catalog: DataFrame) -> DataFrame:
    """Reader card fields."""
    return catalog.select(
        "id",
        "title",
        V.falsy_text("author", V.NO_AUTHOR).alias("author_text"),
        V.falsy_text("category", V.NO_CATEGORY).alias("category_text"),
        V.copies_text("quantity").alias("quantity_text"),
    )


def detail_rows(catalog: DataFrame) -> DataFrame:
    """The detail dialog."""
    return catalog.select(
        "id",
        "title",
        V.falsy_text("author", V.DASH).alias("author_text"),
        V.falsy_text("category", V.DASH).alias("category_text"),
        V.falsy_text("published_year", V.DASH, numeric=True).alias("year_text"),
        F.coalesce(V.copies_text("quantity"), F.lit(V.DASH)).alias("quantity_text"),
        "description",
        V.is_truthy_text("description").alias("has_description"),
    )


def author_listing(authors: DataFrame, number_col: str = "row_no") -> DataFrame:
    """P3 + P8: author rows as listed (``bio || —``, ``birthdate || —``)."""
    return authors.select(
        "id",
        F.col(number_col),
        V.template_text("full_name").alias("name_text"),
        V.falsy_text("bio", V.DASH).alias("note_text"),
        F.coalesce(V.date_text("birthdate"), F.lit(V.DASH)).alias("date_text"),
    )


def category_listing(categories: DataFrame, number_col: str = "row_no") -> DataFrame:
    """P4 + P8: category rows as listed (``description || —``)."""
    return categories.select(
        "id",
        F.col(number_col),
        V.template_text("name").alias("name_text"),
        V.falsy_text("description", V.DASH).alias("note_text"),
        F.lit(None).cast("string").alias("date_text"),
    )


def content_coverage(books: DataFrame, files: DataFrame, key: str = "id", file_key: str = "content_id",
                     how: str = "flag") -> DataFrame:
    """Pair records with their content files by id.

    ``how='flag'`` keeps every record with ``has_content``; ``'with'`` /
    ``'without'`` keep only records that have / lack a file (semi / anti
    join).  The file side is reduced to distinct ids first, so the join can
    never multiply records.
    """
    ids = files.select(F.col(file_key).alias("_content_key")).where(F.col("_content_key").isNotNull()).distinct()
    cond = books[key] == ids["_content_key"]
    if how == "with":
        return books.join(ids, cond, "left_semi")
    if how == "without":
        return books.join(ids, cond, "left_anti")
    flagged = books.join(ids.withColumn("_has", F.lit(True)), cond, "left")
    return flagged.select(*books.columns, F.coalesce(F.col("_has"), F.lit(False)).alias("has_content"))
