"""Catalogue queries over the driver tables: browse, look up, search, count.

Every function takes ``(spark, sf_dir)`` and returns a lazy ``DataFrame``
over the whole tables; ``ORACLE_SQL`` holds the same query for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import values as V
from folio.operators import enrich as E
from folio.operators import search as S
from folio.operators import stats as A
from folio.operators.numbering import number_rows
from folio.plans.bindings import catalog_tables, table, with_catalog

# Parameters of the registered queries (the reference's user inputs).
POINT_ID = 12
FACET_CHOICE = "2"
TITLE_QUERY = "#00000012"
FACET_QUERY = "0012"
ROW_QUERY = "null"
DOCUMENT_QUERY = "ÜE"


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    books, authors, categories = catalog_tables(spark, sf_dir)
    return E.enrich(books, authors, categories)


def catalog_enriched(spark, sf_dir):
    return catalog(spark, sf_dir)


def catalog_point(spark, sf_dir):
    books, _, _ = catalog_tables(spark, sf_dir)
    return S.lookup(E.edit_projection(books), "id", POINT_ID)


def catalog_detail(spark, sf_dir):
    return E.detail_rows(catalog(spark, sf_dir))


def reader_cards(spark, sf_dir):
    return E.reader_cards(catalog(spark, sf_dir))


def admin_listing(spark, sf_dir):
    return E.admin_cells(number_rows(catalog(spark, sf_dir), "id"))


def facet_filter(spark, sf_dir):
    return S.facet(catalog(spark, sf_dir), FACET_CHOICE)


def text_search(spark, sf_dir):
    return S.text_search(catalog(spark, sf_dir), TITLE_QUERY)


def facet_and_search(spark, sf_dir):
    return E.reader_cards(S.facet_and_search(catalog(spark, sf_dir), FACET_CHOICE, FACET_QUERY))


def row_text_search(spark, sf_dir):
    return S.admin_row_search(catalog(spark, sf_dir), ROW_QUERY)


def document_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = S.text_search(docs, DOCUMENT_QUERY, columns=("text", "source"))
    return found.select("doc_id", "lang", "source", "n_chars")


def catalog_stats(spark, sf_dir):
    books, authors, categories = catalog_tables(spark, sf_dir)
    return A.catalog_stats_by_keys(books, authors, categories)


def entity_counts(spark, sf_dir):
    books, authors, categories = catalog_tables(spark, sf_dir)
    return A.entity_counts(books, authors, categories)


def author_names(spark, sf_dir):
    books, authors, _ = catalog_tables(spark, sf_dir)
    return A.referenced_names(books, authors, "author_id", "id", "full_name", out="author")


def numbered_rows(spark, sf_dir):
    books, _, _ = catalog_tables(spark, sf_dir)
    return number_rows(books.select("id", "title"), "id")


def dimension_listings(spark, sf_dir):
    _, authors, categories = catalog_tables(spark, sf_dir)
    a = E.author_listing(number_rows(authors, "id")).withColumn("entity", F.lit("author"))
    c = E.category_listing(number_rows(categories, "id")).withColumn("entity", F.lit("category"))
    both = a.unionByName(c)
    return both.withColumn("entity_label", V.entity_label("entity"))


QUERIES = {
    "catalog_enriched": catalog_enriched,
    "catalog_point": catalog_point,
    "catalog_detail": catalog_detail,
    "reader_cards": reader_cards,
    "admin_listing": admin_listing,
    "facet_filter": facet_filter,
    "text_search": text_search,
    "facet_and_search": facet_and_search,
    "row_text_search": row_text_search,
    "document_search": document_search,
    "catalog_stats": catalog_stats,
    "entity_counts": entity_counts,
    "author_names": author_names,
    "numbered_rows": numbered_rows,
    "dimension_listings": dimension_listings,
}


# ---------------------------------------------------------------------------
# DuckDB oracle text.  ``catalog`` and the bindings are CTEs (bindings.py).
# ---------------------------------------------------------------------------
_ROW_SEP = "chr(10) || repeat(' ', 10)"
_ROW_TAIL = " || ".join(f"chr(10) || repeat(' ', {n})" for n in (12, 14, 16, 14, 14, 16, 14, 12, 10, 8))

_ADMIN_SQL = """
admin AS (
  SELECT id, CAST(row_number() OVER (ORDER BY id) AS BIGINT) AS row_no,
         coalesce(CAST(title AS VARCHAR), 'null') AS title_text,
         coalesce(author, 'null') AS author_text,
         coalesce(category, 'null') AS category_text,
         CASE WHEN published_year IS NULL OR published_year = 0 THEN '—'
              ELSE CAST(published_year AS VARCHAR) END AS year_text,
         CAST(CASE WHEN quantity IS NULL OR quantity = 0 THEN 0 ELSE quantity END AS INTEGER) AS quantity_shown
  FROM catalog)
"""

_CARDS = """
  SELECT id, title,
         CASE WHEN author IS NULL OR author = '' THEN 'Chưa có tác giả' ELSE author END AS author_text,
         CASE WHEN category IS NULL OR category = '' THEN 'Chưa phân loại' ELSE category END AS category_text,
         CASE WHEN quantity IS NOT NULL THEN CAST(quantity AS VARCHAR) || ' quyển' END AS quantity_text
"""

ORACLE_SQL = {
    "catalog_enriched": with_catalog("SELECT * FROM catalog"),
    "catalog_point": with_catalog(f"""
        SELECT id, title, author_id, category_id, published_year, description, quantity
        FROM books WHERE id = {POINT_ID} LIMIT 1"""),
    "catalog_detail": with_catalog("""
        SELECT id, title,
               CASE WHEN author IS NULL OR author = '' THEN '—' ELSE author END AS author_text,
               CASE WHEN category IS NULL OR category = '' THEN '—' ELSE category END AS category_text,
               CASE WHEN published_year IS NULL OR published_year = 0 THEN '—'
                    ELSE CAST(published_year AS VARCHAR) END AS year_text,
               CASE WHEN quantity IS NOT NULL THEN CAST(quantity AS VARCHAR) || ' quyển' ELSE '—' END AS quantity_text,
               description,
               (description IS NOT NULL AND description <> '') AS has_description
        FROM catalog"""),
    "reader_cards": with_catalog(_CARDS + " FROM catalog"),
    "admin_listing": with_catalog(", " + _ADMIN_SQL + " SELECT * FROM admin"),
    "facet_filter": with_catalog(f"SELECT * FROM catalog WHERE category_id = {int(FACET_CHOICE)}"),
    "text_search": with_catalog(f"""
        SELECT * FROM catalog
        WHERE contains(lower(coalesce(title, '')), lower('{TITLE_QUERY}'))
           OR contains(lower(coalesce(author, '')), lower('{TITLE_QUERY}'))"""),
    "facet_and_search": with_catalog(_CARDS + f"""
        FROM catalog
        WHERE category_id = {int(FACET_CHOICE)}
          AND (contains(lower(coalesce(title, '')), lower('{FACET_QUERY}'))
               OR contains(lower(coalesce(author, '')), lower('{FACET_QUERY}')))"""),
    "row_text_search": with_catalog(", " + _ADMIN_SQL + f"""
        SELECT id, row_no FROM admin
        WHERE contains(lower({_ROW_SEP} || CAST(row_no AS VARCHAR) || {_ROW_SEP} || title_text
                             || {_ROW_SEP} || author_text || {_ROW_SEP} || category_text
                             || {_ROW_SEP} || year_text || {_ROW_SEP} || CAST(quantity_shown AS VARCHAR)
                             || {_ROW_SEP} || {_ROW_TAIL}),
                       lower('{ROW_QUERY}'))"""),
    "document_search": f"""
        SELECT doc_id, lang, source, n_chars FROM documents
        WHERE contains(lower(coalesce(text, '')), lower('{DOCUMENT_QUERY}'))
           OR contains(lower(coalesce(source, '')), lower('{DOCUMENT_QUERY}'))""",
    "catalog_stats": with_catalog("""
        SELECT (SELECT count(*) FROM catalog) AS total_books,
               (SELECT count(DISTINCT author) FROM catalog WHERE author <> '') AS distinct_authors,
               (SELECT count(*) FROM categories) AS total_categories"""),
    "entity_counts": with_catalog("""
        SELECT (SELECT count(*) FROM books) AS n_books,
               (SELECT count(*) FROM authors) AS n_authors,
               (SELECT count(*) FROM categories) AS n_categories"""),
    "author_names": with_catalog("SELECT DISTINCT author FROM catalog WHERE author IS NOT NULL AND author <> ''"),
    "numbered_rows": with_catalog("""
        SELECT id, title, CAST(row_number() OVER (ORDER BY id) AS BIGINT) AS row_no FROM books"""),
    "dimension_listings": with_catalog("""
        SELECT id, CAST(row_number() OVER (ORDER BY id) AS BIGINT) AS row_no,
               coalesce(full_name, 'null') AS name_text,
               CASE WHEN bio IS NULL OR bio = '' THEN '—' ELSE bio END AS note_text,
               coalesce(strftime(birthdate, '%Y-%m-%d'), '—') AS date_text,
               'author' AS entity, 'tác giả' AS entity_label
        FROM authors
        UNION ALL
        SELECT id, CAST(row_number() OVER (ORDER BY id) AS BIGINT) AS row_no,
               coalesce(name, 'null') AS name_text,
               CASE WHEN description IS NULL OR description = '' THEN '—' ELSE description END AS note_text,
               CAST(NULL AS VARCHAR) AS date_text,
               'category' AS entity, 'thể loại' AS entity_label
        FROM categories"""),
}
