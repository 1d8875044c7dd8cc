"""Lookups, facet and text search over the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions.text import any_contains_ci, contains_ci, row_text, search_gate
from folio.functions.values import template_text

ALL = "all"


def lookup(df: DataFrame, key: str, value, first_only: bool = True) -> DataFrame:
    """Rows whose ``key`` equals ``value``; empty when none.

    The equality reaches the parquet scan as a pushed filter (and row-group
    statistics skip data); ``first_only`` is the reference's fetch-one.
    """
    out = df.filter(F.col(key) == F.lit(value))
    return out.limit(1) if first_only else out


def lookup_natural_key(users: DataFrame, key: str, value: str, result: list[str],
                       case_sensitive: bool = True) -> DataFrame:
    """look a row up by a natural key (e-mail) and return some columns."""
    if case_sensitive:
        cond = F.col(key) == F.lit(value)
    else:
        cond = F.lower(F.col(key)) == F.lower(F.lit(value))
    return users.filter(cond).select(*result).limit(1)


def _canonical_int(text: str) -> int | None:
    try:
        number = int(text)
    except (TypeError, ValueError):
        return None
    return number if str(number) == text else None


def facet(df: DataFrame, choice, column: str = "category_id") -> DataFrame:
    """``'all'`` keeps every row, else ``String(category_id) === String(choice)``.

    A canonical integer choice is compared as a number so the filter can be
    pushed to the scan; any other text ("02", "x") can only match the string
    form, which no integer column produces except through the cast.
    """
    choice = str(choice)
    if choice == ALL:
        return df
    number = _canonical_int(choice)
    if number is not None:
        # No stored id lies beyond 64 bits.
        return df.filter(F.col(column) == F.lit(number)) if abs(number) < 2 ** 63 else df.filter(F.lit(False))
    # String(null) is "null" in JavaScript, so that choice finds missing ids.
    return df.filter(template_text(column) == F.lit(choice))


def text_search(df: DataFrame, query: str | None, columns: tuple[str, ...] = ("title", "author")) -> DataFrame:
    """reader search.  Runs only when the trimmed query is non-empty; the
    match itself uses the untrimmed, lower-cased query."""
    if not search_gate(query):
        return df
    return df.filter(any_contains_ci(list(columns), query))


def facet_and_search(df: DataFrame, choice, query: str | None) -> DataFrame:
    """facet, then search, on the same rows (Catalyst merges the filters)."""
    return text_search(facet(df, choice), query)


def row_text_search(cells: DataFrame, query: str, cell_columns: list[str]) -> DataFrame:
    """admin whole-row search: the row's text content contains the query
    (lower-cased, not trimmed, no gate)."""
    text = row_text([F.col(c).cast("string") for c in cell_columns])
    return cells.filter(contains_ci(text, query))


ADMIN_CELLS = ["row_no", "title_text", "author_text", "category_text", "year_text", "quantity_shown"]
_ASCII_DIGITS = set("0123456789")


def admin_row_search(catalog: DataFrame, query: str, key: str = "id") -> DataFrame:
    """F7 over the admin listing: ``key, row_no`` of the rows whose text
    contains ``query``.

    The row number is the first cell and is all digits.  A query without
    digits can match neither inside it nor across it, and what it matches in
    the indentation before it also follows it, so such a query is decided on
    the text after the number in the same pass that reads the rows; the
    numbering then moves only ``(key, hit)`` instead of every cell.  A query
    with digits is matched on fully numbered rows.
    """
    from folio.operators.enrich import admin_cells
    from folio.operators.numbering import number_rows

    if _ASCII_DIGITS & set(query):
        cells = admin_cells(number_rows(catalog, key))
        return row_text_search(cells, query, ADMIN_CELLS).select(key, "row_no")
    cells = admin_cells(catalog.withColumn("row_no", F.lit(None).cast("long")))
    text = row_text([F.col(c).cast("string") for c in ADMIN_CELLS[1:]])
    flagged = cells.select(key, contains_ci(text, query).alias("_hit"))
    return number_rows(flagged, key).filter("_hit").select(key, "row_no")


def truthy(df: DataFrame, column: str) -> DataFrame:
    """F8: ``.filter(Boolean)`` on a text column."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def is_empty(df: DataFrame) -> bool:
    """the "nothing found" test (stops at the first row)."""
    return df.isEmpty()
