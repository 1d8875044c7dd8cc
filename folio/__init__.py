"""folio: catalogue analytics on Spark.

A fact table enriched by two dimensions, looked up by key, narrowed by facet
and text search, summarised by exact counts, and kept current by batches of
validated inserts, full-row replacements and deletes.  Every operator takes and
returns ``DataFrame`` / ``Column`` objects built from Spark's own functions.

The most used entry points are re-exported here.
"""

from folio.operators.changes import (
    AUTHOR,
    BOOK,
    CATEGORY,
    apply_change_log,
    apply_changes,
    delete_by_key,
    insert_rows,
    normalise_changes,
    reject_changes,
    replace_by_key,
)
from folio.operators.enrich import (
    admin_cells,
    author_listing,
    category_listing,
    content_coverage,
    detail_rows,
    edit_projection,
    enrich,
    reader_cards,
)
from folio.operators.numbering import assign_ids, number_rows
from folio.operators.search import admin_row_search, facet, facet_and_search, lookup, row_text_search, text_search
from folio.operators.stats import (
    catalog_stats,
    catalog_stats_by_keys,
    distinct_names,
    entity_counts,
    referenced_names,
)
from folio.operators.unique import unique_insert, unique_insert_two_keys
from folio.operators.users import register_users, role_of
from folio.operators.validate import book_rules, split_valid, validation_report
from folio.session import build_session

__version__ = "0.1.0"

__all__ = [
    "AUTHOR", "BOOK", "CATEGORY", "admin_cells", "admin_row_search", "apply_change_log", "apply_changes", "assign_ids",
    "author_listing", "book_rules", "build_session", "catalog_stats", "catalog_stats_by_keys", "category_listing", "content_coverage",
    "delete_by_key", "detail_rows", "distinct_names", "edit_projection", "enrich", "entity_counts", "facet",
    "facet_and_search", "insert_rows", "lookup", "normalise_changes", "number_rows", "reader_cards",
    "referenced_names",
    "register_users", "reject_changes", "replace_by_key", "role_of", "row_text_search", "split_valid",
    "text_search", "unique_insert", "unique_insert_two_keys", "validation_report",
]
