"""Text search predicates and the admin row text.

Search is a scan by nature: the predicate is a built-in ``contains`` on
lower-cased text, evaluated inside the scan's code-generated stage right after
column pruning, so only the searched columns and the key are read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.values import _col

# JavaScript String.prototype.trim() white space (gate of the reader search).
JS_TRIM_CHARS = (
    " \t\n\x0b\x0c\r\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)


def search_gate(query: str | None) -> bool:
    """``query.trim()`` is non-empty: only then does the reader search filter."""
    return bool(query) and bool(query.strip(JS_TRIM_CHARS))


def contains_ci(text: Column | str, query: str | Column) -> Column:
    """Case-insensitive substring test; ``%`` and ``_`` are literal.

    Both sides are lower-cased by Spark (Unicode-aware), never by Python.
    """
    q = query if isinstance(query, Column) else F.lit(query)
    return F.contains(F.lower(_col(text)), F.lower(q))


def any_contains_ci(columns: list[str], query: str) -> Column:
    """``(a || '').toLowerCase().includes(q) || (b || '')...``: null cells never match."""
    cond = None
    for name in columns:
        test = contains_ci(F.coalesce(F.col(name), F.lit("")), query)
        cond = test if cond is None else (cond | test)
    return cond


# ---------------------------------------------------------------------------
# White space of the admin table row template.  A row's text is
# its cells joined by the new line + indentation runs the template writes
# between them; the last cell (action buttons) holds only white space.
# ---------------------------------------------------------------------------
ROW_CELL_SEPARATOR = "\n" + " " * 10
ROW_ACTION_CELL = "".join("\n" + " " * n for n in (12, 14, 16, 14, 14, 16, 14, 12, 10))
ROW_END = "\n" + " " * 8


def row_text(cells: list[Column]) -> Column:
    """Text content of one admin table row built from its visible cells.

    Cells must already be text with nulls replaced (``concat`` returns null
    when any part is null, which would hide the row from every search).
    """
    parts: list[Column] = []
    for cell in cells:
        parts += [F.lit(ROW_CELL_SEPARATOR), cell]
    parts += [F.lit(ROW_CELL_SEPARATOR), F.lit(ROW_ACTION_CELL), F.lit(ROW_END)]
    return F.concat(*parts)
