"""Value rules of the catalogue clients, as ``Column -> Column`` helpers.

The browser code defaults, parses and prints values with JavaScript rules that
differ from SQL (falsy versus null defaults, integer-prefix parsing, templates
that print a missing value as ``null``).  Each rule here is one built-in Spark
expression, so it stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Display text that must equal the reference clients' output.
# ---------------------------------------------------------------------------
DASH = "—"                       # empty detail / listing cell
NO_AUTHOR = "Chưa có tác giả"    # reader card, book without an author
NO_CATEGORY = "Chưa phân loại"   # reader card, book without a category
COPIES_UNIT = "quyển"            # "<quantity> quyển"
NULL_TEXT = "null"               # what a template literal prints for null
ENTITY_LABELS = {"book": "sách", "author": "tác giả", "category": "thể loại"}
DEFAULT_ROLE = "user"            # role of a user inserted without one

# Characters JavaScript treats as white space when parsing a number prefix.
_JS_SPACE = "[\\s\\u00a0\\ufeff\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def is_falsy(c: Column | str, numeric: bool = False) -> Column:
    """JavaScript falsiness of a stored value: null, '' and, for numbers, 0/NaN.

    The result is never null, so it can drive ``when`` and ``filter``.
    """
    c = _col(c)
    if numeric:
        test = c.isNull() | (c == 0) | F.isnan(c.cast("double"))
    else:
        test = c.isNull() | (c == F.lit(""))
    return F.coalesce(test, F.lit(True))


def falsy_default(c: Column | str, default, numeric: bool = False) -> Column:
    """``x || d``: the default replaces null, '' (and 0, NaN for numbers)."""
    c = _col(c)
    return F.when(is_falsy(c, numeric), _lit(default)).otherwise(c)


def falsy_text(c: Column | str, default: str = DASH, numeric: bool = False) -> Column:
    """``x || "—"`` rendered as text: the value's string form or the default."""
    c = _col(c)
    return F.when(is_falsy(c, numeric), F.lit(default)).otherwise(c.cast("string"))


def null_default(c: Column | str, default) -> Column:
    """``x != null ? x : d``: keeps 0 and ''."""
    return F.coalesce(_col(c), _lit(default))


def template_text(c: Column | str) -> Column:
    """``${x}`` in a template literal: the string form, ``null`` for null."""
    return F.coalesce(_col(c).cast("string"), F.lit(NULL_TEXT))


def is_truthy_text(c: Column | str) -> Column:
    """``.filter(Boolean)`` on strings: drops null and ''."""
    c = _col(c)
    return c.isNotNull() & (c != F.lit(""))


def parse_int(c: Column | str, to: str = "int") -> Column:
    """JavaScript ``parseInt(x)``: the leading integer of a text, else null.

    ``"12abc"`` -> 12, ``"  7"`` -> 7, ``"3.9"`` -> 3, ``"1e3"`` -> 1,
    ``"0x1f"`` -> 31, ``"abc"`` / ``""`` -> null (JavaScript's NaN).  Values
    outside ``to`` become null.
    """
    s = _col(c).cast("string")
    is_hex = s.rlike(f"^{_JS_SPACE}*[+-]?0[xX]")
    hex_sign = F.regexp_extract(s, f"^{_JS_SPACE}*([+-]?)0[xX]", 1)
    hex_digits = F.regexp_extract(s, f"^{_JS_SPACE}*[+-]?0[xX]([0-9a-fA-F]+)", 1)
    # No match gives '': make it null before casting, so the cast never takes
    # its (slow) failure path for ordinary non-numeric text.
    dec = F.nullif(F.regexp_extract(s, f"^{_JS_SPACE}*([+-]?[0-9]+)", 1), F.lit(""))
    hex_value = F.concat(hex_sign, F.conv(hex_digits, 16, 10))
    # CASE evaluates only the chosen branch: decimal text costs two regexes.
    return (
        F.when(s.isNull(), F.lit(None).cast(to))
        .when(is_hex, F.when(hex_digits != "", hex_value.try_cast(to)))
        .otherwise(dec.try_cast(to))
    )


def parse_int_or_null(c: Column | str, to: str = "int") -> Column:
    """``parseInt(x) || null``: 0 and NaN both become null."""
    return F.nullif(parse_int(c, to), F.lit(0).cast(to))


def parse_int_or_zero(c: Column | str, to: str = "int") -> Column:
    """``parseInt(x) || 0``."""
    return F.coalesce(parse_int(c, to), F.lit(0).cast(to))


def blank_to_null(c: Column | str) -> Column:
    """``x || null`` on a text field (used for dates only)."""
    return F.nullif(_col(c), F.lit(""))


def parse_date(c: Column | str) -> Column:
    """ISO ``yyyy-MM-dd`` text of a date input; blank or bad text -> null."""
    return F.try_to_date(blank_to_null(c), "yyyy-MM-dd")


def date_text(c: Column | str) -> Column:
    """A date shown as ISO text (the form and listing format)."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def copies_text(c: Column | str) -> Column:
    """``${quantity} quyển``; null when the quantity is null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.concat(c.cast("string"), F.lit(" " + COPIES_UNIT)))


def entity_label(c: Column | str) -> Column:
    """Constant map lookup of an entity's display label."""
    pairs = []
    for key, label in ENTITY_LABELS.items():
        pairs += [F.lit(key), F.lit(label)]
    return F.create_map(*pairs)[_col(c)]


def editing_route(id_col: Column | str) -> Column:
    """Insert-or-update routing: a truthy editing id means update."""
    return F.when(is_falsy(id_col, numeric=True), F.lit("insert")).otherwise(F.lit("update"))
