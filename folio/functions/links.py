"""Reader links: build ``reader.html?id=..&title=..`` and read them back."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.values import _col, template_text

# ---------------------------------------------------------------------------
# Fixed values of the reader page.
# ---------------------------------------------------------------------------
READER_PAGE = "reader.html"
NO_TITLE = "Không có tiêu đề"    # title shown when the link carries none
CONTENT_SUFFIX = ".pdf"          # content file of a record: "<id>.pdf"

# URLEncoder (Spark's url_encode) escapes these, encodeURIComponent keeps them.
_KEEP_AFTER_ENCODE = [("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")]


def encode_uri_component(c: Column | str) -> Column:
    """JavaScript ``encodeURIComponent`` on text.

    Spark's form encoding differs only in ``+`` for a space and in escaping
    ``! ' ( ) ~``; a literal ``+`` is already ``%2B`` so the swap is safe.
    """
    out = F.replace(F.url_encode(_col(c)), F.lit("+"), F.lit("%20"))
    for escaped, char in _KEEP_AFTER_ENCODE:
        out = F.replace(out, F.lit(escaped), F.lit(char))
    return out


def reader_link(id_col: Column | str, title_col: Column | str) -> Column:
    """``reader.html?id=${id}&title=${encodeURIComponent(title)}``."""
    return F.concat(
        F.lit(READER_PAGE + "?id="),
        template_text(id_col),
        F.lit("&title="),
        encode_uri_component(template_text(title_col)),
    )


def query_param(url: Column | str, name: str) -> Column:
    """First value of a query parameter, form-decoded (``+`` is a space);
    null when absent (never an error).  Like ``URLSearchParams``, any text
    after the first ``?`` up to a ``#`` is the query, and a ``%`` that starts no
    escape is kept as text."""
    query = F.regexp_extract(_col(url), r"^[^?#]*\?([^#]*)", 1)
    pair = rf"(?:^|&){re.escape(name)}(?:=([^&]*))?(?=&|$)"
    raw = F.when(query.rlike(pair), F.regexp_extract(query, pair, 1))
    # Escapes that are none are kept: their percent sign stands for itself.
    return F.try_url_decode(F.regexp_replace(raw, "%(?![0-9A-Fa-f]{2})", "%25"))


def link_fields(url: Column | str) -> dict[str, Column]:
    """What the reader page reads from its link: id, title with fallback, and
    the missing-id flag (``!id`` is true for an absent or empty id)."""
    book_id = query_param(url, "id")
    title = query_param(url, "title")
    return {
        "link_id": book_id,
        "link_title": F.when(F.coalesce(title, F.lit("")) == "", F.lit(NO_TITLE)).otherwise(title),
        "missing_id": F.coalesce(book_id, F.lit("")) == "",
    }


def content_file_name(id_col: Column | str) -> Column:
    """Name of a record's content file, ``<id>.pdf``."""
    return F.concat(template_text(id_col), F.lit(CONTENT_SUFFIX))


def content_id_from_path(path: Column | str, suffix: str = CONTENT_SUFFIX) -> Column:
    """Record id of a content file: the whole file name must be digits + suffix."""
    pattern = "/([0-9]+)" + suffix.replace(".", "\\.") + "$"
    return F.nullif(F.regexp_extract(_col(path), pattern, 1), F.lit("")).try_cast("bigint")
