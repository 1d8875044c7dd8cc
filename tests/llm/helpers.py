"""Small frames and brute-force models shared by the operator tests."""

import re
import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_frame(spark, rows, schema=DOCS):
    """Rows of (doc_id, text[, lang, source]); missing values are null."""
    full = [(r[0], r[1], *(list(r[2:]) + [None] * (4 - len(r))), len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, schema)


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def odd_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, a
    very long text, other scripts."""
    long_text = " ".join(f"word{i % 977} and so on." for i in range(40_000))
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", None), (None, "the lost one", "en", "a"),
        (4, "same text here for all of us", "en", "a"), (5, "same text here for all of us", "de", "b"),
        (6, "same text here for all of us", None, None), (7, long_text, "en", "b"), (8, "12345 +-*/ 67890", None, "c"),
        (9, "žluťoučký kůň 日本語 текст 🙂", "cs", "c"), (10, "x", "en", "d"), (10, "x", "en", "d"), (None, None, None, None),
    ]


def crc_mod(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def components(nodes, links):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in nodes}
