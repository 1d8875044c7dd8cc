"""JSON rows in and out.

In: JSON text is parsed against an explicit schema; text that is not a JSON
object is kept and routed to the rejects, never dropped.  Out: one JSON object
per row with keys in alphabetical order and nulls written as ``null`` (what the
reference's JSON responses contain).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_json_object(text: Column | str) -> Column:
    """True when the whole text is one JSON object (never null)."""
    return object_entries(parse_whole(text)).isNotNull()


def parse_whole(text: Column | str) -> Column:
    """A JSON object text parsed as the only element of an array.

    The parser stops at the end of a value, so ``{..} more`` would pass as an
    object; within an array, text behind the object is malformed.
    """
    c = F.col(text) if isinstance(text, str) else text
    return F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<map<string,string>>")


def object_entries(parsed: Column) -> Column:
    """The members of a ``parse_whole`` result as ``array<struct<key, value>>``
    of texts, in order; null unless the text was one object."""
    return F.when(F.size(parsed) == 1, F.map_entries(parsed[0]))


def member(entries: Column, name: str) -> Column:
    """``struct<key, value>`` of a member (the last of that name), or null."""
    return F.try_element_at(F.filter(entries, lambda e: e["key"] == F.lit(name)), F.lit(-1))


def read_json_rows(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """JSON-lines files -> (parsed rows, malformed lines with their text).

    Lines are read as text and parsed with ``from_json``; a line that is not a
    JSON object goes to the second frame (``line``) instead of vanishing.
    """
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    checked = lines.select("line", is_json_object("line").alias("_ok"))
    good = checked.filter("_ok").select(F.from_json("line", schema).alias("_r")).select("_r.*")
    bad = checked.filter(~F.col("_ok")).select("line")
    return good, bad


def json_text(df: DataFrame, columns: list[str] | None = None, out: str = "json") -> Column:
    """One JSON object per row, keys sorted, nulls kept."""
    names = sorted(columns or df.columns)
    return F.to_json(F.struct(*[F.col(n) for n in names]), {"ignoreNullFields": "false"}).alias(out)


def to_json_rows(df: DataFrame, key: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Rows as JSON text, with ``key`` kept beside it when given."""
    body = json_text(df, columns)
    return df.select(F.col(key), body) if key else df.select(body)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON-lines files, keys sorted, nulls written."""
    names = sorted(df.columns)
    df.select(*names).write.mode(mode).option("ignoreNullFields", "false").json(path)
