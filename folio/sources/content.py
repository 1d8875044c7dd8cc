"""Content files keyed by record id (S4): ``<id>.pdf`` in a folder tree.

The listing uses Spark's ``binaryFile`` source with only path, size and time
selected, so file bytes are never read; the record id comes from the file
name.  Pair the listing with records through ``enrich.content_coverage``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions.links import CONTENT_SUFFIX, content_id_from_path


def list_content(spark: SparkSession, folder: str, suffix: str = CONTENT_SUFFIX) -> DataFrame:
    """``path, length, modified, content_id`` of every ``*<suffix>`` file."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length", "modificationTime")
    )
    return files.select(
        "path", "length", F.col("modificationTime").alias("modified"),
        content_id_from_path("path", suffix).alias("content_id"),
    )


def read_content(spark: SparkSession, folder: str, ids: DataFrame, key: str = "id",
                 suffix: str = CONTENT_SUFFIX) -> DataFrame:
    """Bytes of the content files of the given records (the file a reader
    opens for ``<id>.pdf``); records without a file are not returned."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "content", content_id_from_path("path", suffix).alias("_cid"))
    )
    wanted = ids.select(F.col(key).alias("_cid")).distinct()
    return files.join(wanted, "_cid", "left_semi").withColumnRenamed("_cid", key)
