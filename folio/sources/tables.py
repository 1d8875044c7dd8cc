"""Table sources: the catalogue's stored tables and their schemas.

Reads are plain ``DataFrameReader`` calls so Catalyst can prune columns and push
filters into the scan.  A relational store is read through Spark's JDBC source
with a partition column, so the read is split across executors instead of
going through one connection; connection values always come from the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BOOKS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("author_id", T.LongType(), True),
    T.StructField("category_id", T.LongType(), True),
    T.StructField("published_year", T.IntegerType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("quantity", T.IntegerType(), True),
])

AUTHORS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("full_name", T.StringType(), True),
    T.StructField("bio", T.StringType(), True),
    T.StructField("birthdate", T.DateType(), True),
])

CATEGORIES_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
])

USERS_SCHEMA = T.StructType([
    T.StructField("username", T.StringType(), True),
    T.StructField("email", T.StringType(), True),
    T.StructField("role", T.StringType(), True),
])

# One requested change: entity book/author/category, op insert/update/delete,
# id of the target (null on insert) and the JSON body (null on delete).
CHANGES_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("entity", T.StringType(), False),
    T.StructField("op", T.StringType(), False),
    T.StructField("id", T.LongType(), True),
    T.StructField("body", T.StringType(), True),
])

SCHEMAS = {
    "books": BOOKS_SCHEMA,
    "authors": AUTHORS_SCHEMA,
    "categories": CATEGORIES_SCHEMA,
    "users": USERS_SCHEMA,
    "changes": CHANGES_SCHEMA,
}


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """``<base_dir>/<name>.parquet`` (a file or a folder of part files)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower_bound: int,
    upper_bound: int,
    num_partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A relational table read in ``num_partitions`` key ranges in parallel.

    Bounds only decide the split points; rows outside them are still read.
    Credentials and driver class belong in ``properties``.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(lower_bound))
        .option("upperBound", str(upper_bound))
        .option("numPartitions", str(num_partitions))
        .option("fetchsize", "10000")
    )
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select a frame's columns by name in the schema's order and types.

    Rows are always addressed by name, never by position, so a changed view
    cannot silently relabel columns.
    """
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str,
                  mode: str = "errorifexists") -> DataFrame:
    """Store ``df`` as a catalog table bucketed and sorted by ``key``.

    Two tables bucketed on their join keys with the same bucket count join
    without a shuffle (books by ``author_id`` with authors by ``id``; a
    table by ``id`` with its change log's per-id aggregate), and an
    aggregate by the key reuses the bucketing.  ``path`` keeps the files
    outside the warehouse folder.  Returns the table as read back.
    """
    (df.write.mode(mode).bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)
