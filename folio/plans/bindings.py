"""Bindings of the catalogue model to the driver's TPC-H-like tables.

books      <- orders    id = o_orderkey, title = "Order#" + 9-digit key,
                        author_id = o_custkey, category_id = priority number,
                        published_year = year(o_orderdate),
                        description = o_orderstatus,
                        quantity = floor(o_totalprice / 1000)
authors    <- customer  with c_acctbal >= 0 (some books keep no author)
categories <- distinct order priorities except "4-..." (some books stay
              uncategorised); name = text after the dash

Each binding is a projection over a parquet scan, so Catalyst prunes the
columns a query does not use and pushes its filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.sources.tables import read_table

TITLE_FORMAT = "Order#%09d"
PRIORITY_NUMBER = r"^([0-9]+)-"
PRIORITY_NAME = r"^[0-9]+-(.*)$"
UNCATEGORISED_PRIORITY = "4-%"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def priority_number(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, PRIORITY_NUMBER, 1), F.lit("")).try_cast("bigint")


def books_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.format_string(TITLE_FORMAT, F.col("o_orderkey")).alias("title"),
        F.col("o_custkey").alias("author_id"),
        priority_number(F.col("o_orderpriority")).alias("category_id"),
        F.year("o_orderdate").cast("int").alias("published_year"),
        F.col("o_orderstatus").alias("description"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("quantity"),
    )


def authors_from_customer(customer: DataFrame) -> DataFrame:
    """Authors: full name, bio = market segment; birthdate from the nation
    key (none for nation 0, so listings show the empty-date default)."""
    return customer.filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("bio"),
        F.when(F.col("c_nationkey") != 0,
               F.make_date(F.col("c_nationkey") + 1950, F.lit(1), F.lit(1))).alias("birthdate"),
    )


def categories_from_orders(orders: DataFrame) -> DataFrame:
    """One row per priority; partial aggregation keeps the shuffle to a few
    rows per map task whatever the size of orders."""
    return (
        orders.filter(~F.col("o_orderpriority").like(UNCATEGORISED_PRIORITY))
        .select("o_orderpriority")
        .distinct()
        .select(
            priority_number(F.col("o_orderpriority")).alias("id"),
            F.regexp_extract("o_orderpriority", PRIORITY_NAME, 1).alias("name"),
            F.col("o_orderpriority").alias("description"),
        )
    )


def catalog_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    return (
        books_from_orders(orders),
        authors_from_customer(table(spark, sf_dir, "customer")),
        categories_from_orders(orders),
    )


# SQL text of the same bindings for the DuckDB oracle.
BOOKS_SQL = """
SELECT o_orderkey AS id,
       printf('Order#%09d', o_orderkey) AS title,
       o_custkey AS author_id,
       TRY_CAST(NULLIF(regexp_extract(o_orderpriority, '^([0-9]+)-', 1), '') AS BIGINT) AS category_id,
       CAST(year(o_orderdate) AS INTEGER) AS published_year,
       o_orderstatus AS description,
       CAST(floor(o_totalprice / 1000) AS INTEGER) AS quantity
FROM orders
"""

AUTHORS_SQL = """
SELECT c_custkey AS id, c_name AS full_name, c_mktsegment AS bio,
       CASE WHEN c_nationkey <> 0 THEN make_date(c_nationkey + 1950, 1, 1) END AS birthdate
FROM customer WHERE c_acctbal >= 0
"""

CATEGORIES_SQL = """
SELECT TRY_CAST(NULLIF(regexp_extract(o_orderpriority, '^([0-9]+)-', 1), '') AS BIGINT) AS id,
       regexp_extract(o_orderpriority, '^[0-9]+-(.*)$', 1) AS name,
       o_orderpriority AS description
FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority NOT LIKE '4-%')
"""

CATALOG_SQL = f"""
books AS ({BOOKS_SQL}),
authors AS ({AUTHORS_SQL}),
categories AS ({CATEGORIES_SQL}),
catalog AS (
  SELECT b.id, b.title, a.full_name AS author, c.name AS category,
         b.published_year, b.description, b.quantity, b.category_id, b.author_id
  FROM books b
  LEFT JOIN authors a ON b.author_id = a.id
  LEFT JOIN categories c ON b.category_id = c.id
)
"""


def with_catalog(select_sql: str) -> str:
    """Prefix a query with the catalogue CTEs."""
    return "WITH " + CATALOG_SQL + select_sql
