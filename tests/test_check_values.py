
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def table_count(q, name, condition):
    return q.spark.read.parquet(f"{SF}/{name}.parquet").filter(condition).count()


@pytest.fixture(scope="module")
def q(spark):
    queries = entry.queries()

    def run(name):
        return queries[name](spark, SF)

    run.spark = spark
    return run


def test_catalog_values(q):
    row = q("catalog_enriched").agg(
        F.count(F.lit(1)).alias("n"), F.count("author").alias("with_author"),
        F.count("category").alias("with_category"), F.sum("quantity").alias("qty")).first()
    assert (row.n, row.with_author, row.with_category, row.qty) == (15000, 13751, 11980, 3750963)


def test_search_values(q):
    assert q("catalog_point").count() == 1
    assert q("facet_filter").count() == 3003
    assert q("text_search").count() == 88
    assert q("facet_and_search").count() == 384
    assert q("document_search").count() == 76


def test_stats_values(q):
    row = q("catalog_stats").first()
    assert (row.total_books, row.distinct_authors, row.total_categories) == (15000, 1378, 4)
    assert q("author_names").count() == 1378


def test_change_values(q):
    assert q("validate_rows").filter(~F.col("is_valid")).count() == 13071
    assert q("insert_rows").count() == 1600
    assert q("replace_by_key").filter("changed").count() == 150
    assert q("delete_by_key").count() == 1350
    applied = q("apply_changes")
    assert applied.count() == 1462
    assert applied.filter("updated").count() == 112
    unique = q("unique_insert")
    assert unique.filter("accepted").count() == 927
    assert unique.filter(~F.col("accepted")).count() == 73
    # Two keys: the sequential loop (simulated outside Spark) accepts 109.
    assert q("unique_insert_two_keys").filter("accepted").count() == 109
    # Sign-ups: nation-0 customers lack a password; of the rest all but the
    # accepted ones collide on username or e-mail.
    rejects = q("registration_rejects")
    assert rejects.count() == 1393
    assert rejects.filter(F.col("reasons") == "password required").count() == \
        table_count(q, "customer", "c_nationkey = 0")


def test_link_and_content_values(q):
    assert q("link_parse").filter("has_param").count() == 45
    assert q("content_coverage").filter("has_content").count() == 399
    assert q("content_missing").count() == 1000 - 399
