
from pyspark.sql import functions as F

import __spark_entry__ as entry
from folio.operators import changes as C
from folio.plans import change_queries as Q
from folio.plans.bindings import catalog_tables, table

SF = "/root/testdata/sf0.01"


def test_enrichment_keeps_fact_rows(spark):
    books, _, _ = catalog_tables(spark, SF)
    assert entry.queries()["catalog_enriched"](spark, SF).count() == books.count()


def test_accepted_plus_rejected_is_input(spark):
    log = Q.book_changes(table(spark, SF, "events"))
    ok, bad = C.split_changes(C.normalise_changes(log, C.BOOK))
    assert ok.count() + bad.count() == log.count()
    report = entry.queries()["validate_rows"](spark, SF)
    assert report.count() == table(spark, SF, "orders").count()


def test_unique_insert_accepts_distinct_keys_and_rejects_only_repeats(spark):
    out = entry.queries()["unique_insert"](spark, SF).join(
        table(spark, SF, "documents").select("doc_id", "text"), "doc_id")
    accepted = out.filter("accepted")
    assert accepted.select("text").distinct().count() == accepted.count()
    # Every rejected row repeats the text of an accepted row with a smaller id.
    rejected = out.filter(~F.col("accepted")).alias("r")
    a = accepted.alias("a")
    explained = rejected.join(a, (F.col("r.text") == F.col("a.text")) & (F.col("a.doc_id") < F.col("r.doc_id")),
                              "left_semi")
    assert explained.count() == rejected.count()


def test_numbers_are_exactly_one_to_n(spark):
    for name in ("admin_listing", "numbered_rows"):
        df = entry.queries()[name](spark, SF)
        n = df.count()
        row = df.agg(F.min("row_no"), F.max("row_no"), F.count_distinct("row_no")).first()
        assert tuple(row) == (1, n, n)
