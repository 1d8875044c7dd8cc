"""Scale paths on skewed inputs: a key holding a third of all rows.

The small tables broadcast by default; here broadcasting is switched off so
the shuffle paths (sort-merge joins, AQE skew split) are the ones exercised,
and their results are compared with the plain answers.
"""

import contextlib
import json

from pyspark.sql import functions as F

from folio.operators import changes as C
from folio.operators import enrich as E
from folio.operators import stats as A
from folio.operators.numbering import number_rows
from folio.operators.unique import unique_insert

N = 6000


@contextlib.contextmanager
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "folio.broadcast.maxRows": "0"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def skewed_books(spark):
    # author 1 holds a third of the books; the rest spread over 500 authors.
    return spark.range(N).select(
        F.col("id"), F.format_string("Book %d", "id").alias("title"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500 + 2).cast("long").alias("author_id"),
        (F.col("id") % 4).cast("long").alias("category_id"),
        F.lit(2000).alias("published_year"), F.lit("d").alias("description"), F.lit(1).alias("quantity"))


def test_enrichment_without_broadcast_on_hot_key(spark):
    books = skewed_books(spark)
    authors = spark.range(1, 600).select(F.col("id"), F.format_string("A%d", "id").alias("full_name"),
                                         F.lit(None).cast("string").alias("bio"),
                                         F.lit(None).cast("date").alias("birthdate"))
    cats = spark.range(0, 3).select(F.col("id"), F.format_string("C%d", "id").alias("name"),
                                    F.lit(None).cast("string").alias("description"))
    with no_broadcast(spark):
        out = E.enrich(books, authors, cats)
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = out.collect()
    assert "BroadcastHashJoin" not in plan
    assert len(rows) == N
    assert sum(1 for r in rows if r.author == "A1") == N // 3
    assert sum(1 for r in rows if r.category is None) == N // 4


def test_distinct_authors_on_hot_name(spark):
    books = skewed_books(spark).select(F.format_string("A%d", "author_id").alias("author"))
    cats = spark.range(3)
    row = A.catalog_stats(books, cats).first()
    assert (row.total_books, row.distinct_authors, row.total_categories) == (N, 501, 3)


def test_unique_insert_on_hot_key(spark):
    req = spark.range(N).select(F.col("id").alias("seq"),
                                F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
                                    F.format_string("k%d", F.col("id") % 1000)).alias("key"))
    with no_broadcast(spark):
        out = unique_insert(req, "key", "seq", digest=True)
        accepted = {r.seq for r in out.filter("accepted").collect()}
    firsts = {}
    for r in req.collect():
        firsts.setdefault(r.key, r.seq)
    assert accepted == set(firsts.values())


def test_fold_with_hot_id(spark):
    base = spark.range(1, 101).select(F.col("id"), F.format_string("n%d", "id").alias("full_name"),
                                      F.lit(None).cast("string").alias("bio"),
                                      F.lit(None).cast("date").alias("birthdate"))
    # A third of the log updates id 7; the last one wins.
    log = spark.range(N).select(
        F.col("id").alias("seq"), F.lit("author").alias("entity"), F.lit("update").alias("op"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 100 + 1).cast("long").alias("id"),
        F.concat(F.lit('{"full_name": "v'), F.col("id").cast("string"), F.lit('"}')).alias("body"))
    with no_broadcast(spark):
        ok, bad = C.split_changes(C.normalise_changes(log, C.AUTHOR))
        out = {r.id: r.full_name for r in C.apply_changes(base, ok, C.AUTHOR).collect()}
    assert bad.count() == 0
    last = {}
    for r in log.collect():
        last[r.id] = json.loads(r.body)["full_name"]
    assert out == last


def test_numbering_runs_no_full_single_partition_sort(spark):
    df = spark.range(N).select((F.col("id") * 7 % N).alias("k"))
    out = number_rows(df, "k")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # The only single-partition exchange is the one over the counts per partition.
    assert plan.count("SinglePartition") <= 1
    assert sorted(r.row_no for r in out.collect()) == list(range(1, N + 1))


def test_numbering_splits_a_hot_tied_key(spark):
    # Key 5 holds a third of the rows (ties in any order).
    df = spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") + 10).alias("k"),
                               F.col("id").alias("payload"))
    out = number_rows(df, "k")
    assert sorted(r.row_no for r in out.collect()) == list(range(1, N + 1))
    # Every key occupies exactly the rank range it has in the sorted order.
    ranges = {r.k: (r.lo, r.hi) for r in out.groupBy("k").agg(F.min("row_no").alias("lo"),
                                                             F.max("row_no").alias("hi")).collect()}
    assert ranges[5] == (1, N // 3)
    assert ranges[11] == (N // 3 + 1, N // 3 + 1)


def test_bucketed_tables_join_without_shuffle(spark, scratch):
    from folio.sources.tables import save_bucketed
    name = f"t{abs(hash(scratch)) % 10**8}"
    books = save_bucketed(skewed_books(spark), f"{name}_books", "author_id", 8, f"{scratch}/books")
    authors = save_bucketed(
        spark.range(1, 600).select(F.col("id"), F.format_string("A%d", "id").alias("full_name"),
                                   F.lit(None).cast("string").alias("bio"),
                                   F.lit(None).cast("date").alias("birthdate")),
        f"{name}_authors", "id", 8, f"{scratch}/authors")
    cats = spark.range(0, 3).select(F.col("id"), F.format_string("C%d", "id").alias("name"),
                                    F.lit(None).cast("string").alias("description"))
    with no_broadcast(spark):
        out = E.enrich(books, authors, cats).select("id", "author")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == N
    # The author join and the authors' uniqueness aggregate read the
    # bucketing: no exchange on author ids anywhere in the plan.
    assert "SortMergeJoin" in plan
    assert "hashpartitioning(author_id" not in plan and "hashpartitioning(_author_key" not in plan


def test_broadcast_follows_the_row_count(spark):
    books = skewed_books(spark)
    authors = spark.range(1, 600).select(F.col("id"), F.format_string("A%d", "id").alias("full_name"),
                                         F.lit(None).cast("string").alias("bio"),
                                         F.lit(None).cast("date").alias("birthdate"))
    cats = spark.range(0, 3).select(F.col("id"), F.format_string("C%d", "id").alias("name"),
                                    F.lit(None).cast("string").alias("description"))
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        # 599 authors and 3 categories fit under 1,000 rows: both broadcast.
        small = E.enrich(books, authors, cats, broadcast_max_rows=1000)
        plan = small._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 2
        # Under 100 rows only the categories fit; authors are sort-merge joined.
        mixed = E.enrich(books, authors, cats, broadcast_max_rows=100)
        plan = mixed._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" in plan
        assert mixed.count() == small.count() == N
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_texts_do_not_travel_with_unique_inserts(spark):
    from folio.operators.unique import unique_insert
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    with no_broadcast(spark):
        out = unique_insert(docs, "text", "doc_id", existing=docs.filter("doc_id < 20"), digest=True).select("doc_id", "accepted", "reason")
        plan = out._jdf.queryExecution().optimizedPlan().toString()
    # Under every join and aggregate the text is reduced to its digest.
    import re
    for block in plan.split("Join")[1:]:
        assert not re.search(r"(Project|Aggregate) \[[^\]]*(?<![a-z_(])text#\d+(?=[,\]])", block), plan


def test_bodies_are_parsed_once(spark):
    from folio.plans import change_queries as Q
    sf = "/root/testdata/sf0.001"
    for fn, branches in ((Q.normalise_changes, 1), (Q.change_rejects, 2), (Q.mixed_log_rejects, 2)):
        plan = fn(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == branches, plan
