"""Catalogue operators on hand-made rows (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from folio.operators import enrich as E
from folio.operators import search as S
from folio.operators import stats as A
from folio.operators.numbering import assign_ids, number_rows
from folio.sources.json_io import to_json_rows

BOOKS = "id long, title string, author_id long, category_id long, published_year int, description string, quantity int"


def books(spark, rows):
    return spark.createDataFrame(rows, BOOKS)


def test_facet(spark):
    df = books(spark, [(1, "a", 1, 2, None, None, 0), (2, "b", 1, 12, None, None, 0),
                       (3, "c", 1, None, None, None, 0)])
    assert S.facet(df, "all").count() == 3
    assert [r.id for r in S.facet(df, "2").collect()] == [1]
    assert S.facet(df, "02").count() == 0
    assert [r.id for r in S.facet(df, "null").collect()] == [3]


def test_search_gate_and_match(spark):
    df = spark.createDataFrame([(1, "xa", None), (2, "x a", None), (3, None, None)], "id long, title string, author string")
    ids = lambda q: sorted(r.id for r in S.text_search(df, q).collect())
    assert ids("") == [1, 2, 3]
    assert ids("   ") == [1, 2, 3]
    assert ids(" a") == [2]
    assert ids("A") == [1, 2]


def test_search_literals_and_case(spark):
    df = spark.createDataFrame([(1, "50% off", None), (2, "a_b", None), (3, "abc", None), (4, "đất", None)],
                               "id long, title string, author string")
    assert [r.id for r in S.text_search(df, "%").collect()] == [1]
    assert [r.id for r in S.text_search(df, "_").collect()] == [2]
    assert [r.id for r in S.text_search(df, "ĐẤT").collect()] == [4]


def test_row_text_search_defaults(spark):
    cat = spark.createDataFrame([(1, "t", None, None, None, None)],
                                "id long, title string, author string, category string, published_year int, quantity int")
    cells = E.admin_cells(number_rows(cat, "id"))
    cols = ["row_no", "title_text", "author_text", "category_text", "year_text", "quantity_shown"]
    for q in ("null", "—", "0"):
        assert S.row_text_search(cells, q, cols).count() == 1


def test_distinct_names(spark):
    df = spark.createDataFrame([("A",), ("a",), ("A",), ("",), (None,)], "author string")
    assert A.distinct_names(df, "author").count() == 2


def test_enrichment_keeps_unknown_author(spark):
    b = books(spark, [(1, "t", 99, 1, None, None, 0)])
    authors = spark.createDataFrame([(1, "x", None, None)], "id long, full_name string, bio string, birthdate date")
    cats = spark.createDataFrame([(1, "c", None)], "id long, name string, description string")
    rows = E.enrich(b, authors, cats).collect()
    assert len(rows) == 1 and rows[0].author is None and rows[0].category == "c"


def test_enrichment_rejects_duplicate_dimension_key(spark):
    b = books(spark, [(1, "t", 1, 1, None, None, 0)])
    authors = spark.createDataFrame([(1, "x", None, None), (1, "y", None, None)],
                                    "id long, full_name string, bio string, birthdate date")
    cats = spark.createDataFrame([(1, "c", None)], "id long, name string, description string")
    with pytest.raises(Exception, match="duplicate dimension key"):
        E.enrich(b, authors, cats).collect()


def test_numbering_independent_of_partitions(spark):
    for parts in (1, 3):
        df = spark.createDataFrame([(9,), (3,), (5,)], "id long").repartition(parts)
        got = {r.id: r.row_no for r in number_rows(df, "id").collect()}
        assert got == {3: 1, 5: 2, 9: 3}


def test_numbering_matches_global_window(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 100003).alias("k"), F.col("id").alias("v"))
    ours = number_rows(df, "k").select("k", "row_no")
    ref = df.select("k", F.row_number().over(Window.orderBy("k")).cast("long").alias("row_no"))
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_numbering_per_group(spark):
    df = spark.createDataFrame([("a", 5), ("a", 1), ("b", 7), ("b", 2), ("b", 9)], "g string, k int")
    got = sorted((r.g, r.k, r.row_no) for r in number_rows(df, "k", by=["g"]).collect())
    assert got == [("a", 1, 1), ("a", 5, 2), ("b", 2, 1), ("b", 7, 2), ("b", 9, 3)]


def test_assign_ids_after_max(spark):
    base = spark.createDataFrame([(4,), (10,)], "id long")
    new = spark.createDataFrame([(30, "x"), (20, "y")], "seq long, name string")
    got = {r.name: r.id for r in assign_ids(new, base, "seq").collect()}
    assert got == {"y": 11, "x": 12}


def test_json_out_keeps_nulls_sorted(spark):
    df = spark.createDataFrame([(1, None)], "id long, author string")
    assert to_json_rows(df).first()[0] == '{"author":null,"id":1}'


def test_stats(spark):
    cat = spark.createDataFrame([("A",), ("A",), (None,), ("",), ("B",)], "author string")
    cats = spark.createDataFrame([(1,), (2,)], "id long")
    row = A.catalog_stats(cat, cats).first()
    assert (row.total_books, row.distinct_authors, row.total_categories) == (5, 2, 2)


def test_content_coverage_variants(spark):
    b = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    files = spark.createDataFrame([(1,), (1,), (None,)], "content_id long")
    flags = {r.id: r.has_content for r in E.content_coverage(b, files).collect()}
    assert flags == {1: True, 2: False, 3: False}
    assert E.content_coverage(b, files, how="with").count() == 1
    assert E.content_coverage(b, files, how="without").count() == 2


def test_lookup_by_natural_key_and_empty(spark):
    users = spark.createDataFrame([("u1", "A@x.y", "admin"), ("u2", "b@x.y", "user")],
                                  "username string, email string, role string")
    assert [r.role for r in S.lookup_natural_key(users, "email", "A@x.y", ["role"]).collect()] == ["admin"]
    assert S.is_empty(S.lookup_natural_key(users, "email", "a@x.y", ["role"]))
    assert [r.role for r in S.lookup_natural_key(users, "email", "a@x.y", ["role"],
                                                 case_sensitive=False).collect()] == ["admin"]


def test_lookup_by_id_pushes_to_scan(spark, scratch):
    books(spark, [(1, "a", 1, 1, None, None, 0), (2, "b", 1, 1, None, None, 0)]).write.parquet(f"{scratch}/b")
    df = S.lookup(spark.read.parquet(f"{scratch}/b"), "id", 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,2)" in plan
    assert [r.title for r in df.collect()] == ["b"]


def test_numbering_with_clustered_keys(spark):
    from pyspark.sql import Window
    # Nearly all keys in a narrow range plus far outliers.
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 500 == 0, F.col("id") * 1_000_000_000_000).otherwise(F.col("id")).alias("k"))
    ours = number_rows(df, "k")
    ref = df.select("k", F.row_number().over(Window.orderBy("k")).cast("long").alias("row_no"))
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0
    sizes = ours.groupBy(F.floor((F.col("row_no") - 1) / 47)).count()
    assert sizes.count() > 1


def test_numbering_time_and_double_keys(spark):
    from pyspark.sql import Window
    df = spark.range(0, 500).select(
        F.timestamp_seconds(F.col("id") * 3600 + 7).alias("t"), (F.col("id") * 0.37).alias("d"))
    df = df.withColumns({"n": F.when(F.col("d") == 0, F.lit(float("nan"))).otherwise(F.col("d")),
                         "x": (F.col("d") * 100 + 5_000_000_000_000_000_000).cast("decimal(20,0)") + F.floor(F.col("d")).cast("decimal(20,0)"),
                         "s": F.concat(F.lit("k"), F.col("d").cast("string")),
                         "p": F.timestamp_seconds(F.col("d").cast("long") * 86400).cast("timestamp_ntz")})
    for key in ("t", "d", "n", "s"):
        ours = number_rows(df.select(key), key)
        ref = df.select(key, F.row_number().over(Window.orderBy(key)).cast("long").alias("row_no"))
        assert ours.exceptAll(ref).count() == 0


def test_sql_views_with_bound_parameter(spark):
    from folio.plans.bindings import catalog_tables
    from folio.plans.views import register_catalog_views
    books, authors, categories = catalog_tables(spark, "/root/testdata/sf0.001")
    register_catalog_views(spark, books, authors, categories, prefix="t_")
    rows = spark.sql("SELECT id, title FROM t_catalog WHERE id = ?", args=[12]).collect()
    assert [(r.id, r.title) for r in rows] == [(12, "Order#000000012")]
    n = spark.sql("SELECT count(*) AS n FROM t_catalog WHERE category_id = :c", args={"c": 2}).first().n
    assert n == books.filter("category_id = 2").count()


def test_numbering_edge_cases(spark):
    from pyspark.sql import Window
    empty = spark.createDataFrame([], "k long")
    assert number_rows(empty, "k").count() == 0
    nulls = spark.createDataFrame([(None,), (5,), (None,), (1,)], "k long")
    got = sorted((r.row_no, r.k) for r in number_rows(nulls, "k").collect())
    assert [k for _, k in got] == [None, None, 1, 5]
    ties = spark.range(2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    ours = number_rows(ties, "k", tie_breakers=["t"])
    ref = ties.select("k", "t", F.row_number().over(Window.orderBy("k", "t")).cast("long").alias("row_no"))
    assert ours.exceptAll(ref).count() == 0


def test_row_text_whitespace_runs(spark):
    cat = spark.createDataFrame([(1, "t", "a", "c", 2001, 3), (2, "u", None, None, None, None)],
                                "id long, title string, author string, category string, published_year int, quantity int")
    cells = E.admin_cells(number_rows(cat, "id"))
    cols = ["row_no", "title_text", "author_text", "category_text", "year_text", "quantity_shown"]
    assert S.row_text_search(cells, " " * 16, cols).count() == 2
    assert S.row_text_search(cells, " " * 17, cols).count() == 0
    # A query may start inside the indentation before a cell, but not span two cells.
    assert [r.id for r in S.row_text_search(cells, "          t\n", cols).collect()] == [1]
    assert S.row_text_search(cells, "ta", cols).count() == 0


def test_scale_conf_sizes_partitions():
    from folio.session import scale_conf
    conf = scale_conf(100 * 1024 ** 4, executors=1000, cores_per_executor=8,
                      executor_memory_bytes=64 * 1024 ** 3)
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 256 * 1024 ** 2
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 4096 * 1024 // 1024
    mid = scale_conf(1024 ** 4, executors=100, cores_per_executor=8, executor_memory_bytes=64 * 1024 ** 3)
    assert int(mid["spark.sql.shuffle.partitions"]) == 4096               # 1 TB / 256 MB
    small = scale_conf(10 * 1024 ** 3, executors=2, cores_per_executor=4, executor_memory_bytes=1024 ** 3)
    assert int(small["spark.sql.files.maxPartitionBytes"]) < 256 * 1024 ** 2
    assert int(small["spark.sql.shuffle.partitions"]) >= 8


def test_admin_row_search_matches_full_numbering(spark):
    from folio.plans.bindings import catalog_tables
    books, authors, categories = catalog_tables(spark, "/root/testdata/sf0.001")
    cat = E.enrich(books, authors, categories)
    full = E.admin_cells(number_rows(cat, "id"))
    for q in ("null", "—", " " * 16, "order#", "\n" + " " * 10 + "order", "0012", "1\n", "HIGH", "zz"):
        want = sorted(tuple(r) for r in S.row_text_search(full, q, S.ADMIN_CELLS).select("id", "row_no").collect())
        got = sorted(tuple(r) for r in S.admin_row_search(cat, q).collect())
        assert got == want, q


def test_assert_unique_and_conform(spark):
    import pytest as _pytest
    from folio.operators.joins import assert_unique
    from folio.sources.tables import CATEGORIES_SCHEMA, conform
    assert_unique(spark.createDataFrame([(1,), (2,)], "id long"), ["id"])
    with _pytest.raises(ValueError, match="not unique"):
        assert_unique(spark.createDataFrame([(1,), (1,)], "id long"), ["id"])
    raw = spark.createDataFrame([("x", 3, "n")], "description string, id int, name string")
    out = conform(raw, CATEGORIES_SCHEMA)
    assert out.columns == ["id", "name", "description"] and dict(out.dtypes)["id"] == "bigint"


def test_stats_variants_agree(spark):
    from folio.plans.bindings import catalog_tables
    books, authors, categories = catalog_tables(spark, "/root/testdata/sf0.001")
    via_join = A.catalog_stats(E.enrich(books, authors, categories), categories).first()
    via_keys = A.catalog_stats_by_keys(books, authors, categories).first()
    assert tuple(via_join) == tuple(via_keys)
    names_join = {r.author for r in A.distinct_names(E.enrich(books, authors, categories), "author").collect()}
    names_keys = {r.author for r in A.referenced_names(books, authors, "author_id", "id", "full_name", "author").collect()}
    assert names_join == names_keys


def test_numbering_decimals_beyond_double(spark):
    from pyspark.sql import Window
    df = spark.range(0, 2000).select((F.col("id") + F.lit("5000000000000000000").cast("decimal(20,0)")).cast("decimal(20,0)").alias("k"))
    ref = df.select("k", F.row_number().over(Window.orderBy("k")).cast("long").alias("row_no"))
    assert number_rows(df, "k").exceptAll(ref).count() == 0


def test_numbering_groups_with_null_names(spark):
    df = spark.createDataFrame([(None, 5), (None, 1), ("b", 7)], "g string, k int")
    got = sorted((r.g or "", r.k, r.row_no) for r in number_rows(df, "k", by=["g"]).collect())
    assert got == [("", 1, 1), ("", 5, 2), ("b", 7, 1)]


def test_facet_choices_beyond_any_id(spark):
    df = spark.createDataFrame([(1, 2), (2, None)], "id long, category_id long")
    ids = lambda choice: [r.id for r in S.facet(df, choice).collect()]
    assert ids("12345678901234567890") == [] and ids("02") == [] and ids("null") == [2] and ids("2") == [1]


def test_object_bodies_are_whole_texts(spark):
    from folio.sources.json_io import is_json_object
    texts = ['{"a":1}', ' {"a":{"b":[1]}} ', '{"a":1} trailing', '{"a":1}{"b":2}', '{"a":1},{"b":2}', "[1]", '"s"', "", "{a", None, "{}"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    good = {r.k for r in df.filter(is_json_object("t")).collect()}
    assert good == {0, 1, 10}


def test_link_queries_of_raw_texts(spark):
    from folio.functions.links import link_fields
    links = ["reader.html?id=5&title=100%", "reader.html?id=5&title=a|b", "reader.html?id=5&title=a b", "reader.html?id=5&title=a%20b+c%zz#x",
             "reader.html?title=x", "reader.html?id=&title=", "reader.html", "reader.html#?id=5", "r?xid=4&id=7&id=8"]
    df = spark.createDataFrame([(u,) for u in links], "u string")
    f = link_fields("u")
    got = [tuple(r) for r in df.select(f["link_id"], f["link_title"], f["missing_id"]).collect()]
    none = "Không có tiêu đề"
    assert got == [("5", "100%", False), ("5", "a|b", False), ("5", "a b", False), ("5", "a b c%zz", False), (None, "x", True),
                   ("", none, True), (None, none, True), (None, none, True), ("7", none, False)]


def test_publish_never_replaces_a_folder(spark, scratch):
    from folio.sources import snapshots
    root = f"{scratch}/t"
    spark.range(3).write.parquet(f"{root}/v0000000001")     # a writer that has not published yet
    assert snapshots.publish(spark.range(5), root) == 2
    assert snapshots.read_latest(spark, root).count() == 5 and spark.read.parquet(f"{root}/v0000000001").count() == 3
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        spark.range(1).write.parquet(f"{root}/v0000000003")
        snapshots.publish(spark.range(5), root, version=3)
