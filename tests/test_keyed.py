"""Stored tables that a change rewrites in part, and what is kept on them."""

import random

import pytest
from pyspark.sql import functions as F

from folio.operators import changes as C
from folio.operators import current as K
from folio.operators.enrich import enrich
from folio.sources import keyed
from folio.sources.keyed import Layout

BOOKS = "id long, title string, author_id long, category_id long, published_year int, description string, quantity int"
ACCEPTED = "seq long, op string, id long, title string, author_id long, category_id long, published_year int, description string, quantity int"
LAYOUTS = [Layout("span", 50), Layout("hash", 16), Layout("hash", 1)]


def books(spark, n, step=1):
    return spark.range(0, n * step, step).select(
        "id", F.concat(F.lit("book "), F.col("id").cast("string")).alias("title"), (F.col("id") % 17).alias("author_id"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 5).alias("category_id"), F.lit(None).cast("int").alias("published_year"),
        F.lit("d").alias("description"), F.lit(1).alias("quantity"))


def random_log(seed, n, top):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        op = rng.choice(["insert", "update", "update", "delete"])
        target = None if op == "insert" else rng.choice([rng.randrange(top), rng.randrange(top + 40), -5, 10**12])
        values = (None,) * 6 if op == "delete" else (f"{op} {seq}", rng.randrange(20), None, 2000, None, seq)
        rows.append((seq, op, target, *values))
    return rows


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
def test_same_rows_as_the_fold_of_the_whole_table(spark, scratch, layout):
    base = books(spark, 400)
    keyed.create(base, scratch, layout)
    expected = base
    for seed in range(2 if layout.size > 16 else 1):
        log = spark.createDataFrame(random_log(seed, 40, 60), ACCEPTED)
        top = expected.agg(F.max("id")).first()[0] if seed == 0 else keyed.version(spark, scratch).max_key
        expected = C.apply_changes(expected, log, C.BOOK, start_after=top).checkpoint()
        keyed.apply_log(spark, scratch, log, C.BOOK)
        assert plain(keyed.read(spark, scratch)) == plain(expected)
    # Earlier versions stay readable.
    assert plain(keyed.read(spark, scratch, 1)) == plain(base)


def test_one_percent_of_keys_rewrites_their_folders_only(spark, scratch):
    base = books(spark, 10_000)
    first = keyed.create(base, scratch, Layout("span", 100))
    assert len(first.parts) == 100 and first.rows == 10_000
    # 100 keys in three stretches, beside requests that match no row.
    ids = [*range(250, 290), *range(4000, 4040), *range(9980, 10_000)]
    log = [(k, "update", i, "new", 1, 1, None, None, 0) for k, i in enumerate(ids)]
    log += [(500, "delete", -7, *(None,) * 6), (501, "update", 77_777, "none", 1, 1, None, None, 0)]
    last = keyed.apply_log(spark, scratch, spark.createDataFrame(log, ACCEPTED), C.BOOK)
    assert last.changed_since(first) == [2, 40, 99]
    parts = {part for part, _ in last.parts.values()}
    written = [p for p in parts if p != first.parts[0][0]]
    assert len(written) == 1
    assert spark.read.parquet(f"{scratch}/{written[0]}").count() == 300
    assert keyed.read(spark, scratch).filter("title = 'new'").count() == 100


def test_hash_folders_and_keys_that_do_not_exist(spark, scratch):
    first = keyed.create(books(spark, 2000), scratch, Layout("hash", 64))
    folder = {r["id"]: r["f"] for r in keyed.read(spark, scratch).select("id", first.layout.folder(F.col("id")).alias("f")).collect()}
    log = [(0, "update", 5, "x", 1, 1, None, None, 0), (1, "delete", 1234, *(None,) * 6), (2, "delete", 999_999, *(None,) * 6)]
    last = keyed.apply_log(spark, scratch, spark.createDataFrame(log, ACCEPTED), C.BOOK)
    assert last.changed_since(first) == sorted({folder[5], folder[1234]})
    none = keyed.apply_log(spark, scratch, spark.createDataFrame([(0, "delete", 999_999, *(None,) * 6)], ACCEPTED), C.BOOK)
    assert none.changed_since(last) == [] and none.number == 3


def test_inserts_open_new_folders(spark, scratch):
    first = keyed.create(books(spark, 1000), scratch, Layout("span", 100))
    log = [(k, "insert", None, f"n{k}", 1, 1, None, None, 0) for k in range(250)]
    last = keyed.apply_log(spark, scratch, spark.createDataFrame(log, ACCEPTED), C.BOOK)
    assert last.changed_since(first) == [10, 11, 12] and last.max_key == 1249
    # Ids of rows deleted at the end are not given again.
    gone = [(k, "delete", i, *(None,) * 6) for k, i in enumerate(range(1200, 1250))] + [(900, "insert", None, "late", 1, 1, None, None, 0)]
    after = keyed.apply_log(spark, scratch, spark.createDataFrame(gone, ACCEPTED), C.BOOK)
    assert [r["id"] for r in keyed.read(spark, scratch).filter("title = 'late'").collect()] == [1250]
    assert after.changed_since(last) == [12]


def test_folders_emptied_and_empty_tables(spark, scratch):
    keyed.create(books(spark, 100), scratch, Layout("span", 50))
    log = [(i, "delete", i, *(None,) * 6) for i in range(50)]
    last = keyed.apply_log(spark, scratch, spark.createDataFrame(log, ACCEPTED), C.BOOK)
    assert list(last.parts) == [1] and keyed.read(spark, scratch).count() == 50
    other = f"{scratch}-empty"
    keyed.create(books(spark, 0), other, Layout("span", 50))
    assert keyed.read(spark, other).count() == 0 and keyed.row_count(spark, other).first()[0] == 0
    keyed.apply_log(spark, other, spark.createDataFrame([(0, "insert", None, "a", 1, 1, None, None, 0), (1, "delete", 9, *(None,) * 6)], ACCEPTED), C.BOOK)
    assert [(r["id"], r["title"]) for r in keyed.read(spark, other).collect()] == [(1, "a")]


def test_bad_tables_and_failed_writes(spark, scratch):
    with pytest.raises(Exception, match="null key id"):
        keyed.create(books(spark, 5).withColumn("id", F.nullif("id", F.lit(3))), f"{scratch}-null", Layout("hash", 4))
    with pytest.raises(ValueError, match="not unique"):
        keyed.create(books(spark, 5).unionByName(books(spark, 1)), f"{scratch}-twice", Layout("hash", 4))
    for root in (f"{scratch}-null", f"{scratch}-twice"):
        with pytest.raises(FileNotFoundError):
            keyed.read(spark, root)
    with pytest.raises(ValueError):
        Layout("list", 3)
    keyed.create(books(spark, 100), scratch, Layout("span", 50))
    broken = books(spark, 1).withColumn("title", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        keyed.merge(spark, scratch, broken)
    assert keyed.version(spark, scratch).number == 1 and plain(keyed.read(spark, scratch)) == plain(books(spark, 100))


def test_lookup_opens_one_folder_and_skips_row_groups(spark, scratch):
    rows = books(spark, 5000).withColumn("email", F.concat(F.lit("u"), F.xxhash64("id").cast("string"), F.lit("@x.org")))
    v = keyed.create(rows, scratch, Layout("span", 500), bloom=("email",))
    found = keyed.read_keys(spark, scratch, [1234, None, 999_999, -3])
    assert [r["id"] for r in found.collect()] == [1234]
    assert all(f"/{keyed.FOLDER}=2/" in f for f in found.inputFiles()) and found.inputFiles()
    plan = found._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [" in plan and "1234" in plan.split("PushedFilters")[1].splitlines()[0]
    assert keyed.read_keys(spark, scratch, []).count() == 0
    # Files are sorted by key, so their row groups hold disjoint ranges.
    import glob

    import pyarrow.parquet as pq
    for path in glob.glob(f"{scratch}/{v.parts[0][0]}/*/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        stats = [meta.row_group(k).column(0).statistics for k in range(meta.num_row_groups)]
        assert all(a.max < b.min for a, b in zip(stats, stats[1:]))


def rows_scanned(df):
    """Rows that leave the scan when ``df`` is run (skipped row groups do not)."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_bloom_filters_skip_row_groups_of_a_natural_key(spark, scratch):
    """e-mails are in no order, so ranges skip nothing; Bloom filters leave
    the row group that holds the e-mail (and a false hit now and then)."""
    from folio.operators.users import role_of
    users = books(spark, 5000).select("id", F.concat(F.lit("u"), F.xxhash64("id").cast("string"), F.lit("@x.org")).alias("email"),
                                      F.when(F.col("id") == 4321, F.lit("admin")).otherwise(F.lit("user")).alias("role"))
    target = users.filter("id = 4321").first()["email"]
    for bloom, most in ((("email",), 1500), ((), 5000)):
        root = f"{scratch}-{len(bloom)}"
        keyed.create(users, root, Layout("span", 500), bloom=bloom)
        table = keyed.read(spark, root)
        assert [r["role"] for r in role_of(table, target).collect()] == ["admin"]
        scanned = rows_scanned(table.filter(F.col("email") == target))
        assert scanned <= most and (bloom or scanned > 4000)
        assert rows_scanned(table.filter(F.col("email") == "u-nobody@x.org")) <= most


def test_differences_and_their_application(spark, scratch):
    base = books(spark, 600)
    copy = f"{scratch}-copy"
    keyed.create(base, scratch, Layout("span", 64))
    keyed.create(base, copy, Layout("hash", 8))
    # An update that changes nothing is no difference, though its folder is written.
    same = [(1000, "update", 400, "book 400", 400 % 17, None, None, "d", 1)]
    keyed.apply_log(spark, scratch, spark.createDataFrame(random_log(8, 60, 300) + same, ACCEPTED), C.BOOK)
    found = keyed.differences(spark, scratch, 1, 2)
    before = {r["id"]: r for r in base.collect()}
    after = {r["id"]: r for r in keyed.read(spark, scratch).collect()}
    want = {i: ("insert" if i not in before else "delete" if i not in after else "update")
            for i in before.keys() | after.keys() if before.get(i) != after.get(i)}
    assert {r["id"]: r["change"] for r in found.collect()} == want and 400 not in want
    for r in found.collect():
        assert r["before"] == before.get(r["id"]) and r["after"] == after.get(r["id"])
    keyed.apply_differences(spark, copy, found)
    assert plain(keyed.read(spark, copy)) == plain(keyed.read(spark, scratch))
    assert keyed.differences(spark, scratch, 2, 2).count() == 0
    # Back again.
    back = keyed.differences(spark, scratch, 2, 1)
    keyed.apply_differences(spark, copy, back)
    assert plain(keyed.read(spark, copy)) == plain(base)


def test_differences_read_changed_folders_only(spark, scratch):
    keyed.create(books(spark, 1000), scratch, Layout("span", 100))
    keyed.apply_log(spark, scratch, spark.createDataFrame([(0, "delete", 321, *(None,) * 6)], ACCEPTED), C.BOOK)
    files = keyed.differences(spark, scratch, 1, 2).inputFiles()
    assert files and all(f"/{keyed.FOLDER}=3/" in f for f in files)


def test_text_keys(spark, scratch):
    rows = spark.createDataFrame([(f"k{i}", i) for i in range(200)], "name string, n long")
    keyed.create(rows, scratch, Layout("hash", 8, "name"))
    keyed.merge(spark, scratch, spark.createDataFrame([("k3", -1), ("new", 5)], "name string, n long"),
                spark.createDataFrame([("k4",), ("k3",), ("none",)], "name string"))
    got = {r["name"]: r["n"] for r in keyed.read(spark, scratch).collect()}
    assert got == {**{f"k{i}": i for i in range(200) if i != 4}, "k3": -1, "new": 5}
    assert keyed.version(spark, scratch).max_key is None


AUTHORS = "id long, full_name string, bio string, birthdate date"


def test_counts_and_view_through_random_changes(spark, scratch):
    """Several logs one after another; references, names and the view equal a
    full recount each time.  Names are shared, empty and null."""
    rng = random.Random(12)
    authors = spark.createDataFrame([(i, rng.choice(["Ann", "Bob", "", None, f"A{i}"]), None, None) for i in range(20)], AUTHORS)
    categories = spark.createDataFrame([(1, "one"), (2, "two")], "id long, name string")
    roots = {n: f"{scratch}-{n}" for n in ("books", "authors", "refs", "names", "view")}
    base = books(spark, 300)
    keyed.create(base, roots["books"], Layout("span", 40))
    keyed.create(authors, roots["authors"], Layout("hash", 4))
    keyed.create(K.counted(base, "author_id", "author_id"), roots["refs"], Layout("span", 10, "author_id"))
    keyed.create(K.catalog_names(base, authors), roots["names"], Layout("hash", 4, "name"))
    keyed.create(enrich(base, authors, categories), roots["view"], Layout("span", 40))
    for step in (1, 2):
        keyed.apply_log(spark, roots["books"], spark.createDataFrame(random_log(20 + step, 30, 200), ACCEPTED), C.BOOK)
        log = [(k, *rng.choice([("update", rng.randrange(25), rng.choice(["Ann", "Cy", "", None])), ("delete", rng.randrange(25), None),
                                ("insert", None, "Dee")]), None, None) for k in range(4)]
        keyed.apply_log(spark, roots["authors"], spark.createDataFrame(log, "seq long, op string, id long, full_name string, bio string, birthdate date"),
                        C.AUTHOR)
        moved = (step, step + 1)
        K.keep_counts(spark, roots["books"], roots["authors"], roots["refs"], roots["names"], moved, moved)
        K.refresh_view(spark, roots["view"], roots["books"], roots["authors"], categories, moved, moved)
        now, people = keyed.read(spark, roots["books"]), keyed.read(spark, roots["authors"])
        assert plain(keyed.read(spark, roots["refs"])) == plain(K.counted(now, "author_id", "author_id"))
        assert plain(keyed.read(spark, roots["names"])) == plain(K.catalog_names(now, people))
        assert plain(keyed.read(spark, roots["view"])) == plain(enrich(now, people, categories))


def test_view_rewrites_folders_of_the_changed_author_only(spark, scratch):
    base = books(spark, 400).withColumn("author_id", F.floor(F.col("id") / 40))
    authors = spark.createDataFrame([(i, f"A{i}", None, None) for i in range(10)], AUTHORS)
    categories = spark.createDataFrame([(1, "one"), (2, "two"), (3, "x"), (4, "y")], "id long, name string")
    roots = {n: f"{scratch}-{n}" for n in ("books", "authors", "view")}
    keyed.create(base, roots["books"], Layout("span", 40))
    keyed.create(authors, roots["authors"], Layout("hash", 4))
    first = keyed.create(enrich(base, authors, categories), roots["view"], Layout("span", 40))
    keyed.merge(spark, roots["books"])
    keyed.merge(spark, roots["authors"], spark.createDataFrame([(7, "Z", None, None)], AUTHORS))
    last = K.refresh_view(spark, roots["view"], roots["books"], roots["authors"], categories, (1, 2), (1, 2))
    assert last.changed_since(first) == [7]
    assert {r["author"] for r in keyed.read_keys(spark, roots["view"], [281, 319, 320]).collect()} == {"Z", "A8"}
    # A changed category concerns its books in every folder that has some.
    renamed = spark.createDataFrame([(1, "uno"), (2, "two"), (3, "x"), (4, "y")], "id long, name string")
    third = K.refresh_view(spark, roots["view"], roots["books"], roots["authors"], renamed, (2, 2), (2, 2),
                           spark.createDataFrame([(1,)], "id long"))
    assert len(third.changed_since(last)) == 10
    assert keyed.read(spark, roots["view"]).filter("category = 'uno'").count() == base.filter("category_id = 1").count()


def test_counts_that_do_not_fit_are_refused(spark, scratch):
    keyed.create(spark.createDataFrame([("a", 2)], "name string, n long"), scratch, Layout("hash", 2, "name"))
    with pytest.raises(Exception, match="count below 0 for name=a"):
        K.add_counts(spark, scratch, spark.createDataFrame([("a", -3)], "name string, n long"))
    K.add_counts(spark, scratch, spark.createDataFrame([("a", -2), ("b", 4)], "name string, n long"))
    assert plain(keyed.read(spark, scratch)) == [("b", 4)]


def directories(scratch, v):
    import glob
    return {part: len(glob.glob(f"{scratch}/{part}/{keyed.FOLDER}=*")) for part in {part for part, _ in v.parts.values()}}


def test_many_folders_are_few_directories(spark, scratch):
    """Directories grow with the rows, not with the folders; folders that
    share one are still rewritten, compared and read one by one."""
    base = books(spark, 2800, step=3).withColumn("id", F.col("id") - 900)
    first = keyed.create(base, scratch, Layout("span", 4))
    assert len(first.parts) > 600 and first.bundle > 10
    assert all(n <= 2 * keyed.FEW_DIRECTORIES for n in directories(scratch, first).values())
    wanted = [-900, -897, 0, 3, 2403, 6000, 6300]
    log = [(k, "update", i, "new", 1, 1, None, None, 0) for k, i in enumerate(wanted)]
    log += [(100 + k, "delete", i, *(None,) * 6) for k, i in enumerate([9, 12, 15, 7000])]
    log += [(200 + k, "insert", None, f"n{k}", 1, 1, None, None, 0) for k in range(40)]
    frame = spark.createDataFrame(log, ACCEPTED)
    last = keyed.apply_log(spark, scratch, frame, C.BOOK)
    now = C.apply_changes(base, frame, C.BOOK, start_after=first.max_key).checkpoint()
    assert plain(keyed.read(spark, scratch)) == plain(now) and plain(keyed.read(spark, scratch, 1)) == plain(base)
    assert len(last.changed_since(first)) < 120
    before, after = {r["id"]: r for r in base.collect()}, {r["id"]: r for r in now.collect()}
    found = {r["id"] for r in keyed.differences(spark, scratch, 1, 2).collect()}
    assert found == {i for i in before.keys() | after.keys() if before.get(i) != after.get(i)}
    assert sorted(r["id"] for r in keyed.read_keys(spark, scratch, [-897, 9, 2403, 10**9]).collect()) == [-897, 2403]
    # Every other key, so that ranges of folders would be many.
    keys = base.filter("id % 2 = 0").select("id")
    third = keyed.merge(spark, scratch, deleted=keys)
    assert plain(keyed.read(spark, scratch)) == plain(now.join(keys, "id", "left_anti").select(now.columns))
    assert sum(directories(scratch, third).values()) <= 6 * keyed.FEW_DIRECTORIES


def test_a_folder_emptied_in_a_shared_directory(spark, scratch):
    keyed.create(books(spark, 400), scratch, Layout("span", 2))
    gone = [(i, "delete", i, *(None,) * 6) for i in (10, 11, 20)]
    last = keyed.apply_log(spark, scratch, spark.createDataFrame(gone, ACCEPTED), C.BOOK)
    assert last.bundle > 1 and 5 not in last.parts and last.parts[10][1] == 1
    assert sorted(r["id"] for r in keyed.read(spark, scratch).collect()) == [i for i in range(400) if i not in (10, 11, 20)]
    assert keyed.row_count(spark, scratch).first()[0] == 397
    with pytest.raises(ValueError, match="not unique"):
        keyed.create(books(spark, 400).unionByName(books(spark, 1)), f"{scratch}-twice", Layout("span", 2))
