"""Queries over stored, versioned tables and what is kept current on them.

Stand-ins: books and authors are the catalogue's (``bindings``), stored by
spans of ids in the session's shared folder; the changes are requests derived
from events (``shelf_log``) and the author changes of ``change_queries``.
Users are a hundredth of the orders, so the log changes about a hundredth of
the books, and the folders that hold none of them must not be written again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions import values as V
from folio.operators import changes as C
from folio.operators import current as K
from folio.operators.enrich import enrich
from folio.plans.bindings import BOOKS_SQL, CATEGORIES_SQL, books_from_orders, categories_from_orders, table
from folio.plans.change_queries import (
    _AUTHOR_FIELDS, _AUTHOR_LOG, _AUTHOR_REQUIRED, _AUTHORS_ALL, LOOKUP_EMAIL, _normalised_sql, author_changes, authors_all,
)
from folio.session import shared_checkpoint_dir
from folio.sources import gram_index, keyed

SEARCHES = ("ÜE", "Thtieding", "HEANESEN", "src1", "no such text", "tion the th")
SPAN = 512                  # ids per folder
STRIDE = 7                  # requests name every 7th id


def _root(spark, name: str) -> str:
    return f"{shared_checkpoint_dir(spark)}/folio-tables/{name}-{uuid.uuid4().hex}"


def shelf_log(events: DataFrame) -> DataFrame:
    """Requests on books, in event order: a purchase inserts, a view replaces
    the book STRIDE * user_id, an error of value over 200 deletes it, a click
    replaces a book that does not exist; signups are no requests."""
    et, eid, uid = F.col("event_type"), F.col("event_id"), F.col("user_id")
    body = F.to_json(F.struct(
        F.concat(et, F.lit(" "), eid.cast("string")).alias("title"), (uid * 3).alias("author_id"), (1 + eid % 5).alias("category_id"),
        F.when(et == "view", 1990 + eid % 30).alias("published_year"), (eid % 7).alias("quantity")), {"ignoreNullFields": "true"})
    is_delete = (et == "error") & (F.col("value") > 200)
    return events.filter(is_delete | et.isin("purchase", "view", "click")).select(
        eid.alias("seq"), F.lit("book").alias("entity"),
        F.when(is_delete, F.lit("delete")).when(et == "purchase", F.lit("insert")).otherwise(F.lit("update")).alias("op"),
        F.when(et == "click", -1 - uid).when(et != "purchase", uid * STRIDE).cast("bigint").alias("id"),
        F.when(~is_delete, body).alias("body"))


def _accepted(log: DataFrame, spec: C.EntitySpec) -> DataFrame:
    ok, _ = C.split_changes(C.normalise_changes(log, spec).checkpoint())
    return ok


def _stored_books(spark, sf_dir) -> tuple[str, keyed.Version, keyed.Version]:
    """Books stored and then changed by the log: root and both versions."""
    root = _root(spark, "books")
    books = books_from_orders(table(spark, sf_dir, "orders")).select(*C.BOOK.table_columns)
    first = keyed.create(books, root, keyed.Layout("span", SPAN))
    return root, first, keyed.apply_log(spark, root, _accepted(shelf_log(table(spark, sf_dir, "events")), C.BOOK), C.BOOK)


def _stored_authors(spark, sf_dir) -> tuple[str, keyed.Version, keyed.Version]:
    root = _root(spark, "authors")
    first = keyed.create(authors_all(table(spark, sf_dir, "customer")).select(*C.AUTHOR.table_columns), root, keyed.Layout("hash", 16))
    return root, first, keyed.apply_log(spark, root, _accepted(author_changes(table(spark, sf_dir, "events")), C.AUTHOR), C.AUTHOR)


def stored_apply_log(spark, sf_dir):
    """D4 + S5: a log folded into a stored table; every book afterwards, and
    whether its folder was written anew."""
    root, first, last = _stored_books(spark, sf_dir)
    anew = spark.createDataFrame([(f,) for f in last.changed_since(first)], "_f bigint")
    books = keyed.read(spark, root).withColumn("_at", last.layout.folder(F.col("id")))
    flagged = books.join(F.broadcast(anew.withColumn("_anew", F.lit(True))), F.col("_at") == F.col("_f"), "left")
    return flagged.select(*C.BOOK.table_columns, F.coalesce("_anew", F.lit(False)).alias("rewritten"))


def version_differences(spark, sf_dir):
    """The books that differ between two published versions."""
    root, first, last = _stored_books(spark, sf_dir)
    found = keyed.differences(spark, root, first.number, last.number)
    sides = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("before", "after") for c in ("title", "author_id", "published_year", "quantity")]
    return found.select("id", "change", *sides)


def _kept_counts(spark, sf_dir) -> tuple[str, str]:
    """Roots of books and names, the counts brought through both logs."""
    books, b1, b2 = _stored_books(spark, sf_dir)
    authors, a1, a2 = _stored_authors(spark, sf_dir)
    refs, names = _root(spark, "refs"), _root(spark, "names")
    old_books, old_authors = keyed.read(spark, books, b1.number), keyed.read(spark, authors, a1.number)
    keyed.create(K.counted(old_books, "author_id", "author_id").checkpoint(), refs, keyed.Layout("span", SPAN, "author_id"))
    keyed.create(K.catalog_names(old_books, old_authors), names, keyed.Layout("hash", 16, "name"))
    K.keep_counts(spark, books, authors, refs, names, (b1.number, b2.number), (a1.number, a2.number))
    return books, names


def names_kept_current(spark, sf_dir):
    """U2 + A3: the names the catalogue shows and the books that show them,
    kept through changes of books and of authors."""
    _, names = _kept_counts(spark, sf_dir)
    return keyed.read(spark, names)


def stats_kept_current(spark, sf_dir):
    """A2 + A3: the reader's counts after the changes, from the counts that
    the stored versions keep."""
    books, names = _kept_counts(spark, sf_dir)
    tagged = keyed.row_count(spark, books).select(F.lit("b").alias("of"), "rows").unionByName(
        keyed.row_count(spark, names).select(F.lit("n").alias("of"), "rows")).unionByName(
        categories_from_orders(table(spark, sf_dir, "orders")).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("c").alias("of"), "rows"))
    return tagged.agg(*[F.sum(F.when(F.col("of") == of, F.col("rows"))).alias(name)
                        for of, name in (("b", "total_books"), ("n", "distinct_authors"), ("c", "total_categories"))])


def view_kept_current(spark, sf_dir):
    """The stored catalogue view after changes of books and of authors."""
    books, b1, b2 = _stored_books(spark, sf_dir)
    authors, a1, a2 = _stored_authors(spark, sf_dir)
    categories = categories_from_orders(table(spark, sf_dir, "orders"))
    view = _root(spark, "view")
    keyed.create(enrich(keyed.read(spark, books, b1.number), keyed.read(spark, authors, a1.number), categories), view, keyed.Layout("span", SPAN),
                 bundle=b1.bundle)
    K.refresh_view(spark, view, books, authors, categories, (b1.number, b2.number), (a1.number, a2.number))
    return keyed.read(spark, view)


def stored_authors_after(spark, sf_dir):
    """D2 + D3 + S5 on a table dealt by a hash of its key."""
    root, _, _ = _stored_authors(spark, sf_dir)
    return keyed.read(spark, root).withColumn("birthdate", V.date_text("birthdate"))


def indexed_search(spark, sf_dir):
    """F5 through the trigram index: the documents that several searches find
    in their whole texts or sources."""
    root, index = _root(spark, "documents"), _root(spark, "grams")
    keyed.create(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), root, keyed.Layout("span", SPAN, "doc_id"))
    gram_index.build(spark, root, ["text", "source"], index, folders=16)
    out = None
    for query in SEARCHES:
        found = gram_index.search(spark, root, index, query, ("text", "source")).select(F.lit(query).alias("query"), "doc_id")
        out = found if out is None else out.unionByName(found)
    return out


def stored_role_lookup(spark, sf_dir):
    """the role of the user with an e-mail, from users stored by key with
    Bloom filters on the e-mails."""
    from folio.operators.users import role_of
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.lower(F.concat(F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@example.org"))).alias("email"),
        F.when(F.col("c_acctbal") > 5000, F.lit("admin")).otherwise(F.lit("user")).alias("role"))
    root = _root(spark, "users")
    keyed.create(users, root, keyed.Layout("span", SPAN), bloom=("email",))
    return role_of(keyed.read(spark, root), LOOKUP_EMAIL)


QUERIES = {
    "stored_role_lookup": stored_role_lookup,
    "indexed_search": indexed_search,
    "stored_apply_log": stored_apply_log,
    "stored_authors_after": stored_authors_after,
    "version_differences": version_differences,
    "names_kept_current": names_kept_current,
    "stats_kept_current": stats_kept_current,
    "view_kept_current": view_kept_current,
}


# ---------------------------------------------------------------------------
# DuckDB oracle text: the logs told request by request, everything recounted.
# ---------------------------------------------------------------------------
_SHELF = f"""
books AS ({BOOKS_SQL}),
log AS (SELECT event_id AS seq, CASE event_type WHEN 'purchase' THEN 'insert' WHEN 'view' THEN 'update' ELSE 'delete' END AS op,
          CASE WHEN event_type <> 'purchase' THEN user_id * {STRIDE} END AS id, event_type || ' ' || event_id AS title,
          user_id * 3 AS author_id, 1 + event_id % 5 AS category_id,
          CASE WHEN event_type = 'view' THEN CAST(1990 + event_id % 30 AS INTEGER) END AS published_year, CAST(event_id % 7 AS INTEGER) AS quantity
        FROM events WHERE event_type IN ('purchase', 'view') OR event_type = 'error' AND value > 200),
started AS (SELECT *, -1 AS created FROM books
  UNION ALL SELECT (SELECT max(id) FROM books) + row_number() OVER (ORDER BY seq), title, author_id, category_id, published_year, NULL, quantity, seq
  FROM log WHERE op = 'insert'),
last_word AS (SELECT * FROM (SELECT l.*, s.id AS at, row_number() OVER (PARTITION BY s.id ORDER BY l.seq DESC) AS k
  FROM started s JOIN log l ON l.id = s.id AND l.seq > s.created AND l.op = 'update') WHERE k = 1),
books2 AS (SELECT s.id, coalesce(u.title, s.title) AS title,
    CASE WHEN u.at IS NULL THEN s.author_id ELSE u.author_id END AS author_id,
    CASE WHEN u.at IS NULL THEN s.category_id ELSE u.category_id END AS category_id,
    CASE WHEN u.at IS NULL THEN s.published_year ELSE u.published_year END AS published_year,
    CASE WHEN u.at IS NULL THEN s.description END AS description,
    CASE WHEN u.at IS NULL THEN s.quantity ELSE u.quantity END AS quantity
  FROM started s LEFT JOIN last_word u ON u.at = s.id
  WHERE NOT EXISTS (SELECT 1 FROM log d WHERE d.op = 'delete' AND d.id = s.id AND d.seq > s.created))
"""

_AUTHORS2 = _AUTHORS_ALL + ", " + _AUTHOR_LOG + ", norm AS (" + _normalised_sql("author_log", _AUTHOR_REQUIRED, _AUTHOR_FIELDS, ()) + """),
ok AS (SELECT * FROM norm WHERE reasons IS NULL),
renamed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM ok WHERE op = 'update') WHERE rn = 1),
authors2 AS (SELECT a.id, CASE WHEN u.id IS NOT NULL THEN u.full_name ELSE a.full_name END AS full_name,
    CASE WHEN u.id IS NOT NULL THEN u.bio ELSE a.bio END AS bio,
    CASE WHEN u.id IS NOT NULL THEN u.birthdate ELSE a.birthdate END AS birthdate
  FROM authors_all a LEFT JOIN renamed u ON a.id = u.id WHERE a.id NOT IN (SELECT id FROM ok WHERE op = 'delete'))
"""

_VIEW2 = f"WITH {_SHELF}, {_AUTHORS2}, categories AS ({CATEGORIES_SQL})" + """,
view2 AS (SELECT b.id, b.title, a.full_name AS author, c.name AS category, b.published_year, b.description, b.quantity, b.category_id, b.author_id
  FROM books2 b LEFT JOIN authors2 a ON a.id = b.author_id LEFT JOIN categories c ON c.id = b.category_id)
"""

_PAIR = ", ".join(f"{t}.{c} AS {side}_{c}" for side, t in (("before", "x"), ("after", "y")) for c in ("title", "author_id", "published_year", "quantity"))

ORACLE_SQL = {
    "stored_role_lookup": f"""
        SELECT CASE WHEN c_acctbal > 5000 THEN 'admin' ELSE 'user' END AS role FROM customer
        WHERE lower(replace(c_name, '#', '.') || '@example.org') = '{LOOKUP_EMAIL}'""",
    "indexed_search": " UNION ALL ".join(f"""
        SELECT '{q}' AS query, doc_id FROM documents
        WHERE contains(lower(coalesce(text, '')), lower('{q}')) OR contains(lower(coalesce(source, '')), lower('{q}'))""" for q in SEARCHES),
    "stored_apply_log": f"WITH {_SHELF}" + f""",
        touched AS (SELECT DISTINCT s.id // {SPAN} AS f FROM started s WHERE s.created >= 0
                    UNION SELECT b.id // {SPAN} FROM books b JOIN log l ON l.id = b.id)
        SELECT *, id // {SPAN} IN (SELECT f FROM touched) AS rewritten FROM books2""",
    "stored_authors_after": f"WITH {_AUTHORS2}" + "SELECT id, full_name, bio, strftime(birthdate, '%Y-%m-%d') AS birthdate FROM authors2",
    "version_differences": f"WITH {_SHELF}" + f"""
        SELECT coalesce(x.id, y.id) AS id, CASE WHEN x.id IS NULL THEN 'insert' WHEN y.id IS NULL THEN 'delete' ELSE 'update' END AS change, {_PAIR}
        FROM books x FULL JOIN books2 y ON x.id = y.id
        WHERE x.id IS NULL OR y.id IS NULL OR x.title IS DISTINCT FROM y.title OR x.author_id IS DISTINCT FROM y.author_id
           OR x.category_id IS DISTINCT FROM y.category_id OR x.published_year IS DISTINCT FROM y.published_year
           OR x.description IS DISTINCT FROM y.description OR x.quantity IS DISTINCT FROM y.quantity""",
    "names_kept_current": _VIEW2 + "SELECT author AS name, count(*) AS n FROM view2 WHERE author IS NOT NULL AND author <> '' GROUP BY author",
    "stats_kept_current": _VIEW2 + """
        SELECT (SELECT count(*) FROM view2) AS total_books, (SELECT count(DISTINCT author) FROM view2 WHERE author <> '') AS distinct_authors,
               (SELECT count(*) FROM categories) AS total_categories""",
    "view_kept_current": _VIEW2 + "SELECT * FROM view2",
}
