"""Change, validation, link, JSON and content queries over the driver tables.

Stand-ins (every input is a driver table or derived from one by Spark):

* submissions to validate    <- customer rows as book forms
* change log of books        <- events (one request per event, body built
                                from the event; see ``book_changes``)
* authors table to change    <- customer (all rows)
* author changes             <- events: view/click = update, error with
                                value > 200 = delete, in event order
* unique inserts             <- documents, unique text, first by doc_id
* links                      <- catalogue titles; pages.url
* content files              <- labels by doc_id (documents with content);
                                binaryFile listing of the table folder
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import values as V
from folio.functions.links import link_fields, query_param, reader_link
from folio.operators import changes as C
from folio.operators import enrich as E
from folio.operators import search as S
from folio.operators import validate as VAL
from folio.operators.numbering import number_rows
from folio.operators.unique import unique_insert, unique_insert_two_keys
from folio.plans.bindings import table, with_catalog
from folio.plans.catalog_queries import catalog
from folio.sources.json_io import json_text

DELETE_VALUE_OVER = 200
LINK_PARAM = "page"
LOOKUP_EMAIL = "customer.000000012@example.org"
FACET_CHOICES = ("all", "2", "02", "null", "12345678901234567890", "2 ", "x")
EMPTY_QUERIES = ("no such title", "#00000012", "customer#000000012", "   ")


def _q(c: Column) -> Column:
    """A JSON string literal of a text column (values here need no escaping)."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def _props_k(events: DataFrame) -> Column:
    return F.get_json_object(events["props"], "$.k")


def book_changes(events: DataFrame) -> DataFrame:
    """Change log of books, one request per event (seq = event_id):

    purchase -> insert with every key (quantity = k); a purchase with
                value > 300 carries a cut-off, malformed body
    signup   -> insert with explicit nulls for category_id and quantity
    view     -> update of id user_id (routed by the editing id: id 0 is
                falsy, so it becomes an insert), no quantity key (-> 0)
    click    -> same routing, no category_id key (rejected), quantity as text
    error    -> delete of id user_id
    """
    k = _props_k(events)
    uid = events["user_id"].cast("string")
    eid = events["event_id"].cast("string")
    et = events["event_type"]
    head = F.concat(F.lit('{"title": '), _q(F.concat(et, F.lit(" "), eid)), F.lit(', "author_id": '), uid)
    body = (
        F.when((et == "purchase") & (events["value"] > 300), F.concat(F.lit('{"title": "purchase'), eid))
        .when(et == "purchase", F.concat(head, F.lit(', "category_id": '), k, F.lit(', "quantity": '), k, F.lit("}")))
        .when(et == "signup", F.concat(head, F.lit(', "category_id": null, "quantity": null}')))
        .when(et == "view", F.concat(head, F.lit(', "category_id": '), k, F.lit(', "published_year": '),
                                     (F.lit(1990) + k.cast("int")).cast("string"),
                                     F.lit(', "description": "seen"}')))
        .when(et == "click", F.concat(head, F.lit(', "quantity": '), _q(k), F.lit("}")))
    )
    editing = F.when(et.isin("view", "click"), events["user_id"])
    op = (
        F.when(et == "error", F.lit("delete"))
        .when(et.isin("view", "click"), C.route_op(editing))
        .otherwise(F.lit("insert"))
    )
    target = F.when(et.isin("view", "click", "error") & (op != "insert"), events["user_id"])
    return events.select(
        F.col("event_id").alias("seq"), F.lit("book").alias("entity"), op.alias("op"),
        target.cast("bigint").alias("id"), body.alias("body"),
    )


def authors_all(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("bio"),
        F.when(F.col("c_nationkey") != 0,
               F.make_date(F.col("c_nationkey") + 1950, F.lit(1), F.lit(1))).alias("birthdate"),
    )


def author_changes(events: DataFrame) -> DataFrame:
    """view/click -> full replace (birthdate omitted, so it is cleared);
    error with value > 200 -> delete; other events are not changes."""
    et = events["event_type"]
    body = F.concat(F.lit('{"full_name": '), _q(F.concat(et, F.lit(" "), events["event_id"].cast("string"))),
                    F.lit(', "bio": '), _q(et), F.lit("}"))
    is_delete = (et == "error") & (events["value"] > DELETE_VALUE_OVER)
    return events.filter(is_delete | et.isin("view", "click")).select(
        F.col("event_id").alias("seq"), F.lit("author").alias("entity"),
        F.when(is_delete, F.lit("delete")).otherwise(F.lit("update")).alias("op"),
        F.col("user_id").alias("id"),
        F.when(~is_delete, body).alias("body"),
    )


# ---------------------------------------------------------------------------
# Registered queries
# ---------------------------------------------------------------------------

def validate_rows(spark, sf_dir):
    """V1 on book forms derived from orders; every rule has rows that fail it."""
    o = table(spark, sf_dir, "orders")
    urgent, low = F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority").startswith("5")
    year = F.year("o_orderdate")
    forms = o.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("title"),
        F.when(~F.col("o_orderpriority").startswith("2"), F.col("o_custkey")).alias("author_id"),
        F.when(F.col("o_orderstatus") != "O", F.lit(1).cast("bigint")).alias("category_id"),
        F.when(urgent, year - 1000).when(low, year + 104).when(F.col("o_orderstatus") == "F", year).cast("int").alias("published_year"),
        F.floor((F.col("o_totalprice") - 100000) / 1000).cast("int").alias("quantity"),
    )
    return VAL.validation_report(forms, VAL.book_rules())


def validate_people(spark, sf_dir):
    """V1 on the author, category and sign-up forms derived from customers."""
    c = table(spark, sf_dir, "customer")
    nation, segment = F.col("c_nationkey"), F.col("c_mktsegment")
    month = F.lpad((nation + 1).cast("string"), 2, "0")          # months 13..25 are none
    authors = c.select(
        F.col("c_custkey").alias("id"), F.when(nation != 3, F.col("c_name")).alias("full_name"),
        F.when(nation == 4, F.lit("")).when(nation != 5, F.concat(F.lit("1970-"), month, F.lit("-01"))).alias("birthdate"))
    categories = c.select(F.col("c_custkey").alias("id"), F.when(segment == "MACHINERY", F.lit("")).otherwise(segment).alias("name"))
    host = F.when(nation < 5, F.lit("example.org")).when(nation < 10, F.lit("-bad.org")).when(nation < 15, F.lit("")).otherwise(
        F.lit("mail.example.org"))
    users = c.select(
        F.col("c_custkey").alias("id"), F.when(segment != "BUILDING", F.col("c_name")).alias("username"),
        F.when(nation == 24, F.lit("")).when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(
            F.concat(F.col("c_name"), F.lit("@"), host)).alias("email"),
        F.when(nation == 2, F.lit("")).when(nation != 7, F.lit("x")).alias("password"))
    out = None
    for form, frame, rules in (("author", authors, VAL.author_rules()), ("category", categories, VAL.category_rules()),
                               ("user", users, VAL.user_rules())):
        one = VAL.validation_report(frame, rules).withColumn("form", F.lit(form))
        out = one if out is None else out.unionByName(one)
    return out


def normalise_changes(spark, sf_dir):
    log = book_changes(table(spark, sf_dir, "events"))
    return C.normalise_changes(log, C.BOOK)


def form_payload(spark, sf_dir):
    """The admin form's text fields turned into a request payload
    (``parseInt`` rules), one form per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        C.route_op(F.col("user_id")).alias("op"),
        V.parse_int(F.concat(F.col("user_id").cast("string"), F.lit("abc")), "bigint").alias("author_id"),
        V.parse_int(F.col("event_type"), "bigint").alias("category_id"),
        V.parse_int_or_null(F.col("value").cast("string")).alias("published_year"),
        V.parse_int_or_zero(_props_k(ev)).alias("quantity"),
    )


def insert_rows(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("full_name"), F.col("c_mktsegment").alias("bio"))
    new = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("request_seq"), F.col("s_name").alias("full_name"),
        F.lit(None).cast("string").alias("bio"))
    return C.insert_rows(base, new, "request_seq")


def replace_by_key(spark, sf_dir):
    base = authors_all(table(spark, sf_dir, "customer")).select("id", "full_name", "bio")
    ev = table(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click"))
    upd = ev.select(
        F.col("user_id").alias("id"), "ts", "event_id",
        F.concat(F.col("event_type"), F.lit(" "), F.col("event_id").cast("string")).alias("full_name"),
        F.lit(None).cast("string").alias("bio"),
    )
    last = C.last_per_key(upd, "id", ["ts", "event_id"], ["full_name", "bio"]).drop("ts", "event_id")
    return C.replace_by_key(base, last, "id", flag="changed")


def delete_by_key(spark, sf_dir):
    base = authors_all(table(spark, sf_dir, "customer")).select("id", "full_name")
    errors = table(spark, sf_dir, "events").filter(F.col("event_type") == "error").select(
        F.col("user_id").alias("id"))
    return C.delete_by_key(base, errors)


def apply_changes(spark, sf_dir):
    base = authors_all(table(spark, sf_dir, "customer"))
    log = author_changes(table(spark, sf_dir, "events"))
    normalised = C.normalise_changes(log, C.AUTHOR)
    ok, _ = C.split_changes(normalised)
    out = C.apply_changes(base, ok, C.AUTHOR, with_status=True).drop("_created_seq")
    # Dates leave as ISO text, the form the listings show.
    return out.withColumn("birthdate", V.date_text("birthdate"))


def change_rejects(spark, sf_dir):
    """A mixed log dispatched to books and authors; the rejected requests."""
    ev = table(spark, sf_dir, "events")
    log = book_changes(ev).unionByName(author_changes(ev))
    return C.reject_changes(log, ["book", "author"])


def unique_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return unique_insert(docs, "text", "doc_id", digest=True).select("doc_id", "accepted", "reason")


def registration_requests(customer: DataFrame) -> DataFrame:
    """Sign-ups derived from customers, in key order: username from market
    segment and nation, e-mail from the balance in hundreds, so requests
    collide on either key in crossing ways."""
    return customer.select(
        F.col("c_custkey").alias("seq"),
        F.concat(F.lower("c_mktsegment"), F.lit("_"), F.col("c_nationkey").cast("string")).alias("username"),
        F.concat(F.lit("u"), F.floor(F.col("c_acctbal") / 100).cast("string"), F.lit("@example.org")).alias("email"),
        # Customers of nation 0 leave the password blank (a form rule rejects them).
        F.when(F.col("c_nationkey") == 0, F.lit("")).otherwise(
            F.concat(F.lit("x"), F.col("c_custkey").cast("string"))).alias("password"),
    )


def unique_pairs(spark, sf_dir):
    """D5 on two keys: each request is accepted unless its username or e-mail
    belongs to an earlier accepted request (rounds, checkpointed into the
    session's spark.checkpoint.dir)."""
    req = registration_requests(table(spark, sf_dir, "customer"))
    return unique_insert_two_keys(req, ("username", "email"), "seq").select("seq", "username", "email", "accepted")


def registration_rejects(spark, sf_dir):
    """V1 + D5 + D9: sign-ups into an empty users table; the refused ones
    with their reasons (form rules first, then a taken username or e-mail)."""
    from folio.operators.users import register_users
    req = registration_requests(table(spark, sf_dir, "customer"))
    users = spark.createDataFrame([], "username string, email string, role string")
    _, rejected = register_users(users, req)
    return rejected


def link_build(spark, sf_dir):
    books = catalog(spark, sf_dir)
    links = books.select("id", "title", reader_link("id", "title").alias("link"))
    fields = link_fields("link")
    return links.select("id", "link", fields["link_id"].alias("link_id"),
                        fields["link_title"].alias("link_title"), fields["missing_id"].alias("missing_id"),
                        (fields["link_title"] == F.col("title")).alias("title_roundtrip"))


def link_parse(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    value = query_param("url", LINK_PARAM)
    return pages.select("page_id", value.alias("page_param"),
                        F.coalesce(value.isNotNull(), F.lit(False)).alias("has_param"))


def json_rows(spark, sf_dir):
    books = catalog(spark, sf_dir)
    return books.select("id", json_text(books, E.CATALOG_COLUMNS))


def content_coverage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    files = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("content_id"))
    return E.content_coverage(docs, files, key="doc_id")


def content_missing(spark, sf_dir):
    """J5, anti-join form: the records whose content file is missing (the
    reader would fail to load them)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    files = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("content_id"))
    return E.content_coverage(docs, files, key="doc_id", how="without")


def mixed_log(events: DataFrame) -> DataFrame:
    """Requests of two entities in event order.  Tables start with the
    suppliers as authors and the nations as categories, so ids of users beyond
    them are rows that the log itself has inserted, or none.

    purchase -> insert an author, its birthdate blank or the event's day
    view     -> update of author user_id; click -> the same, name missing
    error    -> delete of author user_id if its value is over 200
    signup   -> insert a category; error up to 200 -> update of category
                user_id; a signup of value over 300 has text behind its body
    """
    et, value = F.col("event_type"), F.col("value")
    named = F.concat(et, F.lit(" "), F.col("event_id").cast("string"))
    day = F.when(value > 100, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.lit(""))
    author = F.concat(F.lit('{"full_name": '), _q(named), F.lit(', "bio": '), _q(et), F.lit(', "birthdate": '), _q(day), F.lit("}"))
    category = F.concat(F.lit('{"name": '), _q(named), F.lit("}"), F.when(value > 300, F.lit(" and more")).otherwise(F.lit("")))
    of_author = et.isin("purchase", "view", "click") | (et == "error") & (value > DELETE_VALUE_OVER)
    return events.select(
        F.col("event_id").alias("seq"), F.when(of_author, F.lit("author")).otherwise(F.lit("category")).alias("entity"),
        F.when(et.isin("purchase", "signup"), F.lit("insert")).when((et == "error") & (value > DELETE_VALUE_OVER), F.lit("delete"))
        .otherwise(F.lit("update")).alias("op"),
        F.when(~et.isin("purchase", "signup"), F.col("user_id")).alias("id"),
        F.when(et.isin("purchase", "view"), author).when(et == "click", F.concat(F.lit('{"bio": '), _q(et), F.lit("}")))
        .when(~of_author, category).alias("body"))


def _mixed_tables(spark, sf_dir):
    authors = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("bigint").alias("id"), F.col("s_name").alias("full_name"),
        F.lit(None).cast("string").alias("bio"), F.lit(None).cast("date").alias("birthdate"))
    categories = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"), F.lit("nation").alias("description"))
    return {"author": authors, "category": categories}


def apply_mixed_log(spark, sf_dir):
    """D8 + D4 + D1: a log of two entities folded into both tables, with
    inserted rows that later requests update or delete."""
    new, _ = C.apply_change_log(_mixed_tables(spark, sf_dir), mixed_log(table(spark, sf_dir, "events")))
    authors = new["author"].select(F.lit("author").alias("entity"), "id", F.col("full_name").alias("name"),
                                   F.col("bio").alias("note"), V.date_text("birthdate").alias("birthdate"))
    categories = new["category"].select(F.lit("category").alias("entity"), "id", "name", F.col("description").alias("note"),
                                        F.lit(None).cast("string").alias("birthdate"))
    return authors.unionByName(categories)


def mixed_log_rejects(spark, sf_dir):
    """The requests of the same log that are refused, with reasons."""
    return C.reject_changes(mixed_log(table(spark, sf_dir, "events")), ["author", "category"])


def existing_users(customer: DataFrame) -> DataFrame:
    """Users on file: the customers of nation 5, under the next nation's name,
    so both their usernames and their e-mails meet requests of others."""
    own = registration_requests(customer.filter(F.col("c_nationkey") == 5))
    return own.select(F.regexp_replace("username", "_5$", "_6").alias("username"), "email",
                      F.when(F.col("seq") > 1000, F.lit("admin")).otherwise(F.lit("user")).alias("role")).dropDuplicates(["username", "email"])


def registered_users(spark, sf_dir):
    """V1 + J4 + D5 + D9 + U1: sign-ups against users on file; all users
    afterwards, with their roles."""
    from folio.operators.users import register_users
    customer = table(spark, sf_dir, "customer")
    users, _ = register_users(existing_users(customer), registration_requests(customer.filter(F.col("c_nationkey") != 5)))
    return users


def unique_insert_existing(spark, sf_dir):
    """D5 + J4, one key: documents inserted under unique texts beside those on
    file (the documents of one source)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    on_file = F.coalesce(F.col("source") == "src1", F.lit(False))
    out = unique_insert(docs.filter(~on_file), "text", "doc_id", existing=docs.filter(on_file), digest=True)
    return out.select("doc_id", "accepted", "reason")


def role_lookup(spark, sf_dir):
    """the role of the user with an e-mail."""
    from folio.operators.users import role_of
    c = table(spark, sf_dir, "customer")
    users = c.select(F.col("c_name").alias("username"), F.lower(F.concat(F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@example.org"))).alias("email"),
                     F.when(F.col("c_acctbal") > 5000, F.lit("admin")).otherwise(F.lit("user")).alias("role"))
    return role_of(users, LOOKUP_EMAIL)


def empty_results(spark, sf_dir):
    """whether searches find nothing, beside their counts."""
    books = catalog(spark, sf_dir)
    out = None
    for query in EMPTY_QUERIES:
        one = S.text_search(books, query).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(query).alias("query"), "n", (F.col("n") == 0).alias("is_empty"))
        out = one if out is None else out.unionByName(one)
    return out


def numbered_by_price(spark, sf_dir):
    """W1 on a decimal key that is not unique, ties by order key."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(20,0)").alias("price"))
    return number_rows(o, "price", tie_breakers=["o_orderkey"]).withColumn("price", F.col("price").cast("bigint"))


def link_texts(spark, sf_dir):
    """X14 on links whose titles are whole raw texts: their separators, spaces
    and percent signs end, split or stand in the title as the page reads it."""
    docs = table(spark, sf_dir, "documents")
    links = docs.select("doc_id", F.concat(F.lit("reader.html?id="), F.col("doc_id").cast("string"), F.lit("&title="),
                                           F.coalesce("text", F.lit(""))).alias("link"))
    fields = link_fields("link")
    return links.select("doc_id", *[fields[c].alias(c) for c in ("link_id", "link_title", "missing_id")])


def link_whole_texts(spark, sf_dir):
    """X12 + X14: whole texts encoded into links, and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    links = docs.select("doc_id", "text", reader_link("doc_id", "text").alias("link"))
    title = query_param("link", "title")
    return links.select("doc_id", F.sha2("link", 256).alias("link_sha256"), F.length("link").cast("long").alias("link_chars"),
                        F.coalesce(title == F.coalesce("text", F.lit("null")), F.lit(False)).alias("title_roundtrip"))


def facet_choices(spark, sf_dir):
    """F4 + F9: every kind of choice -- all, a number, a number written another
    way, a missing id, more digits than an id has, no number -- with the rows it
    keeps and whether nothing is found."""
    books = catalog(spark, sf_dir)
    out = None
    for choice in FACET_CHOICES:
        found = S.facet(books, choice)
        one = found.agg(F.count(F.lit(1)).alias("n")).select(F.lit(choice).alias("choice"), "n", F.lit(S.is_empty(found)).alias("is_empty"))
        out = one if out is None else out.unionByName(one)
    return out


QUERIES = {
    "validate_rows": validate_rows,
    "normalise_changes": normalise_changes,
    "form_payload": form_payload,
    "insert_rows": insert_rows,
    "replace_by_key": replace_by_key,
    "delete_by_key": delete_by_key,
    "apply_changes": apply_changes,
    "change_rejects": change_rejects,
    "unique_insert": unique_documents,
    "unique_insert_two_keys": unique_pairs,
    "registration_rejects": registration_rejects,
    "link_build": link_build,
    "link_parse": link_parse,
    "json_rows": json_rows,
    "content_coverage": content_coverage,
    "content_missing": content_missing,
    "validate_people": validate_people,
    "apply_mixed_log": apply_mixed_log,
    "mixed_log_rejects": mixed_log_rejects,
    "registered_users": registered_users,
    "unique_insert_existing": unique_insert_existing,
    "role_lookup": role_lookup,
    "empty_results": empty_results,
    "numbered_by_price": numbered_by_price,
    "link_texts": link_texts,
    "link_whole_texts": link_whole_texts,
    "facet_choices": facet_choices,
}


# ---------------------------------------------------------------------------
# DuckDB oracle text
# ---------------------------------------------------------------------------
_BOOK_LOG = """
book_log AS (
  SELECT event_id AS seq, 'book' AS entity,
    CASE WHEN event_type = 'error' THEN 'delete'
         WHEN event_type IN ('view', 'click') THEN CASE WHEN user_id = 0 THEN 'insert' ELSE 'update' END
         ELSE 'insert' END AS op,
    CASE WHEN event_type = 'error' OR (event_type IN ('view', 'click') AND user_id <> 0)
         THEN user_id END AS id,
    CASE WHEN event_type = 'purchase' AND value > 300 THEN '{"title": "purchase' || event_id
         WHEN event_type = 'purchase' THEN head || ', "category_id": ' || k || ', "quantity": ' || k || '}'
         WHEN event_type = 'signup' THEN head || ', "category_id": null, "quantity": null}'
         WHEN event_type = 'view' THEN head || ', "category_id": ' || k || ', "published_year": '
              || CAST(1990 + CAST(k AS INTEGER) AS VARCHAR) || ', "description": "seen"}'
         WHEN event_type = 'click' THEN head || ', "quantity": "' || k || '"}'
    END AS body
  FROM (SELECT *, json_extract_string(props, '$.k') AS k,
               '{"title": "' || event_type || ' ' || event_id || '", "author_id": ' || user_id AS head
        FROM events))
"""

_AUTHOR_LOG = """
author_log AS (
  SELECT event_id AS seq, 'author' AS entity,
    CASE WHEN event_type = 'error' AND value > 200 THEN 'delete' ELSE 'update' END AS op,
    user_id AS id,
    CASE WHEN NOT (event_type = 'error' AND value > 200)
         THEN '{"full_name": "' || event_type || ' ' || event_id || '", "bio": "' || event_type || '"}' END AS body
  FROM events
  WHERE (event_type = 'error' AND value > 200) OR event_type IN ('view', 'click'))
"""


def _normalised_sql(log: str, required: list[str], fields: dict[str, str], zero_if_absent: tuple[str, ...]) -> str:
    duck = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE"}
    cols, problems = [], [
        "CASE WHEN op NOT IN ('insert', 'update', 'delete') THEN 'unknown op' END",
        "CASE WHEN op IN ('update', 'delete') AND id IS NULL THEN 'id required' END",
        "CASE WHEN nb AND NOT is_obj THEN 'body is not a JSON object' END",
    ]
    for k in required:
        problems.append(f"CASE WHEN nb AND is_obj AND NOT list_contains(keys, '{k}') THEN '{k} missing' END")
    for k, t in fields.items():
        raw = f"CASE WHEN is_obj THEN json_extract_string(body, '$.{k}') END"
        typed = raw if t == "string" else (
            f"TRY_STRPTIME({raw}, '%Y-%m-%d')::DATE" if t == "date" else f"TRY_CAST({raw} AS {duck[t]})")
        value = typed
        if k in zero_if_absent:
            value = f"CASE WHEN is_obj AND list_contains(keys, '{k}') THEN {typed} ELSE CAST(0 AS {duck[t]}) END"
        cols.append(f"CASE WHEN nb THEN {value} END AS {k}")
        problems.append(f"CASE WHEN nb AND {raw} IS NOT NULL AND {typed} IS NULL THEN '{k} not a {t}' END")
    return f"""
      SELECT seq, op, CAST(id AS BIGINT) AS id, {', '.join(cols)},
             NULLIF(concat_ws('; ', {', '.join(problems)}), '') AS reasons
      FROM (SELECT *, op IN ('insert', 'update') AS nb,
                   coalesce(CASE WHEN json_valid(body) THEN json_type(body) = 'OBJECT' END, false) AS is_obj,
                   CASE WHEN CASE WHEN json_valid(body) THEN json_type(body) = 'OBJECT' END
                        THEN json_keys(body) END AS keys
            FROM {log})"""


def _walk(requests: str) -> str:
    """The sequential definition of two-key uniqueness as a recursive step:
    take ``requests`` (columns i, seq, username, email; i = 1..n in order)
    one at a time, accepting a request unless its username or e-mail is
    already taken by an accepted one."""
    taken = "list_contains(w.used_u, r.username) OR list_contains(w.used_e, r.email)"
    return f"""
          SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), CAST([] AS BIGINT[])
          UNION ALL
          SELECT r.i,
                 CASE WHEN {taken} THEN w.used_u ELSE list_append(w.used_u, r.username) END,
                 CASE WHEN {taken} THEN w.used_e ELSE list_append(w.used_e, r.email) END,
                 CASE WHEN {taken} THEN w.acc ELSE list_append(w.acc, r.seq) END
          FROM walk w JOIN {requests} r ON r.i = w.i + 1"""


# Written out here, not taken from the library's own tables of fields.
_BOOK_FIELDS = {"title": "string", "author_id": "bigint", "category_id": "bigint", "published_year": "int",
                "description": "string", "quantity": "int"}
_BOOK_REQUIRED = ["title", "author_id", "category_id"]
_AUTHOR_FIELDS = {"full_name": "string", "bio": "string", "birthdate": "date"}
_AUTHOR_REQUIRED = ["full_name"]

_MIXED = """
WITH log AS (
  SELECT event_id AS seq, CASE WHEN event_type IN ('purchase', 'view', 'click') OR event_type = 'error' AND value > 200
                               THEN 'author' ELSE 'category' END AS entity,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'insert' WHEN event_type = 'error' AND value > 200 THEN 'delete'
              ELSE 'update' END AS op,
         CASE WHEN event_type NOT IN ('purchase', 'signup') THEN CAST(user_id AS BIGINT) END AS id,
         event_type || ' ' || event_id AS name,
         CASE WHEN event_type IN ('purchase', 'view') THEN event_type END AS note,
         CASE WHEN event_type IN ('purchase', 'view') AND value > 100 THEN strftime(ts, '%Y-%m-%d') END AS birthdate,
         CASE WHEN event_type = 'click' THEN 'full_name missing'
              WHEN (event_type = 'signup' OR event_type = 'error' AND value <= 200) AND value > 300
              THEN 'body is not a JSON object' END AS reasons
  FROM events),
ok AS (SELECT * FROM log WHERE reasons IS NULL),
rows_ AS (
  SELECT 'author' AS entity, CAST(s_suppkey AS BIGINT) AS id, s_name AS name, CAST(NULL AS VARCHAR) AS note,
         CAST(NULL AS VARCHAR) AS birthdate, -1 AS created FROM supplier
  UNION ALL SELECT 'category', CAST(n_nationkey AS BIGINT), n_name, 'nation', NULL, -1 FROM nation
  UNION ALL SELECT entity, row_number() OVER (PARTITION BY entity ORDER BY seq)
         + CASE entity WHEN 'author' THEN (SELECT max(s_suppkey) FROM supplier) ELSE (SELECT max(n_nationkey) FROM nation) END,
         name, note, birthdate, seq FROM ok WHERE op = 'insert')
"""

_AUTHORS_ALL = """
authors_all AS (
  SELECT c_custkey AS id, c_name AS full_name, c_mktsegment AS bio,
         CASE WHEN c_nationkey <> 0 THEN make_date(c_nationkey + 1950, 1, 1) END AS birthdate
  FROM customer)
"""

_ENCODE = ("replace(replace(replace(replace(replace(url_encode({x}), '%2A', '*'), '%21', '!'), "
           "'%28', '('), '%29', ')'), '%27', '''')")

ORACLE_SQL = {
    "validate_rows": """
        WITH f AS (
          SELECT o_orderkey AS id,
                 CASE o_orderstatus WHEN 'P' THEN '' WHEN 'F' THEN o_orderpriority END AS title,
                 CASE WHEN o_orderpriority NOT LIKE '2%' THEN o_custkey END AS author_id,
                 CASE WHEN o_orderstatus <> 'O' THEN 1 END AS category_id,
                 CASE WHEN o_orderpriority LIKE '1%' THEN year(o_orderdate) - 1000
                      WHEN o_orderpriority LIKE '5%' THEN year(o_orderdate) + 104
                      WHEN o_orderstatus = 'F' THEN year(o_orderdate) END AS y,
                 floor((o_totalprice - 100000) / 1000) AS q
          FROM orders),
        r AS (SELECT id, list_filter([
                 CASE WHEN coalesce(title, '') = '' THEN 'title required' END,
                 CASE WHEN author_id IS NULL THEN 'author_id required' END,
                 CASE WHEN category_id IS NULL THEN 'category_id required' END,
                 CASE WHEN y NOT BETWEEN 1000 AND 2099 THEN 'published_year out of range' END,
                 CASE WHEN q < 0 THEN 'quantity below 0' END], lambda x: x IS NOT NULL) AS bad FROM f)
        SELECT id, len(bad) = 0 AS is_valid, NULLIF(array_to_string(bad, '; '), '') AS reasons, CAST(len(bad) AS INTEGER) AS n_reasons
        FROM r""",
    "validate_people": """
        WITH a AS (SELECT c_custkey AS id, 'author' AS form, [
            CASE WHEN c_nationkey = 3 OR coalesce(c_name, '') = '' THEN 'full_name required' END,
            CASE WHEN c_nationkey >= 12 THEN 'birthdate not a date' END] AS bad FROM customer),
        c AS (SELECT c_custkey AS id, 'category' AS form, [
            CASE WHEN c_mktsegment = 'MACHINERY' OR coalesce(c_mktsegment, '') = '' THEN 'name required' END] AS bad FROM customer),
        u AS (SELECT c_custkey AS id, 'user' AS form, [
            CASE WHEN c_mktsegment = 'BUILDING' OR coalesce(c_name, '') = '' THEN 'username required' END,
            CASE WHEN c_nationkey = 24 THEN 'email required' END,
            CASE WHEN c_nationkey <> 24 AND (c_acctbal < 0 OR c_nationkey BETWEEN 5 AND 14) THEN 'email not an e-mail' END,
            CASE WHEN c_nationkey IN (2, 7) THEN 'password required' END] AS bad FROM customer),
        r AS (SELECT id, form, list_filter(bad, lambda x: x IS NOT NULL) AS bad
              FROM (SELECT * FROM a UNION ALL SELECT * FROM c UNION ALL SELECT * FROM u))
        SELECT id, form, len(bad) = 0 AS is_valid, NULLIF(array_to_string(bad, '; '), '') AS reasons, CAST(len(bad) AS INTEGER) AS n_reasons
        FROM r""",
    # The log told in SQL of its own: what each request means, which are
    # refused, the id of every insert, and per row the last word on it.
    "apply_mixed_log": _MIXED + """
        SELECT entity, id, name, note, birthdate FROM (
          SELECT r.entity, r.id, coalesce(u.name, r.name) AS name,
                 CASE WHEN u.seq IS NOT NULL THEN u.note ELSE r.note END AS note,
                 CASE WHEN u.seq IS NOT NULL THEN u.birthdate ELSE r.birthdate END AS birthdate,
                 row_number() OVER (PARTITION BY r.entity, r.id ORDER BY u.seq DESC NULLS LAST) AS k
          FROM rows_ r LEFT JOIN ok u ON u.op = 'update' AND u.entity = r.entity AND u.id = r.id AND u.seq > r.created
          WHERE NOT EXISTS (SELECT 1 FROM ok d WHERE d.op = 'delete' AND d.entity = r.entity AND d.id = r.id AND d.seq > r.created))
        WHERE k = 1""",
    "mixed_log_rejects": _MIXED + "SELECT entity, seq, op, id, reasons FROM log WHERE reasons IS NOT NULL",
    "registered_users": """
        WITH RECURSIVE req AS (
          SELECT c_custkey AS seq, c_nationkey AS nation,
                 lower(c_mktsegment) || '_' || CAST(c_nationkey AS VARCHAR) AS username,
                 'u' || CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR) || '@example.org' AS email
          FROM customer),
        on_file AS (SELECT regexp_replace(username, '_5$', '_6') AS username, email, seq FROM req WHERE nation = 5),
        valid AS (SELECT CAST(row_number() OVER (ORDER BY seq) AS BIGINT) AS i, seq, username, email FROM req
                  WHERE nation NOT IN (0, 5) AND username NOT IN (SELECT username FROM on_file) AND email NOT IN (SELECT email FROM on_file)),
        walk(i, used_u, used_e, acc) AS (""" + _walk("valid") + """)
        SELECT username, email, CASE WHEN min(seq) > 1000 THEN 'admin' ELSE 'user' END AS role FROM on_file GROUP BY username, email
        UNION ALL
        SELECT v.username, v.email, 'user' AS role FROM valid v, (SELECT acc FROM walk ORDER BY i DESC LIMIT 1) f
        WHERE list_contains(f.acc, v.seq)""",
    "unique_insert_existing": """
        SELECT doc_id, coalesce(text IS NOT NULL AND NOT taken AND doc_id = first, false) AS accepted,
               CASE WHEN text IS NULL THEN 'text required' WHEN taken THEN 'text exists'
                    WHEN doc_id = first THEN NULL ELSE 'text repeated in batch' END AS reason
        FROM (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY text) AS first,
                     coalesce(text IN (SELECT text FROM documents WHERE source = 'src1' AND text IS NOT NULL), false) AS taken
              FROM documents WHERE source IS DISTINCT FROM 'src1')""",
    "role_lookup": f"""
        SELECT CASE WHEN c_acctbal > 5000 THEN 'admin' ELSE 'user' END AS role FROM customer
        WHERE lower(replace(c_name, '#', '.') || '@example.org') = '{LOOKUP_EMAIL}'""",
    "empty_results": with_catalog(" UNION ALL ".join(f"""
        SELECT '{q}' AS query, count(*) AS n, count(*) = 0 AS is_empty FROM catalog
        WHERE trim('{q}') = '' OR contains(lower(coalesce(title, '')), lower('{q}')) OR contains(lower(coalesce(author, '')), lower('{q}'))"""
        for q in EMPTY_QUERIES)),
    "numbered_by_price": """
        SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(20,0)) AS BIGINT) AS price,
               CAST(row_number() OVER (ORDER BY CAST(o_totalprice AS DECIMAL(20,0)), o_orderkey) AS BIGINT) AS row_no FROM orders""",
    "link_texts": """
        SELECT doc_id, id AS link_id, CASE WHEN t = '' THEN 'Không có tiêu đề' ELSE t END AS link_title, id = '' AS missing_id
        FROM (SELECT doc_id, regexp_extract(link, '[?&]id=([^&#]*)', 1) AS id,
                     url_decode(replace(regexp_replace(regexp_extract(link, '[?&]title=([^&#]*)', 1), '%([^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|.?$)', '%25\\1', 'g'), '+', ' ')) AS t
              FROM (SELECT doc_id, 'reader.html?id=' || doc_id || '&title=' || coalesce(text, '') AS link FROM documents))""",
    "link_whole_texts": f"""
        SELECT doc_id, sha256(link) AS link_sha256, length(link) AS link_chars, true AS title_roundtrip
        FROM (SELECT doc_id, 'reader.html?id=' || doc_id || '&title=' || {_ENCODE.format(x="coalesce(text, 'null')")} AS link FROM documents)""",
    "facet_choices": with_catalog(" UNION ALL ".join(f"""
        SELECT '{c}' AS choice, count(*) AS n, count(*) = 0 AS is_empty FROM catalog
        WHERE '{c}' = 'all' OR coalesce(CAST(category_id AS VARCHAR), 'null') = '{c}'""" for c in FACET_CHOICES)),
    "normalise_changes": "WITH " + _BOOK_LOG + _normalised_sql(
        "book_log", _BOOK_REQUIRED, _BOOK_FIELDS, ("quantity",)),
    "form_payload": """
        SELECT event_id,
               CASE WHEN user_id = 0 THEN 'insert' ELSE 'update' END AS op,
               TRY_CAST(NULLIF(regexp_extract(CAST(user_id AS VARCHAR) || 'abc', '^\\s*([+-]?[0-9]+)', 1), '') AS BIGINT) AS author_id,
               TRY_CAST(NULLIF(regexp_extract(event_type, '^\\s*([+-]?[0-9]+)', 1), '') AS BIGINT) AS category_id,
               NULLIF(TRY_CAST(NULLIF(regexp_extract(CAST(value AS VARCHAR), '^\\s*([+-]?[0-9]+)', 1), '') AS INTEGER), 0) AS published_year,
               coalesce(TRY_CAST(NULLIF(regexp_extract(json_extract_string(props, '$.k'), '^\\s*([+-]?[0-9]+)', 1), '') AS INTEGER), 0) AS quantity
        FROM events""",
    "insert_rows": """
        SELECT c_custkey AS id, c_name AS full_name, c_mktsegment AS bio FROM customer
        UNION ALL
        SELECT CAST((SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey) AS BIGINT) AS id,
               s_name AS full_name, CAST(NULL AS VARCHAR) AS bio
        FROM supplier""",
    "replace_by_key": "WITH " + _AUTHORS_ALL + """,
        upd AS (
          SELECT user_id AS id, event_type || ' ' || event_id AS full_name
          FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
                FROM events WHERE event_type IN ('view', 'click')) WHERE rn = 1)
        SELECT a.id,
               CASE WHEN u.id IS NOT NULL THEN u.full_name ELSE a.full_name END AS full_name,
               CASE WHEN u.id IS NOT NULL THEN CAST(NULL AS VARCHAR) ELSE a.bio END AS bio,
               u.id IS NOT NULL AS changed
        FROM authors_all a LEFT JOIN upd u ON a.id = u.id""",
    "delete_by_key": "WITH " + _AUTHORS_ALL + """
        SELECT id, full_name FROM authors_all
        WHERE id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND user_id IS NOT NULL)""",
    "apply_changes": "WITH " + _AUTHORS_ALL + ", " + _AUTHOR_LOG + ", norm AS (" + _normalised_sql(
        "author_log", _AUTHOR_REQUIRED, _AUTHOR_FIELDS, ()) + """),
        ok AS (SELECT * FROM norm WHERE reasons IS NULL),
        last_upd AS (
          SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn
                         FROM ok WHERE op = 'update') WHERE rn = 1)
        SELECT a.id,
               CASE WHEN u.id IS NOT NULL THEN u.full_name ELSE a.full_name END AS full_name,
               CASE WHEN u.id IS NOT NULL THEN u.bio ELSE a.bio END AS bio,
               strftime(CASE WHEN u.id IS NOT NULL THEN u.birthdate ELSE a.birthdate END, '%Y-%m-%d') AS birthdate,
               u.id IS NOT NULL AS updated
        FROM authors_all a LEFT JOIN last_upd u ON a.id = u.id
        WHERE a.id NOT IN (SELECT id FROM ok WHERE op = 'delete')""",
    "change_rejects": "WITH " + _BOOK_LOG + ", " + _AUTHOR_LOG + ", bn AS (" + _normalised_sql(
        "book_log", _BOOK_REQUIRED, _BOOK_FIELDS, ("quantity",)) + "), an AS (" + _normalised_sql(
        "author_log", _AUTHOR_REQUIRED, _AUTHOR_FIELDS, ()) + """)
        SELECT 'book' AS entity, seq, op, id, reasons FROM bn WHERE reasons IS NOT NULL
        UNION ALL
        SELECT 'author' AS entity, seq, op, id, reasons FROM an WHERE reasons IS NOT NULL""",
    "unique_insert": """
        SELECT doc_id, doc_id = first AS accepted,
               CASE WHEN text IS NULL THEN 'text required' WHEN doc_id = first THEN NULL
                    ELSE 'text repeated in batch' END AS reason
        FROM (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY text) AS first FROM documents)""",
    # The sequential definition itself: walk the requests in order, keeping
    # the usernames and e-mails taken so far.
    "unique_insert_two_keys": """
        WITH RECURSIVE req AS (
          SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS i, c_custkey AS seq,
                 lower(c_mktsegment) || '_' || CAST(c_nationkey AS VARCHAR) AS username,
                 'u' || CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR) || '@example.org' AS email
          FROM customer),
        walk(i, used_u, used_e, acc) AS (""" + _walk("req") + """)
        SELECT r.seq, r.username, r.email, list_contains(f.acc, r.seq) AS accepted
        FROM req r, (SELECT acc FROM walk ORDER BY i DESC LIMIT 1) f""",
    "registration_rejects": """
        WITH RECURSIVE req AS (
          SELECT c_custkey AS seq,
                 lower(c_mktsegment) || '_' || CAST(c_nationkey AS VARCHAR) AS username,
                 'u' || CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR) || '@example.org' AS email,
                 CASE WHEN c_nationkey = 0 THEN '' ELSE 'x' || CAST(c_custkey AS VARCHAR) END AS password
          FROM customer),
        valid AS (
          SELECT CAST(row_number() OVER (ORDER BY seq) AS BIGINT) AS i, seq, username, email
          FROM req WHERE password <> ''),
        walk(i, used_u, used_e, acc) AS (""" + _walk("valid") + """)
        SELECT seq, username, email, 'password required' AS reasons FROM req WHERE password = ''
        UNION ALL
        SELECT v.seq, v.username, v.email, 'username or email already exists' AS reasons
        FROM valid v, (SELECT acc FROM walk ORDER BY i DESC LIMIT 1) f
        WHERE NOT list_contains(f.acc, v.seq)""",
    "link_build": with_catalog(f"""
        SELECT id, link, link_id,
               CASE WHEN coalesce(t, '') = '' THEN 'Không có tiêu đề' ELSE t END AS link_title,
               coalesce(link_id, '') = '' AS missing_id,
               (CASE WHEN coalesce(t, '') = '' THEN 'Không có tiêu đề' ELSE t END) = title AS title_roundtrip
        FROM (SELECT id, title, link,
                     url_decode(replace(regexp_extract(link, '[?&]id=([^&#]*)', 1), '+', ' ')) AS link_id,
                     url_decode(replace(regexp_extract(link, '[?&]title=([^&#]*)', 1), '+', ' ')) AS t
              FROM (SELECT id, title,
                           'reader.html?id=' || CAST(id AS VARCHAR) || '&title='
                           || {_ENCODE.format(x="coalesce(title, 'null')")} AS link
                    FROM catalog))"""),
    "link_parse": f"""
        SELECT page_id, page_param, page_param IS NOT NULL AS has_param
        FROM (SELECT page_id,
                     CASE WHEN regexp_matches(url, '[?&]{LINK_PARAM}=')
                          THEN url_decode(replace(regexp_extract(url, '[?&]{LINK_PARAM}=([^&#]*)', 1), '+', ' '))
                     END AS page_param
              FROM pages)""",
    "json_rows": with_catalog("""
        SELECT id, CAST(to_json(struct_pack(author := author, author_id := author_id, category := category,
                                       category_id := category_id, description := description, id := id,
                                       published_year := published_year, quantity := quantity,
                                       title := title)) AS VARCHAR) AS json
        FROM catalog"""),
    "content_missing": """
        SELECT doc_id, source FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)""",
    "content_coverage": """
        SELECT doc_id, doc_id IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) AS has_content
        FROM documents""",
}
