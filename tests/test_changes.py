"""Change log fold, validation and unique inserts against a sequential model."""

import json
import random

from folio.operators import changes as C
from folio.operators import validate as VAL
from folio.operators.unique import unique_insert, unique_insert_two_keys
from folio.sources import snapshots
from folio.sources.json_io import read_json_rows

AUTHORS = "id long, full_name string, bio string, birthdate date"
LOG = "seq long, entity string, op string, id long, body string"


def base(spark, rows=((1, "a", "x", None), (2, "b", "y", None))):
    return spark.createDataFrame(list(rows), AUTHORS)


def fold(spark, base_df, log_rows):
    log = spark.createDataFrame(log_rows, LOG)
    ok, bad = C.split_changes(C.normalise_changes(log, C.AUTHOR))
    return C.apply_changes(base_df, ok, C.AUTHOR), bad


def body(name, **extra):
    return json.dumps({"full_name": name, **extra})


def as_dict(df):
    return {r.id: r.asDict() for r in df.collect()}


def test_update_clears_value(spark):
    out, _ = fold(spark, base(spark), [(1, "author", "update", 1, json.dumps({"full_name": "n", "bio": None}))])
    assert as_dict(out)[1]["bio"] is None and as_dict(out)[1]["full_name"] == "n"


def test_unknown_ids_are_noops(spark):
    out, _ = fold(spark, base(spark), [(1, "author", "update", 99, body("z")), (2, "author", "delete", 99, None)])
    assert sorted(as_dict(out)) == [1, 2]


def test_delete_is_terminal(spark):
    out, _ = fold(spark, base(spark), [(1, "author", "update", 1, body("p")), (2, "author", "delete", 1, None),
                                       (3, "author", "update", 1, body("q"))])
    assert 1 not in as_dict(out)


def test_last_update_wins(spark):
    out, _ = fold(spark, base(spark), [(1, "author", "update", 1, body("a")), (2, "author", "update", 1, body("b"))])
    assert as_dict(out)[1]["full_name"] == "b"


def test_rejected_change_leaves_row(spark):
    out, bad = fold(spark, base(spark), [(1, "author", "update", 1, body("a")),
                                         (2, "author", "update", 1, json.dumps({"bio": "no name"}))])
    assert as_dict(out)[1]["full_name"] == "a"
    assert [(r.seq, r.reasons) for r in bad.collect()] == [(2, "full_name missing")]


def test_malformed_body_is_rejected_not_dropped(spark):
    out, bad = fold(spark, base(spark), [(1, "author", "insert", None, "{bad")])
    assert bad.count() == 1 and out.count() == 2


def test_quantity_key_absent_versus_null(spark):
    log = spark.createDataFrame([
        (1, "book", "insert", None, json.dumps({"title": "t", "author_id": 1, "category_id": 1})),
        (2, "book", "insert", None, json.dumps({"title": "t", "author_id": 1, "category_id": 1, "quantity": None})),
        (3, "book", "insert", None, json.dumps({"title": "t", "author_id": 1, "category_id": 1, "quantity": 3})),
    ], LOG)
    got = {r.seq: r.quantity for r in C.normalise_changes(log, C.BOOK).collect()}
    assert got == {1: 0, 2: None, 3: 3}


def test_inserts_get_new_ids_and_can_be_changed_later(spark):
    out, _ = fold(spark, base(spark), [(1, "author", "insert", None, body("new")),
                                       (2, "author", "update", 3, body("renamed")),
                                       (3, "author", "insert", None, body("newer"))])
    got = as_dict(out)
    assert got[3]["full_name"] == "renamed" and got[4]["full_name"] == "newer"


def sequential_fold(base_rows, log):
    table = {r[0]: r[1] for r in base_rows}
    next_id = max(table) + 1 if table else 1
    for seq, op, id_, name in sorted(log):
        if op == "insert":
            table[next_id] = name
            next_id += 1
        elif op == "update" and id_ in table:
            table[id_] = name
        elif op == "delete":
            table.pop(id_, None)
    return table


def test_fold_equals_sequential_loop_on_random_logs(spark):
    rng = random.Random(7)
    base_rows = [(i, f"n{i}", None, None) for i in range(1, 31)]
    for trial in range(3):
        log = []
        for seq in range(300):
            op = rng.choice(["update", "update", "delete", "insert"])
            id_ = None if op == "insert" else rng.randint(1, 45)
            log.append((seq, op, id_, f"v{trial}_{seq}"))
        rows = [(s, "author", op, i, None if op == "delete" else body(n)) for s, op, i, n in log]
        out, bad = fold(spark, base(spark, base_rows), rows)
        assert bad.count() == 0
        got = {r.id: r.full_name for r in out.collect()}
        assert got == sequential_fold(base_rows, log)


def test_dispatch_by_entity(spark):
    log = spark.createDataFrame([(1, "author", "delete", 1, None), (2, "category", "delete", 1, None),
                                 (3, "shelf", "delete", 1, None)], LOG)
    cats = spark.createDataFrame([(1, "c", None)], "id long, name string, description string")
    tables, rejected = C.apply_change_log({"author": base(spark), "category": cats}, log)
    assert sorted(as_dict(tables["author"])) == [2]
    assert tables["category"].count() == 0
    assert [r.reasons for r in rejected.collect()] == ["unknown entity"]


def test_validation_ranges_and_reasons(spark):
    rows = [(1, "t", 1, 1, 999, 0), (2, "t", 1, 1, 1000, 0), (3, "t", 1, 1, 2099, 0), (4, "t", 1, 1, 2100, 0),
            (5, "t", 1, 1, None, 0), (6, "t", 1, 1, None, -1), (7, "", 1, 1, None, -1)]
    df = spark.createDataFrame(rows, "id long, title string, author_id long, category_id long, "
                                     "published_year int, quantity int")
    report = {r.id: (r.is_valid, r.n_reasons) for r in VAL.validation_report(df, VAL.book_rules()).collect()}
    assert report == {1: (False, 1), 2: (True, 0), 3: (True, 0), 4: (False, 1), 5: (True, 0),
                      6: (False, 1), 7: (False, 2)}
    ok, bad = VAL.split_valid(df, VAL.book_rules())
    assert ok.count() + bad.count() == df.count()


def test_email_rule(spark):
    df = spark.createDataFrame([("a@b.c",), ("nope",), ("",)], "email string")
    rule = VAL.email_shape("email")
    assert [r[0] for r in df.select(rule[1]).collect()] == [False, True, False]


def test_unique_insert_one_key(spark):
    req = spark.createDataFrame([(1, "u1"), (2, "u1"), (3, "u2"), (4, "u9")], "seq long, username string")
    existing = spark.createDataFrame([("u9",)], "username string")
    got = {r.seq: (r.accepted, r.reason) for r in unique_insert(req, "username", "seq", existing).collect()}
    assert got == {1: (True, None), 2: (False, "username repeated in batch"), 3: (True, None),
                   4: (False, "username exists")}


def sequential_two_keys(rows, existing=()):
    used1 = {e[0] for e in existing}
    used2 = {e[1] for e in existing}
    out = {}
    for seq, a, b in sorted(rows):
        if a in used1 or b in used2:
            out[seq] = False
        else:
            out[seq] = True
            used1.add(a)
            used2.add(b)
    return out


def run_two_keys(spark, rows, existing=None):
    req = spark.createDataFrame(rows, "seq long, username string, email string")
    ex = spark.createDataFrame(existing, "username string, email string") if existing else None
    out = unique_insert_two_keys(req, ("username", "email"), "seq", ex)
    return {r.seq: r.accepted for r in out.collect()}


def test_two_keys_fixture(spark):
    rows = [(1, "u1", "e1"), (2, "u1", "e2"), (3, "u3", "e2")]
    assert run_two_keys(spark, rows) == {1: True, 2: False, 3: True}
    assert run_two_keys(spark, [(1, "u1", "e1"), (2, "u1", "e2")], [("u9", "e1")]) == {1: False, 2: True}


def test_two_keys_equal_sequential_loop(spark):
    rng = random.Random(3)
    for _ in range(2):
        rows = [(s, f"u{rng.randint(0, 40)}", f"e{rng.randint(0, 40)}") for s in range(200)]
        existing = [(f"u{rng.randint(0, 40)}", f"e{rng.randint(0, 40)}") for _ in range(3)]
        assert run_two_keys(spark, rows, existing) == sequential_two_keys(rows, existing)


def test_snapshots_publish_and_reread(spark, scratch):
    root = f"{scratch}/authors"
    v1 = snapshots.publish(base(spark), root)
    out, _ = fold(spark, snapshots.read_latest(spark, root), [(1, "author", "delete", 1, None)])
    v2 = snapshots.publish(out, root)
    assert (v1, v2) == (1, 2)
    assert sorted(r.id for r in snapshots.read_latest(spark, root).collect()) == [2]


def test_json_rows_source_routes_malformed(spark, scratch):
    path = f"{scratch}/in.json"
    with open(path, "w") as fh:
        fh.write('{"id": 1, "name": "a"}\n{bad\n')
    good, bad = read_json_rows(spark, path, spark.createDataFrame([], "id long, name string").schema)
    assert good.count() == 1 and bad.count() == 1


def test_default_role(spark):
    users = spark.createDataFrame([("a", "a@x.y", None), ("b", "b@x.y", "admin")], "username string, email string, role string")
    assert [r.role for r in C.with_default_role(users).orderBy("username").collect()] == ["user", "admin"]


def test_write_json_sorted_keys_with_nulls(spark, scratch):
    from folio.sources.json_io import write_json
    df = spark.createDataFrame([(1, None, "t")], "id long, author string, title string")
    write_json(df.coalesce(1), f"{scratch}/out")
    lines = [r.value for r in spark.read.text(f"{scratch}/out").collect()]
    assert lines == ['{"author":null,"id":1,"title":"t"}']


def test_content_listing_and_read(spark, scratch):
    import os
    from folio.operators.enrich import content_coverage
    from folio.sources.content import list_content, read_content
    os.makedirs(f"{scratch}/contents/sub")
    for name, data in [("12.pdf", b"%PDF-12"), ("sub/7.pdf", b"%PDF-7"), ("x3.pdf", b"x"), ("5.txt", b"t")]:
        with open(f"{scratch}/contents/{name}", "wb") as fh:
            fh.write(data)
    listing = {r.content_id: r.length for r in list_content(spark, f"{scratch}/contents").collect()}
    assert listing == {12: 7, 7: 6, None: 1}
    books = spark.createDataFrame([(7,), (12,), (99,)], "id long")
    got = {r.id: bytes(r.content) for r in read_content(spark, f"{scratch}/contents", books).collect()}
    assert got == {7: b"%PDF-7", 12: b"%PDF-12"}
    flags = {r.id: r.has_content for r in content_coverage(books, list_content(spark, f"{scratch}/contents")).collect()}
    assert flags == {7: True, 12: True, 99: False}


def test_register_users(spark):
    from folio.operators.users import register_users, role_of
    users = spark.createDataFrame([("admin", "a@x.io", "admin")], "username string, email string, role string")
    req = spark.createDataFrame([
        (1, "u1", "e1@x.io", "p"), (2, "u1", "e2@x.io", "p"), (3, "u3", "e2@x.io", "p"),
        (4, "u4", "a@x.io", "p"), (5, "", "bad", "p"), (6, "u6", "e6@x.io", ""),
    ], "seq long, username string, email string, password string")
    new_users, rejected = register_users(users, req)
    assert sorted((r.username, r.role) for r in new_users.collect()) == [("admin", "admin"), ("u1", "user"), ("u3", "user")]
    reasons = {r.seq: r.reasons for r in rejected.collect()}
    assert reasons[2] == reasons[4] == "username or email already exists"
    assert reasons[5] == "username required; email not an e-mail"
    assert reasons[6] == "password required"
    assert [r.role for r in role_of(new_users, "e2@x.io").collect()] == ["user"]


def test_negative_sequence_numbers(spark):
    out, _ = fold(spark, base(spark), [(-9, "author", "update", 1, body("neg")), (-5, "author", "delete", 2, None)])
    assert {r.id: r.full_name for r in out.collect()} == {1: "neg"}


def _sequential(rows):
    users, mails, accepted = set(), set(), set()
    for seq, u, e in sorted(rows):
        if u not in users and e not in mails:
            users.add(u)
            mails.add(e)
            accepted.add(seq)
    return accepted


def test_two_keys_settle_a_long_chain(spark):
    import time
    from folio.operators.unique import unique_insert_two_keys
    # Every request waits for the one before: u0 e0, u0 e1, u1 e1, u1 e2, ...
    rows = [(k, f"u{k // 2}", f"e{(k + 1) // 2}") for k in range(1000)]
    began = time.time()
    out = unique_insert_two_keys(spark.createDataFrame(rows, "seq long, u string, e string"), ("u", "e"), "seq")
    got = {r.seq for r in out.collect() if r.accepted}
    assert got == _sequential(rows)
    assert time.time() - began < 180


def test_two_keys_by_groups_equal_the_loop(spark):
    import random
    from folio.operators.unique import unique_insert_two_keys
    rng = random.Random(11)
    rows = [(k, f"u{rng.randrange(60)}", f"e{rng.randrange(60)}") for k in range(150)]
    out = unique_insert_two_keys(spark.createDataFrame(rows, "seq long, u string, e string"), ("u", "e"), "seq", rounds_first=1)
    assert {r.seq for r in out.collect() if r.accepted} == _sequential(rows)
