"""Two-key inserts settled by links, and existing keys that many rows name."""

import random

import pytest
from pyspark.sql import functions as F

from folio.operators import unique as U
from folio.operators.joins import salted_join


def sequential(rows, existing=()):
    users, mails, accepted = {e[0] for e in existing}, {e[1] for e in existing}, set()
    for seq, u, e in sorted(rows):
        if u is not None and e is not None and u not in users and e not in mails:
            users.add(u)
            mails.add(e)
            accepted.add(seq)
    return accepted


def decided(spark, rows, **more):
    frame = spark.createDataFrame(rows, "seq long, u string, e string")
    return U.unique_insert_two_keys(frame, ("u", "e"), "seq", **more).collect()


def test_chain_of_50000_in_at_most_20_rounds(spark):
    # Every request waits for the one before: u0 e0, u0 e1, u1 e1, u1 e2, ...
    n = 50_000
    rows = spark.range(n).select(F.col("id").alias("seq"), F.concat(F.lit("u"), F.floor(F.col("id") / 2)).alias("u"),
                                 F.concat(F.lit("e"), F.floor((F.col("id") + 1) / 2)).alias("e"))
    out = U.unique_insert_two_keys(rows, ("u", "e"), "seq").select("seq", "accepted", "decided_round").collect()
    assert max(r.decided_round for r in out) <= 20
    assert {r.seq for r in out if r.accepted} == sequential([(k, k // 2, (k + 1) // 2) for k in range(n)])


@pytest.mark.parametrize("rounds", [6, 24])
def test_branching_groups_by_links_rounds_and_walks(spark, monkeypatch, rounds):
    """Keys with many holders branch; what links leave is walked by group or
    goes on.  Every path gives what the loop gives."""
    rng = random.Random(rounds)
    monkeypatch.setattr(U, "GROUP_LIMIT", 12)
    monkeypatch.setattr(U, "LINK_ROUNDS", rounds)
    rows = [(k, f"u{rng.randrange(15)}", f"e{rng.randrange(15)}") for k in range(60)]
    rows += [(k, f"c{(k - 200) // 2}", f"d{(k - 199) // 2}") for k in range(200, 240)]
    rows += [(300 + k, rng.choice([None, "u1", f"x{k}"]), rng.choice([None, "e1", f"y{k % 5}"])) for k in range(30)]
    out = decided(spark, rows, rounds_first=1)
    assert len(out) == len(rows) and {r.seq for r in out if r.accepted} == sequential(rows)


def test_links_alone(spark):
    rng = random.Random(9)
    rows = [(k, f"u{rng.randrange(30)}", f"e{rng.randrange(200)}") for k in range(300)]
    rows += [(k, "hot", f"e{rng.randrange(200)}") for k in range(300, 450)]
    frame = spark.createDataFrame(rows, "_seq long, _k1 string, _k2 string")
    found, left, rounds = U._settle_links(frame, 40)
    assert left.isEmpty() and rounds < 20
    assert {r._seq for r in found.collect() if r._won} == sequential(rows)


def test_salted_join_deals_a_hot_key(spark):
    """A third of the rows on one key and a third without: no task gets three
    times the median."""
    n = 60_000
    rows = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"))
    side = spark.range(0, n, 2).select(F.col("id").cast("string").alias("k"), F.lit(True).alias("hit")).unionByName(
        spark.createDataFrame([("hot", True)], "k string, hit boolean"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(old, ("false", "50", "-1")):
            spark.conf.set(k, v)
        out = salted_join(rows, side, "k")
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        # The plain join for comparison: the hot key and the nulls fill two tasks.
        plain = sorted(r["count"] for r in rows.join(side, "k", "left").groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(sizes) == 50 and sizes[-1] <= 3 * sizes[25] and plain[-1] > 10 * plain[25]
    got = out.agg(F.count(F.lit(1)), F.count_if("hit"), F.count_if(F.col("hit") & (F.col("k") == "hot"))).first()
    evens = sum(1 for i in range(n) if i % 3 == 1 and i % 2 == 0)
    assert tuple(got) == (n, n // 3 + evens, n // 3)


@pytest.mark.parametrize("limit", ["0", "500000"])
def test_existing_hot_keys(spark, limit):
    rng = random.Random(2)
    existing = [(f"u{k}", f"e{k}") for k in range(0, 40, 2)] * 3 + [(None, "e3"), ("u5", None)]
    rows = [(k, rng.choice(["u0", "u0", f"u{rng.randrange(80)}", None]), f"e{rng.randrange(300)}") for k in range(900)]
    spark.conf.set("folio.broadcast.maxRows", limit)
    try:
        out = decided(spark, rows, existing=spark.createDataFrame(existing, "u string, e string"))
        one = U.unique_insert(spark.createDataFrame([r[:2] for r in rows], "seq long, u string"), "u", "seq",
                              spark.createDataFrame(existing, "u string, e string")).collect()
    finally:
        spark.conf.unset("folio.broadcast.maxRows")
    assert {r.seq for r in out if r.accepted} == sequential(rows, existing)
    taken, seen = {e[0] for e in existing}, set()
    assert len(one) == len(rows)
    for r in sorted(one, key=lambda r: r.seq):
        want = "u required" if r.u is None else "u exists" if r.u in taken else "u repeated in batch" if r.u in seen else None
        assert (r.accepted, r.reason) == (want is None, want)
        seen.add(r.u)


def test_existing_side_is_not_shuffled_for_few_requests(spark):
    existing = spark.range(5000).select(F.concat(F.lit("u"), "id").alias("u"))
    requests = spark.createDataFrame([(1, "u17"), (2, "new")], "seq long, u string")
    out = {r.seq: r.reason for r in U.unique_insert(requests, "u", "seq", existing).collect()}
    assert out == {1: "u exists", 2: None}
