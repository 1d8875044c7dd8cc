"""Inserts under unique keys.

The reference inserts users one request at a time; an insert fails when its
username or e-mail is already taken by an existing or earlier *accepted* row.
A rejected row takes nothing, so it does not block later rows.

One key: the first request per key wins, unless the key already exists.
That is an aggregate (``min(seq)`` per key, partial on the map side, so a key
held by a third of the rows costs one row per map task) and a join on the
unique ``seq``.  Against existing rows, the requests' distinct keys select the
existing keys that matter (sent to the existing rows where they are counted
few, so those are not shuffled), and the rows meet them in a salted join that
deals a hot key over several tasks.

Two keys: the outcome depends on the order of decisions (A(u1,e1) accepted,
B(u1,e2) rejected, C(u3,e2) accepted).

* Rounds: every undecided row that is first on *both* its keys is accepted --
  the sequential loop would accept it too -- and every undecided row sharing a
  key with a newly accepted one is rejected.  What a few rounds leave waits in
  chains.
* Links: whether a row finds its username taken follows from the row before it
  on that username: taken(r) = taken(p) or not other-taken(p).  Each such
  condition depends on at most two others.  In every round each one takes over
  what its references are by then -- a value, or another condition or its
  negation -- so chains halve as pointers double: a chain of n requests takes
  about log2(n) rounds, and values move into branches as they are found.
* At most ``GROUP_LIMIT`` rows left are walked in order within one aggregate;
  so are, after ``LINK_ROUNDS`` rounds of links, conflict groups (rows connected
  over shared keys) of that size.  Larger groups that branch so deeply go on in
  links, a level of the branches at least each round.

Every round's state is written into the shared folder named by
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.operators.joins import checked_broadcast, salted_join
from folio.operators.numbering import number_rows
from folio.session import shared_checkpoint_dir, stage


def key_digest(c: Column | str) -> Column:
    """A 40-byte stand-in for a long text key: SHA-256 of its UTF-8 bytes plus
    its length.  Grouping on it moves 40 bytes per key through the shuffle
    instead of the whole text; two different texts share it with probability
    about 2**-256."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.concat(F.sha2(c, 256), F.lit(":"), F.length(c).cast("string")))


def _with_taken(rows: DataFrame, existing_keys: DataFrame, key: str, flag: str) -> DataFrame:
    """``rows`` plus ``flag``: whether ``key`` is among the existing keys (a
    frame with that column, repeats and nulls allowed)."""
    # Both are cut here: the counts are read three times, and the join below
    # has a plain shuffle on either side.
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    counts = stage(counts, "key-counts")
    asked = counts.select(F.col(key).alias("_asked"))
    on_file = existing_keys.select(F.col(key)).where(F.col(key).isNotNull())
    taken = on_file.join(checked_broadcast(asked), on_file[key] == asked["_asked"], "left_semi").distinct()
    taken = stage(taken, "keys-taken")
    out = salted_join(rows, taken.withColumn(flag, F.lit(True)), key, counts)
    return out.withColumn(flag, F.coalesce(flag, F.lit(False)))


def unique_insert(requests: DataFrame, key: str, order_col: str,
                  existing: DataFrame | None = None, digest: bool = False) -> DataFrame:
    """All request rows plus ``accepted`` and ``reason`` (null when accepted).

    ``order_col`` must be unique (the request sequence).  ``digest`` groups
    long text keys by ``key_digest`` instead of the text itself.
    """
    def stand_in(name: str) -> Column:
        return key_digest(name) if digest else F.col(name)

    # What the joins need of the key is computed before them, so a long key
    # is not carried along unless the caller reads it.
    rows = requests.withColumns({"_key_null": F.col(key).isNull(), "_gkey": stand_in(key)})
    if existing is None:
        rows = rows.withColumn("_exists", F.lit(False))
    else:
        shared_checkpoint_dir(requests.sparkSession)
        # The flags travel by the sequence number, without the requests' rest.
        flags = _with_taken(rows.select(F.col(order_col).alias("_flag_seq"), "_gkey"), existing.select(stand_in(key).alias("_gkey")), "_gkey", "_exists")
        rows = rows.join(flags.where("_exists").select("_flag_seq", "_exists"), F.col(order_col) == F.col("_flag_seq"), "left")
        rows = rows.withColumn("_exists", F.coalesce("_exists", F.lit(False))).drop("_flag_seq")
    firsts = rows.where(~F.col("_key_null") & ~F.col("_exists")).groupBy("_gkey").agg(F.min(order_col).alias("_first"))
    winners = firsts.select(F.col("_first").alias("_win_seq"), F.lit(True).alias("_won"))
    joined = rows.join(winners, rows[order_col] == winners["_win_seq"], "left")
    won = F.coalesce(F.col("_won"), F.lit(False))
    reason = (
        F.when(F.col("_key_null"), F.lit(f"{key} required"))
        .when(won, F.lit(None).cast("string"))
        .when(F.col("_exists"), F.lit(f"{key} exists"))
        .otherwise(F.lit(f"{key} repeated in batch"))
    )
    return joined.select(*requests.columns, won.alias("accepted"), reason.alias("reason"))


# Rounds before links, rounds of links before groups are walked, and the rows
# that are walked as one list.
ROUNDS_FIRST = 2
LINK_ROUNDS = 24
GROUP_LIMIT = 2_000


def _conflict_groups(rows: DataFrame) -> DataFrame:
    """``rows(_seq, _k1, _k2)`` plus ``_g``: the smallest ``_seq`` reachable
    over shared keys.

    Each pass takes the smallest label of both keys' holders and then the
    label of the request that label names, so a chain's labels travel twice as
    far with every pass: about log2(chain) passes, each staged.
    """
    current = rows.withColumn("_g", F.col("_seq"))
    while True:
        by1 = current.groupBy("_k1").agg(F.min("_g").alias("_g1"))
        by2 = current.groupBy("_k2").agg(F.min("_g").alias("_g2"))
        step = current.join(by1, "_k1").join(by2, "_k2").withColumn("_n", F.least("_g1", "_g2"))
        named = step.select(F.col("_seq").alias("_named"), F.col("_n").alias("_up"))
        step = step.join(named, step["_n"] == named["_named"]).select(
            "_seq", "_k1", "_k2", "_g", F.least("_n", "_up").alias("_n"))
        step = stage(step, "groups")
        current = step.select("_seq", "_k1", "_k2", F.col("_n").alias("_g"))
        if step.filter(F.col("_n") != F.col("_g")).isEmpty():
            return current


def _walk_groups(grouped: DataFrame) -> DataFrame:
    """``(_seq, _won)`` for whole conflict groups, each walked in order."""
    types = dict(grouped.dtypes)
    empty = {k: F.array().cast(f"array<{types[k]}>") for k in ("_seq", "_k1", "_k2")}
    start = F.struct(empty["_k1"].alias("u1"), empty["_k2"].alias("u2"), empty["_seq"].alias("won"))

    def take(state, row):
        taken = F.array_contains(state["u1"], row["_k1"]) | F.array_contains(state["u2"], row["_k2"])
        more = F.struct(F.array_append(state["u1"], row["_k1"]).alias("u1"), F.array_append(state["u2"], row["_k2"]).alias("u2"),
                        F.array_append(state["won"], row["_seq"]).alias("won"))
        return F.when(taken, state).otherwise(more)

    lists = grouped.groupBy("_g").agg(F.sort_array(F.collect_list(F.struct("_seq", "_k1", "_k2"))).alias("_rows"))
    walked = lists.withColumn("_won", F.aggregate("_rows", start, take, lambda state: state["won"]))
    return walked.select(F.explode("_rows").alias("_row"), "_won").select(
        F.col("_row._seq").alias("_seq"), F.array_contains("_won", F.col("_row._seq")).alias("_won"))


def _previous(rows: DataFrame, key: str) -> DataFrame:
    """``_seq, _prev``: the row before each one on ``key``.  Rows are numbered
    in the order of (key, seq) by range partitioning and meet their neighbour
    by number, so a hot key is cut like any other stretch."""
    numbered = number_rows(rows.select(key, "_seq"), key, "_no", tie_breakers=["_seq"])
    before = numbered.select(F.col(key).alias("_of"), F.col("_seq").alias("_prev"), (F.col("_no") + 1).alias("_next"))
    met = numbered.join(before, (F.col("_no") == F.col("_next")) & (F.col(key) == F.col("_of")), "left")
    return met.select("_seq", "_prev")


def _conditions(rows: DataFrame) -> DataFrame:
    """One row ``_id, _x, _nx, _y, _ny, _is`` for each row and key.

    ``_id`` is 2 * seq for "the first key is taken before this row" and one
    more for the second key.  The condition holds if condition ``_x`` (not, if
    ``_nx``) or ``_y`` (not, if ``_ny``) does; a null reference is none.
    ``_is`` is the value once it is known.
    """
    out = None
    for side, key in enumerate(("_k1", "_k2")):
        linked = _previous(rows, key)
        own, other = 2 * F.col("_prev") + side, 2 * F.col("_prev") + (1 - side)
        part = linked.select(
            (2 * F.col("_seq") + side).alias("_id"), own.alias("_x"), F.lit(False).alias("_nx"), other.alias("_y"), F.lit(True).alias("_ny"),
            F.when(F.col("_prev").isNull(), F.lit(False)).alias("_is"))
        out = part if out is None else out.unionByName(part)
    return out


def _follow_links(conditions: DataFrame) -> DataFrame:
    """One round: every open condition takes over what its references are."""
    done = conditions.where(F.col("_is").isNotNull())
    open_ = conditions.where(F.col("_is").isNull())
    for ref, neg in (("_x", "_nx"), ("_y", "_ny")):
        # Of a condition with two references the reference stays.
        seen = conditions.select(
            F.col("_id").alias("_ref"), F.col("_is").alias("_value"),
            F.when(F.col("_is").isNull() & F.col("_y").isNull(), F.col("_x")).alias("_to"), F.col("_nx").alias("_turn"))
        open_ = open_.join(seen, open_[ref] == seen["_ref"], "left").withColumns({
            f"{ref}_is": F.col("_value") != F.col(neg),
            neg: F.when(F.col("_to").isNotNull(), F.col(neg) != F.col("_turn")).otherwise(F.col(neg)),
            ref: F.when(F.col("_value").isNull(), F.coalesce("_to", ref)),
        }).drop("_ref", "_value", "_to", "_turn")
    same = F.col("_x") == F.col("_y")
    value = (F.when(F.col("_x_is") | F.col("_y_is"), F.lit(True))
             .when(F.col("_x").isNull() & F.col("_y").isNull(), F.lit(False))
             .when(same & (F.col("_nx") != F.col("_ny")), F.lit(True)))
    # What is left of one reference only stands in _x.
    first = F.col("_x").isNotNull()
    settled = open_.select(
        "_id", F.coalesce("_x", "_y").alias("_x"), F.when(first, F.col("_nx")).otherwise(F.col("_ny")).alias("_nx"),
        F.when(first & ~F.coalesce(same, F.lit(False)), F.col("_y")).alias("_y"), "_ny", value.alias("_is"))
    return stage(done.unionByName(settled), "links")


def _settle_links(rows: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame, int]:
    """(``_seq, _won`` of the rows that links decide, the rows left, rounds)."""
    conditions = stage(_conditions(rows), "links")
    number = 0
    while number < rounds and not conditions.where(F.col("_is").isNull()).isEmpty():
        conditions = _follow_links(conditions)
        number += 1
    # A row is accepted where neither key is taken; it is refused by either.
    known = conditions.groupBy(F.shiftright("_id", 1).alias("_seq")).agg(
        F.max(F.coalesce("_is", F.lit(False))).alias("_taken"), F.count("_is").alias("_known"))
    decided = known.where(F.col("_taken") | (F.col("_known") == 2)).select("_seq", (~F.col("_taken")).alias("_won"))
    decided = stage(decided, "links-decided")
    # Rows whose conditions have not caught up yet: a key of an accepted row is
    # taken, also from rows before it (it could not be accepted otherwise).
    won = rows.join(decided.where("_won"), "_seq", "left_semi")
    marked = rows.join(decided, "_seq", "left_anti").join(won.select("_k1", F.lit(True).alias("_t1")), "_k1", "left").join(
        won.select("_k2", F.lit(True).alias("_t2")), "_k2", "left")
    marked = stage(marked.select("_seq", "_k1", "_k2", (F.col("_t1").isNotNull() | F.col("_t2").isNotNull()).alias("_late")), "links-left")
    late = marked.where("_late").select("_seq", F.lit(False).alias("_won"))
    return decided.unionByName(late), marked.where("NOT _late").select("_seq", "_k1", "_k2"), number


def unique_insert_two_keys(requests: DataFrame, keys: tuple[str, str], order_col: str,
                           existing: DataFrame | None = None, max_rounds: int | None = None,
                           rounds_first: int = ROUNDS_FIRST) -> DataFrame:
    """``requests`` plus ``accepted`` and ``decided_round``, equal to the
    sequential one-by-one insert.  ``order_col`` must be unique (the request
    sequence, an integer); rows with a missing key are rejected.  Each round
    is cut into the shared folder named by ``spark.checkpoint.dir``."""
    shared_checkpoint_dir(requests.sparkSession)

    def cut(df: DataFrame) -> DataFrame:
        return stage(df, "unique-round")

    k1, k2 = keys
    rows = requests.select(F.col(order_col).alias("_seq"), F.col(k1).alias("_k1"), F.col(k2).alias("_k2"))

    # Round 0: rows with a missing key or a key already taken are rejected.
    bad = F.col("_k1").isNull() | F.col("_k2").isNull()
    if existing is not None:
        for key, own, flag in ((k1, "_k1", "_t1"), (k2, "_k2", "_t2")):
            rows = _with_taken(rows, existing.select(F.col(key).alias(own)), own, flag)
        bad = bad | F.col("_t1") | F.col("_t2")
    rows = cut(rows.select("_seq", "_k1", "_k2", bad.alias("_bad")))
    decided = rows.filter("_bad").select("_seq", F.lit(False).alias("accepted"), F.lit(0).alias("decided_round"))
    undecided = rows.filter(~F.col("_bad")).select("_seq", "_k1", "_k2")

    round_no = 0
    parts = [decided]

    def settle(found: DataFrame, rounds: int = 1) -> None:
        nonlocal round_no
        round_no += rounds
        if max_rounds is not None and round_no > max_rounds:
            raise RuntimeError(f"unique insert did not settle in {max_rounds} rounds")
        parts.append(found.select("_seq", F.col("_won").alias("accepted"), F.lit(round_no).alias("decided_round")))

    while True:
        left = undecided.count()
        if left == 0:
            break
        if left <= GROUP_LIMIT:
            settle(cut(_walk_groups(undecided.withColumn("_g", F.lit(0)))))
            break
        if round_no < max(rounds_first, 1):
            round_state = cut(_round(undecided))
            settle(round_state.filter(F.col("_won").isNotNull()))
            undecided = round_state.filter(F.col("_won").isNull()).select("_seq", "_k1", "_k2")
            continue
        found, undecided, rounds = _settle_links(undecided, LINK_ROUNDS)
        settle(found, rounds)
        if not undecided.isEmpty():
            grouped = _conflict_groups(undecided)
            small = grouped.groupBy("_g").count().filter(F.col("count") <= GROUP_LIMIT).select("_g")
            settle(cut(_walk_groups(grouped.join(small, "_g", "left_semi"))))
            undecided = cut(grouped.join(small, "_g", "left_anti").select("_seq", "_k1", "_k2"))

    outcome = parts[0]
    for p in parts[1:]:
        outcome = outcome.unionByName(p)
    return requests.join(outcome.withColumnRenamed("_seq", order_col), order_col, "left")


def _round(undecided: DataFrame) -> DataFrame:
    """``undecided`` plus ``_won``: true for rows that are first on both their
    keys, false for others that share a key with one of those, else null."""
    first1 = undecided.groupBy("_k1").agg(F.min("_seq").alias("_seq"))
    first2 = undecided.groupBy("_k2").agg(F.min("_seq").alias("_seq"))
    won_seq = first1.select("_seq").join(first2.select("_seq"), "_seq").select("_seq", F.lit(True).alias("_first"))
    won = undecided.join(won_seq.select("_seq"), "_seq", "left_semi")
    # Winners hold distinct keys, so these joins never fan out.
    taken1 = won.select("_k1", F.lit(True).alias("_t1"))
    taken2 = won.select("_k2", F.lit(True).alias("_t2"))
    marked = undecided.join(won_seq, "_seq", "left").join(taken1, "_k1", "left").join(taken2, "_k2", "left")
    return marked.select("_seq", "_k1", "_k2", F.when(F.col("_first"), F.lit(True)).when(F.col("_t1") | F.col("_t2"), F.lit(False)).alias("_won"))
