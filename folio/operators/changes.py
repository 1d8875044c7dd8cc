"""Batches of inserts, full-row replacements and deletes.

The reference changes one row per request.  Here a change log -- rows of
``(seq, entity, op, id, body)`` -- is normalised, checked, and folded into a
new version of each table in one pass of joins and aggregates:

* a delete is terminal: ids come from the store on insert, so a deleted id
  never returns and later updates of it do nothing;
* otherwise the last update of an existing id replaces the whole row (an
  omitted optional field becomes null, an omitted quantity 0);
* an update or delete of an unknown id is a silent no-op;
* inserts get new ids after the largest id, in request order.

Per-id work is a hash aggregate (``max`` of the sequence numbers), so a hot id
collapses to one row per map task before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import values as V
from folio.operators.numbering import assign_ids
from folio.session import shared_checkpoint_dir
from folio.operators.joins import checked_broadcast
from folio.sources.json_io import member, object_entries, parse_whole


@dataclass(frozen=True)
class EntitySpec:
    """A table the change log may target."""

    name: str
    required: tuple[str, ...]            # keys a body must contain (V2)
    fields: dict[str, str]               # body field -> Spark type
    zero_if_absent: tuple[str, ...] = () # data.get(k, 0)
    key: str = "id"

    @property
    def table_columns(self) -> list[str]:
        return [self.key, *self.fields]


# ---------------------------------------------------------------------------
# Request bodies the reference's API accepts per entity.
# ---------------------------------------------------------------------------
BOOK = EntitySpec(
    "book",
    required=("title", "author_id", "category_id"),
    fields={"title": "string", "author_id": "bigint", "category_id": "bigint",
            "published_year": "int", "description": "string", "quantity": "int"},
    zero_if_absent=("quantity",),
)
AUTHOR = EntitySpec("author", required=("full_name",),
                    fields={"full_name": "string", "bio": "string", "birthdate": "date"})
CATEGORY = EntitySpec("category", required=("name",), fields={"name": "string", "description": "string"})
ENTITIES = {spec.name: spec for spec in (BOOK, AUTHOR, CATEGORY)}

OPS = ("insert", "update", "delete")


def _given(text: Column, type_name: str) -> Column:
    """A blank date says nothing (D7); other blanks are values."""
    return V.blank_to_null(text) if type_name == "date" else text


def _typed(text: Column, type_name: str) -> Column:
    if type_name == "string":
        return text
    if type_name == "date":
        return F.try_to_date(text, "yyyy-MM-dd")
    return text.try_cast(type_name)


def normalise_changes(changes: DataFrame, spec: EntitySpec) -> DataFrame:
    """S2 + D7 + V2 on the log rows of one entity.

    Returns ``seq, op, id, <fields>, reasons`` where ``reasons`` is null for
    an accepted change and lists every problem otherwise (malformed body,
    missing required key, value of the wrong type, missing id).  The body is
    parsed once: the members it yields stand behind a generator, which no
    later filter is pushed through.
    """
    rows = changes.filter(F.col("entity") == spec.name)
    names = list(spec.fields)
    parsed = rows.select("seq", "op", F.col("id").cast("bigint").alias("id"),
                         F.inline(F.array(F.struct(parse_whole("body").alias("_parsed")))))
    parsed = parsed.select("seq", "op", "id", object_entries(F.col("_parsed")).alias("_entries"))
    entries = F.col("_entries")
    members = [member(entries, k).alias(f"_m_{k}") for k in names]
    present = parsed.select("seq", "op", "id", entries.isNotNull().alias("_is_obj"), *members).select(
        "seq", "op", "id", "_is_obj",
        *[F.col(f"_m_{k}").isNotNull().alias(f"_has_{k}") for k in names],
        *[_given(F.col(f"_m_{k}")["value"], t).alias(f"_t_{k}") for k, t in spec.fields.items()],
    )
    typed = present.select(
        "*", *[_typed(F.col(f"_t_{k}"), t).alias(f"_v_{k}") for k, t in spec.fields.items()]
    )
    needs_body = F.col("op").isin("insert", "update")
    problems = [
        F.when(~F.col("op").isin(*OPS), F.lit("unknown op")),
        F.when(F.col("op").isin("update", "delete") & F.col("id").isNull(), F.lit("id required")),
        F.when(needs_body & ~F.col("_is_obj"), F.lit("body is not a JSON object")),
    ]
    for k in spec.required:
        problems.append(F.when(needs_body & F.col("_is_obj") & ~F.col(f"_has_{k}"), F.lit(f"{k} missing")))
    fields = []
    for k, type_name in spec.fields.items():
        value = F.col(f"_v_{k}")
        if k in spec.zero_if_absent:
            value = F.when(F.col(f"_has_{k}"), value).otherwise(F.lit(0).cast(type_name))
        fields.append(F.when(needs_body, value).alias(k))
        problems.append(F.when(needs_body & F.col(f"_t_{k}").isNotNull() & F.col(f"_v_{k}").isNull(),
                               F.lit(f"{k} not a {type_name}")))
    # concat_ws skips the nulls of the rules that pass.
    reasons = F.nullif(F.concat_ws("; ", *problems), F.lit(""))
    return typed.select("seq", "op", "id", *fields, reasons.alias("reasons"))


def split_changes(normalised: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted changes, rejected changes with reasons)."""
    ok = normalised.filter(F.col("reasons").isNull()).drop("reasons")
    bad = normalised.filter(F.col("reasons").isNotNull())
    return ok, bad


def route_op(editing_id: Column | str) -> Column:
    """A truthy editing id makes the form an update, else an insert."""
    return V.editing_route(editing_id)


def _one_order(df: DataFrame, order_cols: list[str]) -> Column | None:
    """Time and number in one decimal that orders like both, where that is
    what ``order_cols`` are: microseconds times 2 * 10**19 plus the number."""
    types = [df.schema[c].dataType.typeName() for c in order_cols]
    if len(types) != 2 or types[0] not in ("timestamp", "timestamp_ntz", "date") or types[1] not in ("long", "integer", "short", "byte"):
        return None
    at = F.col(order_cols[0])
    if types[0] == "timestamp":
        micros = F.unix_micros(at)
    else:
        micros = F.unix_date(at.cast("date")).cast("bigint") * 86_400_000_000
        if types[0] == "timestamp_ntz":
            # Taken from its fields, so the session's time zone has no say.
            micros = micros + (F.hour(at) * 3600 + F.minute(at) * 60).cast("bigint") * 1_000_000 + (
                F.date_part(F.lit("SECOND"), at) * 1_000_000).cast("bigint")
    # The factor leaves room for every number once it is moved above 0.
    number = F.col(order_cols[1]).cast("decimal(20,0)") + F.lit(str(2 ** 63)).cast("decimal(20,0)")
    return (micros.cast("decimal(18,0)") * F.lit(str(2 * 10 ** 19)).cast("decimal(20,0)")).cast("decimal(38,0)") + number


def last_per_key(df: DataFrame, key: str, order_cols: list[str], columns: list[str]) -> DataFrame:
    """The row that is largest by ``order_cols`` per ``key``.

    ``order_cols`` together are unique per key and not null.  A time and a
    number are one hash aggregate (``max``; a hot key leaves a map task as one
    row) joined back; other columns one for each.
    """
    last = df.select(key, *order_cols, *columns)
    both = _one_order(df, order_cols)
    orders = [(c, F.col(c)) for c in order_cols] if both is None else [("_order", both)]
    for name, value in orders:
        last = last.withColumn(name, value)
        top = last.groupBy(F.col(key).alias("_key")).agg(F.max(name).alias("_top"))
        last = last.join(top, (F.col(key) == F.col("_key")) & (F.col(name) == F.col("_top"))).drop("_key", "_top")
    return last.select(key, *order_cols, *columns)


def delete_by_key(base: DataFrame, keys: DataFrame, key: str = "id") -> DataFrame:
    """Drop base rows whose key is listed; unknown keys do nothing."""
    ids = keys.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    return base.join(checked_broadcast(ids, measured=keys), key, "left_anti")


def replace_by_key(base: DataFrame, updates: DataFrame, key: str = "id",
                   flag: str | None = None) -> DataFrame:
    """Full-row replace where the key matches (one update per key).

    Every column comes from the update when matched -- a null in the update
    clears the value -- and an update of an unknown key is a no-op.
    """
    cols = [c for c in base.columns if c != key]
    upd = updates.select(F.col(key).alias("_ukey"), *[F.col(c).alias(f"_u_{c}") for c in cols],
                         F.lit(True).alias("_matched"))
    joined = base.join(checked_broadcast(upd), base[key] == upd["_ukey"], "left")
    matched = F.coalesce(F.col("_matched"), F.lit(False))
    out = [base[key]] + [F.when(matched, F.col(f"_u_{c}")).otherwise(base[c]).alias(c) for c in cols]
    if flag:
        out.append(matched.alias(flag))
    return joined.select(*out)


def insert_rows(base: DataFrame, new_rows: DataFrame, order_col: str, key: str = "id") -> DataFrame:
    """D1 + U1: append rows with store-assigned ids (after the largest id, in
    request order)."""
    numbered = assign_ids(new_rows, base, order_col, key)
    return base.unionByName(numbered.select(*base.columns))


def apply_changes(base: DataFrame, accepted: DataFrame, spec: EntitySpec,
                  with_status: bool = False, start_after: int | None = None) -> DataFrame:
    """Fold accepted, normalised changes of one entity into ``base``.

    ``accepted`` has ``seq, op, id`` and the entity's fields; ``seq`` is
    unique.  With ``with_status`` the result keeps ``_created_seq`` and an
    ``updated`` flag.  ``start_after`` (the base's largest id, when known)
    saves a pass over the base.
    """
    key = spec.key
    fields = list(spec.fields)
    base_cols = [key, *fields]
    current = base.select(*base_cols, F.lit(None).cast("long").alias("_created_seq"))
    inserts = accepted.filter(F.col("op") == "insert").select("seq", *fields)
    if not inserts.isEmpty():
        created = assign_ids(inserts, base, "seq", key, start_after=start_after)
        current = current.unionByName(created.select(key, *fields, F.col("seq").alias("_created_seq")))

    # Per id the last delete and the last update (hash aggregates), then the
    # values of that update by its sequence number.
    mods = accepted.filter(F.col("op").isin("update", "delete"))
    last = mods.groupBy(F.col("id").alias("_mod_key")).agg(
        F.max(F.when(F.col("op") == "delete", F.col("seq"))).alias("_deleted_seq"),
        F.max(F.when(F.col("op") == "update", F.col("seq"))).alias("_upd_seq"))
    values = mods.filter(F.col("op") == "update").select(F.col("seq").alias("_value_seq"), F.struct("seq", *fields).alias("_upd"))
    per_id = last.join(values, last["_upd_seq"] == values["_value_seq"], "left").drop("_upd_seq", "_value_seq")

    joined = current.join(checked_broadcast(per_id, measured=mods), current[key] == per_id["_mod_key"], "left")

    def after_creation(seq):
        # A change counts only if it comes after the row exists: base rows
        # (no creation seq) always, inserted rows only for later requests.
        return seq.isNotNull() & (F.col("_created_seq").isNull() | (seq > F.col("_created_seq")))

    deleted = after_creation(F.col("_deleted_seq"))
    updated = after_creation(F.col("_upd.seq"))
    kept = joined.filter(~deleted)
    out = [F.col(key)] + [F.when(updated, F.col("_upd")[c]).otherwise(F.col(c)).alias(c) for c in fields]
    if with_status:
        out += [F.col("_created_seq"), updated.alias("updated")]
    return kept.select(*out)


def reject_changes(changes: DataFrame, entities: list[str]) -> DataFrame:
    """The requests of a mixed log that would be refused, with reasons
    (``entity, seq, op, id, reasons``); nothing is folded."""
    unknown = changes.filter(~F.col("entity").isin(*entities)).select(
        "entity", "seq", "op", F.col("id").cast("bigint").alias("id"), F.lit("unknown entity").alias("reasons"))
    out = unknown
    for name in entities:
        _, bad = split_changes(normalise_changes(changes, ENTITIES[name]))
        out = out.unionByName(bad.select(F.lit(name).alias("entity"), "seq", "op", "id", "reasons"))
    return out


def apply_change_log(tables: dict[str, DataFrame], changes: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Dispatch a mixed log to each entity's table.

    Returns the new version of every table in ``tables`` and all rejected
    changes (``entity, seq, op, id, reasons``).  Each entity's normalised log
    is checkpointed, so bodies are parsed once for the fold and the rejects.
    """
    shared_checkpoint_dir(changes.sparkSession)
    new_tables = {}
    rejected = changes.filter(~F.col("entity").isin(*tables)).select(
        "entity", "seq", "op", F.col("id").cast("bigint").alias("id"), F.lit("unknown entity").alias("reasons"))
    for name, base in tables.items():
        spec = ENTITIES[name]
        ok, bad = split_changes(normalise_changes(changes, spec).checkpoint())
        new_tables[name] = apply_changes(base, ok, spec)
        rejected = rejected.unionByName(bad.select(F.lit(name).alias("entity"), "seq", "op", "id", "reasons"))
    return new_tables, rejected


def with_default_role(users: DataFrame, role_col: str = "role") -> DataFrame:
    """A user inserted without a role gets the default one."""
    if role_col in users.columns:
        return users.withColumn(role_col, F.coalesce(F.col(role_col), F.lit(V.DEFAULT_ROLE)))
    return users.withColumn(role_col, F.lit(V.DEFAULT_ROLE))
