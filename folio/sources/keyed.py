"""Tables that a change rewrites in part.

Rows are dealt to folders by their key, either by a hash of it (a fixed number
of folders) or by spans of so many keys (integer keys; new ids then open new
folders and touch none of the old).  A version is one row in ``_versions``
that names, for every folder, the write (``part``) its files come from.  A
change log is mapped to the folders that hold the keys it changes; those are
read, folded and written anew, and every other folder is carried over by name,
unread.  Readers open the folders that the highest version names, so a write
that fails half-way is never seen and no file is ever replaced.

The driver holds one short row per folder and version, never rows or keys; the
number of folders is the layout's choice, e.g. 10,000 spans of 10 million keys
for 10**11 rows.  Small folders do not become small files: ``bundle``
neighbouring folders share a directory, chosen as the table is created so that
there is a directory for about every ``BUNDLE_ROWS`` rows (and a few for small
tables).  A directory read for some of its folders is filtered by them, in
ranges of the key where they are few, else by a join with their numbers; a
change writes only the folders it touches.  Within a directory rows are split
into files of about ``FILE_ROWS`` rows and sorted by key, and columns named in
``bloom`` get Parquet Bloom filters, so a lookup by key opens one directory and
skips the row groups that cannot hold it.

One writer per table is assumed.  A key appears once; a null key is refused.
Superseded folders stay until someone removes them: earlier versions remain
readable and comparable (``differences``).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.utils import AnalysisException

from folio.operators.changes import EntitySpec, apply_changes

VERSIONS = "_versions"
FOLDER = "keyfolder"
FILE_ROWS = 2_000_000
# A directory for about so many rows, but up to so many of a small table.
BUNDLE_ROWS = 250_000
FEW_DIRECTORIES = 32
# Folders are read by ranges of their keys up to so many, else by a join.
MOST_RANGES = 16
VERSIONS_SCHEMA = ("version long, kind string, size long, key string, max_key long, columns string, bloom array<string>, bundle long, "
                   "folders array<struct<folder:bigint,part:string,rows:bigint>>")


@dataclass(frozen=True)
class Layout:
    """``hash``: ``size`` folders; ``span``: folders of ``size`` keys each."""

    kind: str
    size: int
    key: str = "id"

    def __post_init__(self):
        if self.kind not in ("hash", "span") or self.size < 1:
            raise ValueError("a layout is ('hash', folders) or ('span', keys per folder)")

    def folder(self, key: Column) -> Column:
        if self.kind == "hash":
            return F.pmod(F.xxhash64(key), F.lit(self.size)).cast("bigint")
        return F.call_function("div", key - F.pmod(key, F.lit(self.size)), F.lit(self.size)).cast("bigint")

    def file(self, key: Column, files: int) -> Column:
        """Which of a folder's files a key goes to."""
        if self.kind == "hash":
            return F.pmod(F.xxhash64(key, F.lit(7)), F.lit(files)).cast("int")
        return F.floor(F.pmod(key, F.lit(self.size)) * F.lit(files) / F.lit(self.size)).cast("int")


@dataclass(frozen=True)
class Version:
    """What a version names: its layout and the part of every folder."""

    number: int
    layout: Layout
    max_key: int | None
    schema: StructType
    bloom: tuple[str, ...]
    parts: dict[int, tuple[str, int]]      # folder -> (part, rows)
    bundle: int = 1                        # folders that share a directory

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.parts.values())

    def changed_since(self, earlier: Version) -> list[int]:
        """Folders whose files differ between two versions."""
        both = self.parts.keys() | earlier.parts.keys()
        return sorted(f for f in both if self.parts.get(f) != earlier.parts.get(f))


def _root(root: str) -> str:
    return root.rstrip("/")


def version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest published version, or the one of a number."""
    try:
        log = spark.read.schema(VERSIONS_SCHEMA).parquet(f"{_root(root)}/{VERSIONS}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no published version under {root}") from missing
    if number is not None:
        log = log.filter(F.col("version") == number)
    row = log.agg(F.max_by(F.struct("*"), "version").alias("v")).first()["v"]
    if row is None:
        raise FileNotFoundError(f"no version {number} under {root}")
    return Version(row["version"], Layout(row["kind"], row["size"], row["key"]), row["max_key"],
                   StructType.fromJson(json.loads(row["columns"])), tuple(row["bloom"]),
                   {f["folder"]: (f["part"], f["rows"]) for f in row["folders"]}, row["bundle"] or 1)


def _publish(spark: SparkSession, root: str, v: Version) -> Version:
    row = (v.number, v.layout.kind, v.layout.size, v.layout.key, v.max_key, v.schema.json(), list(v.bloom), v.bundle,
           [(f, part, rows) for f, (part, rows) in sorted(v.parts.items())])
    spark.createDataFrame([row], VERSIONS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{_root(root)}/{VERSIONS}")
    return v


def _ranges(folders: list[int]) -> list[tuple[int, int]]:
    """Sorted numbers as stretches without a gap."""
    out: list[tuple[int, int]] = []
    for f in folders:
        if out and out[-1][1] == f - 1:
            out[-1] = (out[-1][0], f)
        else:
            out.append((f, f))
    return out


def _only(rows: DataFrame, layout: Layout, folders: list[int]) -> DataFrame:
    """The rows of some folders, of directories that hold others too."""
    ranges = _ranges(folders)
    key = F.col(layout.key)
    if layout.kind == "span" and len(ranges) <= MOST_RANGES:
        # On the key itself, so that row groups are skipped.
        inside = [(key >= a * layout.size) & (key < (b + 1) * layout.size) for a, b in ranges]
        return rows.filter(reduce(lambda one, other: one | other, inside))
    # One row per folder: the layout's own bound.
    wanted = rows.sparkSession.createDataFrame([(f,) for f in folders], "_wanted bigint")
    return rows.join(F.broadcast(wanted), layout.folder(key) == F.col("_wanted"), "left_semi")


def _folders(spark: SparkSession, root: str, v: Version, folders) -> DataFrame:
    """Rows of some folders of a version."""
    by_part: dict[str, list[int]] = {}
    for f in sorted(folders):
        if f in v.parts:
            by_part.setdefault(v.parts[f][0], []).append(f)
    out = None
    whole: list[str] = []
    for part, held in by_part.items():
        paths = [f"{_root(root)}/{part}/{FOLDER}={d}" for d in sorted({f // v.bundle for f in held})]
        if v.bundle == 1:
            whole += paths
            continue
        rows = _only(spark.read.schema(v.schema).parquet(*paths), v.layout, held)
        out = rows if out is None else out.unionByName(rows)
    if whole:
        return spark.read.schema(v.schema).parquet(*whole)
    return spark.createDataFrame([], v.schema) if out is None else out


def read(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """All rows of the newest version, or of the one of a number."""
    v = version(spark, root, number)
    return _folders(spark, root, v, sorted(v.parts))


def _near(spark: SparkSession, v: Version, keys: DataFrame) -> list[int]:
    """Folders of the table that the keys (column ``_key``) belong to."""
    if not v.parts:
        return []
    known = spark.createDataFrame([(f,) for f in sorted(v.parts)], f"{FOLDER} bigint")
    # One row per folder of the table: the layout's own bound.
    near = keys.select(v.layout.folder(F.col("_key")).alias(FOLDER)).distinct().join(F.broadcast(known), FOLDER, "left_semi")
    return sorted(r[FOLDER] for r in near.collect())


def read_keys(spark: SparkSession, root: str, keys: list) -> DataFrame:
    """the rows of a few keys; only their folders are opened, and the
    keys are pushed to the row groups of their files."""
    v = version(spark, root)
    key, keys = v.layout.key, [k for k in keys if k is not None]
    wanted = spark.createDataFrame([(k,) for k in keys], StructType([StructField("_key", v.schema[key].dataType)]))
    return _folders(spark, root, v, _near(spark, v, wanted)).filter(F.col(key).isin(keys))


def read_matching(spark: SparkSession, root: str, keys: DataFrame, number: int | None = None) -> DataFrame:
    """The rows whose key is in the first column of ``keys``; only the folders
    those keys belong to are opened."""
    v = version(spark, root, number)
    wanted = keys.select(F.col(keys.columns[0]).alias("_key")).filter("_key is not null").distinct()
    rows = _folders(spark, root, v, _near(spark, v, wanted))
    return rows.join(wanted, rows[v.layout.key] == F.col("_key"), "left_semi")


def row_count(spark: SparkSession, root: str) -> DataFrame:
    """``rows`` of the newest version, from what was counted as it was
    written: no file of the table is opened."""
    log = spark.read.schema(VERSIONS_SCHEMA).parquet(f"{_root(root)}/{VERSIONS}")
    newest = log.agg(F.max_by("folders", "version").alias("folders"))
    return newest.select(F.aggregate("folders", F.lit(0).cast("bigint"), lambda n, f: n + f["rows"]).alias("rows"))


def _write(rows: DataFrame, root: str, layout: Layout, bundle: int, bloom: tuple[str, ...], most_rows: int) -> dict[int, tuple[str, int, int | None]]:
    """Write rows as a new part; folder -> (part, rows, largest key)."""
    spark, key = rows.sparkSession, F.col(layout.key)
    part = f"data/{uuid.uuid4().hex}"
    path = f"{_root(root)}/{part}"
    checked = F.when(key.isNull(), F.raise_error(F.lit(f"null key {layout.key}"))).otherwise(_directory(layout.folder(key), bundle))
    files = max(1, -(-most_rows // FILE_ROWS)) if bundle == 1 else 1
    dealt = rows.withColumn(FOLDER, checked).withColumn("_file", layout.file(key, files))
    dealt = dealt.repartition(FOLDER, "_file").sortWithinPartitions(FOLDER, layout.key).drop("_file")
    writer = dealt.write.mode("errorifexists").partitionBy(FOLDER).option("maxRecordsPerFile", 2 * FILE_ROWS)
    for name in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.parquet(path)
    schema = StructType([rows.schema[layout.key]])
    numeric = rows.schema[layout.key].dataType.typeName() in ("long", "integer", "short", "byte")
    top = F.max(layout.key).cast("bigint") if numeric else F.lit(None).cast("bigint")
    # One row per folder written; the key column alone is read back.
    held = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    counts = held.groupBy(layout.folder(key).alias(FOLDER)).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(layout.key).alias("keys"), top.alias("top")).collect()
    for r in counts:
        if r["keys"] != r["rows"]:
            raise ValueError(f"key {layout.key} is not unique in folder {r[FOLDER]}")
    return {r[FOLDER]: (part, r["rows"], r["top"]) for r in counts}


def _directory(folder: Column, bundle: int) -> Column:
    """The directory of a folder: ``folder // bundle``, rounded down."""
    return F.call_function("div", folder - F.pmod(folder, F.lit(bundle)), F.lit(bundle)).cast("bigint")


def _bundle(df: DataFrame, layout: Layout) -> int:
    """How many folders are to share a directory, from the key column."""
    if layout.kind == "hash" and layout.size <= FEW_DIRECTORIES:
        return 1
    held = df.groupBy(layout.folder(F.col(layout.key)).alias(FOLDER)).agg(F.count(F.lit(1)).alias("rows"))
    found = held.agg(F.count(F.lit(1)).alias("folders"), F.sum("rows").alias("rows")).first()
    return max(1, -(-found["folders"] // max(FEW_DIRECTORIES, -(-(found["rows"] or 0) // BUNDLE_ROWS))))


def create(df: DataFrame, root: str, layout: Layout, bloom: tuple[str, ...] = (), rows_per_folder: int = FILE_ROWS,
           bundle: int | None = None) -> Version:
    """Write a table as its first version (or, where there are versions, a
    whole new one).  ``rows_per_folder`` is about what a hash folder holds;
    a span folder holds no more than its span.  ``bundle`` (found from the
    keys where none is given) is how many folders share a directory, e.g.
    that of another table of the same keys."""
    spark = df.sparkSession
    if FOLDER in df.columns:
        raise ValueError(f"column {FOLDER} is the folders' own")
    try:
        number = version(spark, root).number + 1
    except FileNotFoundError:
        number = 1
    most = min(rows_per_folder, layout.size) if layout.kind == "span" else rows_per_folder
    bundle = _bundle(df, layout) if bundle is None else bundle
    written = _write(df, root, layout, bundle, bloom, most)
    tops = [top for _, _, top in written.values() if top is not None]
    return _publish(spark, root, Version(number, layout, max(tops, default=None), df.schema, tuple(bloom),
                                         {f: (part, n) for f, (part, n, _) in written.items()}, bundle))


def _folders_with(spark: SparkSession, root: str, v: Version, keys: DataFrame) -> set[int]:
    """Folders that hold at least one of the keys (column ``_key``).  Only the
    key column of the folders the keys belong to is read."""
    near = _near(spark, v, keys)
    if not near:
        return set()
    of = v.layout.folder(F.col("_key"))
    held = _folders(spark, root, v, near).select(F.col(v.layout.key).alias("_key"))
    hit = held.join(keys.select("_key").distinct(), "_key", "left_semi").select(of.alias(FOLDER)).distinct().collect()
    return {r[FOLDER] for r in hit}


def _next(spark: SparkSession, root: str, v: Version, rows: DataFrame, touched: set[int], max_key: int | None) -> Version:
    """Publish the version in which ``rows`` take the place of ``touched``."""
    if version(spark, root).number != v.number:
        raise RuntimeError(f"{root} has been published by another writer since version {v.number}")
    most = max([v.parts[f][1] for f in touched if f in v.parts], default=0) or (v.layout.size if v.layout.kind == "span" else FILE_ROWS)
    written = _write(rows, root, v.layout, v.bundle, v.bloom, most) if touched else {}
    if not written.keys() <= touched:
        raise RuntimeError("rows outside the folders that are replaced")
    parts = {f: p for f, p in v.parts.items() if f not in touched}
    parts |= {f: (part, n) for f, (part, n, _) in written.items()}
    return _publish(spark, root, Version(v.number + 1, v.layout, max_key, v.schema, v.bloom, parts, v.bundle))


def apply_log(spark: SparkSession, root: str, accepted: DataFrame, spec: EntitySpec) -> Version:
    """D4 on a stored table: fold accepted, normalised changes (as
    ``apply_changes`` takes them) and publish the next version.

    Rewritten are the folders that hold a changed or deleted row and those of
    the new ids; ids go on after the largest the table ever had.
    """
    v = version(spark, root)
    if v.layout.key != spec.key:
        raise ValueError(f"the table is laid out by {v.layout.key}, not {spec.key}")
    top = v.max_key or 0
    n_new = accepted.filter(F.col("op") == "insert").count()
    keys = accepted.filter(F.col("op").isin("update", "delete")).select(F.col("id").alias("_key"))
    touched = _folders_with(spark, root, v, keys)
    if n_new:
        new = spark.range(top + 1, top + n_new + 1).select(v.layout.folder(F.col("id")).alias(FOLDER)).distinct().collect()
        touched |= {r[FOLDER] for r in new}
    base = _folders(spark, root, v, sorted(touched))
    rows = apply_changes(base, accepted, spec, start_after=top).select(*v.schema.names)
    return _next(spark, root, v, rows, touched, top + n_new if n_new else v.max_key)


def merge(spark: SparkSession, root: str, changed: DataFrame | None = None, deleted: DataFrame | None = None) -> Version:
    """Publish the version with whole rows put in the place of those of their
    key (or added) and the rows of ``deleted`` keys gone; a key in both is
    put.  Only the folders concerned are rewritten."""
    v = version(spark, root)
    key = v.layout.key
    gone = None if deleted is None else deleted.select(F.col(key).alias("_key"))
    put = None if changed is None else changed.select(*v.schema.names)
    touched: set[int] = set() if gone is None else _folders_with(spark, root, v, gone)
    top = v.max_key
    if put is not None:
        touched |= {r[FOLDER] for r in put.select(v.layout.folder(F.col(key)).alias(FOLDER)).distinct().collect()}
        new = put.select(F.col(key).alias("_key"))
        gone = new if gone is None else gone.unionByName(new)
        if v.max_key is not None:
            top = max(v.max_key, put.agg(F.max(key)).first()[0] or v.max_key)
    rows = _folders(spark, root, v, sorted(touched))
    if gone is not None:
        rows = rows.join(gone.distinct(), rows[key] == F.col("_key"), "left_anti")
    if put is not None:
        rows = rows.unionByName(put)
    return _next(spark, root, v, rows, touched, top)


def differences(spark: SparkSession, root: str, old: int, new: int) -> DataFrame:
    """What changed from one published version to another.

    ``key, change, before, after``: ``change`` is insert, update or delete,
    ``before`` and ``after`` hold the whole rows (null where there is none).
    Folders that both versions take from the same write are not read.  Rows
    are compared column by column, nulls equal.
    """
    a, b = version(spark, root, old), version(spark, root, new)
    if a.layout != b.layout or a.schema != b.schema:
        raise ValueError(f"versions {old} and {new} of {root} differ in layout or columns")
    folders, key = b.changed_since(a), a.layout.key

    def side(v: Version, name: str) -> DataFrame:
        rows = _folders(spark, root, v, folders)
        return rows.select(F.col(key).alias(f"_{name}"), F.struct(*v.schema.names).alias(name))

    both = side(a, "before").join(side(b, "after"), F.col("_before") == F.col("_after"), "full")
    change = (F.when(F.col("_before").isNull(), F.lit("insert")).when(F.col("_after").isNull(), F.lit("delete"))
              .when(~F.col("before").eqNullSafe(F.col("after")), F.lit("update")))
    return both.select(F.coalesce("_before", "_after").alias(key), change.alias("change"), "before", "after").filter("change is not null")


def apply_differences(spark: SparkSession, root: str, changes: DataFrame) -> Version:
    """Bring another copy of a table up to date with the rows of
    ``differences``."""
    key = version(spark, root).layout.key
    put = changes.filter(F.col("after").isNotNull()).select("after.*")
    gone = changes.filter(F.col("change") == "delete").select(key)
    return merge(spark, root, put, gone)
