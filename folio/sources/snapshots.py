"""Versioned table snapshots (S5 write with commit, S6 re-read after write).

Plain Parquet tables cannot be updated in place, and a table must not be
overwritten while it is being read.  A change therefore writes the next
version into a new folder; only after that write job has committed is the
version published by appending one row to the table's ``_versions`` log.
Readers open the highest published version, so they never see a partial
write, and a failed or retried job leaves no published trace.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

VERSIONS = "_versions"
# What a table without any published version raises.
MISSING = ("PATH_NOT_FOUND",)
VERSIONS_SCHEMA = "version long, path string, max_key long"


def _root(root: str) -> str:
    return root.rstrip("/")


def _versions(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(VERSIONS_SCHEMA).parquet(f"{_root(root)}/{VERSIONS}")
    except AnalysisException as missing:
        if missing.getCondition() not in MISSING:
            raise
        return None


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("x int").parquet(path)
        return True
    except AnalysisException as missing:
        if missing.getCondition() not in MISSING:
            raise
        return False


def latest_entry(spark: SparkSession, root: str) -> dict | None:
    """``{version, path, max_key}`` of the newest published version."""
    log = _versions(spark, root)
    if log is None:
        return None
    row = log.agg(F.max_by(F.struct("version", "path", "max_key"), "version").alias("v")).first()["v"]
    return row.asDict() if row else None


def latest_version(spark: SparkSession, root: str) -> tuple[int, str] | None:
    entry = latest_entry(spark, root)
    return (int(entry["version"]), entry["path"]) if entry else None


def publish(df: DataFrame, root: str, version: int | None = None,
            key: str | None = "id") -> int:
    """Write ``df`` as a new version under ``root`` and publish it.

    Returns the version number.  An existing version folder is never
    overwritten once published.  One writer per table is assumed.  When the
    table has ``key``, its largest value is recorded with the version (read
    from the written files, one column), so new ids can be assigned later
    without scanning the table.
    """
    spark = df.sparkSession
    current, version_given = latest_version(spark, root), version
    if version is None:
        version = (current[0] + 1) if current else 1
    elif current and version <= current[0]:
        raise ValueError(f"version {version} is not after the published version {current[0]}")
    path = f"{_root(root)}/v{version:010d}"
    # A folder that exists may be another writer's version: it is never
    # replaced.  Leftovers of a failed attempt are passed over by number.
    while version_given is None and _exists(spark, path):
        version += 1
        path = f"{_root(root)}/v{version:010d}"
    df.write.mode("errorifexists").parquet(path)
    max_key = None
    if key and key in df.columns:
        value = spark.read.parquet(path).agg(F.max(key)).first()[0]
        max_key = int(value) if value is not None else None
    entry = spark.createDataFrame([(version, path, max_key)], VERSIONS_SCHEMA)
    entry.coalesce(1).write.mode("append").parquet(f"{_root(root)}/{VERSIONS}")
    return version


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The newest published version (S6: always re-read, never a stale cache)."""
    latest = latest_version(spark, root)
    if latest is None:
        raise FileNotFoundError(f"no published version under {root}")
    return spark.read.parquet(latest[1])
