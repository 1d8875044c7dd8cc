"""Shared helpers: stage tables in the cluster's shared folder, ids, schemas."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.session import checkpoint_dir, use_checkpoint_dir


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch folder only
    where the session names none (local tests)."""
    folder = checkpoint_dir(spark)
    if not folder:
        folder = tempfile.mkdtemp(prefix="folio-ckpt-")
        use_checkpoint_dir(spark, fallback=folder)
    return str(folder).rstrip("/")


ROWS_A_FILE = 100_000


def stage(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs its running tasks only, and a
    frame that is used several times is computed once.  ``most``: ``df`` has
    at most so many rows, of ids and numbers only, and is written in no more
    files than these need, however many partitions a shuffle has.
    """
    if most is not None:
        df = df.coalesce(max(1, -(-most // ROWS_A_FILE)))
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/folio-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def digest(*cols: Column) -> Column:
    """128-bit digest of text columns (null and empty differ)."""
    parts = [F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in cols]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of an id written as text, modulo ``n`` (null for a null id)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def bounded_sample(rows: DataFrame, id_col: str, size: int) -> list:
    """About ``size`` rows on the driver, chosen by a hash of their ids (all
    rows where there are fewer).  For fitting classifiers only."""
    total = rows.agg(F.count(F.lit(1))).first()[0]
    cells = 1 << 30
    part = F.pmod(F.xxhash64(F.col(id_col), F.lit(23)), F.lit(cells))
    picked = rows if total <= size else rows.filter(part < int(cells * size / total))
    return picked.collect()
