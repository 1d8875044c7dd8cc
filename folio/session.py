"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings every session of the library runs with.  AQE re-plans joins from
# the real shuffle sizes, coalesces small partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints of finished rounds are deleted once unreachable, so the
    # shared checkpoint folder does not grow with every iterative job.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "folio",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is left to ``spark-submit`` when None.  On a cluster the
    checkpoint folder comes from the cluster's ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    use_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the session, if any."""
    value = spark.conf.get(CHECKPOINT_CONF, None)
    if not value:
        value = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not value:
        value = spark.sparkContext.getCheckpointDir()
    return value or None


def use_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Point ``DataFrame.checkpoint`` at the session's shared folder.

    ``fallback`` is used only when the session names none (tests pass a
    scratch folder here; a cluster always names its own).
    """
    folder = checkpoint_dir(spark) or fallback
    if folder and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def require_checkpoint_dir(spark: SparkSession) -> str:
    folder = checkpoint_dir(spark)
    if not folder:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative jobs cut their lineage "
            "with checkpoint() into that shared folder"
        )
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def shared_checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared folder; a scratch folder only where a local
    session names none.  On a cluster a folder of one machine would not be
    seen by the others, so a cluster without one is refused."""
    folder = checkpoint_dir(spark)
    if not folder and not spark.sparkContext.master.startswith("local"):
        return require_checkpoint_dir(spark)
    folder = folder or tempfile.mkdtemp(prefix="folio-ckpt-")
    use_checkpoint_dir(spark, fallback=folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Like ``checkpoint`` this cuts the lineage, but the frame is computed once
    and nothing of its plan (inferred constraints among it, which double with
    every round of an iterative job) goes on.  Stage tables are not deleted.
    """
    spark = df.sparkSession
    path = f"{shared_checkpoint_dir(spark).rstrip('/')}/folio-tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scale_conf(
    input_bytes: int,
    executors: int,
    cores_per_executor: int,
    executor_memory_bytes: int,
    target_partition_bytes: int = 256 * 1024 ** 2,
) -> dict[str, str]:
    """Settings that keep every task's data within its share of executor memory.

    * scans: ``maxPartitionBytes`` = the target, so a 100 TB scan makes about
      400,000 tasks of 256 MB (compressed) each;
    * shuffles: one partition per target of (compressed) input and never
      fewer than two waves of all cores; AQE then coalesces small partitions
      and splits skewed ones around the same size;
    * a task's share of execution memory bounds the target: with less, the
      target shrinks so sorts and hash tables spill rather than fail.
    """
    cores = max(1, executors * cores_per_executor)
    per_task_memory = int(executor_memory_bytes * 0.6 / max(1, cores_per_executor))
    target = max(32 * 1024 ** 2, min(target_partition_bytes, per_task_memory // 2))
    shuffle_partitions = max(2 * cores, int(input_bytes / target))
    return {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }
