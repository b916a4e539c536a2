"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale.  shuffle.partitions is sized for the
# machine at hand; on a cluster set it to ~ (shuffle bytes / 128 MB) and let
# AQE coalesce small partitions and split skewed ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    master: str | None = None,
    app: str = "headway",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the library's defaults; existing settings on a cluster are kept."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured is a folder of our own installed: ``fallback``
    if given (tests), else a fresh scratch folder when the master is local (one
    machine, so its temp folder is the shared one).  On a cluster with nothing
    configured, None is returned.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not fallback and spark.sparkContext.master.startswith("local"):
        fallback = tempfile.mkdtemp(prefix="headway-ckpt-")
    if fallback:
        spark.sparkContext.setCheckpointDir(fallback)
        return spark.sparkContext.getCheckpointDir() or fallback
    return None


def materialize(
    df: DataFrame, name: str, spark: SparkSession | None = None, folder: str = "headway", compression: str | None = None
) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts lineage for a table that several jobs reuse, and survives executor
    loss (the files live in shared storage).  A cluster must name that folder in
    ``spark.checkpoint.dir``; without one this raises.
    """
    spark = spark or df.sparkSession
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = os.path.join(str(base), folder, f"{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` through the Hadoop file system (any cluster storage)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True))


def run_folder(spark: SparkSession, run_id: str) -> str | None:
    base = ensure_checkpoint_dir(spark)
    return os.path.join(str(base), "headway", run_id) if base else None


TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the given files or folders (Hadoop file system content summary)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def cluster_conf(fact_bytes: int, cores: int, target_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Settings sized from the incident log's bytes on disk.

    Shuffle partitions ~ fact bytes / target (the fact table is the only input
    that shuffles before aggregation), never below twice the cores; AQE then
    coalesces small partitions and splits skewed ones at the same target size.
    """
    parts = max(2 * cores, -(-fact_bytes // target_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)
