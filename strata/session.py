"""Session helpers: one place for the settings the engine relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine's semantics depend on (not tuning knobs).
ENGINE_CONF = {
    # Cursor and audit timestamps are TIMESTAMP_NTZ holding UTC; pin the session
    # zone so string <-> timestamp conversions never shift them.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet partition columns are typed by the declared schema, never guessed.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Only the partitions a write touches are replaced (versioned Silver buckets).
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: Compressed shuffle bytes that AQE merges into one task of the sync engine. Its records and ids are so alike
#: that what Spark's default merges (64 MB) is gigabytes of rows in a task's sorts, and one core's work.
TASK_SHUFFLE_BYTES = 1 << 20


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "strata") -> SparkSession:
    """Session for tests, scripts and the bench (local mode)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_engine_conf(spark)
    bound_tasks(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the semantic settings to a session someone else built."""
    for k, v in ENGINE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared cluster session
            pass


def bound_tasks(spark: SparkSession) -> None:
    """Hold AQE's target for merged shuffle partitions at ``TASK_SHUFFLE_BYTES``; a session's lower one stays."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    asked = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    spark.conf.set(name, str(min(asked, TASK_SHUFFLE_BYTES)))


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and engine-written tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system).  Only in local mode (tests, scripts) is a private folder made
    and registered when the session has none; a cluster session must name one.
    """
    sc = spark.sparkContext
    root = None
    try:
        root = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        root = None
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="strata-")
        sc.setCheckpointDir(root)
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:
            pass
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique directory name under the shared root (not created)."""
    return "/".join([shared_root(spark), *parts, uuid.uuid4().hex])


def sf_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")


def size_shuffle(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 128 << 20,
                 expansion: float = 3.0) -> int:
    """Set ``spark.sql.shuffle.partitions`` so a shuffle partition holds about
    ``target_partition_bytes`` of (decoded, ``expansion``-times the Parquet
    size) input, never fewer than two per core.  AQE then coalesces small
    partitions and splits skewed ones from runtime statistics."""
    cores = spark.sparkContext.defaultParallelism
    n = max(2 * cores, int(input_bytes * expansion // target_partition_bytes) + 1)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes // 2))
    return n


def input_size(spark: SparkSession, paths: list[str]) -> int:
    """Total bytes under the given paths (Hadoop file system, any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total
