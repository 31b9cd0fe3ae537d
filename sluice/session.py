"""Session helpers: building a local session for tests and finding the shared staging folder.

The library never builds a session on its own for a job; callers hand one in. Intermediate data that
must outlive a task (staged scans, quarantine files, stream checkpoints) goes under the folder the
cluster names in ``spark.checkpoint.dir``. Only when that setting is missing *and* the master is local
do we pick a folder ourselves, as a test would.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def cluster_conf(total_cores: int, input_bytes: int | None = None, target_partition_mb: int = 256) -> dict[str, str]:
    """Settings sized for a cluster run (pass them to ``spark-submit --conf`` or the session builder).

    * scan splits of ``target_partition_mb`` so a task's input fits comfortably in executor memory;
    * initial shuffle partitions ~ input / target size (at least 3 per core), which AQE then coalesces to
      the advisory size, so small stages do not pay for thousands of tiny tasks;
    * AQE skew handling for joins and rebalances, and a broadcast limit that stays small (broadcasts in this
      library are additionally proven by row counts).
    """
    parts = max(3 * total_cores, 200)
    if input_bytes:
        parts = max(parts, int(input_bytes // (target_partition_mb << 20)) + 1)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.parquet.filterPushdown": "true",
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sluice",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra_conf or {}).items():  # applied last, so they override the defaults above
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate data, read from ``spark.checkpoint.dir``.

    Set on the cluster; set here only if it is unset and the master is local (tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc = spark.sparkContext
        root = sc.getCheckpointDir()
        if not root:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir is not set; a cluster run needs a shared folder")
            root = tempfile.mkdtemp(prefix="sluice-ckpt-")
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir()
    return root.rstrip("/")


def session_key(spark: SparkSession) -> str:
    """A stable id of the running application (works for classic and Connect sessions)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def staging_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder (nothing is created yet)."""
    return "/".join([checkpoint_root(spark), "sluice", *parts, uuid.uuid4().hex])


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme for the few places Python itself touches a local path (tests only)."""
    return path[len("file:"):] if path.startswith("file:") else path


def cut_lineage(df, spark: SparkSession | None = None, name: str = "stage"):
    """Materialise ``df`` as parquet under the shared folder and read it back.

    Used instead of ``localCheckpoint`` so the data survives executor loss.
    """
    spark = spark or df.sparkSession
    path = staging_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


__all__ = ["cluster_conf", "local_session", "session_key", "checkpoint_root", "staging_path", "cut_lineage", "local_fs_path"]
