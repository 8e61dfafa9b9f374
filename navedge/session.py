"""Session construction and shared scratch locations.

Scratch data (staged text files, stream checkpoints, snapshot tables) always
lives under the directory the cluster names in ``spark.checkpoint.dir``: on a
cluster that is a shared filesystem (HDFS, object store), so a lost executor
or a restarted driver finds it again. Only when the setting is absent (local
runs, tests) do we create one, under the system temp directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job needs whatever the scale. Sizes that depend on the cluster
# (shuffle partitions, executor memory) are left to the caller / spark-submit.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Aggregation state of the streaming queries grows with the number of
    # distinct edges; RocksDB keeps it off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit a changelog per batch instead of uploading a full snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, app: str = "navedge",
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; set one only if unset."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: scratch data and stream "
                               "checkpoints must survive the loss of any one machine")
        root = tempfile.mkdtemp(prefix="navedge-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/navedge/{name}-{uuid.uuid4().hex[:12]}"


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
               scan_split_bytes: int = 512 << 20) -> dict[str, str]:
    """Settings sized from the input, for ``spark-submit --conf`` on a cluster.

    Shuffle partitions start at about ``input / target`` (at least 2 per
    core); adaptive execution then coalesces small ones toward the advisory
    size, and splits skewed join partitions. Larger scan splits cut the task
    count of a 100 TB scan to about 200k.
    """
    parts = max(2 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
    }
