"""Session construction and shared scratch space.

On a cluster the session already exists and ``spark.checkpoint.dir`` names
a shared folder; we read it and never substitute a machine-local one.  Only
when it is unset (local tests) do we create a temporary folder for it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that shape plans; applied by ``get_session`` only.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for a large cluster (≈100 TB of ticks, ~1000 executors).  Pass
# them at submit time or through ``get_session(extra=CLUSTER_CONF)``.  AQE
# starts from many shuffle partitions and coalesces them to the advisory
# size, splits skewed join and rebalance partitions, and 512 MiB input
# splits keep map tasks few but within executor memory.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32768",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.shuffle.partitions": "32768",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.files.openCostInBytes": "8m",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str = "local[8]", app: str = "quotelake",
                shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests) gets a temporary folder when it is
    unset; on a cluster executors cannot see a machine-local folder, so an
    unset value is an error there.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None)
    if not cur:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        cur = tempfile.mkdtemp(prefix="quotelake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(cur)
    return sc.getCheckpointDir() or cur


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/quotelake-scratch/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the Hadoop file system of the path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True))


def hadoop_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def local_path(path: str) -> str:
    """Strip a file: scheme so Python can use a local path in tests."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
