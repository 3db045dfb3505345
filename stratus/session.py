"""Session helpers.

The library never creates machine-local scratch space on a cluster: any
intermediate table or checkpoint goes under the shared folder named by
``spark.checkpoint.dir``.  Only where that setting is absent and the master is
local (tests, the bench) do we pick a temporary folder ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the library's semantics depend on.
REQUIRED_CONF = {
    # Date parts, date truncation and ISO offsets are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
}

# Sensible defaults for a fresh session; a cluster session keeps its own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "stratus", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session configured the way the library expects.

    Master and shuffle partitions are set only if given: under ``spark-submit``
    the cluster's own settings hold.  The driver memory is raised only for a
    local master, where the driver is the executor.
    """
    builder = SparkSession.builder.appName(app_name)
    conf = {**DEFAULT_CONF, **REQUIRED_CONF}
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings results depend on (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder for checkpoints and written tables.

    Reads ``spark.checkpoint.dir`` from the session.  When it is unset, a
    local master gets a fresh temporary folder; any other master is refused,
    as executors would not share one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="stratus-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (never reused)."""
    base = shared_dir(spark)
    return f"{base}/stratus/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the session's Hadoop FileSystem (any scheme: file, hdfs, s3a...)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


# Settings recommended for a large cluster (not applied by the library: a
# cluster session keeps its own).  Shuffle partitions start high and AQE
# coalesces them; skewed joins are split; the dedup stream keeps its state in
# RocksDB so it is not bounded by executor heap.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.session.timeZone": "UTC",
}
