"""Session helpers: a local session for tests and benchmarks, and the shared
scratch location taken from the session's checkpoint directory."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on; a cluster deployment sets them in its own
# spark-defaults, tests and the benchmark set them here.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit only the state changes of each micro-batch (smaller, faster checkpoints)
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vigil",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("VIGIL_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; only when it is unset (local runs
    and tests) a fresh local folder is created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
        sc = None
    if sc is not None:
        d = sc.getCheckpointDir()
        if d:
            return d
        d = sc.getConf().get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local"):  # executors would not share a folder of the driver's machine
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            d = tempfile.mkdtemp(prefix="vigil-ckpt-")
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/vigil/{name}-{uuid.uuid4().hex[:12]}"


#: Shuffle partitions to a file, for tables of a few rows of numbers for each document, and for those of one or fewer.
BROAD, NARROW = 8, 32


def materialize(df, name: str, share: int = 1):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return the re-read table.  Cuts lineage (a lost executor re-runs only
    the scan) and lets several downstream plans share one computation.

    ``share``: shuffle partitions are sized for the widest rows of a job.  A
    table of narrow rows has one file for that many of them, and one a core
    (two where tables are broad) at least: each file costs requests, and on a
    local disk without Hadoop's native library a ``chmod`` forked from the
    executor, which counts twice in memory until it starts.
    """
    spark = df.sparkSession
    if share > 1:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        cores = spark.sparkContext.defaultParallelism
        df = df.coalesce(max(cores * (1 if share >= NARROW else 2), -(-partitions // share)))
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
