"""Session construction and shared scratch locations."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a generated method above 8000 bytes is never JIT-compiled by the JVM;
    # fall back to per-operator code for such stages instead of interpreting it
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # streaming state off the JVM heap (keys can number in the millions), with
    # incremental changelog checkpoints instead of full snapshots per batch
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # an executor has a store for each of its partitions, and each could take 128 MB beside the heap before it writes
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    # checkpoint files go when nothing refers to them any more (one merge per micro-batch)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8,
              app: str = "skyroute", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every job here assumes."""
    conf = {"spark.sql.shuffle.partitions": str(shuffle_partitions), **(extra or {})}
    return _built(SparkSession.builder.master(master).appName(app), conf)


def cluster_session(app: str) -> SparkSession:
    """The session that ``spark-submit`` configures, with the settings every job here assumes.

    The package is sent to the executors, so nothing has to be installed there.
    """
    spark = _built(SparkSession.builder.appName(app), {})
    if not is_local(spark.sparkContext.master):
        ship_package(spark)
    return spark


def _built(builder: SparkSession.Builder, conf: dict) -> SparkSession:
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def small_methods(spark: SparkSession) -> None:
    """Keep generated methods small enough to be compiled, in sessions that were not built here too.

    Typing a flight takes a method beyond ``hugeMethodLimit``, which the JVM would interpret for every row.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > int(DEFAULT_CONF[key]):
        spark.conf.set(key, DEFAULT_CONF[key])


def state_off_heap(spark: SparkSession) -> None:
    """Keep streaming state off the executors' heap in sessions that were not built here too, if they leave it to Spark.

    Spark's own store holds every key of the state as an object, and the map of keys once more for each version.
    A query that goes on from a checkpoint keeps the store that it began with.
    """
    prefix = "spark.sql.streaming.stateStore."
    if spark.conf.get(prefix + "providerClass").endswith(".HDFSBackedStateStoreProvider"):
        for key, value in DEFAULT_CONF.items():
            if key.startswith(prefix):
                spark.conf.set(key, value)


def ship_package(spark: SparkSession) -> None:
    """Send this package to all executors as a zip file."""
    package = Path(__file__).resolve().parent
    with tempfile.TemporaryDirectory() as d:
        archive = shutil.make_archive(f"{d}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)


def is_local(master: str) -> bool:
    """One JVM: driver and executors share their folders."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting gets one of our own; on a cluster a folder of one
    machine would be lost to the others, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not is_local(sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="skyroute-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for one run."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/skyroute/{name}-{uuid.uuid4().hex[:12]}"
