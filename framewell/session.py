"""Session construction and the shared work folder.

Library code never invents a scratch location on a cluster: streaming
checkpoints and table versions live under ``spark.checkpoint.dir``, which the
cluster names. Only a local master (tests, bench) may get a private folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "framewell") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    parts = shuffle_partitions or int(os.environ.get("FRAMEWELL_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FRAMEWELL_DRIVER_MEMORY", "16g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")  # = ROCKSDB_PROVIDER
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_dir(spark)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir``; set a private one only when it is unset
    and the master is local (tests). On a cluster an unset value is an error.
    """
    sc = spark.sparkContext
    base = sc.getConf().get(_CKPT_KEY, None)
    if not base:
        try:
            base = spark.conf.get(_CKPT_KEY, None)
        except Exception:  # noqa: BLE001 - conf lookups differ across deploy modes
            base = None
    if not base and sc.getCheckpointDir():
        base = sc.getCheckpointDir()  # set earlier by setCheckpointDir
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="framewell-ckpt-")
        try:
            spark.conf.set(_CKPT_KEY, base)
        except Exception:  # noqa: BLE001
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique folder under the work folder (never reused)."""
    return f"{work_dir(spark)}/{kind}/{uuid.uuid4().hex}"


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ensure_rocksdb_state_store(spark: SparkSession) -> None:
    """Stateful processors with several state variables need the RocksDB
    state store; select it for the session when another one is set. Applies
    to queries started afterwards (a checkpoint keeps its provider)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)
