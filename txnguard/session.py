"""Session construction and the shared working folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; only a
local master without that setting (tests) gets a fresh temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, app: str = "txnguard",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder
               .master(master or f"local[{cpus}]")
               .appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               # streaming state (dedup, windows, velocity) off-heap in RocksDB, checkpointed as changelogs
               .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
               .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
               .config("spark.driver.memory", os.environ.get("TXNGUARD_DRIVER_MEMORY", "8g")))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship_package(spark)


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package's modules to the Python workers, once per Spark context, so functions that run
    there import it whatever folder the driver was started in."""
    sc = spark.sparkContext
    if not getattr(sc, "_txnguard_shipped", False):
        top = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="txnguard-package-"), "txnguard.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("txnguard", os.path.relpath(full, top)))
        sc.addPyFile(path)
        sc._txnguard_shipped = True
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the folder all executors can see (``spark.checkpoint.dir``).

    Reads the setting from the session; only where it is unset on a local master
    (tests) a fresh temporary folder is created and registered as the checkpoint
    dir. On a cluster an unset folder is an error: executors do not share /tmp.
    """
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="txnguard-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_work_path(spark: SparkSession, label: str) -> str:
    """A unique sub-path of the shared folder for one run's output/checkpoint."""
    return f"{shared_dir(spark)}/txnguard/{label}-{uuid.uuid4().hex[:12]}"
