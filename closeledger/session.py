"""Session helpers.

Library code never creates a session; it takes the caller's.  These
helpers are for tests, the benchmark and small local runs, and for reading
the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
    # Python call-site capture for DataFrame error context costs several
    # py4j round trips per API call while a plan is built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Settings for a large cluster run (1000 executors, a period slice of ~1 TB
# out of a 100 TB ledger).  Shuffle partitions start high and AQE coalesces
# them to ~256 MB; skewed join partitions are split; scan splits are 256 MB.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(master: str = "local[8]", app: str = "closeledger", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that
    they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="closeledger-"), "closeledger")
        shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package))
        spark.sparkContext.addPyFile(f"{archive}.zip")
        _shipped.add(app)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder (``spark.checkpoint.dir``).  Only
    a local-mode session without one (a test run) gets a scratch folder; on a
    cluster a missing setting is an error, never a machine-local folder."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder on shared storage")
        d = tempfile.mkdtemp(prefix="closeledger-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
