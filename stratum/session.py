"""Session defaults and shared-storage helpers."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. They are applied only where the session
# leaves them unset, so a cluster's own tuning always wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "stratum") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set library defaults that the session has not set itself."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    # The reference's pipelines are UTC throughout; compared stamps need it.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    A cluster sets it to shared storage and it is always read from the
    session. Only a local-mode session (tests) without one gets a temporary
    folder, which goes with the process; on a cluster a missing setting is an
    error, because a machine-local folder is not visible to the other executors.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="stratum-")  # one process: driver and executor share it
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the shared directory, in the
    application's own scratch folder, which goes when the application ends."""
    root = f"{shared_dir(spark)}/stratum-scratch/{spark.sparkContext.applicationId}"
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        fs.mkdirs(at)
        fs.deleteOnExit(at)
    return f"{root}/{label}-{uuid.uuid4().hex}"
