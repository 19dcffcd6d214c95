"""Session helpers: one place that sets the Spark options the engine relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Options every eventmill session needs.  Event times are UTC wall clock, AQE re-plans
# joins and shuffles at run time, and the UI (a web server) stays off.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parquet min/max skipping for the clustered event tables.
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, app: str = "eventmill", conf: dict | None = None) -> SparkSession:
    """Return a session with the engine's settings.

    On a cluster `master` stays None and the launcher's settings win; in tests a local
    master and a small shuffle-partition count are passed in.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**BASE_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_conf(spark)
    return spark


def ensure_session_conf(spark: SparkSession) -> None:
    """Apply the settings that can change at run time on an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by `spark.checkpoint.dir`.

    On a cluster the launcher names a shared (distributed) folder and it is used as is.
    Only when it is unset (local tests) a fresh local folder is created and set.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="eventmill-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run (inputs, sinks, state)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def local_makedirs(path: str) -> None:
    if is_local_path(path):
        os.makedirs(path.replace("file:", ""), exist_ok=True)
