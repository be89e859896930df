"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on. Shuffle width and executor sizes belong to the cluster, not to this package.
SESSION_CONF = {
    # every hour and date in the result tables is a UTC hour or date
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # lets AQE cut a hot (date, type) partition into several files instead of one long task
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # a repeated JSON key keeps its last value, as the event producers' own parser does
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings that only count when a session is created.
STARTUP_CONF = {
    "spark.ui.enabled": "false",
    # recording the Python call site of every column expression costs more than planning these queries
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "wardlight", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**STARTUP_CONF, **SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to a session that somebody else built."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Executors on other machines must see the path, so a local temporary folder is only accepted in local mode.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="wardlight-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/wardlight/{purpose}-{uuid.uuid4().hex}"
