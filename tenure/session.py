"""SparkSession helpers.

On a cluster the session comes from the launcher; these helpers only fill in
settings that are unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
    "spark.sql.ansi.enabled": "true",
    # checkpoint files of collected DataFrames are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: str = "*", app: str = "tenure", **conf: str) -> SparkSession:
    """Build (or reuse) a local session with test-friendly defaults."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**_LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting wins.  Only when it is unset (local tests) is a
    scratch folder created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext._jsc.sc().getCheckpointDir()
        configured = configured.get() if configured.isDefined() else None
    if not configured:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="tenure-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured
