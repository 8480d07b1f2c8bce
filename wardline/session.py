"""Session construction for tests, the bench and local runs.

Library code never creates or reconfigures a session; it only reads it.  A
cluster job passes its own session (with ``spark.checkpoint.dir`` pointing at
shared storage); this builder is for local runs and sets a checkpoint folder
only when none is configured.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Scale-relevant defaults.  AQE re-plans joins from runtime sizes, coalesces
# small shuffle partitions and splits skewed ones; forcing the skew split lets
# it act even when the join feeds an aggregate on the same key (the extra
# shuffle then runs after partial aggregation has shrunk the hot key).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Base keys filter event scans (over 10 GB, Spark's default) before the shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "wardline", driver_memory: str = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Return the session's checkpoint folder; set one only where none is named.

    A machine-local temporary folder is used only for plain ``local`` masters.
    On a cluster the folder must be shared storage named by the cluster
    (``spark.checkpoint.dir``); without one nothing is set and each reader of a
    stage computes it again.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if fallback is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
        return None
    sc.setCheckpointDir(fallback or tempfile.mkdtemp(prefix="wardline-ckpt-"))
    return sc.getCheckpointDir()
