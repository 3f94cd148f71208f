"""Session settings the library relies on, and the shared folder for checkpoints, sinks and models."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a caller should have on the session. Nothing here is required for correct results; they are what the
# plans were tuned against: AQE re-plans shuffles at run time (coalesces small partitions, splits skewed join
# partitions even when that needs one more exchange before a following aggregate), and a UTC session time zone makes
# the events adapter's timestamp arithmetic zone free.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # newest-N windows cut rows before the shuffle for any N (Spark's own limit is 1000)
    "spark.sql.optimizer.windowGroupLimitThreshold": str(2**31 - 1),
    "spark.sql.session.timeZone": "UTC",
}


def apply_recommended(spark: SparkSession) -> SparkSession:
    for k, v in RECOMMENDED_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "stridex") -> SparkSession:
    """Session for tests and local benchmarks. On a cluster the caller brings its own session."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints, sink tables and models.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint dir). Only a local-mode session
    without one gets a fresh folder under the system temp dir; a cluster session without it is an error, because
    a machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor shares")
    d = tempfile.mkdtemp(prefix="stridex-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared folder."""
    return f"{shared_dir(spark)}/stridex/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["RECOMMENDED_CONF", "apply_recommended", "local_session", "shared_dir", "scratch_path"]
