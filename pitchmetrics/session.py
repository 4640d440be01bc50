"""Session settings the jobs rely on, and the shared checkpoint folder.

Only runtime SQL settings are touched; cluster sizing (executors, memory) is the
deployer's.  On a cluster, ``spark.sql.shuffle.partitions`` should be sized so a
shuffle partition is ~128-256 MB at the target scale; AQE then coalesces small
ones and splits skewed join partitions at run time.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def configure(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    conf = spark.conf
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    conf.set("spark.sql.session.timeZone", "UTC")
    conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    if shuffle_partitions:
        conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).  Only a local
    master may go without: there a scratch folder is made and registered."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pitchmetrics-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d


def local_session(cores: int = 8, app: str = "pitchmetrics") -> SparkSession:
    """A local session for tests and the benchmark (no UI, UTC, AQE on)."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call sites for every column
             .config("spark.sql.shuffle.partitions", str(cores))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
