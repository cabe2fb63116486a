"""Session construction and lineage cutting.

``stable(df)`` writes a reliable checkpoint into the directory the cluster
names in ``spark.checkpoint.dir``.  A private directory under /tmp is only
created when the session runs in local mode and nothing was configured
(tests, benchmarks on one machine); on a cluster an unset directory is an
error, because a machine-local folder would not survive executor loss.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, cpus: int | None = None,
                  app: str = "retainspark", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or max(8, cpus * 2)
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, configuring it from
    ``spark.checkpoint.dir`` (or a local-mode default) when needed."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="retainspark-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a reliable checkpoint so later jobs see the same
    partitions and rows even if executors are lost and work is recomputed."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
