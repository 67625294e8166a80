"""Session helpers.

Cluster jobs take the session they are given.  ``get_spark`` exists for
tests, the bench and local runs: it pins the settings the oracle compare
needs (UTC, ANSI) and sets a checkpoint directory only when none is set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewatch",
              extra_conf: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a scratch one only if unset."""
    cur = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if cur:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(cur)
        return cur
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    base = base[len("file:"):] if base.startswith("file:") and not base.startswith("file://") else base
    return os.path.join(base, "tidewatch", f"{name}-{uuid.uuid4().hex[:12]}")


def stage_table(df, name: str):
    """Materialise ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage so a lost executor re-reads the written table instead of
    recomputing an expensive upstream plan.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
