"""Session helpers: one place that decides Spark settings for tests, bench and entry."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "skein") -> SparkSession:
    """Return the active session or build a local one tuned for small fixtures.

    On a cluster the session already exists (spark-submit) and its settings win;
    we only fill in what is unset.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder
        .master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.constraintPropagation.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SKEIN_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``. Where it is unset a local session (tests) gets a temporary folder; a
    cluster, whose executors could not see one, gets an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="skein-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def wide_plan_guard(spark: SparkSession) -> None:
    """Plans with dozens of aliased window/feature columns behind a multi-column null
    filter make Catalyst's constraint inference explode (minutes of planning). The
    operators that build such plans switch it off for the session; nothing in this
    library relies on inferred filters."""
    if spark.conf.get("spark.sql.constraintPropagation.enabled", "true") != "false":
        spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
