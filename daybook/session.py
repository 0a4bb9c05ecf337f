"""Session defaults."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    # Dates are derived from instants in UTC unless a wall clock is asked for.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join keys even where the aggregation after the join then needs a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Once sizes are measured, hash instead of sorting where each partition's share is small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Small literal tables become local relations, which the optimizer can size.
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "daybook", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``fallback`` is used only where the session has no ``spark.checkpoint.dir``; in local mode,
    where one machine is all there is, a temporary folder is set if there is neither.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or fallback
    if not folder and spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="daybook-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not folder:
        raise ValueError("set spark.checkpoint.dir or pass a folder all executors can reach")
    return folder.rstrip("/")
