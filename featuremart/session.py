"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Size tasks from what the shuffles measured, and split partitions that are too large.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even if the next step then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Do not record the Python call site of every column expression; halves the time to
    # build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Snapshots carry plain local days; keep them free of the machine's zone.
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app: str = "featuremart", **settings) -> SparkSession:
    """A session with the settings above; keyword arguments override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
