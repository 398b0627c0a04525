"""A SparkSession with the settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Action times are wall-clock text; UTC keeps every one of them valid and unshifted.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even if the aggregation after it then needs its own shuffle:
    # that shuffle carries map-side combined rows, the unsplit partition would carry them all.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # When every partition of one join side turns out to be at most this large, hash it instead of
    # sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def build_session(app_name: str = "visitlens", **conf: str) -> SparkSession:
    """Start (or get) a session. The master comes from spark-submit or from ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Put the settings on a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark
