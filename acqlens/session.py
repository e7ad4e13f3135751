"""Session settings shared by tests, the bench and the driver entry point."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  AQE coalesces the small
# post-aggregation partitions, converts joins to broadcast only when the
# measured side is below the broadcast threshold, and splits skewed join
# partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Python call-site capture costs several JVM round trips per Column call
    # while plans are built; it only enriches error messages.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "acqlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, the folder that the driver and all
    executors share.  Only a local session that has none (tests) uses a scratch
    folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="acqlens-shared-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
