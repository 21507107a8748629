"""Session set-up and the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Only settings that change results or state layout. Sizing (memory, shuffle
# width, cores) belongs to the submit command; AQE resizes batch shuffles.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A busy user's events are merged into sessions before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def get_session(app_name: str = "tidemark", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_made: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``; where it
    does not, the warehouse is the folder all executors share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    _made.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}")
    return _made[-1]


def clear_shared(spark: SparkSession) -> None:
    """Delete the work folders handed out so far. Results that read from them are gone with them."""
    while _made:
        target = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
