"""Session settings that the semantics depend on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Set what parsing needs on a given session: UTC, and field names that differ by case (T and t, S and s)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.caseSensitive", "true")
    return spark


def market_session(app_name: str = "tidemark", **conf: str) -> SparkSession:
    """A session for market events. Master and partitions are the cluster's choice; large state goes to RocksDB."""
    builder = SparkSession.builder.appName(app_name)
    settings = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.adaptive.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local session, which has no other machine, may lack one and
    gets a temporary one."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-tidemark-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")
