"""Session settings and the folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect.

    AQE picks the final number of reduce partitions, splits skewed joins and skewed rebalance
    partitions; the initial number only has to be large enough for the biggest shuffle.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return pin_utc(builder.getOrCreate())


def pin_utc(spark: SparkSession) -> SparkSession:
    """Hours, days and weeks are UTC buckets, whatever zone the cluster runs in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_rocksdb_state(spark: SparkSession) -> SparkSession:
    """Keep streaming state on disk, so it may outgrow executor memory."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return spark


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the cluster names in ``spark.checkpoint.dir``.

    A local folder is used only where that setting is absent and Spark itself runs locally.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="gridtally-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/gridtally/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back.

    The result outlives lost executors, is computed once, and has a known size, so the planner can
    decide for or against a broadcast before it plans the other side.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
