"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

_own_dir: str | None = None


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    Shuffle partitions are left to the cluster: adaptive execution coalesces
    them, so a generous ``spark.sql.shuffle.partitions`` costs little.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All timestamps of the engine are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for staged tables and stream checkpoints.

    It lies under ``spark.checkpoint.dir``, which the cluster points at storage
    that every executor sees. Only where that is unset (tests, local runs) a
    folder of this process is used.
    """
    global _own_dir
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _own_dir is None:
            _own_dir = tempfile.mkdtemp(prefix="tidemark-")
        base = _own_dir
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")
