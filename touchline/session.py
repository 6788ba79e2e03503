"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that decide results; safe to apply to a session someone else built.
RESULT_CONF = {
    # dt/hr partitions and window bounds are computed on UTC instants.
    "spark.sql.session.timeZone": "UTC",
}

# Settings that decide speed; used only for sessions built here.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keyed state lives off-heap and only its changes are uploaded per batch.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Sessions of one user are joined in each map task first, so a hot user sends few rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app_name: str = "touchline", **conf: str) -> SparkSession:
    """A session with the result and scale settings, plus any overrides."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RESULT_CONF, **SCALE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to an existing session."""
    for key, value in RESULT_CONF.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for ``label`` below the shared folder of the cluster.

    The shared folder is ``spark.checkpoint.dir``.  Only a local session may
    fall back to a temporary folder, because there every task sees it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = os.path.join(tempfile.gettempdir(), "touchline")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
