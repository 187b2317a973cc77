"""Session set-up and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "hazardlens", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job here relies on (UTC clock, AQE, skew handling)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # State of the streaming de-duplication lives off-heap and survives executor loss via the checkpoint.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach. The cluster names it in ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset: a cluster run needs a folder shared by all executors")
    fallback = os.path.join(tempfile.gettempdir(), "hazardlens-shared")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


_scratch: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared folder for one written table. It lasts as long as this application,
    unless :func:`remove_scratch` is called before."""
    path = f"{shared_dir(spark)}/hazardlens/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append((spark, path))
    return path


def remove_scratch() -> None:
    """Delete every table that this application wrote to a scratch path."""
    while _scratch:
        spark, path = _scratch.pop()
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)
        except Exception:   # the JVM is gone: nothing can be deleted any more
            return


atexit.register(remove_scratch)


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and go on from there, without its lineage."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
