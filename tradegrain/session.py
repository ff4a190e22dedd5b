"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A side is only ever hinted for broadcast after its rows were counted against this bound.
BROADCAST_ROWS = 200_000


def build_session(app: str = "tradegrain", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; `conf` overrides any of them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if master is None or not master.startswith("local"):
        # Shuffles start with many partitions, and adaptive execution merges the small ones.
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = "4000"
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's `spark.checkpoint.dir`.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tradegrain-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/tradegrain/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and go on from the written table.

    Cuts the lineage at a point that survives lost executors, keeps column pruning for the
    readers, and gives the planner true sizes, so that it broadcasts only what is small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
