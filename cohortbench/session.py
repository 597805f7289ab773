"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on. Cluster sizing (executors, memory, shuffle
# partitions) is left to the cluster; AQE coalesces and splits at run time.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

_local_scratch: tempfile.TemporaryDirectory | None = None


def local_session(cores: str = "*", memory: str = "8g", app: str = "cohortbench") -> SparkSession:
    """Single-JVM session for tests and the local benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder path under the checkpoint folder every executor can reach."""
    return f"{scratch_root(spark)}/cohortbench/{label}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The same rows, written once to the checkpoint folder and read from there."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()


def scratch_root(spark: SparkSession) -> str:
    """The checkpoint folder.

    Only a local-mode session without that setting falls back to a temporary
    folder; on a cluster a machine-local folder would lose the files with the
    machine, so the missing setting is an error there.
    """
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if _local_scratch is None:
            _local_scratch = tempfile.TemporaryDirectory(prefix="cohortbench-")
        root = _local_scratch.name
    return root.rstrip("/")
