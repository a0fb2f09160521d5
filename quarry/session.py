"""Session defaults that every entry point shares."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quarry") -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster the master and the checkpoint directory come from the
    submit configuration; locally we fall back to ``local[*]`` and a
    scratch checkpoint folder.
    """
    builder = SparkSession.builder.appName(app_name)
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    if master:
        builder = builder.master(master)
    elif not submitted and not os.environ.get("SPARK_MASTER"):
        builder = builder.master("local[*]")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Where none is configured, a local session gets a scratch folder; on a cluster that would be
    each executor's own disk, so it is refused.
    """
    context = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not current:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="quarry-ckpt-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(current)
    return current


#: Folders that this process has written stages to.
_STAGES: list[str] = []


def stage_path(spark: SparkSession, name: str, group: str = "quarry-stages") -> str:
    """A new folder below the shared checkpoint folder, for a stage's output."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{group}/{name}-{uuid.uuid4().hex[:12]}"
    _STAGES.append(path)
    return path


def drop_stages(spark: SparkSession) -> int:
    """Delete the stages that this process has written, once nothing reads them any more; returns how many there were.

    For callers that run many queries in one session (``bench.py``): a query's result may read its stages until it is written.
    """
    n = len(_STAGES)
    for path in _STAGES:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _STAGES.clear()
    return n


def materialize(df, name: str):
    """Cut lineage at a stage boundary: write ``df`` as Parquet under the shared checkpoint
    folder and return a DataFrame reading it back (survives executor loss, unlike a cache)."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
