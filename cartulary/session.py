"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Left to the cluster: master, memory, shuffle partitions. AQE coalesces small shuffle
# partitions, switches to a broadcast only from measured sizes, and splits skewed ones,
# also where an aggregate follows the join.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Columns are made by the hundred here; a stack trace for each takes longer than planning them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "cartulary", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster a
    machine-local folder is lost with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="cartulary-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def enable_checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/cartulary/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, times: int = 2) -> DataFrame:
    """Rows dealt over all cores, before work that takes far longer than reading them.

    A small file of many rows is read by one or two tasks, and so would be all that is made from it.
    """
    return df.repartition(times * df.sparkSession.sparkContext.defaultParallelism)
