"""Session construction and lineage checkpoints.

The library never creates its own cluster settings beyond what a job needs:
on a cluster the session is handed in, ``spark.checkpoint.dir`` names the
shared folder, and every iterative operator cuts lineage with
``DataFrame.checkpoint()`` into that folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Sizing for the single-node test container; on a cluster these come from the
# job submission and ``build_session`` is not used.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Broadcast only what the optimizer has measured to be small; larger
    # sides fall back to a shuffle join on their own.
    "spark.sql.autoBroadcastJoinThreshold": str(16 * 1024 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "panelspark") -> SparkSession:
    builder = SparkSession.builder.appName(app).master(master or os.environ.get("PANELSPARK_MASTER", "local[8]"))
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("PANELSPARK_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    without one (tests) gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="panelspark-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def side_by_side(spark: SparkSession, tasks: Sequence[Callable[[], Any]], at_once: int = 4) -> list:
    """The results of `tasks` in their order, a few running at once as `CrossValidator(parallelism=...)` runs its fits: a fit
    over a small panel is hundreds of short jobs of one task, which wait for each other but not for other fits."""
    with ThreadPoolExecutor(max(1, min(at_once, len(tasks)))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]]


def write_once(df: DataFrame) -> DataFrame:
    """`df` written as Parquet into a folder of its own below the shared checkpoint folder and read back: for tables with a
    row per raw row, of which each reader takes few columns. Compressed columns are a fraction of a checkpoint's rows."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss) into the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
