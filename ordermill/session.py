"""Sessions for tests and benchmarks, and the shared folder that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ordermill")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``. Only a single-machine session without one
    gets a temporary folder: on a cluster such a folder would vanish with its machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="ordermill-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
