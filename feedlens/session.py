"""Session factory for tests, benchmarks and local runs.

On a cluster the caller owns the session; library functions never create one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = 8,
    shuffle_partitions: int = 8,
    app_name: str = "feedlens",
    driver_memory: str = "8g",
    master: str | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master or f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Where it is unset, a session on a local master (one machine: tests, benchmarks) gets a
    temporary folder; on a cluster a machine-local folder would lose data, so this raises.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir is not set and the master is {master!r}; point it at shared storage")
    path = tempfile.mkdtemp(prefix="feedlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
