"""Parallelism lookup."""

from __future__ import annotations

from pyspark.sql import SparkSession


def default_parallelism(spark: SparkSession) -> int:
    """Cores the cluster can run at once (falls back to configuration when the
    session has no SparkContext, e.g. a Spark Connect client)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:
        conf = spark.conf.get("spark.default.parallelism", None) or spark.conf.get(
            "spark.sql.shuffle.partitions", "200"
        )
        return int(conf)
