"""Engine-wide settings and the shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Java's ``\s`` (no UNICODE_CHARACTER_CLASS): space, tab, LF, VT, FF, CR.
# Spelled out so that Spark (Java regex) and DuckDB (RE2) agree; neither
# engine's own ``\s`` has exactly this set.
WHITESPACE_RE = r"[ \t\n\x0B\f\r]+"

# Java ``String.trim`` removes every char <= U+0020 at both ends.
JAVA_TRIM_RE = r"^[\x00-\x20]+|[\x00-\x20]+$"

DEFAULT_TOP_K = 10

# A dictionary is broadcast only when both bounds hold; beyond them the
# aggregate-first plan (shuffle by token, then join) is used instead.
MAX_BROADCAST_DICTIONARY_ROWS = 2_000_000
MAX_BROADCAST_DICTIONARY_BYTES = 64 * 1024 * 1024
# Rough bytes of one row in a broadcast hash relation besides its texts.
BROADCAST_ROW_OVERHEAD = 96

# A filter of dictionary keys (16 bits a key) is broadcast up to this size:
# over 100 million keys.
MAX_BROADCAST_FILTER_BYTES = 256 * 1024 * 1024

# A word with over 1/HOT_SHARE of all tokens is hot: at most HOT_SHARE words
# can be, whatever the corpus, so their list may be broadcast. A hot word's
# rows are split so that each part has at most that share.
HOT_SHARE = 2000

# Feed fetches: limits of one socket operation and of a whole download, bytes
# of bodies a task gathers before it hands them on, and bytes of all bodies it
# may hold, under way or gathered.
FETCH_TIMEOUT_SECONDS = 30.0
FETCH_DEADLINE_SECONDS = 300.0
FETCH_BATCH_BYTES = 16 * 1024 * 1024
FETCH_BUDGET_BYTES = 64 * 1024 * 1024


def checkpoint_base(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``: shared storage, never a folder of one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(e.g. an HDFS/S3 prefix) before landing tables"
        )
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared ``spark.checkpoint.dir``.

    Landed tables (fetched feeds) go here so that a lost executor recomputes
    from durable storage instead of re-running a non-deterministic fetch.
    The setting is read from the session; it is never replaced by a
    machine-local temporary folder. The folder is deleted when the driver ends.
    """
    base = checkpoint_base(spark)
    path = f"{base}/feedlens/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path
