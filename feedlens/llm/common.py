"""Helpers shared by the operators: landed tables, byte words, running totals."""

from __future__ import annotations

import sys
import types
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of bytes other than space, tab, LF, VT, FF and CR.
WORD_RE = r"[^\x20\x09-\x0D]+"

#: Ids, digests or runs are broadcast only when a count has shown at most so many rows.
MAX_BROADCAST_ROWS = 1_000_000

#: Largest Arrow batch between the JVM and a Python worker; both sides hold a few of them.
ARROW_BYTES = 4_000_000

#: Texts are taken out of an Arrow batch in slices of about so many bytes.
SLICE_BYTES = 2_000_000


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``, deleted when the driver ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage before running")
    path = f"{base.rstrip('/')}/feedlens-llm/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared scratch and read it back: the lineage is cut and a lost
    executor re-reads durable files."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows (counted), else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``; its session's Arrow batches are from now on at most ``ARROW_BYTES`` (a smaller setting stays)."""
    key, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(key)) > ARROW_BYTES:
        conf.set(key, f"{ARROW_BYTES}b")
    return df


def fold(column: Column) -> Column:
    """A-Z only lower-casing, JVM-side. ``translate`` walks the text by code point."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def remainder(id_column: Column, modulus: int) -> Column:
    """``crc32(id as text) mod modulus``; a null id has no remainder (null)."""
    return F.crc32(id_column.cast("string").cast("binary")) % F.lit(modulus)


def running(df: DataFrame, order: list[str], value: Column, by: list[str], name: str) -> DataFrame:
    """``df`` (landed) with ``before``: the sum of ``value`` over the rows ahead of each row in
    ``order``, within its ``by`` group.

    A group may hold any share of the rows: rows are range-partitioned by ``order``, each
    partition is summed on its own and gets the totals of those ahead of it (one row for each
    partition and group). ``order`` must begin with ``by``. Rows equal in all of ``order``
    get consecutive places in any order.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn("_v", value).repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id())
    landed = land(ranged, name)
    group = ["_pid", *by]
    ahead = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    base = landed.groupBy(*group).agg(F.sum("_v").alias("_s")).select(*group, F.coalesce(F.sum("_s").over(ahead), F.lit(0)).alias("_base"))
    here = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    base = base.select(*(F.col(c).alias(f"_{c}_b") for c in group), "_base")
    on = [F.col(c).eqNullSafe(F.col(f"_{c}_b")) if c in by else F.col(c) == F.col(f"_{c}_b") for c in group]
    inside = landed.withColumn("_in", F.coalesce(F.sum("_v").over(here), F.lit(0)))
    return inside.join(base, on, "inner").withColumn("before", F.col("_base") + F.col("_in")).select(*df.columns, "before")


def worker_state(key: str, make):
    """A value kept for the life of a Python worker (tasks that follow on it find it again)."""
    module = sys.modules.setdefault("_feedlens_worker", types.ModuleType("_feedlens_worker"))
    if key not in module.__dict__:
        module.__dict__[key] = make()
    return module.__dict__[key]


def slices(batch, text: int = 1, most: int = SLICE_BYTES):
    """Yield row slices of an Arrow batch whose texts have about ``most`` bytes together (one
    long text alone makes a slice)."""
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def texts_of(batch, text: int = 1) -> list[bytes]:
    """The texts of a batch as UTF-8 bytes; null counts as empty."""
    import pyarrow as pa

    column = batch.column(text)
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finisher: spreads 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit keyed hash of each word."""
    import pandas as pd

    array = np.empty(len(words), dtype=object)
    array[:] = words
    return pd.util.hash_array(array, categorize=False) if len(words) else np.empty(0, np.uint64)


def segment_sums(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each half-open segment; empty segments give 0. Segments ascend."""
    out = np.zeros(len(starts), dtype=np.int64)
    full = ends > starts
    if full.any():
        cuts = np.stack([starts[full], ends[full]], 1).ravel()
        closed = cuts[-1] == len(flags)
        out[full] = np.add.reduceat(flags, cuts[:-1] if closed else cuts, dtype=np.int64)[::2]
    return out
