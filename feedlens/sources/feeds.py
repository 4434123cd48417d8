"""Feed fetch (S3) and landing.

Fetching is the one step that needs Python: each partition downloads its
URLs with a bounded thread pool (I/O bound), a timeout, a hard deadline and
a byte budget (``sources.download``); any error yields NULL content (a
failed feed), never a failed task.

Download results are not deterministic, so they are landed once to parquet
under ``spark.checkpoint.dir`` and every statistic is computed from the
landed table. A lost executor then re-reads durable files instead of
downloading again and changing the counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens import config
from feedlens.functions.jsonfeed import post_ok, post_text, read_post
from feedlens.operators.partitioning import default_parallelism
from feedlens.sources.download import fetcher

FETCHED_SCHEMA = "feed_id bigint, feed_name string, url string, content string"


def _fetcher(timeout: float, deadline: float, threads: int, batch_bytes: int, budget_bytes: int = config.FETCH_BUDGET_BYTES):
    """The fetch over pandas frames, for ``mapInPandas`` and for callers without Spark."""
    arrow = fetcher(timeout, deadline, threads, batch_bytes, budget_bytes)

    def fetch(frames):
        import pyarrow as pa

        for batch in arrow(pa.RecordBatch.from_pandas(f[["feed_id", "feed_name", "url"]], preserve_index=False) for f in frames):
            yield batch.to_pandas()

    return fetch


def fetch_feeds(
    subscriptions: DataFrame,
    partitions: int | None = None,
    timeout: float = config.FETCH_TIMEOUT_SECONDS,
    threads: int = 8,
    deadline: float = config.FETCH_DEADLINE_SECONDS,
    batch_bytes: int = config.FETCH_BATCH_BYTES,
    budget_bytes: int = config.FETCH_BUDGET_BYTES,
) -> DataFrame:
    """S3: ``(feed_id, feed_name, url, content)``; content NULL = download failed.

    ``deadline`` bounds a whole download however slowly it trickles;
    ``budget_bytes`` the bodies a task holds at a time (and one more body).

    Subscriptions are hash-spread by ``feed_id`` so fetches run in parallel
    and a retried partition gets the same URLs. A URL listed twice is
    fetched twice, as in the reference.
    """
    spark = subscriptions.sparkSession
    n = partitions or default_parallelism(spark)
    return (
        subscriptions.select("feed_id", "feed_name", "url")
        .repartition(n, "feed_id")
        .mapInArrow(fetcher(timeout, deadline, threads, batch_bytes, budget_bytes), FETCHED_SCHEMA)
    )


def land_to(df: DataFrame, name: str) -> str:
    """Write ``df`` once to a fresh parquet path under the shared checkpoint dir."""
    path = config.scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return path


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once (``land_to``) and read it back: lineage stops here."""
    return df.sparkSession.read.parquet(land_to(df, name))


def read_landed_feed_files(spark: SparkSession, subscriptions: DataFrame, feeds_dir: str) -> DataFrame:
    """Feeds already landed as one file per subscription (``<feed_id>.json``).

    Left join keeps every subscription; a subscription without a file is a
    failed feed (NULL content). Files are read whole, one row each.
    """
    files = spark.read.text(feeds_dir, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(-?\d+)\.json$", 1).alias("fid"),
        F.col("value").alias("content"),
    ).where(F.col("fid") != "")
    files = files.select(F.col("fid").cast("bigint").alias("feed_id"), "content")
    return subscriptions.select("feed_id", "feed_name", "url").join(files, "feed_id", "left")


def read_post_lines(spark: SparkSession, path: str) -> DataFrame:
    """Bulk dumps as JSON Lines, one post object per line, entering at F1.

    A single feed is one row, so one giant feed would be one task; a bulk
    dump split into lines is parsed by as many tasks as it has splits. Each
    line follows the feed field rules (string / number / boolean / null
    kept, missing or object / array rejected), applied per post: a bad line
    rejects only itself. Returns ``(file, line_ok, title, selftext)``.
    """
    raw = spark.read.text(path).where(F.trim("value") != "")
    read = raw.select(F.col("_metadata.file_path").alias("file"), read_post("value").alias("post"))
    checked = read.select("file", post_ok(F.col("post")).alias("line_ok"), post_text(F.col("post")).alias("fields"))
    own = lambda name: F.when(F.col("line_ok"), F.col(f"fields.{name}")).alias(name)
    return checked.select("file", "line_ok", own("title"), own("selftext"))
