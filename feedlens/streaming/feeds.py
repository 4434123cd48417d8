"""Incremental entity counts over landed feeds (Structured Streaming).

A fetch job lands feed rows as parquet files in a directory
(``sources.feeds.land`` writes exactly that shape). This module treats the
directory as a file stream; each micro-batch runs the batch operators: parse
(P1) -> flatten (P2) -> live filter (F1) -> dictionary match (J1, by whichever
plan the dictionary's size asks for) -> counts by (type, name) (A1).

The counts of a micro-batch are written to a folder of its own, named by its
epoch, and the running result is their sum. So no state grows with the
stream, a dictionary may have any size, and a replayed epoch replaces only
what it wrote itself: its commit comes after its files. With the same
checkpoint a later run goes on where the last one ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.operators import detect, posts
from feedlens.schemas import FEED, literal_table

COUNTS = "entity_type string, entity_name string, n bigint"


def landed_feed_stream(spark: SparkSession, landed_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(feed_id, feed_name, url, content)`` from parquet files in ``landed_dir``."""
    reader = spark.readStream.schema(FEED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(landed_dir)


def run_available(feeds: DataFrame, dictionary: detect.PreparedDictionary, out_path: str, checkpoint: str) -> DataFrame:
    """Count everything available now into ``out_path`` and stop; the running counts.

    ``checkpoint`` is the stream's own folder on shared storage: keep it for
    the next run. A directory without files gives no rows.
    """
    spark = feeds.sparkSession
    literal_table(spark, [], COUNTS).write.mode("overwrite").parquet(f"{out_path}/epoch=-1")

    def count(batch: DataFrame, epoch: int) -> None:
        kept = posts.live_filter(posts.explode_posts(posts.parse_feeds(batch)))
        detect.entity_counts(kept, dictionary).write.mode("overwrite").parquet(f"{out_path}/epoch={epoch}")

    started = feeds.writeStream.option("checkpointLocation", checkpoint).foreachBatch(count).trigger(availableNow=True).start()
    started.awaitTermination()
    return running_counts(spark, out_path)


def running_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """``(entity_type, entity_name, n)`` over all epochs so far."""
    every = spark.read.schema(COUNTS).parquet(out_path)
    return every.groupBy("entity_type", "entity_name").agg(F.sum("n").alias("n"))
