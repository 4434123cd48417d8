"""Feed and post outcome statistics.

The reference counts with accumulators, which over-count when a task is
retried; these are plain aggregates, exact under retries and speculation.

All six numbers come from one scan of the parsed feeds: each feed row folds
its own posts array (size, kept count, kept length) with higher-order
functions, and one global aggregate sums those partials. No join and no
second scan of the posts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.text import utf16_length
from feedlens.operators.posts import truncated_average

STAT_COLUMNS = [
    "feeds_success",
    "feeds_failed",
    "posts_success",
    "posts_failed",
    "posts_filtered",
    "avg_chars",
]


def _kept(p: Column) -> Column:
    return F.coalesce((p["title"] != "") & (p["selftext"] != ""), F.lit(False))


def feed_partials(parsed_feeds: DataFrame) -> DataFrame:
    """Per feed: downloaded, parse_ok, number of posts, kept posts, kept length."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("chars"))
    folded = F.aggregate(
        "posts",
        zero,
        lambda acc, p: F.when(
            _kept(p),
            F.struct((acc["n"] + 1).alias("n"), (acc["chars"] + utf16_length(p["title"]) + utf16_length(p["selftext"])).alias("chars")),
        ).otherwise(acc),
    )
    return parsed_feeds.select(
        "downloaded", "parse_ok", F.size("posts").cast("bigint").alias("n_posts"), folded.alias("kept")
    ).select("downloaded", "parse_ok", "n_posts", F.col("kept.n").alias("n_kept"), F.col("kept.chars").alias("kept_chars"))


def feed_outcomes(parsed_feeds: DataFrame) -> DataFrame:
    """A11 (+ parse failures): downloaded, not downloaded, downloaded but rejected."""
    return parsed_feeds.agg(
        F.count_if(F.col("downloaded")).alias("feeds_success"),
        F.count_if(~F.col("downloaded")).alias("feeds_failed"),
        F.count_if(F.col("downloaded") & ~F.col("parse_ok")).alias("feeds_parse_failed"),
    )


def processing_stats(parsed_feeds: DataFrame) -> DataFrame:
    """A10: the six processing statistics as one row.

    ``feeds_success`` counts downloaded feeds even when they do not parse;
    ``posts_success`` counts every post reaching the filter (dropped ones
    included); ``posts_failed`` and ``posts_filtered`` both count dropped
    posts, as in the reference.
    """
    p = feed_partials(parsed_feeds)
    total = F.coalesce(F.sum("n_posts"), F.lit(0)).cast("bigint")
    kept = F.coalesce(F.sum("n_kept"), F.lit(0)).cast("bigint")
    return p.agg(
        F.count_if(F.col("downloaded")).alias("feeds_success"),
        F.count_if(~F.col("downloaded")).alias("feeds_failed"),
        total.alias("posts_success"),
        (total - kept).alias("posts_failed"),
        (total - kept).alias("posts_filtered"),
        truncated_average(F.sum("kept_chars"), kept).alias("avg_chars"),
    )
