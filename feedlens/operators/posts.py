"""Posts: parse feeds into posts, filter empty posts, post statistics.

Operators: P1 feed parse, P2 flatten, F1 live filter, F2 strict filter,
P5 post length, A7 row counts, A8 dropped posts, A9 average length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.jsonfeed import children_ok, children_posts, feed_children
from feedlens.functions.text import has_visible_char, non_empty, utf16_length

POST_STRUCT = "array<struct<title:string,selftext:string>>"


def parse_feeds(feeds: DataFrame) -> DataFrame:
    """Add ``downloaded``, ``parse_ok`` and ``posts`` to a feeds table.

    ``feeds`` needs a nullable ``content`` column (NULL = download failed).
    The content is parsed once into the children array, which is then checked
    and converted (see ``functions.jsonfeed``).
    """
    staged = feeds.withColumn("_children", feed_children("content"))
    ok = F.col("content").isNotNull() & children_ok("_children")
    return (
        staged.withColumn("downloaded", F.col("content").isNotNull())
        .withColumn("parse_ok", ok)
        .withColumn(
            "posts",
            F.when(ok, children_posts("_children")).otherwise(F.array().cast(POST_STRUCT)),
        )
        .drop("_children")
    )


def explode_posts(parsed_feeds: DataFrame, keep: tuple[str, ...] = ("feed_id", "feed_name")) -> DataFrame:
    """One row per post, keyed by ``(feed_id, post_pos)``; 0..n rows per feed.

    The outer form, its row for an empty feed dropped afterwards: for the inner one the optimizer
    infers ``size(posts) > 0`` and pushes it below the parse, where the content is parsed again.
    """
    exploded = parsed_feeds.select(*keep, F.posexplode_outer("posts").alias("post_pos", "post")).where("post_pos is not null")
    return exploded.select(*keep, F.col("post_pos").cast("bigint").alias("post_pos"), "post.title", "post.selftext")


def live_keep(title: Column | str = "title", selftext: Column | str = "selftext") -> Column:
    """F1 as a non-null boolean: both fields non-empty; whitespace-only is kept."""
    return F.coalesce(non_empty(title) & non_empty(selftext), F.lit(False))


def strict_keep(title: Column | str = "title", selftext: Column | str = "selftext") -> Column:
    """F1 and the Java-trimmed selftext non-empty (title not trimmed)."""
    s = F.col(selftext) if isinstance(selftext, str) else selftext
    return F.coalesce(live_keep(title, selftext) & has_visible_char(s), F.lit(False))


def live_filter(posts: DataFrame) -> DataFrame:
    """the filter the end-to-end run uses. Plain comparisons (a NULL is no
    match), so that they reach the scan."""
    return posts.where((F.col("title") != "") & (F.col("selftext") != ""))


def strict_filter(posts: DataFrame) -> DataFrame:
    """the stricter filter, available but not used by the end-to-end run."""
    return live_filter(posts).where(has_visible_char("selftext"))


def post_length(title: Column | str = "title", selftext: Column | str = "selftext") -> Column:
    """P5: ``title.length + selftext.length`` in UTF-16 units."""
    return utf16_length(title) + utf16_length(selftext)


def post_counts(posts: DataFrame) -> DataFrame:
    """A7 + A8 in one pass: all posts, kept posts, dropped = all - kept."""
    return posts.agg(
        F.count(F.lit(1)).alias("posts_total"),
        F.count_if(live_keep()).alias("posts_kept"),
    ).withColumn("posts_dropped", F.col("posts_total") - F.col("posts_kept"))


def truncated_average(total: Column, n: Column) -> Column:
    """``(total.toDouble / n).toInt`` for non-negative values; 0 when ``n`` is 0."""
    return F.coalesce(
        F.floor(total.cast("double") / F.nullif(n, F.lit(0))).cast("bigint"), F.lit(0).cast("bigint")
    )


def avg_post_chars(posts: DataFrame) -> DataFrame:
    """Integer average length of kept posts, truncated; 0 when none."""
    kept = live_keep()
    return posts.agg(
        truncated_average(F.sum(F.when(kept, post_length())), F.count_if(kept)).alias("avg_chars")
    )

