"""Data-quality guards (Q1-Q8) as a DataFrame of checks.

The reference prints an error and stops; here the fatal guards raise named
exceptions from the run (see ``sources`` and ``analysis``) and every guard
is also reported as a row ``(check_id, check_name, ok, n)`` so that a job
can log or alert on it. Each row is a one-row aggregate; the union is seven
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions import formatting as fmt
from feedlens.operators.stats import feed_partials
from feedlens.schemas import literal_table


class NoValidPosts(ValueError):
    """Q5: nothing left after the filter (statistics are still available)."""

    def __init__(self, message: str, result=None):
        super().__init__(message)
        self.result = result


def path_listing(spark: SparkSession, paths: list[tuple[str, str]]) -> DataFrame:
    """``(check_id, path, found)`` for each ``(check_id, path)``, asked of the path's file system."""
    rows = []
    for check_id, path in paths:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        store = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        rows.append((check_id, path, bool(store.globStatus(hadoop))))
    return literal_table(spark, rows, "check_id string, path string, found boolean")


def _stack(agg: DataFrame, checks: list[tuple[str, str, str, str]]) -> DataFrame:
    """Unpivot one aggregate row into check rows ``(check_id, check_name, ok, n)``.

    ``checks``: (check_id, check_name, column of ``agg``, ok rule ``'zero'`` or
    ``'positive'``).
    """
    parts = []
    for cid, name, col, _ in checks:
        parts += [f"'{cid}'", f"'{name}'", f"cast({col} as bigint)"]
    stacked = agg.selectExpr(f"stack({len(checks)}, {', '.join(parts)}) as (check_id, check_name, n)")
    positive = [cid for cid, _, _, rule in checks if rule == "positive"]
    ok = F.when(F.col("check_id").isin(*positive), F.col("n") > 0).otherwise(F.col("n") == 0) if positive else F.col("n") == 0
    return stacked.select("check_id", "check_name", ok.alias("ok"), "n")


def quality_checks(
    subscription_files: DataFrame | None,
    validated_entries: DataFrame,
    missing_files: DataFrame,
    parsed_feeds: DataFrame,
    listing: DataFrame | None = None,
) -> DataFrame:
    """Q1-Q8 and S6 as rows; ``ok`` is True when nothing is wrong.

    One aggregate pass per source (entries, feeds, missing files, files),
    unpivoted with ``stack``: each source is scanned once. Kept posts (Q5)
    are counted from the per-feed partials, without exploding the posts.
    Q1 and Q4 (missing paths) are counted from ``listing`` (see
    ``path_listing``). Without one they are reported as ok: a run that got
    here has opened both paths.
    """
    spark = validated_entries.sparkSession
    fixed = spark.range(1).select(F.lit(0).alias("zero"))
    paths = [("Q1", "subscriptions_file_found"), ("Q4", "entities_dir_found")]
    if listing is None:
        rows = [_stack(fixed, [(i, name, "zero", "zero") for i, name in paths])]
    else:
        gone = listing.agg(*(F.count_if((F.col("check_id") == i) & ~F.col("found")).alias(i) for i, _ in paths))
        rows = [_stack(gone, [(i, name, i, "zero") for i, name in paths])]
    if subscription_files is not None:
        files = subscription_files.agg(F.count_if(~F.col("file_ok")).alias("bad"))
    else:
        files = fixed.select(F.col("zero").alias("bad"))
    rows.append(_stack(files, [("Q2", "subscriptions_file_invalid", "bad", "zero")]))
    entries = validated_entries.agg(
        F.count_if(F.col("is_valid")).alias("valid"), F.count_if(~F.col("is_valid")).alias("rejected")
    )
    rows.append(
        _stack(entries, [("Q3", "valid_subscriptions", "valid", "positive"), ("Q6", "malformed_subscriptions", "rejected", "zero")])
    )
    feeds = feed_partials(parsed_feeds).agg(
        F.coalesce(F.sum("n_kept"), F.lit(0)).alias("kept"),
        F.count_if(~F.col("downloaded")).alias("failed"),
        F.count_if(F.col("downloaded") & ~F.col("parse_ok")).alias("unparsed"),
    )
    rows.append(
        _stack(
            feeds,
            [
                ("Q5", "posts_after_filter", "kept", "positive"),
                ("Q7", "failed_downloads", "failed", "zero"),
                ("Q8", "failed_parses", "unparsed", "zero"),
            ],
        )
    )
    missing = missing_files.agg(F.count(F.lit(1)).alias("missing"))
    rows.append(_stack(missing, [("S6", "missing_dictionary_files", "missing", "zero")]))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def warnings(validated_entries: DataFrame, parsed_feeds: DataFrame, missing_files: DataFrame) -> DataFrame:
    """Q6, Q7, Q8 and S6 per row: ``(check_id, message)``."""
    q6 = validated_entries.where(~F.col("is_valid")).select(
        F.lit("Q6").alias("check_id"),
        F.lit(fmt.MALFORMED_SUBSCRIPTION_WARNING).alias("message"),
    )
    q7 = parsed_feeds.where(~F.col("downloaded")).select(
        F.lit("Q7").alias("check_id"),
        F.format_string(fmt.DOWNLOAD_WARNING, "feed_name", "url").alias("message"),
    )
    q8 = parsed_feeds.where(F.col("downloaded") & ~F.col("parse_ok")).select(
        F.lit("Q8").alias("check_id"),
        F.format_string(fmt.PARSE_WARNING, "feed_name").alias("message"),
    )
    s6 = missing_files.select(
        F.lit("S6").alias("check_id"),
        F.format_string("Warning: Could not load dictionary file '%s'", "file_name").alias("message"),
    )
    return q6.unionByName(q7).unionByName(q8).unionByName(s6)


def quarantine(validated_entries: DataFrame, parsed_feeds: DataFrame) -> DataFrame:
    """Q6, Q7 and Q8 as records: ``(reason, file, entry_index, feed_id, name, url)``, one for each
    rejected entry and each feed that could not be downloaded or parsed, with the place of its
    subscription (entries of JSON Lines have no index). No rows for what was used.

    ``validated_entries`` needs ``feed_id, file, entry_index``. Only ids and places meet in the
    join; the feeds' posts are not read.
    """
    place = ["feed_id", "file", F.col("entry_index").cast("bigint").alias("entry_index")]
    rejected = validated_entries.where(~F.col("is_valid")).select(F.lit("malformed_subscription").alias("reason"), *place, "name", "url")
    reason = F.when(~F.col("downloaded"), F.lit("failed_download")).otherwise(F.lit("failed_parse"))
    failed = parsed_feeds.where(~F.col("downloaded") | ~F.col("parse_ok")).select(reason.alias("reason"), "feed_id", F.col("feed_name").alias("name"), "url")
    found = failed.join(validated_entries.where("is_valid").select(*place).dropDuplicates(["feed_id"]), "feed_id", "left")
    columns = ["reason", "file", "entry_index", "feed_id", "name", "url"]
    return rejected.select(*columns).unionByName(found.select(*columns))


def write_quarantine(records: DataFrame, path: str) -> str:
    """The records as a table partitioned by reason."""
    records.write.mode("overwrite").partitionBy("reason").parquet(path)
    return path
