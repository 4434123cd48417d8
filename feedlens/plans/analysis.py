"""End-to-end run: subscriptions -> feeds -> posts -> entities -> reports.

This is what a user of the reference runs, as one function::

    with run_analysis(spark, "subscriptions.json", "entities/", top_k=10) as result:
        print(result.report())

The result owns the run's landed tables (``feedlens.runs``): ``close()`` or the
end of ``with`` deletes them. With a ``run_id`` a run that broke off is started
again by the same call and goes on from the tables it had landed: feeds are not
fetched again.

Jobs it launches (everything else stays lazy):

1. a one-row check of the subscriptions file (Q2) and of valid entries (Q3);
2. fetch + parse, landed once as parquet in the run's folder under
   ``spark.checkpoint.dir`` (with observed counters for monitoring);
3. the one-row processing statistics (needed for the Q5 decision);
4. the dictionary, keyed and landed once, and its size check, which decides
   broadcast vs aggregate-first;
5. entity counts, landed once and then reused by the top-k and the type
   statistics.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlens import config
from feedlens.functions import formatting as fmt
from feedlens.operators import aggregate, detect, posts, stats
from feedlens.plans import quality, reports
from feedlens.runs import Owner, RunFolder
from feedlens.sources import dictionary as dictsrc
from feedlens.sources import feeds as feedsrc
from feedlens.sources import subscriptions as subsrc


@dataclass
class AnalysisResult(Owner):
    subscriptions: DataFrame
    rejected_subscriptions: DataFrame
    parsed_feeds: DataFrame
    posts: DataFrame
    kept_posts: DataFrame
    dictionary: DataFrame
    missing_dictionary_files: DataFrame
    processing_stats: DataFrame
    processing_stats_row: dict
    entity_counts: DataFrame | None = None
    top_entities: DataFrame | None = None
    type_stats: DataFrame | None = None
    plan: str | None = None
    extras: dict = field(default_factory=dict)
    folder: RunFolder | None = None
    # builders of the check DataFrames: plan construction only on first use
    _builders: dict = field(default_factory=dict, repr=False)
    _built: dict = field(default_factory=dict, repr=False)

    def _lazy(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    @property
    def quality_checks(self) -> DataFrame:
        """Q1-Q8 + S6 as ``(check_id, check_name, ok, n)`` rows."""
        return self._lazy("quality_checks")

    @property
    def quarantine(self) -> DataFrame:
        """Rejected entries and feeds with reason and source position (see ``quality.quarantine``)."""
        return self._lazy("quarantine")

    @property
    def warnings(self) -> DataFrame:
        """Per-row warnings."""
        return self._lazy("warnings")

    def report(self) -> str:
        """The three reports as text (fixed, small number of rows collected).

        The processing statistics are already on the driver (one row, six
        numbers), so their report is formatted from that row directly.
        """
        out = [reports.render_processing_stats(self.processing_stats_row)]
        if self.top_entities is not None:
            out.append(reports.render(reports.entity_lines(self.top_entities), "rank", fmt.ENTITY_HEADER))
            out.append(
                reports.render(reports.type_lines(self.type_stats), "ordinal", fmt.TYPE_HEADER, subheader_after=1)
            )
        return "\n\n".join(out)


def run_analysis(
    spark: SparkSession,
    subscription_file: str,
    entities_dir: str,
    top_k: int = config.DEFAULT_TOP_K,
    fetch: Callable[[DataFrame], DataFrame] = feedsrc.fetch_feeds,
    plan: str = "auto",
    subscription_lines: bool = False,
    landed_feeds: str | None = None,
    run_id: str | None = None,
) -> AnalysisResult:
    """Run the whole analysis; raise the reference's fatal guards as exceptions.

    ``subscription_lines``: the subscriptions are JSON Lines, parsed in
    parallel, instead of one array. ``landed_feeds``: a folder of feeds
    already landed as ``<feed_id>.json``, read instead of fetching.
    ``run_id``: a name for the run, under which a second call takes over the
    tables that a broken one has landed.

    Raises ``SubscriptionsNotFound`` (Q1), ``InvalidSubscriptionsFile`` (Q2),
    ``NoValidSubscriptions`` (Q3), ``DictionaryDirNotFound`` (Q4),
    ``ValueError`` for k <= 0 (T2) and ``NoValidPosts`` (Q5, carrying the
    result with its statistics).
    """
    aggregate.validate_k(top_k)
    inputs = {"subscriptions": subscription_file, "lines": subscription_lines, "entities": entities_dir, "landed_feeds": landed_feeds, "plan": plan}
    folder = RunFolder(spark, run_id, inputs)
    try:
        return _run(spark, folder, subscription_file, entities_dir, top_k, fetch, plan, subscription_lines, landed_feeds)
    except quality.NoValidPosts:
        raise  # its result owns the folder
    except BaseException:
        if run_id is None:
            folder.close()
        raise


def _run(
    spark: SparkSession,
    folder: RunFolder,
    subscription_file: str,
    entities_dir: str,
    top_k: int,
    fetch: Callable[[DataFrame], DataFrame],
    plan: str,
    subscription_lines: bool,
    landed_feeds: str | None,
) -> AnalysisResult:
    read = subsrc.read_subscription_lines if subscription_lines else subsrc.read_subscriptions
    subs = read(spark, subscription_file)
    if landed_feeds:
        fetch = partial(feedsrc.read_landed_feed_files, spark, feeds_dir=landed_feeds)
    valid = subsrc.require_valid(subs)

    # Fail on a missing directory before any fetch (Q4), as the reference does.
    present = dictsrc.present_dictionary_files(spark, entities_dir)
    dictionary = folder.land(dictsrc.load_dictionary(spark, entities_dir), "dictionary")
    missing = dictsrc.missing_dictionary_files(present)

    # Fetch and parse once; land the parsed feeds (raw content dropped). The
    # observed counters ride on the landing job (monitoring only; the reported
    # statistics below are exact aggregates over the landed table).
    counters = [
        F.count(F.lit(1)).alias("feeds"),
        F.count_if(~F.col("downloaded")).alias("feeds_failed"),
        F.count_if(F.col("downloaded") & ~F.col("parse_ok")).alias("feeds_unparsed"),
        F.coalesce(F.sum(F.size("posts")), F.lit(0)).alias("posts"),
    ]
    fetched = posts.parse_feeds(fetch(valid)).drop("content")
    if folder.has("parsed-feeds"):  # an attempt before this one has fetched them
        parsed = folder.land(fetched, "parsed-feeds")
        metrics = parsed.agg(*counters).first().asDict()
    else:
        observed = Observation("fetch")
        parsed = folder.land(fetched.observe(observed, *counters), "parsed-feeds")
        metrics = observed.get
    all_posts = posts.explode_posts(parsed)
    kept = posts.live_filter(all_posts)

    proc = stats.processing_stats(parsed)
    proc_row = proc.first().asDict()
    result = AnalysisResult(
        subscriptions=valid,
        rejected_subscriptions=subs.rejected,
        parsed_feeds=parsed,
        posts=all_posts,
        kept_posts=kept,
        dictionary=dictionary,
        missing_dictionary_files=missing,
        processing_stats=proc,
        processing_stats_row=proc_row,
        extras={"fetch_metrics": metrics},
        folder=folder,
        _builders={
            "quality_checks": lambda: quality.quality_checks(subs.files, subs.validated, missing, parsed),
            "warnings": lambda: quality.warnings(subs.validated, parsed, missing),
            "quarantine": lambda: quality.quarantine(subs.validated, parsed),
        },
    )
    if proc_row["posts_success"] - proc_row["posts_filtered"] == 0:
        raise quality.NoValidPosts("No valid posts downloaded after filtering", result)

    report = analyze_posts(kept, dictionary, top_k, plan, folder=folder)
    result.entity_counts = report.entity_counts
    result.top_entities = report.top_entities
    result.type_stats = report.type_stats
    result.plan = report.plan
    return result


@dataclass
class EntityReport(Owner):
    entity_counts: DataFrame
    top_entities: DataFrame
    type_stats: DataFrame
    plan: str
    folder: RunFolder | None = None


def analyze_posts(
    kept_posts: DataFrame,
    dictionary: DataFrame,
    top_k: int = config.DEFAULT_TOP_K,
    plan: str = "auto",
    types: list[str] | None = None,
    folder: RunFolder | None = None,
) -> EntityReport:
    """The entity half of the analysis on any posts DataFrame (title, selftext).

    Use it on posts that are already landed (a bulk dump read with
    ``read_post_lines``, a table): it measures the dictionary, picks the
    plan, lands the counts once (in ``folder``, else in a folder that the
    report owns) and derives the top-k and the type statistics from them.
    """
    aggregate.validate_k(top_k)
    prepared = detect.prepare_dictionary(dictionary)
    chosen = plan if plan != "auto" else ("broadcast" if prepared.broadcast else "aggregate_first")
    folder = folder or RunFolder(kept_posts.sparkSession)
    counts = folder.land(detect.entity_counts(kept_posts, prepared, plan=chosen), "entity-counts")
    return EntityReport(
        entity_counts=counts,
        top_entities=aggregate.top_entities(counts, top_k),
        type_stats=aggregate.type_stats_from_counts(counts, types),
        plan=chosen,
        folder=folder,
    )
