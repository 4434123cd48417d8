"""Entity aggregates: counts, counts by type with total, zero-fill, top-k.

Operators: A1/A2 entity counts, A3 type counts from hits, A4 type counts
from entity counts, A5 total, A6 types + total, J2 zero-fill on the type
dimension, T1 top-k, T2 k validation, P8 describe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.formatting import describe
from feedlens.schemas import ENTITY_TYPES, TOTAL_LABEL, literal_table
from feedlens.sources.feeds import land


def entity_counts_from_hits(hits: DataFrame) -> DataFrame:
    """A1: ``count(*)`` by (type, name): partial + final aggregate, one exchange."""
    return hits.groupBy("entity_type", "entity_name").agg(F.count(F.lit(1)).alias("n"))


def _with_total(rolled: DataFrame) -> DataFrame:
    """Guarantee the total row even on empty input (Spark's rollup emits none)."""
    zero = rolled.sparkSession.range(1).select(
        F.lit(TOTAL_LABEL).alias("entity_type"), F.lit(0).cast("bigint").alias("n")
    )
    return (
        rolled.unionByName(zero)
        .groupBy("entity_type")
        .agg(F.sum("n").cast("bigint").alias("n"))
    )


def type_counts_from_hits(hits: DataFrame) -> DataFrame:
    """A3: hits rolled up by type, plus a ``total`` row (told apart by ``grouping``)."""
    rolled = hits.rollup("entity_type").agg(
        F.grouping("entity_type").alias("g"), F.count(F.lit(1)).alias("n")
    )
    labelled = rolled.select(
        F.when(F.col("g") == 1, F.lit(TOTAL_LABEL)).otherwise(F.col("entity_type")).alias("entity_type"),
        "n",
    )
    return _with_total(labelled)


def type_counts(counts: DataFrame) -> DataFrame:
    """A4: sum of counts by type over all entities (not only the top k)."""
    return counts.groupBy("entity_type").agg(F.sum("n").cast("bigint").alias("n"))


def total_entities(counts: DataFrame) -> DataFrame:
    """A5: one row, 0 when there is nothing."""
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"))


def type_counts_with_total(counts: DataFrame) -> DataFrame:
    """Per-type sums and the ``total`` row in one rollup; total always present.

    One pass over ``counts`` (a union of A4 and A5 would plan ``counts``
    twice, and a filter pushed into one branch defeats exchange reuse).
    """
    rolled = counts.rollup("entity_type").agg(
        F.grouping("entity_type").alias("g"), F.sum("n").cast("bigint").alias("n")
    )
    labelled = rolled.select(
        F.when(F.col("g") == 1, F.lit(TOTAL_LABEL)).otherwise(F.col("entity_type")).alias("entity_type"),
        "n",
    )
    return _with_total(labelled)


def type_stats(with_total: DataFrame, types: list[str] | None = None) -> DataFrame:
    """``total`` then the six types in report order, absent types as 0.

    Zero-fill without a join: the seven fixed labels are unioned in with
    n = 0 and summed per label; the ordinal is the label's position in the
    fixed order. A type outside the six is part of the total but gets no row.
    """
    spark = with_total.sparkSession
    labels = [TOTAL_LABEL] + (ENTITY_TYPES if types is None else types)
    zeros = literal_table(spark, [(t, 0) for t in labels], "entity_type string, n bigint")
    filled = (
        with_total.unionByName(zeros)
        .groupBy("entity_type")
        .agg(F.sum("n").cast("bigint").alias("n"))
        .where(F.col("entity_type").isin(*labels))
    )
    ordinal = (F.array_position(F.array(*[F.lit(t) for t in labels]), F.col("entity_type")) - 1).cast("int")
    return filled.select(ordinal.alias("ordinal"), "entity_type", "n")


def type_stats_from_counts(counts: DataFrame, types: list[str] | None = None) -> DataFrame:
    """A6 + J2 in one aggregation: the same rows as ``type_stats(type_counts_with_total(counts))``.

    A zero row per fixed type is added before a single rollup: the rollup then
    yields every type (absent ones as 0) and always a total row (the input is
    never empty), with one exchange instead of three.
    """
    spark = counts.sparkSession
    fixed = ENTITY_TYPES if types is None else types
    zeros = literal_table(spark, [(t, 0) for t in fixed], "entity_type string, n bigint")
    rolled = (
        counts.select("entity_type", F.col("n").cast("bigint").alias("n"))
        .unionByName(zeros)
        .rollup("entity_type")
        .agg(F.grouping("entity_type").alias("g"), F.sum("n").cast("bigint").alias("n"))
    )
    labels = [TOTAL_LABEL] + fixed
    label = F.when(F.col("g") == 1, F.lit(TOTAL_LABEL)).otherwise(F.col("entity_type"))
    ordinal = (F.array_position(F.array(*[F.lit(t) for t in labels]), label) - 1).cast("int")
    return rolled.select(ordinal.alias("ordinal"), label.alias("entity_type"), "n").where(
        (F.col("g") == 1) | F.col("entity_type").isin(*fixed)
    )


def validate_k(k: int) -> int:
    """K must be a positive integer."""
    if isinstance(k, bool) or not isinstance(k, int) or k <= 0:
        raise ValueError(f"top-k must be positive, got {k!r}")
    return k


#: Up to this k the top rows are ranked in one task.
REPORT_K = 10_000


def top_entities(counts: DataFrame, k: int = 10) -> DataFrame:
    """Count desc, type asc, name asc; first k, with their 1-based rank.

    Up to ``REPORT_K`` rows this plans as TakeOrderedAndProject (each task
    keeps k, one task merges and ranks). Any larger k is ranked in parallel
    (``ranked``). The order is total on distinct rows, hence deterministic.
    """
    validate_k(k)
    if k > REPORT_K:
        return ranked(counts, k)
    order = [F.desc("n"), F.asc("entity_type"), F.asc("entity_name")]
    top = counts.orderBy(*order).limit(k)
    return top.select(
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rank"),
        "entity_type",
        "entity_name",
        "n",
    )


def ranked(counts: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows with their rank, for any k: rows are dealt by ranges of the order and
    landed; a row's rank is its place in its range plus the sizes of the ranges ahead, which are
    one number for each range. Ranges that begin beyond k are not read again."""
    spark = counts.sparkSession
    order = [F.desc("n"), F.asc("entity_type"), F.asc("entity_name")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.select("entity_type", "entity_name", "n").repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    landed = land(dealt, "ranges")
    sizes = sorted((r["part"], r["size"]) for r in landed.groupBy("part").agg(F.count(F.lit(1)).alias("size")).collect())  # a row for each range
    ahead, before = 0, []
    for part, size in sizes:
        if ahead < k:
            before.append((part, ahead))
        ahead += size
    starts = F.broadcast(literal_table(spark, before, "part int, ahead bigint"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("ahead")
    placed = landed.join(starts, "part").withColumn("rank", place.cast("bigint"))
    return placed.where(F.col("rank") <= k).select("rank", "entity_type", "entity_name", "n")


def describe_hits(hits: DataFrame, keys: tuple[str, ...] = ("post_id",)) -> DataFrame:
    """``[Type] name`` for each hit."""
    return hits.select(*keys, "field", describe(F.col("entity_type"), F.col("entity_name")).alias("describe"))
