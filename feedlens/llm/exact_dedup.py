"""Exact de-duplication with a heavy-hitter split; DataFrame operations only.

1. ``approx_top_k`` runs a Misra-Gries style frequent-items sketch over the text digests: any
   digest with more than ``rows / tracked`` rows is certain to be in its answer. Sketches are
   merged map-side, so a hot digest costs one entry a task.
2. The sketch's candidates (at most ``tracked``) are counted exactly; those with at least
   ``heavy_rows`` rows are the *verified winners*: digest, rows, largest id.
3. The winners are broadcast (their number is bounded by ``tracked``). Their rows get their
   verdict map-side and never move; all other digests meet in an ordinary shuffle, where no
   group can be large. Where a winner's largest id itself has many rows (repeated rows, or null
   ids only), the one that stays is chosen in two steps: one in each task, then one of those.

Results are the same whatever the sketch finds: it only decides which rows move.

Defined cases: a null text counts as empty; an empty text is a text like any other; null ids
rank below all others; of repeated rows (same id, same text) exactly one stays; further
columns, whatever their names, ride along in ``row``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import bounded_broadcast, fold, land

#: Counters of the frequent-items sketch (a power of two), and so the most rows ever broadcast.
TRACKED = 4096
#: A verified digest is handled map-side from so many rows.
HEAVY_ROWS = 64


def with_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``digest`` (SHA-256 of the folded text, lowercase hex) and ``row`` (all of ``df``'s columns)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("id"), F.sha2(fold(text).cast("binary"), 256).alias("digest"), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))


def heavy_digests(digests: DataFrame, tracked: int = TRACKED, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Verified winners of ``digests(id, digest)``: ``digest, heavy_keep, heavy_size`` and
    ``heavy_tops``, the rows with the largest id; at most ``tracked`` rows."""
    top = digests.agg(F.expr(f"approx_top_k(digest, {tracked // 2}, {tracked})").alias("top"))
    candidates = top.select(F.explode("top.item").alias("digest"))
    counted = digests.join(F.broadcast(candidates), "digest", "left_semi").groupBy("digest")
    found = counted.agg(F.max("id").alias("heavy_keep"), F.count(F.lit(1)).alias("heavy_size"))
    winners = land(found.where(F.col("heavy_size") >= heavy_rows), "winners")
    tops = digests.join(F.broadcast(winners), "digest").where(F.col("id").eqNullSafe(F.col("heavy_keep")))
    return land(tops.groupBy("digest", "heavy_keep", "heavy_size").agg(F.count(F.lit(1)).alias("heavy_tops")), "heavy")


def mark(digested: DataFrame, winners: DataFrame) -> DataFrame:
    """``digested`` with ``keep_id``, ``group_size`` and ``kept``."""
    split = digested.join(F.broadcast(winners), "digest", "left")
    carried = digested.columns
    lost = F.col("heavy_size").isNotNull() & ~F.col("id").eqNullSafe(F.col("heavy_keep"))
    removed = split.where(lost).select(*carried, F.col("heavy_keep").alias("keep_id"), F.col("heavy_size").alias("group_size"), F.lit(False).alias("kept"))
    group = Window.partitionBy("digest")
    many = F.coalesce(F.col("heavy_tops") >= HEAVY_ROWS, F.lit(False))
    ranked = split.where(~lost & ~many).select(
        *carried,
        F.max("id").over(group).alias("keep_id"),
        F.coalesce(F.col("heavy_size"), F.count(F.lit(1)).over(group)).alias("group_size"),
        (F.row_number().over(group.orderBy(F.col("id").desc_nulls_last())) == 1).alias("kept"),
    )
    marked = removed.unionByName(ranked)
    if winners.where(many).isEmpty():
        return marked
    order = F.col("id").desc_nulls_last()
    tops = split.where(~lost & many).withColumn("_task", F.spark_partition_id())
    tops = tops.withColumn("_place", F.row_number().over(Window.partitionBy("digest", "_task").orderBy(order)))
    # the first of each task meet, the others stay with their task
    tops = tops.withColumn("_task", F.when(F.col("_place") == 1, F.lit(-1)).otherwise(F.col("_task")))
    first = F.row_number().over(Window.partitionBy("digest", "_task").orderBy(order)) == 1
    tops = tops.select(*carried, F.col("heavy_keep").alias("keep_id"), F.col("heavy_size").alias("group_size"), ((F.col("_task") == -1) & first).alias("kept"))
    return marked.unionByName(tops)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    digests = land(with_digest(df, id_col, text_col).select("id", "digest"), "digests")
    return mark(digests, heavy_digests(digests)).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the rows that an equal text with a larger id (or an equal row) stands for.

    Decided on the landed ids and digests; texts do not move. Ids none of whose rows stays are
    dropped by an anti join. Only rows of ids that occur more than once, or are null, are looked
    at again: of those equal in id and text one is taken, folded where they are read.
    """
    digests = land(with_digest(df, id_col, text_col).select("id", "digest"), "digests")
    marked = land(mark(digests, heavy_digests(digests)).select("id", "digest", "kept"), "marked")
    ids = marked.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.count_if("kept").alias("stay"))
    ids = land(ids.where("stay = 0 or rows > 1 or id is null"), "ids")
    gone = ids.where("stay = 0 or rows > 1 or id is null").select(F.col("id").alias("_gone"))
    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.col(id_col).alias("_id"))
    plain = packed.join(bounded_broadcast(gone), F.col("_id").eqNullSafe(F.col("_gone")), "left_anti").select("row.*")
    again = ids.where("stay > 0").select(F.col("id").alias("_again"))
    if again.isEmpty():
        return plain
    rows = with_digest(df, id_col, text_col).join(bounded_broadcast(again), F.col("id").eqNullSafe(F.col("_again")), "left_semi")
    winners = marked.where("kept").select(F.col("id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    one = rows.groupBy("id", "digest").agg(F.first("row").alias("row"))
    staying = one.join(winners, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left_semi")
    return plain.unionByName(staying.select("row.*"))


def oracle_sql() -> str:
    text = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
        WITH t AS (SELECT doc_id, sha256({text}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)"""
