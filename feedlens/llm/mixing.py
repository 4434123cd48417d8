"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words: the total is shared by weight, a source's target
stops at ``MAX_COPIES`` times its size and the excess is shared again by weight among the
others until none is above. Inside a source a document's expected copies are
``min(MAX_COPIES, t * g)``, where ``g`` rises with the square root of its size up to
``FULL_WORDS`` words and ``t`` makes the expected words meet the target. Whole copies are
certain. For the fractions, documents are ranked by the Pareto variable

    [u / (1 - u)] / [f / (1 - f)]     u: random, fixed by the document; f: the fraction

and taken in that order while they fit in the source's remaining words: an unequal-probability
sample of fixed size in words. A long document at the boundary would leave a gap, so up to
``ROUNDS`` times the documents that still fit in what is left are taken in the same order.

At scale: after one pass over the texts all work is on a landed table of sizes; the ranking
is a range-partitioned running sum, so a source may hold any share of the rows; targets are
found by a few small aggregates over the sources.

Defined cases: a null or empty text has size 0 and takes 0 words (its copies are certain ones
only); a null source is a source of its own, last in order; null ids and repeated rows are
documents of their own (equal rows share their random number); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import WORD_RE, bounded_broadcast, land, running

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
#: Documents below so many words are taken less often.
FULL_WORDS = 50
ROUNDS = 3
SEED = 20240229


def sizes(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``doc_id, source, size, u``: the words of each document and its random number in (0, 1)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    random = F.xxhash64(F.lit(SEED), F.col(id_col).cast("bigint"), F.xxhash64(text))
    return df.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD_RE)).cast("bigint").alias("size"),
        ((F.shiftrightunsigned(random, 11) + F.lit(0.5)) / F.lit(float(1 << 53))).alias("u"),
        F.xxhash64(text).alias("tie"),
    )


def source_targets(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MAX_COPIES) -> DataFrame:
    """``source, source_size, target`` for each source of ``docs(source, size)``."""
    summed = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = running(summed.withColumn("last", F.col("source").isNull()), ["last", "source"], F.lit(1), [], "sources")
    table = F.array(*(F.lit(float(w)) for w in weights))
    weighed = land(placed.select("source", "source_size", F.get(table, (F.col("before") % len(weights)).cast("int")).alias("weight")), "weights")
    total = weighed.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    level, before = 0.0, -1.0
    cap = F.col("source_size") * float(most)
    # a source stops at its cap; what is over is shared again by weight: the level rises until nothing is over
    while level != before:
        free = cap > F.col("weight") * F.lit(level)
        row = weighed.agg(F.sum(F.when(free, F.col("weight"))).alias("w"), F.sum(F.when(~free, cap)).alias("c")).first()
        before, level = level, ((total - (row["c"] or 0.0)) / row["w"] if row["w"] else level)
    return weighed.select("source", "source_size", F.least(cap, F.col("weight") * F.lit(level)).cast("double").alias("target"))


def merit(size: Column) -> Column:
    """How much more often a document is taken than the shortest ones."""
    return F.sqrt(F.least(F.greatest(size, F.lit(1)), F.lit(FULL_WORDS)) / F.lit(float(FULL_WORDS)))


def _solve(rows):
    """The factor of one source from its sizes by merit (at most ``FULL_WORDS`` rows)."""
    import numpy as np

    g, words, target = rows["g"].to_numpy(), rows["words"].to_numpy().astype(float), float(rows["target"].iloc[0])
    order = np.argsort(-g)
    factor, capped = 0.0, 0.0
    for k in range(len(order) + 1):  # the k documents of highest merit are at the cap
        rest = order[k:]
        weight = float((g[rest] * words[rest]).sum())
        if weight <= 0:
            factor = MAX_COPIES / max(float(g.min()), 1e-9)
            break
        factor = (target - capped) / weight
        if factor * g[rest].max() <= MAX_COPIES * (1 + 1e-12):
            break
        capped += MAX_COPIES * words[order[k]]
    out = rows.iloc[:1][["source"]].copy()
    out["factor"] = factor
    return out


def copies(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``n_copies``."""
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    same = F.col("source").eqNullSafe(F.col("_source"))
    by_merit = docs.groupBy("source", merit(F.col("size")).alias("g")).agg(F.sum("size").alias("words")).join(t, same).drop("_source")
    factors = by_merit.groupBy("source").applyInPandas(_solve, "source string, factor double")
    known = t.join(factors, F.col("_source").eqNullSafe(F.col("source"))).drop("source")
    known = land(known, "factors")
    expected = docs.join(known, same).drop("_source").withColumn("c", F.least(F.lit(float(MAX_COPIES)), F.col("factor") * merit(F.col("size"))))
    split = expected.withColumn("whole", F.floor(F.col("c") + 1e-9)).withColumn("f", F.greatest(F.lit(0.0), F.col("c") - F.col("whole")))
    split = land(split.withColumn("f", F.when(F.col("f") > 1e-9, F.col("f")).otherwise(0.0)), "expected")
    columns = [*docs.columns, "source_size", "target"]
    done = split.where("f = 0 or size = 0").select(*columns, F.col("whole").cast("bigint").alias("n_copies"))
    pareto = (F.col("u") / (1 - F.col("u"))) / (F.col("f") / (1 - F.col("f")))
    pool = split.where("f > 0 and size > 0").withColumn("q", pareto).drop("c", "f", "factor")
    taken = split.groupBy("source", "target").agg(F.sum(F.col("whole") * F.col("size")).alias("got"))
    gaps = land(taken.select("source", (F.col("target") - F.col("got")).alias("gap")), "gaps")
    beside = lambda rows: rows.join(gaps.withColumnRenamed("source", "_source"), same).drop("_source")
    for _ in range(ROUNDS):
        ranked = running(beside(pool).where("size <= gap"), ["source", "q", "doc_id", "tie"], F.col("size"), ["source"], "ranked")
        ranked = land(ranked.withColumn("more", F.col("before") + F.col("size") <= F.col("gap")), "drawn")
        over = beside(pool).where("size > gap")
        done = done.unionByName(ranked.where("more").select(*columns, (F.col("whole") + 1).cast("bigint").alias("n_copies")))
        done = done.unionByName(over.select(*columns, F.col("whole").cast("bigint").alias("n_copies")))
        got = ranked.where("more").groupBy("source").agg(F.sum("size").alias("got")).withColumnRenamed("source", "_source")
        pool = ranked.where(~F.col("more")).select(*pool.columns)
        gaps = land(gaps.join(got, same, "left").select("source", (F.col("gap") - F.coalesce("got", F.lit(0))).alias("gap")), "gaps")
    return done.unionByName(pool.select(*columns, F.col("whole").cast("bigint").alias("n_copies")))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, n_copies``."""
    docs = land(sizes(df, id_col, text_col, source_col), "sizes")
    drawn = copies(docs, source_targets(docs))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("n_copies")).alias("taken"), "n_copies")


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it. Copies are found by id and text,
    so only ids, text hashes and counts are joined back. Equal rows (same id and text) share
    the copies they were given, the first ones one more if these do not divide."""
    docs = land(sizes(df, id_col, text_col, source_col), "sizes")
    drawn = copies(docs, source_targets(docs)).groupBy("doc_id", "tie").agg(F.sum("n_copies").alias("n"), F.count(F.lit(1)).alias("rows"))
    drawn = land(drawn.where("n > 0").select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), "n", "rows"), "copies")
    kept = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.col(id_col).cast("bigint").alias("_doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_hash"))
    joined = kept.join(bounded_broadcast(drawn), F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_tie")))
    place = F.row_number().over(Window.partitionBy("_doc", "_hash").orderBy(F.lit(0)))
    shared = joined.where("rows > 1").withColumn("place", place)
    shared = shared.select("row", (F.floor(F.col("n") / F.col("rows")) + (F.col("place") <= F.col("n") % F.col("rows")).cast("bigint")).alias("n"))
    each = joined.where("rows = 1").select("row", "n").unionByName(shared).where("n > 0")
    return each.select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("row.*")
