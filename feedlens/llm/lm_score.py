"""Scoring with a hierarchical Pitman-Yor language model.

Tokens are a text's lower-cased words and one end token. The model is a hierarchy of Chinese
restaurants: the root serves words over a uniform base of 1 / (V + 1); each *context* has a
restaurant whose new tables are customers of the root, which all contexts share as parent.
A token's context is the word right before it, whatever its length; a text's first token has a
context of its own. So there are as many restaurants as words that precede another.

Seating is sampled by Gibbs: all customers of a word in a restaurant leave and sit down again
one after another, each at a new table with probability
``A / (A + seated - d * tables)``, ``A = (theta + d * tables of the restaurant) * parent's
probability`` (beyond the first few in growing blocks, in which the probability is held; the
tables that have left are not counted). A
sweep does so for every word and context, then for the root. The tables of a whole restaurant
are summed over all words between rounds, as usual for distributed Gibbs. The predictive
probability is averaged over ``SAMPLES`` sweeps (of the whole, not of its factors), and each
context's mass sums to one over all words and an unknown one. Discounts come from the counts of counts.

How the work is spread: see ``lm_restaurants``. Each task reads *chunks* of about
``CHUNK_BYTES`` of text and keeps its documents as numbers of the chunk's distinct pairs; the
pairs are counted on a grid of twice as many shards as input partitions, and the answer for
each chunk's pairs goes back. So what is gathered grows with the corpus, and no vocabulary and
no restaurant need be in one place. Each text is read once. Arrays travel packed (``pack``), and
what a step has used up is deleted.

Defined cases: null and empty texts are the end token alone; null ids are never held out;
repeated rows count each time; with no training rows at all every token has probability one;
very long texts are whole (a chunk of their own); further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import bounded_batches, land, remainder, scratch_path

CHUNK_BYTES = 16_000_000
THETA = 1.0
#: Rounds that settle the restaurants' totals, sweeps before sampling, sweeps averaged.
ROUNDS, BURN_IN, SAMPLES = 2, 2, 4
HELD_MODULUS, HELD_REMAINDER = 7, 2
SEED = 11
#: Pairs are shuffled to their shards in so many parts, one after another.
PARTS = 2


#: Element kinds of a packed array, by its first byte.
KINDS = ["u1", "<u2", "<u4", "<i8", "<f4", "<f8"]


def pack(values: np.ndarray) -> bytes:
    """An array as bytes: whole numbers in as few bytes each as the largest needs, all first bytes
    before all second ones, so that bytes that are mostly zero compress away."""
    if values.dtype.kind == "f" and not (values.dtype.itemsize == 4 or len(values) and ((values < 0) | (values != np.floor(values)) | (values >= 2**53)).any()):
        values = values.astype(np.int64)
    if values.dtype.kind == "f":
        code = 4 if values.dtype.itemsize == 4 else 5
    else:
        most = int(values.max(initial=0)) if int(values.min(initial=0)) >= 0 else 2**32
        code = next((k for k in range(3) if most < 256 ** (1 << k)), 3)
    typed = np.ascontiguousarray(values.astype(KINDS[code]))
    return bytes([code]) + typed.view(np.uint8).reshape(len(typed), typed.itemsize).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    """The array, as 64-bit whole or floating numbers."""
    kind = np.dtype(KINDS[data[0]])
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind).astype(np.float64 if kind.kind == "f" else np.int64)


def unpacked(column) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a column of packed arrays."""
    parts = [unpack(x) for x in column.to_pylist()]
    return np.concatenate(parts) if parts else np.empty(0, np.int64), np.array([len(x) for x in parts], np.int64)


def reseat(n: np.ndarray, mass: np.ndarray, discount: float, random, grow: np.ndarray | float = 0.0) -> np.ndarray:
    """Tables after ``n`` customers sit down in turn; ``mass`` is A of the module's text without
    their own tables, each of which adds ``grow`` to it."""
    tables, seated = np.minimum(n, 1).astype(float), np.minimum(n, 1).astype(float)
    grow, active = np.broadcast_to(grow, n.shape), np.flatnonzero(n > 1)
    while len(active):
        i, t = seated[active], tables[active]
        a = mass[active] + grow[active] * t
        block = np.minimum(np.maximum(1, i // 8), n[active] - i)
        tables[active] = t + random.binomial(block.astype(np.int64), a / (a + i - discount * t))
        seated[active] = i + block
        active = active[seated[active] < n[active]]
    return tables


def unseen(model: dict) -> float:
    """The root's probability of a word without customers."""
    return (THETA + model["d0"] * model["S"]) * model["base"] / (THETA + model["R"])


def _score(model: dict):
    """For one chunk: the figures of its documents."""
    whole = np.log10(model["N"] + model["V"] + 1)

    def run(docs, answers):
        import pyarrow as pa

        answers = answers.sort_by("shard")
        logp, count = unpacked(answers.column("logp"))[0].astype(np.float64), unpacked(answers.column("count"))[0]
        tokens, n = unpacked(docs.column("tokens"))
        starts = np.cumsum(n) - n  # every document has its end token
        per = [np.add.reduceat(x[tokens], starts) for x in (logp, np.log10(count + 1.0), (count > 0).astype(np.int64))]
        return pa.table(
            [docs.column("doc_id"), docs.column("held_out"), pa.array(n), pa.array(per[2]), pa.array(np.full(len(n), model["N"], np.int64)), pa.array(per[1] - n * whole), pa.array(per[0])],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return run


def land_apart(encoded: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The pairs of chunks in ``PARTS`` parts of the shards, and their documents, landed in one
    pass in a folder each, so that a part can be deleted before the next is shuffled."""
    spark, path = encoded.sparkSession, scratch_path(encoded.sparkSession, name)
    part = F.when(F.col("shard") >= 0, F.col("shard") % PARTS).otherwise(-1)
    encoded.withColumn("part", part).write.option("compression", "zstd").partitionBy("part").parquet(path)
    for k in range(-1, PARTS):  # the folders are there without rows too
        spark.createDataFrame([], encoded.schema).write.mode("append").parquet(f"{path}/part={k}")
    docs, *pairs = (spark.read.schema(encoded.schema).parquet(f"{path}/part={k}") for k in range(-1, PARTS))
    return pairs, docs


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` and its ``perplexity``."""
    from feedlens.llm import lm_restaurants

    chosen = bounded_batches(df).selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")
    chosen = chosen.withColumn("held_out", F.coalesce(remainder(F.col("doc_id"), HELD_MODULUS) == HELD_REMAINDER, F.lit(False)))
    grid = lm_restaurants.side(max(8, 2 * chosen.rdd.getNumPartitions()))
    with lm_restaurants.tidy(df.sparkSession):
        parts, docs = land_apart(lm_restaurants.encode(chosen, grid), "encoded")
        path = scratch_path(df.sparkSession, "shards")
        for part in parts:
            pairs = part.select("chunk", "shard", "words", "contexts", "pair_word", "pair_context", "pair_n")
            merged = pairs.groupBy("shard").applyInArrow(lm_restaurants.merge(grid), lm_restaurants.SHARDS)
            merged.write.mode("append").option("compression", "zstd").parquet(path)
            lm_restaurants.drop_landed(part)
        shards = df.sparkSession.read.schema(lm_restaurants.SHARDS).parquet(path)
        model, letters = lm_restaurants.train(shards, grid)
        answers = shards.groupBy("shard").cogroup(letters.groupBy("cell")).applyInArrow(lm_restaurants.answer(model, grid), "chunk bigint, shard int, logp binary, count binary")
        answers = land(answers, "answers")
        for done in (letters, shards):
            lm_restaurants.drop_landed(done)
    docs = docs.select("chunk", "doc_id", "held_out", "tokens")
    scored = docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score(model), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
