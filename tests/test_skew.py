"""A hot word in every post: results stay exact and whole, the shuffle plan
splits the hot word by a salt, the aggregate-first plan folds it map-side. Checked against a brute-force count on the fixture."""

from __future__ import annotations

import contextlib
import io
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedlens import config
from feedlens.operators import detect

N_POSTS = 3000
N_ENTRIES = 500


def _fixture(spark):
    posts = spark.range(N_POSTS).select(
        F.col("id").alias("post_id"),
        F.concat(F.lit("hot w"), F.col("id").cast("string")).alias("title"),
        F.concat(F.lit("x"), F.col("id").cast("string"), F.lit(" y"), (F.col("id") % 7).cast("string")).alias("selftext"),
    )
    dic = spark.range(N_ENTRIES).select(
        F.lit("Place").alias("entity_type"), F.concat(F.lit("w"), (F.col("id") * 6).cast("string")).alias("entity_name")
    ).unionByName(spark.createDataFrame([("Person", "Hot"), ("Place", "hot")], "entity_type string, entity_name string"))
    return posts, dic


def _brute_force():
    entries = [("Place", f"w{i * 6}") for i in range(N_ENTRIES)] + [("Person", "Hot"), ("Place", "hot")]
    out = Counter()
    for i in range(N_POSTS):
        for text in (f"hot w{i}", f"x{i} y{i % 7}"):
            words = set(text.lower().split())
            for t, n in entries:
                if n.lower() in words:
                    out[(t, n)] += 1
    return out


@pytest.fixture()
def no_skew_join(spark):
    keys = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_hot_word_is_salted_without_skew_join(spark, no_skew_join, monkeypatch):
    """The engine splits a hot word itself: no setting of the session does it."""
    monkeypatch.setattr(config, "HOT_SHARE", 40)
    posts, dic = _fixture(spark)
    prepared = detect.prepare_dictionary(dic, force="shuffle")
    hits = detect.entity_hits(posts, prepared)
    assert Counter((r["entity_type"], r["entity_name"]) for r in hits.collect()) == _brute_force()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        hits.explain()
    assert "SortMergeJoin" in buf.getvalue() and "ShuffledHashJoin" not in buf.getvalue()
    cut = detect.restrict_to_corpus(posts, prepared)
    joined = detect.salted_join(detect.field_words(posts), cut, ("post_id",))
    salts = {r["word"]: r["n"] for r in joined.groupBy("word").agg(F.countDistinct("salt").alias("n")).collect()}
    assert salts["hot"] >= 8 and salts["w6"] == 1


def test_hot_words_without_an_entry_do_not_move(spark):
    posts = spark.range(500).select(F.col("id").alias("post_id"), F.lit("common w1").alias("title"), F.lit("common").alias("selftext"))
    dic = spark.createDataFrame([("Place", "w1")], "entity_type string, entity_name string")
    cut = detect.restrict_to_corpus(posts, detect.prepare_dictionary(dic, force="shuffle"))
    assert detect.salted_join(detect.field_words(posts), cut, ("post_id",)).count() == 500


@pytest.mark.parametrize("filter_bytes, times", [(None, 1), (0, 2)])
def test_over_bound_hits_read_the_corpus_once(spark, tmpdir_path, monkeypatch, filter_bytes, times):
    """Once, behind the filter of keys; twice only where that filter is over its bound (for the
    vocabulary and for the hits). Measuring and joining read landed tables."""
    if filter_bytes is not None:
        monkeypatch.setattr(config, "MAX_BROADCAST_FILTER_BYTES", filter_bytes)
    posts, dic = _fixture(spark)
    path = f"{tmpdir_path}/posts"
    posts.write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    seen = spark.read.parquet(path).mapInArrow(counted, posts.schema)
    hits = detect.entity_hits(seen, detect.prepare_dictionary(dic, max_rows=300))
    assert Counter((r["entity_type"], r["entity_name"]) for r in hits.collect()) == _brute_force()
    assert reads.value == times * N_POSTS


def test_hot_word_counts_all_plans_exact(spark):
    posts, dic = _fixture(spark)
    expected = _brute_force()
    for prep, plan in (
        (detect.prepare_dictionary(dic), "broadcast"),
        (detect.prepare_dictionary(dic, force="shuffle"), "aggregate_first"),
    ):
        got = {(r[0], r[1]): r[2] for r in detect.entity_counts(posts, prep, plan=plan).collect()}
        assert got == dict(expected)


def test_large_dictionary_hits_are_broadcast_after_restriction(spark):
    """Over the bound, the dictionary is cut to entries present in the corpus
    (exactly), re-measured, and broadcast when that fits."""
    posts, dic = _fixture(spark)
    # 502 entries > bound of 300 rows; entries present in the corpus: 2 + 500
    big = detect.prepare_dictionary(dic, max_rows=300)
    assert big.broadcast is False
    cut = detect.restrict_to_corpus(posts, big, max_rows=600)
    assert cut.broadcast is True and cut.rows == 502
    hits = detect.entity_hits(posts, big)
    got = Counter((r["entity_type"], r["entity_name"]) for r in hits.collect())
    assert got == _brute_force()


def test_restriction_drops_absent_entries(spark):
    posts, dic = _fixture(spark)
    absent = spark.createDataFrame([("Place", f"zz{i}") for i in range(50)], "entity_type string, entity_name string")
    big = detect.prepare_dictionary(dic.unionByName(absent), max_rows=10)
    cut = detect.restrict_to_corpus(posts, big)
    assert cut.rows == 502

