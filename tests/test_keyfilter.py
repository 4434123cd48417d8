from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from feedlens import config
from feedlens.operators import detect, keyfilter


@pytest.mark.parametrize("n", [1, 100, 20_000])
def test_keys_pass_and_few_others(spark, n):
    keys = spark.range(n).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    built = keyfilter.build(keys.union(keys), "key", n)  # repeats set the same bits
    assert built.blocks.count() <= built.n_blocks == keyfilter.blocks_for(n)
    assert keyfilter.passing(keys, "key", built).count() == n
    others = spark.range(50_000).select(F.concat(F.lit("other"), F.col("id")).alias("key"), F.lit(1).alias("more"))
    passed = keyfilter.passing(others, "key", built)
    assert passed.columns == ["key", "more"] and passed.count() < 0.01 * 50_000


def test_every_bit_of_a_block_is_found(spark):
    """The longs hold the bits where the bitmap functions put them."""
    bits = spark.range(0, 32_768, 7).select(F.lit(0).alias("block"), F.col("id").alias("position"))
    made = bits.groupBy("block").agg(F.bitmap_construct_agg("position").alias("bits"))
    longs = F.transform(F.sequence(F.lit(0), F.lit(511)), lambda k: F.conv(F.hex(F.substring("bits", k * 8 + 1, F.lit(8))), 16, -10).cast("bigint"))
    probes = spark.range(32_768).select(F.col("id").cast("int").alias("p")).crossJoin(F.broadcast(made.select(longs.alias("longs"))))
    wrong = probes.where(keyfilter._bit(F.col("longs"), F.col("p")) != (F.col("p") % 7 == 0))
    assert wrong.count() == 0


def test_nothing_and_nulls(spark):
    none = spark.createDataFrame([], "key string")
    rows = spark.createDataFrame([("a",), (None,), ("",)], "key string")
    assert keyfilter.passing(rows, "key", keyfilter.build(none, "key", 0)).count() == 0
    assert {r.key for r in keyfilter.passing(rows, "key", keyfilter.build(rows.where("key is not null"), "key", 2)).collect()} >= {"a", ""}


def test_bound(monkeypatch):
    assert keyfilter.fits(100_000_000) and not keyfilter.fits(1_000_000_000)
    monkeypatch.setattr(config, "MAX_BROADCAST_FILTER_BYTES", 1000)
    assert not keyfilter.fits(1)


def test_tokens_are_dropped_where_they_are_read(spark):
    """No exchange between the scan and the filter, and only candidates are landed."""
    posts = spark.range(2000).select(F.col("id").alias("post_id"), F.concat(F.lit("common w"), F.col("id")).alias("title"), F.lit("common words here").alias("selftext"))
    dic = spark.range(0, 2000, 100).select(F.lit("Place").alias("entity_type"), F.concat(F.lit("W"), F.col("id")).alias("entity_name"))
    prepared = detect.prepare_dictionary(dic, force="shuffle")
    built = keyfilter.build(prepared.df, "key", prepared.rows)
    passed = keyfilter.passing(detect.field_words(posts), "word", built)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        passed.explain()
    plan = out.getvalue()
    assert "BroadcastHashJoin" in plan and "Python" not in plan
    assert "Exchange hashpartitioning" not in plan.split("BroadcastExchange")[0]
    assert detect.candidate_words(posts, prepared, ("post_id",)).count() < 20 + 0.01 * 10_000
    assert detect.entity_hits(posts, prepared).count() == 20
