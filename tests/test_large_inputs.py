"""Feeds, fields and subscription files beyond the JSON library's own limits are kept whole."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from feedlens.operators import posts, stats
from feedlens.sources import feeds as feedsrc
from feedlens.sources import subscriptions as subsrc

MIB = 1 << 20


def _feeds(spark, *fields):
    """One feed whose children are built by Spark: (title, length of selftext) each."""
    zero = F.col("id").cast("int")  # not foldable: the text is made in the task, not in the plan
    child = lambda t, n: F.concat(F.lit('{"data":{"title":"%s","selftext":"' % t), F.repeat(F.lit("x"), zero + n), F.lit('"}}'))
    body = F.concat(F.lit('{"data":{"children":['), F.concat_ws(",", *(child(t, n) for t, n in fields)), F.lit("]}}"))
    return spark.range(1).select(F.col("id").alias("feed_id"), F.lit("f").alias("feed_name"), F.lit("u").alias("url"), body.alias("content"))


def test_feed_of_130_mib(spark):
    parsed = posts.parse_feeds(_feeds(spark, *((f"t{i}", MIB) for i in range(130))))
    row = parsed.select("parse_ok", F.size("posts").alias("n"), F.forall("posts", lambda p: F.length(p["selftext"]) == MIB).alias("whole")).first()
    assert (row.parse_ok, row.n, row.whole) == (True, 130, True)


def test_field_of_20_mib_keeps_its_feed(spark):
    parsed = posts.parse_feeds(_feeds(spark, ("a", 10), ("b", 20 * MIB), ("c", 5)))
    row = stats.processing_stats(parsed).first()
    assert (row.posts_success, row.posts_filtered, row.avg_chars) == (3, 0, (3 + 15 + 20 * MIB) // 3)


@pytest.fixture(scope="module")
def large_folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("large"))


def test_subscriptions_file_of_130_mib(spark, large_folder):
    path = os.path.join(large_folder, "subs.json")
    with open(path, "w") as f:
        f.write("[")
        for i in range(130):
            f.write(("," if i else "") + '{"name":"n%d","url":"u","note":"%s"}' % (i, "x" * MIB))
        f.write("]")
    assert subsrc.read_subscriptions(spark, path).valid.count() == 130


def test_lines_with_a_20_mib_field(spark, large_folder):
    entry, post = os.path.join(large_folder, "s.jsonl"), os.path.join(large_folder, "p.jsonl")
    with open(entry, "w") as f:
        f.write('{"name":"n","url":"%s"}\n' % ("u" * 20 * MIB))
    with open(post, "w") as f:
        f.write('{"title":"t","selftext":"%s"}\n{"title":"t"}\n' % ("s" * 20 * MIB))
    assert subsrc.read_subscription_lines(spark, entry).valid.select(F.length("url")).first()[0] == 20 * MIB
    got = [(r.line_ok, r.n) for r in feedsrc.read_post_lines(spark, post).select("line_ok", F.length("selftext").alias("n")).collect()]
    assert got == [(True, 20 * MIB), (False, None)]
