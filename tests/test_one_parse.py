"""Feeds are parsed once; a field's kind comes from its VARIANT."""

from __future__ import annotations

import json
import os

import pytest

from feedlens.operators import posts
from feedlens.sources import feeds as feedsrc


def feed(*children: str) -> str:
    return '{"data":{"children":[' + ",".join('{"data":%s}' % c for c in children) + "]}}"


def parsed(spark, *contents: str | None):
    rows = [(i, "n", "u", c) for i, c in enumerate(contents)]
    df = posts.parse_feeds(spark.createDataFrame(rows, "feed_id bigint, feed_name string, url string, content string"))
    return [(r.parse_ok, [tuple(p) for p in r.posts]) for r in sorted(df.collect(), key=lambda r: r.feed_id)]


def texts(plan: str, name: str) -> int:
    return plan.lower().count(f"{name}(")


def test_the_plan_has_one_parse_of_the_content(spark):
    df = posts.parse_feeds(spark.createDataFrame([(1, "n", "u", "{}")], "feed_id bigint, feed_name string, url string, content string"))
    for plan in (df, posts.explode_posts(df), posts.live_filter(posts.explode_posts(df))):
        optimised = plan._jdf.queryExecution().optimizedPlan().toString()
        assert texts(optimised, "from_json") + texts(optimised, "jsontostructs") == 1, optimised
        assert "parse_json" not in optimised


@pytest.mark.parametrize(
    "value, text",
    [('"x"', "x"), ('"[Question] how"', "[Question] how"), ('"{}"', "{}"), ('"[1, 2]"', "[1, 2]"), ('""', ""), ("null", None), ("true", "true"), ("7", "7"), ("-12", "-12"),
     ("1.50", "1.5"), ("2.0", "2.0"), ("1e3", "1000.0"), ("100000000.5", "1.000000005E8"), ("12345678901234567890", "12345678901234567890"), ('"\\u00e9\\n"', "é\n")],
)
def test_scalar_fields(spark, value, text):
    assert parsed(spark, feed('{"title":%s,"selftext":"b"}' % value)) == [(True, [(text, "b")])]


@pytest.mark.parametrize("value", ["{}", "[]", '{"a":1}', "[1]", '{"a":1,"a":2}'])
def test_nested_fields_reject_the_feed(spark, value):
    assert parsed(spark, feed('{"title":"a","selftext":"b"}', '{"title":%s,"selftext":"b"}' % value)) == [(False, [])]


def test_other_shapes(spark):
    wrong = [None, "", "<html>", "[]", "{}", '{"data":[1]}', '{"data":{"children":null}}', '{"data":{"children":[5]}}', '{"data":{"children":[null]}}', '{"data":{"children":[{}]}}',
             '{"data":{"children":[{"data":null}]}}', feed('"text"'), feed('{"title":"a"}'), feed('{"selftext":"a"}'), feed('{"title":"a","selftext":"b"}')[:-3]]
    assert parsed(spark, *wrong) == [(False, [])] * len(wrong)
    right = ['{"data":{"children":[]}}', feed('{"title":"a","title":"b","selftext":"c","other":{"k":1,"k":[2]}}'), feed('{"selftext":"b","title":"a"}') + " and more"]
    assert parsed(spark, *right) == [(True, []), (True, [("b", "c")]), (True, [("a", "b")])]


def test_post_lines_follow_the_same_rules(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "posts.jsonl")
    lines = ['{"title":"[x]","selftext":"{y}"}', '{"title":1.50,"selftext":null}', '{"title":"a"}', '{"title":[1],"selftext":"b"}', "nonsense", json.dumps({"title": "é", "selftext": "z", "n": {}})]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n\n")
    got = [tuple(r)[1:] for r in feedsrc.read_post_lines(spark, path).collect()]
    assert got == [(True, "[x]", "{y}"), (True, "1.5", None), (False, None, None), (False, None, None), (False, None, None), (True, "é", "z")]
    plan = feedsrc.read_post_lines(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert texts(plan, "from_json") + texts(plan, "jsontostructs") == 1
