"""Per-operator edge cases: Java string semantics, feed JSON rules, filters,
subscription files, dictionary cleaning, aggregates."""

from __future__ import annotations

import os

import pytest
from conftest import ENTITIES_DIR, write_json
from pyspark.sql import functions as F

from feedlens.functions.text import java_trim, tokens, utf16_length, word_set
from feedlens.operators import aggregate, detect, posts, stats
from feedlens.sources import dictionary as dictsrc
from feedlens.sources import subscriptions as subsrc
from feedlens.sources.tables import literal_dictionary


def one(spark, value):
    return spark.createDataFrame([(value,)], "x string")


# ------------------------------------------------------------ text (X1-X7) --

def test_java_trim_strips_control_chars(spark):
    assert one(spark, "\t\n").select(F.length(java_trim("x"))).first()[0] == 0
    assert one(spark, " \x01a b\x1f ").select(java_trim("x")).first()[0] == "a b"


def test_split_uses_java_whitespace(spark):
    # vertical tab splits, no-break space does not
    assert one(spark, "x\u000by z").select(tokens("x")).first()[0] == ["x", "y z"]


def test_utf16_length_counts_surrogates(spark):
    assert one(spark, "\U0001F600a").select(utf16_length("x")).first()[0] == 3


def test_lower_full_case_mapping(spark):
    assert one(spark, "İ").select(F.length(F.lower("x"))).first()[0] == 2


def test_word_set_keeps_punctuation_and_dedups(spark):
    got = sorted(one(spark, "Scala scala SCALA, c++").select(word_set("x")).first()[0])
    assert got == ["c++", "scala", "scala,"]


# ---------------------------------------------------- feed parse (P1, N1-N5) --

def _parse(spark, content):
    df = spark.createDataFrame([(1, "f", "u", content)], "feed_id bigint, feed_name string, url string, content string")
    return posts.parse_feeds(df).first()


@pytest.mark.parametrize(
    "content, ok, expected",
    [
        ('{"data":{"children":[{"data":{"title":"a","selftext":"b"}}]}}', True, [("a", "b")]),
        ('{"data":{"children":[{"data":{"title":"a"}}]}}', False, []),  # missing field
        ('{"data":{"children":[{"data":{"title":"a","selftext":null}}]}}', True, [("a", None)]),
        ('{"data":{"children":[{"data":{"title":"a","selftext":{"a":1}}}]}}', False, []),
        ('{"data":{"children":[{"data":{"title":"a","selftext":[1]}}]}}', False, []),
        ('{"data":{"children":[{"data":{"title":"a","selftext":5}}]}}', True, [("a", "5")]),
        ('{"data":{"children":[{"data":{"title":true,"selftext":"s"}}]}}', True, [("true", "s")]),
        ("<html>", False, []),
        ('{"data":{}}', False, []),
        ('{"data":{"children":{"a":1}}}', False, []),
        ('{"data":{"children":[]}}', True, []),
        ('{"data":{"children":[{"data":{"title":"a","selftext":"b"}}, 5]}}', False, []),
        # documented choices where the reference's JSON library is not decidable from its source
        ('{"data":{"children":[{"data":{"title":"a","selftext":"b"}}]}} trailing', True, [("a", "b")]),
        ('{"data":{"children":[{"data":{"title":"a","title":"c","selftext":"b"}}]}}', True, [("c", "b")]),
        ('{"x":1,"x":2,"data":{"children":[{"data":{"title":"a","selftext":"b"}}]}}', True, [("a", "b")]),
        ('{"data":{"children":[{"data":{"title":"[OC] a","selftext":"{b}"}}]}}', True, [("[OC] a", "{b}")]),
        ('{"data":{"children":[{"data":{"title":"[x]","selftext":["x"]}}]}}', False, []),
        ('{"data":{"children":[{"data":{"title":"a","selftext":"b"}}]', False, []),  # cut short
        ('{"data":{"children":["{}"]}}', False, []),
        ('{"data":{"children":[null]}}', False, []),
    ],
)
def test_feed_parse_rules(spark, content, ok, expected):
    r = _parse(spark, content)
    assert r["downloaded"] is True
    assert r["parse_ok"] is ok
    assert [(p["title"], p["selftext"]) for p in r["posts"]] == expected


def test_failed_download_is_not_parsed(spark):
    r = _parse(spark, None)
    assert (r["downloaded"], r["parse_ok"], r["posts"]) == (False, False, [])


def test_null_field_post_is_dropped_and_counted(spark):
    df = spark.createDataFrame(
        [(1, "f", "u", '{"data":{"children":[{"data":{"title":"a","selftext":null}},{"data":{"title":"t","selftext":"s"}}]}}')],
        "feed_id bigint, feed_name string, url string, content string",
    )
    s = stats.processing_stats(posts.parse_feeds(df)).first().asDict()
    assert s == {"feeds_success": 1, "feeds_failed": 0, "posts_success": 2, "posts_failed": 1,
                 "posts_filtered": 1, "avg_chars": 2}


# --------------------------------------------------------- filters F1, F2 ----

def test_live_and_strict_filters(spark):
    df = spark.createDataFrame(
        [(1, "t", "s"), (2, "", "s"), (3, "t", " "), (4, "t", "\t\n"), (5, " ", "s"), (6, None, "s")],
        "post_id bigint, title string, selftext string",
    )
    assert sorted(r[0] for r in posts.live_filter(df).select("post_id").collect()) == [1, 3, 4, 5]
    assert sorted(r[0] for r in posts.strict_filter(df).select("post_id").collect()) == [1, 5]
    c = posts.post_counts(df).first()
    # a NULL field is dropped, and counted as dropped (total - kept)
    assert (c["posts_total"], c["posts_kept"], c["posts_dropped"]) == (6, 4, 2)


def test_avg_chars_zero_when_nothing_kept(spark):
    df = spark.createDataFrame([(1, "", "s")], "post_id bigint, title string, selftext string")
    assert posts.avg_post_chars(df).first()["avg_chars"] == 0


# ------------------------------------------------------ subscriptions (S1) --

@pytest.mark.parametrize(
    "text, valid_file, n_valid, n_rejected",
    [
        ('[{"name":"a","url":"u"},{"x":"y"}]', True, 1, 1),
        ('{"name":"a","url":"u"}', False, 0, 0),
        ('[{"name":"a"},5]', False, 0, 0),
        ('[{"name":null,"url":"u"}]', True, 0, 1),
        ("[]", True, 0, 0),
        ("no JSON here", False, 0, 0),
        ('[{"name":"a","url":"u","extra":"z"}]', True, 1, 0),
        ('[{"name":"a","name":"b","url":"u"}]', True, 1, 0),  # a key given twice: the last value
        ('[{"name":"[a]","url":"{u"}]', True, 1, 0),
        ('[{"name":{"a":1},"url":"u"}]', False, 0, 0),
        ('[{"name":"a","url":"u","extra":["z"]}]', False, 0, 0),
        ('["{}"]', False, 0, 0),
    ],
)
def test_subscription_files(spark, tmpdir_path, text, valid_file, n_valid, n_rejected):
    p = os.path.join(tmpdir_path, "s.json")
    with open(p, "w") as f:
        f.write(text)
    if not valid_file:
        with pytest.raises(subsrc.InvalidSubscriptionsFile):
            subsrc.read_subscriptions(spark, p)
        return
    s = subsrc.read_subscriptions(spark, p)
    assert s.valid.count() == n_valid
    assert s.rejected.count() == n_rejected


def test_feed_ids_are_unique_over_files(spark, tmpdir_path):
    for name in ("s1.json", "s2.json"):
        write_json(os.path.join(tmpdir_path, name), [{"name": "a", "url": "u1"}, {"name": "a", "url": "u1"}])
    got = subsrc.read_subscriptions(spark, tmpdir_path).valid
    ids = [r.feed_id for r in got.collect()]
    assert len(set(ids)) == 4
    assert ids == [r.feed_id for r in subsrc.read_subscriptions(spark, tmpdir_path).valid.collect()]


# ------------------------------------------------------------ dictionary ----

def test_reference_dictionary_load(spark):
    d = dictsrc.load_dictionary(spark, ENTITIES_DIR)
    assert d.count() == 167
    by_type = {r["entity_type"]: r["count"] for r in d.groupBy("entity_type").count().collect()}
    assert by_type == {"Person": 13, "University": 10, "ProgrammingLanguage": 17, "Organization": 15, "Place": 112}
    # duplicates are kept
    assert d.where("entity_name = 'Stockholm'").count() == 2
    assert d.where("entity_name like '#%'").count() == 0


def test_dictionary_cleaning(spark):
    lines = spark.createDataFrame(
        [("people.txt", "  Ada  "), ("people.txt", "\t"), ("people.txt", " # comment"),
         ("people.txt", "a#b"), ("other.txt", "Zed"), ("places.txt", "New York")],
        "file_name string, value string",
    )
    got = sorted(tuple(r) for r in dictsrc.type_by_file(dictsrc.clean_lines(lines)).select("entity_type", "entity_name").collect())
    assert got == [("Person", "Ada"), ("Person", "a#b"), ("Place", "New York")]


def test_type_fallback(spark):
    df = spark.createDataFrame([("Place",), ("Persona",), ("Technology",)], "t string")
    assert [r[0] for r in df.select(dictsrc.with_fallback_type("t")).collect()] == ["Place", "Person", "Technology"]


def test_single_file_with_given_type(spark):
    d = dictsrc.load_dictionary_file(spark, os.path.join(ENTITIES_DIR, "languages.txt"), "Nope")
    assert d.count() == 17 and {r[0] for r in d.select("entity_type").collect()} == {"Person"}


# ------------------------------------------------------- detect + aggregate --

def _posts(spark, rows):
    return spark.createDataFrame(rows, "post_id bigint, title string, selftext string")


def test_hits_presence_per_field_and_multiplicity(spark):
    p = _posts(spark, [(1, "in In IN", "in the"), (2, "nothing", "The end")])
    d = detect.prepare_dictionary(literal_dictionary(spark))
    hits = detect.entity_hits(p, d)
    got = sorted(tuple(r) for r in hits.collect())
    # post 1: 'in' once per field; Place 'In' is listed twice, University 'in' once
    assert got.count((1, "title", "Place", "In")) == 2
    assert got.count((1, "selftext", "Place", "In")) == 2
    assert got.count((1, "title", "University", "in")) == 1
    assert (2, "selftext", "Person", "The") in got
    counts = {(r[0], r[1]): r[2] for r in aggregate.entity_counts_from_hits(hits).collect()}
    assert counts[("Place", "In")] == 4 and counts[("Person", "The")] == 2


def test_multiword_entries_never_match(spark):
    p = _posts(spark, [(1, "New York", "new york")])
    d = detect.prepare_dictionary(literal_dictionary(spark))
    assert detect.entity_hits(p, d).count() == 0


def test_type_rollup_total_on_empty(spark):
    empty = spark.createDataFrame([], "entity_type string, entity_name string, n bigint")
    assert [tuple(r) for r in aggregate.type_counts_with_total(empty).collect()] == [("total", 0)]
    hits = spark.createDataFrame([], "entity_type string, entity_name string")
    assert [tuple(r) for r in aggregate.type_counts_from_hits(hits).collect()] == [("total", 0)]
    st = aggregate.type_stats(aggregate.type_counts_with_total(empty)).orderBy("ordinal").collect()
    assert [r["n"] for r in st] == [0] * 7


def test_unknown_type_counts_in_total_only(spark):
    counts = spark.createDataFrame([("Alien", "x", 3), ("Place", "y", 2)], "entity_type string, entity_name string, n bigint")
    st = {r["entity_type"]: r["n"] for r in aggregate.type_stats(aggregate.type_counts_with_total(counts)).collect()}
    assert st["total"] == 5 and st["Place"] == 2 and "Alien" not in st


def test_top_k_order_and_validation(spark):
    counts = spark.createDataFrame(
        [("B", "b", 2), ("A", "z", 2), ("A", "a", 2), ("C", "c", 5), ("A", "y", 1)],
        "entity_type string, entity_name string, n bigint",
    )
    got = [tuple(r) for r in aggregate.top_entities(counts, 3).collect()]
    assert got == [(1, "C", "c", 5), (2, "A", "a", 2), (3, "A", "z", 2)]
    for bad in (0, -1, 1.5, True):
        with pytest.raises(ValueError):
            aggregate.top_entities(counts, bad)


def test_extension_by_dimension_rows(spark, tmpdir_path):
    """A new type is a file-map row plus a type-list entry, no code change."""
    d = os.path.join(tmpdir_path, "ents")
    os.makedirs(d)
    with open(os.path.join(d, "tools.txt"), "w") as f:
        f.write("# tools\nSpark\nDuckDB\n")
    with open(os.path.join(d, "people.txt"), "w") as f:
        f.write("Ada\n")
    files = [("people.txt", "Person"), ("tools.txt", "Tool")]
    types = ["Person", "Tool"]
    dic = dictsrc.load_dictionary(spark, d, files)
    assert sorted(tuple(r) for r in dic.collect()) == [("Person", "Ada"), ("Tool", "DuckDB"), ("Tool", "Spark")]
    p = _posts(spark, [(1, "spark and duckdb", "ada")])
    counts = detect.entity_counts(p, detect.prepare_dictionary(dic))
    st = aggregate.type_stats(aggregate.type_counts_with_total(counts), types)
    assert [tuple(r) for r in st.orderBy("ordinal").collect()] == [(0, "total", 3), (1, "Person", 1), (2, "Tool", 2)]
    fb = spark.createDataFrame([("Tool",), ("Robot",)], "t string")
    assert [r[0] for r in fb.select(dictsrc.with_fallback_type("t", types)).collect()] == ["Tool", "Person"]


def test_dictionary_ignores_subdirectories(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "ents")
    for sub in ("sub", "k=v"):
        os.makedirs(os.path.join(d, sub))
        with open(os.path.join(d, sub, "people.txt"), "w") as f:
            f.write("Nested\n")
    with open(os.path.join(d, "people.txt"), "w") as f:
        f.write("Ada\n")
    with open(os.path.join(d, "notes.md"), "w") as f:
        f.write("Zed\n")
    assert [tuple(r) for r in dictsrc.load_dictionary(spark, d).collect()] == [("Person", "Ada")]
    assert sorted(r[0] for r in dictsrc.present_dictionary_files(spark, d).collect()) == ["people.txt"]
    empty = os.path.join(tmpdir_path, "empty")
    os.makedirs(empty)
    assert dictsrc.load_dictionary(spark, empty).count() == 0
    assert dictsrc.missing_dictionary_files(dictsrc.present_dictionary_files(spark, empty)).count() == 5
    with pytest.raises(dictsrc.DictionaryDirNotFound):
        dictsrc.load_dictionary(spark, os.path.join(tmpdir_path, "nope"))


def test_single_missing_file_contributes_nothing(spark, tmpdir_path):
    assert dictsrc.load_dictionary_file(spark, os.path.join(tmpdir_path, "none.txt"), "Place").count() == 0


def test_entity_type_dimension(spark):
    from feedlens.schemas import entity_types

    rows = [tuple(r) for r in entity_types(spark).orderBy("ordinal").collect()]
    assert rows == [(1, "Person"), (2, "Organization"), (3, "University"), (4, "Place"),
                    (5, "Technology"), (6, "ProgrammingLanguage")]


def test_type_stats_one_pass_equals_composition(spark):
    counts = spark.createDataFrame(
        [("Place", "a", 3), ("Place", "b", 2), ("Alien", "x", 4), ("University", "c", 1)],
        "entity_type string, entity_name string, n bigint",
    )
    empty = counts.where("false")
    for c in (counts, empty):
        one = sorted(tuple(r) for r in aggregate.type_stats_from_counts(c).collect())
        two = sorted(tuple(r) for r in aggregate.type_stats(aggregate.type_counts_with_total(c)).collect())
        assert one == two and len(one) == 7
