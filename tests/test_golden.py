"""End-to-end run on the hand-computed golden fixture, and the guard cases."""

from __future__ import annotations

import os
import shutil

import pytest
from conftest import ENTITIES_DIR, feed_json, write_json

from feedlens.plans.analysis import run_analysis
from feedlens.plans.quality import NoValidPosts
from feedlens.sources.dictionary import DictionaryDirNotFound
from feedlens.sources.subscriptions import InvalidSubscriptionsFile, NoValidSubscriptions, SubscriptionsNotFound

EXPECTED_TOP = [
    (1, "Place", "Stockholm", 2),
    (2, "ProgrammingLanguage", "Scala", 2),
    (3, "Place", "Berkeley", 1),
    (4, "Place", "London", 1),
    (5, "ProgrammingLanguage", "C++", 1),
    (6, "ProgrammingLanguage", "Java", 1),
    (7, "ProgrammingLanguage", "JavaScript", 1),
    (8, "University", "Berkeley", 1),
]


@pytest.mark.parametrize("plan", ["auto", "broadcast", "aggregate_first"])
def test_golden_counts(spark, golden, plan):
    r = run_analysis(spark, golden, ENTITIES_DIR, top_k=10, plan=plan)
    top = [tuple(x) for x in r.top_entities.orderBy("rank").collect()]
    assert top == EXPECTED_TOP
    stats = {x["entity_type"]: x["n"] for x in r.type_stats.collect()}
    assert stats == {
        "total": 10, "Person": 0, "Organization": 0, "University": 1,
        "Place": 4, "Technology": 0, "ProgrammingLanguage": 5,
    }


def test_golden_processing_stats(spark, golden):
    r = run_analysis(spark, golden, ENTITIES_DIR)
    assert r.processing_stats_row == {
        "feeds_success": 2, "feeds_failed": 1, "posts_success": 4,
        "posts_failed": 1, "posts_filtered": 1, "avg_chars": 39,
    }


def test_golden_report_text(spark, golden):
    text = run_analysis(spark, golden, ENTITIES_DIR, top_k=10).report()
    assert "Feeds descargados exitosamente: 2" in text
    assert "Feeds fallidos: 1" in text
    assert "Largo promedio en posts: 39" in text
    assert "[Type=Place] Stockholm: 2 apariciones" in text
    assert "Entidades totales: 10" in text
    assert "    [ProgrammingLanguage]: 5" in text
    assert "    [Technology]: 0" in text
    lines = text.split("\n")
    assert sum(1 for ln in lines if ln.startswith("[Type=")) == 8
    # types are listed in the fixed report order
    order = [ln.strip() for ln in lines if ln.startswith("    [")]
    assert [o.split("]")[0][1:] for o in order] == [
        "Person", "Organization", "University", "Place", "Technology", "ProgrammingLanguage"
    ]


def test_golden_observed_fetch_metrics(spark, golden):
    r = run_analysis(spark, golden, ENTITIES_DIR)
    assert r.extras["fetch_metrics"] == {"feeds": 3, "feeds_failed": 1, "feeds_unparsed": 1, "posts": 4}


def test_golden_warnings(spark, golden):
    r = run_analysis(spark, golden, ENTITIES_DIR)
    msgs = sorted(x["message"] for x in r.warnings.collect())
    assert any(m.startswith("Warning: Failed to download from 'B'") for m in msgs)
    assert "Warning: Failed to parse JSON from 'C'" in msgs
    checks = {x["check_id"]: (x["ok"], x["n"]) for x in r.quality_checks.collect()}
    assert checks["Q7"] == (False, 1)
    assert checks["Q8"] == (False, 1)
    assert checks["Q5"] == (True, 3)
    assert checks["S6"] == (True, 0)


# --- the reference's end-to-end scenarios, re-run on local files ------------

MANY = [(f"Post {i}", text) for i, text in enumerate([
    "Scala Python Haskell Java Rust Go",
    "Google Apple Microsoft Amazon London Paris",
    "Torvalds Knuth Hopper MIT Stanford",
])]


@pytest.fixture()
def many_subs(tmpdir_path):
    feed = write_json(os.path.join(tmpdir_path, "many.json"), feed_json(MANY))
    return write_json(
        os.path.join(tmpdir_path, "subs.json"),
        [{"name": "one", "url": f"file://{feed}"}, {"name": "two", "url": f"file://{feed}"}],
    )


def _entity_lines(r):
    return [x for x in r.report().split("\n") if x.startswith("[Type=")]


def test_default_top_k_gives_ten_lines(spark, many_subs):
    assert len(_entity_lines(run_analysis(spark, many_subs, ENTITIES_DIR))) == 10


def test_top_k_two(spark, many_subs):
    r = run_analysis(spark, many_subs, ENTITIES_DIR, top_k=2)
    assert len(_entity_lines(r)) == 2
    assert r.warnings.count() == 0
    # a URL listed twice is fetched and counted twice
    assert r.entity_counts.where("entity_name = 'Scala'").first()["n"] == 2


def test_malformed_subscriptions_file(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "bad.json")
    with open(p, "w") as f:
        f.write("no JSON here")
    with pytest.raises(InvalidSubscriptionsFile, match="invalid JSON format"):
        run_analysis(spark, p, ENTITIES_DIR)


def test_missing_subscriptions_file(spark, tmpdir_path):
    with pytest.raises(SubscriptionsNotFound, match="file not found"):
        run_analysis(spark, os.path.join(tmpdir_path, "nope.json"), ENTITIES_DIR)


def test_bad_url(spark, many_subs, tmpdir_path):
    import json

    subs = json.load(open(many_subs)) + [{"name": "gone feed", "url": "file:///no/such/feed.json"}]
    p = write_json(os.path.join(tmpdir_path, "bad_url.json"), subs)
    r = run_analysis(spark, p, ENTITIES_DIR)
    assert "Feeds fallidos: 1" in r.report()
    assert any("Failed to download from 'gone feed'" in x["message"] for x in r.warnings.collect())


def test_missing_fields(spark, many_subs, tmpdir_path):
    import json

    subs = json.load(open(many_subs)) + [{"title": "no name, no url"}]
    p = write_json(os.path.join(tmpdir_path, "fields.json"), subs)
    r = run_analysis(spark, p, ENTITIES_DIR)
    assert r.rejected_subscriptions.count() == 1
    assert any("Skipping malformed subscription" in x["message"] for x in r.warnings.collect())


def test_no_valid_subscriptions(spark, tmpdir_path):
    p = write_json(os.path.join(tmpdir_path, "none.json"), [{"name": "a"}])
    with pytest.raises(NoValidSubscriptions):
        run_analysis(spark, p, ENTITIES_DIR)


def test_missing_entities_dir(spark, many_subs, tmpdir_path):
    with pytest.raises(DictionaryDirNotFound, match="not found"):
        run_analysis(spark, many_subs, os.path.join(tmpdir_path, "nonexistent"))


def test_partial_dictionary(spark, many_subs, tmpdir_path):
    d = os.path.join(tmpdir_path, "partial")
    os.makedirs(d)
    shutil.copy(os.path.join(ENTITIES_DIR, "languages.txt"), d)
    r = run_analysis(spark, many_subs, d)
    missing = sorted(x["file_name"] for x in r.missing_dictionary_files.collect())
    assert missing == ["organizations.txt", "people.txt", "places.txt", "universities.txt"]
    assert {x["entity_type"] for x in r.entity_counts.collect()} == {"ProgrammingLanguage"}


def test_empty_dictionary_dir_gives_zero_total(spark, many_subs, tmpdir_path):
    d = os.path.join(tmpdir_path, "empty")
    os.makedirs(d)
    r = run_analysis(spark, many_subs, d)
    assert r.top_entities.count() == 0
    assert {x["entity_type"]: x["n"] for x in r.type_stats.collect()}["total"] == 0


def test_no_posts_left_after_filter(spark, tmpdir_path):
    feed = write_json(os.path.join(tmpdir_path, "empty.json"), feed_json([("", "x"), ("t", "")]))
    p = write_json(os.path.join(tmpdir_path, "subs.json"), [{"name": "e", "url": f"file://{feed}"}])
    with pytest.raises(NoValidPosts) as e:
        run_analysis(spark, p, ENTITIES_DIR)
    assert e.value.result.processing_stats_row["posts_filtered"] == 2


def test_top_k_must_be_positive(spark, golden):
    with pytest.raises(ValueError):
        run_analysis(spark, golden, ENTITIES_DIR, top_k=0)


GOLDEN_REPORT = """============ ESTADÍSTICAS DE PROCESAMIENTO ============
Feeds descargados exitosamente: 2
Feeds fallidos: 1
Posts descargados exitosamente: 4
Posts fallidos: 1
Posts filtrados (vacíos/nulos): 1
Largo promedio en posts: 39

============ ENTIDADES NOMBRADAS MÁS FRECUENTES ============
[Type=Place] Stockholm: 2 apariciones
[Type=ProgrammingLanguage] Scala: 2 apariciones
[Type=Place] Berkeley: 1 apariciones
[Type=Place] London: 1 apariciones
[Type=ProgrammingLanguage] C++: 1 apariciones
[Type=ProgrammingLanguage] Java: 1 apariciones
[Type=ProgrammingLanguage] JavaScript: 1 apariciones
[Type=University] Berkeley: 1 apariciones

============ ESTADÍSTICAS DE ENTIDADES ============
Entidades totales: 10
Entidades por categoría:
    [Person]: 0
    [Organization]: 0
    [University]: 1
    [Place]: 4
    [Technology]: 0
    [ProgrammingLanguage]: 5"""


def test_golden_report_full_text(spark, golden):
    assert run_analysis(spark, golden, ENTITIES_DIR, top_k=10).report() == GOLDEN_REPORT


def test_analyze_posts_on_landed_posts(spark):
    from feedlens.plans.analysis import analyze_posts
    from feedlens.sources.dictionary import load_dictionary

    posts = spark.createDataFrame(
        [(t, s) for t, s in [("Scala and Java", "I love Scala scala SCALA, in London"),
                             ("Berkeley C++ notes", " "), ("Moved to New York", "Stockholm is nice, javascript too")]],
        "title string, selftext string",
    )
    r = analyze_posts(posts, load_dictionary(spark, ENTITIES_DIR), top_k=10)
    assert [tuple(x) for x in r.top_entities.orderBy("rank").collect()] == EXPECTED_TOP
