"""Numbers published in FIXTURES.md §4 for the shared tables (literal
dictionary, title = first line, live filter), reproduced end to end."""

from __future__ import annotations

import pytest

from feedlens.plans.catalog import queries

Q = queries()


@pytest.mark.parametrize(
    "sf, top3, posts, dropped",
    [
        ("0.01", [("Place", "In", 1358), ("Person", "The", 933), ("Person", "of", 693)], 1000, 69),
        ("0.1", [("Place", "In", 14344), ("Person", "The", 8784), ("University", "in", 7172)], 10000, 794),
    ],
)
def test_top3_and_post_counts(spark, sf, top3, posts, dropped):
    d = f"/root/testdata/sf{sf}"
    got = [(r["entity_type"], r["entity_name"], r["n"]) for r in Q["top_entities"](spark, d).orderBy("rank").collect()]
    assert got[:3] == top3
    pc = Q["post_counts"](spark, d).first()
    assert (pc["posts_total"], pc["posts_dropped"]) == (posts, dropped)


def test_by_type_sf001(spark):
    st = {r["entity_type"]: r["n"] for r in Q["type_stats_zero_filled"](spark, "/root/testdata/sf0.01").collect()}
    assert st == {
        "total": 3754, "Person": 1626, "University": 679, "Organization": 0,
        "Place": 1358, "ProgrammingLanguage": 91, "Technology": 0,
    }
