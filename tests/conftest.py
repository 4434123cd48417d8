from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from feedlens.session import local_session  # noqa: E402

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
ENTITIES_DIR = os.path.join(FIXTURES, "entities")
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4, app_name="feedlens-tests", driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="feedlens-test-")


def write_json(path: str, obj) -> str:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(obj, f)
    return path


def feed_json(posts: list[tuple]) -> dict:
    return {"data": {"children": [{"data": {"title": t, "selftext": s}} for t, s in posts]}}


# Golden fixture (hand-computed results in the tests): feed A has four posts,
# feed B fails to download, feed C is not JSON.
GOLDEN_POSTS = [
    ("Scala and Java", "I love Scala scala SCALA, in London"),
    ("", "x"),
    ("Berkeley C++ notes", " "),
    ("Moved to New York", "Stockholm is nice, javascript too"),
]


@pytest.fixture()
def golden(tmpdir_path):
    """Subscriptions file + feed files for the golden run; returns the paths."""
    a = write_json(os.path.join(tmpdir_path, "a.json"), feed_json(GOLDEN_POSTS))
    c = os.path.join(tmpdir_path, "c.json")
    with open(c, "w") as f:
        f.write("<html>")
    subs = [
        {"name": "A", "url": f"file://{a}"},
        {"name": "B", "url": f"file://{tmpdir_path}/missing.json"},
        {"name": "C", "url": f"file://{c}"},
    ]
    return write_json(os.path.join(tmpdir_path, "subs.json"), subs)
