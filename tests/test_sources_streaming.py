"""Scale-oriented sources (JSON Lines subscriptions, landed feed files), the
streaming path, and the command-line front end."""

from __future__ import annotations

import json
import os

import pytest
from conftest import ENTITIES_DIR, GOLDEN_POSTS, feed_json, write_json
from pyspark.sql import functions as F

from feedlens import config
from feedlens.operators import aggregate, detect, posts
from feedlens.sources import dictionary as dictsrc
from feedlens.sources import feeds as feedsrc
from feedlens.sources import subscriptions as subsrc
from feedlens.streaming.feeds import landed_feed_stream, run_available, running_counts


def test_subscription_lines(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "subs.jsonl")
    with open(p, "w") as f:
        f.write('{"name":"a","url":"u1"}\n\n{"name":"b"}\n{"name":"a","url":"u1"}\n')
    s = subsrc.read_subscription_lines(spark, p)
    assert s.valid.count() == 2  # a line listed twice is kept twice
    assert s.rejected.count() == 1


def test_subscription_lines_invalid(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "subs.jsonl")
    with open(p, "w") as f:
        f.write('{"name":"a","url":"u1"}\n[1,2]\n')
    with pytest.raises(subsrc.InvalidSubscriptionsFile):
        subsrc.read_subscription_lines(spark, p)


def test_fetch_file_urls(spark, tmpdir_path):
    a = write_json(os.path.join(tmpdir_path, "a.json"), feed_json(GOLDEN_POSTS))
    subs = spark.createDataFrame(
        [(0, "A", f"file://{a}"), (1, "B", f"file://{tmpdir_path}/none.json"), (2, "C", "not a url")],
        "feed_id bigint, feed_name string, url string",
    )
    got = {r["feed_name"]: r["content"] for r in feedsrc.fetch_feeds(subs, partitions=2, timeout=5).collect()}
    assert json.loads(got["A"])["data"]["children"][0]["data"]["title"] == "Scala and Java"
    assert got["B"] is None and got["C"] is None


def test_land_uses_checkpoint_dir(spark):
    df = spark.range(5)
    path = feedsrc.land_to(df, "probe")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
    assert spark.read.parquet(path).count() == 5


def test_fetch_hands_bodies_on_by_bytes(spark, tmpdir_path):
    """Many large bodies: frames stay near the byte bound, whatever the number of urls."""
    n, size = 40, 200_000
    paths = []
    for i in range(n):
        paths.append(os.path.join(tmpdir_path, f"{i}.txt"))
        with open(paths[-1], "w") as f:
            f.write(str(i % 10) * size)
    import pandas as pd

    fetch = feedsrc._fetcher(5, 60, 4, 1_000_000)
    frames = list(fetch(iter([pd.DataFrame({"feed_id": range(n), "feed_name": "x", "url": [f"file://{p}" for p in paths]})])))
    assert sum(len(f) for f in frames) == n and len(frames) >= n * size // 2_700_000
    assert max(f["content"].str.len().sum() for f in frames) <= 1_000_000 + 8 * size
    assert sorted(pd.concat(frames)["feed_id"]) == list(range(n))


def test_fetch_deadline(tmpdir_path):
    import pandas as pd

    path = os.path.join(tmpdir_path, "big.txt")
    with open(path, "w") as f:
        f.write("x" * 5_000_000)
    (frame,) = feedsrc._fetcher(5, -1, 2, 1_000_000)(iter([pd.DataFrame({"feed_id": [1], "feed_name": ["x"], "url": [f"file://{path}"]})]))
    assert frame["content"].isna().all()


def test_landed_feed_files(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "landed")
    os.makedirs(d)
    write_json(os.path.join(d, "0.json"), feed_json(GOLDEN_POSTS))
    with open(os.path.join(d, "2.json"), "w") as f:
        f.write("<html>")
    subs = spark.createDataFrame(
        [(0, "A", "u0"), (1, "B", "u1"), (2, "C", "u2")], "feed_id bigint, feed_name string, url string"
    )
    feeds = feedsrc.read_landed_feed_files(spark, subs, d)
    parsed = {r["feed_name"]: (r["downloaded"], r["parse_ok"], len(r["posts"])) for r in posts.parse_feeds(feeds).collect()}
    assert parsed == {"A": (True, True, 4), "B": (False, False, 0), "C": (True, False, 0)}


def _landed_golden(spark):
    feeds = spark.createDataFrame(
        [
            (0, "A", "u0", json.dumps(feed_json(GOLDEN_POSTS))),
            (1, "B", "u1", None),
            (2, "C", "u2", "<html>"),
        ],
        "feed_id bigint, feed_name string, url string, content string",
    )
    return feedsrc.land_to(feeds, "stream-test-feeds")


def _paths(spark):
    return config.scratch_path(spark, "stream-out"), config.scratch_path(spark, "stream-checkpoint")


@pytest.mark.parametrize("force", [None, "shuffle"])
def test_streaming_counts_equal_batch(spark, force):
    landed = _landed_golden(spark)
    d = detect.prepare_dictionary(dictsrc.load_dictionary(spark, ENTITIES_DIR), force=force)  # any size
    streamed = run_available(landed_feed_stream(spark, landed), d, *_paths(spark))
    batch_posts = posts.live_filter(posts.explode_posts(posts.parse_feeds(spark.read.parquet(landed))))
    batch = sorted(tuple(r) for r in detect.entity_counts(batch_posts, d).collect())
    assert sorted(tuple(r) for r in streamed.collect()) == batch
    top = aggregate.top_entities(streamed, 2).collect()
    assert [(r["entity_name"], r["n"]) for r in top] == [("Stockholm", 2), ("Scala", 2)]


def test_stream_goes_on_from_its_checkpoint(spark):
    landed = _landed_golden(spark)
    d = detect.prepare_dictionary(dictsrc.load_dictionary(spark, ENTITIES_DIR))
    out, checkpoint = _paths(spark)
    run = lambda: {tuple(r)[:2]: r["n"] for r in run_available(landed_feed_stream(spark, landed, 1), d, out, checkpoint).collect()}
    first = run()
    assert run() == first  # nothing new: nothing counted again
    spark.read.parquet(landed).write.mode("append").parquet(landed + "-more")
    spark.read.parquet(landed + "-more").write.mode("append").parquet(landed)
    assert run() == {k: 2 * n for k, n in first.items()}


def test_stream_over_an_empty_directory(spark, tmpdir_path):
    d = detect.prepare_dictionary(dictsrc.load_dictionary(spark, ENTITIES_DIR))
    out, checkpoint = _paths(spark)
    assert run_available(landed_feed_stream(spark, tmpdir_path), d, out, checkpoint).collect() == []
    assert running_counts(spark, out).count() == 0


def test_cli_main(spark, golden, capsys):
    from feedlens.__main__ import main

    rc = main(["--subscription-file", golden, "--entities-dir", ENTITIES_DIR, "--top-k", "3"], spark=spark)
    out = capsys.readouterr().out
    assert rc == 0
    assert out.count("[Type=") == 3 and "Entidades totales: 10" in out
    assert "Warning: Failed to download from 'B'" in out and "Warning: Failed to parse JSON from 'C'" in out


def test_cli_error_line(spark, tmpdir_path, capsys):
    from feedlens.__main__ import main

    rc = main(["--subscription-file", os.path.join(tmpdir_path, "x.json"), "--entities-dir", ENTITIES_DIR], spark=spark)
    assert rc == 1 and "Error: Could not load" in capsys.readouterr().out


def test_feed_posts_keep_json_text_exactly(spark):
    text = 'tab\there "quoted" \\ back é \U0001F600   end'
    df = spark.createDataFrame(
        [(0, "A", "u", json.dumps(feed_json([(text, text)])))], "feed_id bigint, feed_name string, url string, content string"
    )
    p = posts.explode_posts(posts.parse_feeds(df)).first()
    assert p["title"] == text and p["selftext"] == text
    assert df.select(F.col("content").isNotNull()).first()[0]


def test_post_lines_rules(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "dump.jsonl")
    with open(p, "w") as f:
        f.write(
            '{"title":"a","selftext":"b","score":3}\n'
            '{"title":"a"}\n'
            '{"title":"a","selftext":null}\n'
            '{"title":"a","selftext":{"x":1}}\n'
            "not json\n"
            '{"title":7,"selftext":"s"}\n'
        )
    rows = [(r["line_ok"], r["title"], r["selftext"]) for r in feedsrc.read_post_lines(spark, p).collect()]
    assert rows == [
        (True, "a", "b"), (False, None, None), (True, "a", None),
        (False, None, None), (False, None, None), (True, "7", "s"),
    ]
    kept = posts.live_filter(feedsrc.read_post_lines(spark, p).where("line_ok"))
    assert kept.count() == 2


def test_cli_partial_dictionary_warns(spark, golden, tmpdir_path, capsys):
    import shutil

    from feedlens.__main__ import main

    d = os.path.join(tmpdir_path, "partial")
    os.makedirs(d)
    shutil.copy(os.path.join(ENTITIES_DIR, "places.txt"), d)
    rc = main(["--subscription-file", golden, "--entities-dir", d], spark=spark)
    out = capsys.readouterr().out
    assert rc == 0
    assert "Warning: Could not load dictionary file 'people.txt'" in out
    assert "[Type=Place] Stockholm: 2 apariciones" in out and "ProgrammingLanguage] Scala" not in out


def test_cli_as_a_process(golden):
    """``python -m feedlens`` as a user runs it (own JVM, own session)."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run(
        [sys.executable, "-m", "feedlens", "--subscription-file", golden, "--entities-dir", ENTITIES_DIR,
         "--top-k", "2", "--master", "local[2]"],
        cwd=root, capture_output=True, text=True, timeout=600,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    lines = out.stdout.splitlines()
    assert [ln for ln in lines if ln.startswith("[Type=")] == [
        "[Type=Place] Stockholm: 2 apariciones",
        "[Type=ProgrammingLanguage] Scala: 2 apariciones",
    ]
    assert "Feeds fallidos: 1" in lines


def test_fetch_needs_no_package_on_workers(tmpdir_path):
    """Python workers start without ``feedlens`` on their path (cwd elsewhere,
    package only on the driver's sys.path): the fetch function must be shipped
    by value."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    feed = write_json(os.path.join(tmpdir_path, "a.json"), feed_json(GOLDEN_POSTS))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from feedlens.session import local_session
from feedlens.sources.feeds import fetch_feeds
spark = local_session(cores=2)
subs = spark.createDataFrame([(0, "A", "file://{feed}")], "feed_id bigint, feed_name string, url string")
print("LEN", len(fetch_feeds(subs, partitions=1).first()["content"]))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmpdir_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    assert "LEN " in out.stdout and int(out.stdout.split("LEN ")[1].split()[0]) > 50


def test_run_from_lines_and_landed_feeds(spark, tmpdir_path):
    """Subscriptions as JSON Lines and feeds landed as files: no fetch at all."""
    from feedlens.plans.analysis import run_analysis

    subs = os.path.join(tmpdir_path, "subs.jsonl")
    with open(subs, "w") as f:
        f.write('{"name":"A","url":"u1"}\n{"name":"B","url":"u2"}\n{"name":"C"}\n')
    ids = {r.feed_name: r.feed_id for r in subsrc.read_subscription_lines(spark, subs).valid.collect()}
    landed = os.path.join(tmpdir_path, "landed")
    os.makedirs(landed)
    write_json(os.path.join(landed, f"{ids['A']}.json"), feed_json(GOLDEN_POSTS))
    result = run_analysis(spark, subs, ENTITIES_DIR, subscription_lines=True, landed_feeds=landed)
    assert result.processing_stats_row["feeds_success"] == 1 and result.processing_stats_row["feeds_failed"] == 1
    assert result.rejected_subscriptions.count() == 1
    assert {r.entity_name: r.n for r in result.entity_counts.collect()}["Scala"] == 2


def test_two_subscription_files_do_not_mix(spark, tmpdir_path):
    from feedlens.plans.analysis import run_analysis

    subs, feeds = os.path.join(tmpdir_path, "subs"), os.path.join(tmpdir_path, "feeds")
    os.makedirs(subs)
    os.makedirs(feeds)
    for name in ("x", "y"):
        url = "file://" + write_json(os.path.join(feeds, f"{name}.json"), feed_json([(name, "Scala")]))
        write_json(os.path.join(subs, f"{name}.json"), [{"name": name, "url": url}])
    result = run_analysis(spark, subs, ENTITIES_DIR)
    assert sorted((r.feed_name, r.title) for r in result.posts.collect()) == [("x", "x"), ("y", "y")]


def test_scratch_needs_a_shared_folder(monkeypatch):
    from feedlens import session

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(RuntimeError):
        config.scratch_path(Session(), "x")
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
    Session.conf = Conf({"spark.master": "spark://host:7077", "spark.checkpoint.dir": "hdfs://x/y"})
    assert session.ensure_checkpoint_dir(Session()) == "hdfs://x/y"
