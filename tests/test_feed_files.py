"""Feed files are written by the tasks that make them: one file a feed, whatever ids they share."""

from __future__ import annotations

import os

import pyarrow as pa

from feedlens import config
from feedlens.operators import posts
from feedlens.sources import feeds as feedsrc
from feedlens.sources import tables

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows(*pairs):
    return [(i, f"title {i}\nbody {i}", "en", source, 10) for i, source in pairs]


def test_one_file_for_each_feed_and_no_folder_of_its_own(spark):
    docs = spark.createDataFrame(rows(*((i, f"src{j}") for i in range(0, 3000, 50) for j in (0, 1, 3))), DOCS)
    path = config.scratch_path(spark, "feed-files")
    subs = tables.write_feed_files(docs, path).collect()
    files = [os.path.join(d, f) for d, _, found in os.walk(f"{path}/feeds") for f in found]
    folders = [d for d, _, _ in os.walk(f"{path}/feeds")]
    there = sorted(s.url for s in subs if not s.url.startswith("file:///missing/"))
    assert len(subs) == 90 and len(there) == 60
    assert there == sorted(f"file://{f}" for f in files)
    assert len(folders) <= 1 + 16**tables.FEED_FOLDER_DIGITS


def test_feeds_that_share_an_id_stay_apart(spark):
    docs = spark.createDataFrame(rows((7, "src0"), (7, "src1"), (7, "src2"), (7, "src3"), (8, "src1"), (None, "src0")), DOCS).repartition(4)
    subs = tables.write_feed_files(docs, config.scratch_path(spark, "feed-files"))
    parsed = posts.parse_feeds(feedsrc.fetch_feeds(subs))
    got = sorted((r.feed_name, r.feed_id, r.downloaded, len(r.posts or [])) for r in parsed.collect() if r.feed_id is not None)
    assert got == [("src0/0", 7, True, 1), ("src1/0", 7, True, 2), ("src2/0", 7, True, 1), ("src3/0", 7, False, 0)]
    alone = [(r.url, r.downloaded) for r in parsed.where("feed_id is null").collect()]
    assert alone == [(None, False)]


def test_a_repeated_attempt_leaves_the_same_files(tmp_path):
    batch = pa.RecordBatch.from_pydict({"feed_id": [1, 2, None], "feed_name": ["a/0", "b/0", "c"], "content": ["é", None, "x"]})
    write = tables.feed_file_writer(f"{tmp_path}/my feeds")
    first, second = ([b.column(2).to_pylist() for b in write([batch])] for _ in range(2))
    assert first == second and first[0][1:] == ["file:///missing/2", None]
    files = [p for p in (tmp_path / "my feeds").rglob("*") if p.is_file()]
    assert [p.as_uri() for p in files] == first[0][:1]
    assert files[0].read_text(encoding="utf-8") == "é\n"
