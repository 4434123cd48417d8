"""Registered queries: DuckDB oracle agreement, plan equivalence, and the
physical-plan properties the engine relies on at scale."""

from __future__ import annotations

import contextlib
import io
import json
import math
import os
import subprocess
import sys

import duckdb
import pytest
from conftest import SF_MID, SF_SMALL

import __spark_entry__ as entry_mod
from feedlens.operators import detect, posts
from feedlens.plans.catalog import oracle_sql, queries
from feedlens.sources import tables

QUERIES = queries()
ORACLE = oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in tables.TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _bag(df.columns, df.collect()) == _bag(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["rank", "entity_type", "entity_name", "n"]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"feeds_fetched"}))
def test_no_cartesian_join_no_python_deterministic(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # every registered query runs on built-in expressions only
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF"):
        assert python_node not in plan
    # deterministic: a partition recomputed after a lost executor gives the same rows
    for nondeterministic in ("rand(", "randn(", "uuid(", "monotonically_increasing_id", "shuffle(", "current_timestamp"):
        assert nondeterministic not in plan


def test_tokenize_match_and_partial_count_share_one_codegen_stage(spark):
    df = QUERIES["top_entities"](spark, SF_SMALL)
    df.collect()  # codegen stage ids appear in the final adaptive plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    lines = buf.getvalue().split("\n")

    def stage(marker):
        hit = [ln for ln in lines if marker in ln and "*(" in ln]
        assert hit, marker
        return hit[0].split("*(")[1].split(")")[0]

    s = stage("BroadcastHashJoin")
    assert stage("Generate explode") == s
    assert stage("partial_sum") == s


def test_broadcast_plan_keeps_tokens_local(spark):
    plan = _plan(QUERIES["entity_counts"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
    # only the documents columns the query needs are read
    schemas = [ln for ln in plan.split("\n") if ln.strip().startswith("ReadSchema") and "text" in ln]
    assert schemas and all("lang" not in ln and "n_chars" not in ln for ln in schemas)


def test_shuffle_plan_has_no_broadcast_of_dictionary(spark):
    d = detect.prepare_dictionary(tables.literal_dictionary(spark), force="shuffle")
    kept = posts.live_filter(tables.documents_as_posts(tables.table(spark, SF_SMALL, "documents")))
    plan = _plan(detect.entity_counts(kept, d, plan="aggregate_first"))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and "ShuffledHashJoin" not in plan
    # words are counted before the exchange (partial aggregate), then joined
    assert "partial_count" in plan and "hashpartitioning(word" in plan


def test_broadcast_refused_above_size_bound(spark):
    with pytest.raises(ValueError):
        detect.prepare_dictionary(tables.literal_dictionary(spark), max_rows=2, force="broadcast")
    d = detect.prepare_dictionary(tables.literal_dictionary(spark), max_rows=2)
    assert d.broadcast is False and d.rows == 7  # 'New York' cannot match and is dropped


def test_plans_agree_on_large_dictionary(spark):
    kept = posts.live_filter(tables.documents_as_posts(tables.table(spark, SF_MID, "documents")))
    bench = tables.benchmark_dictionary(tables.table(spark, SF_MID, "benchmark"))
    a = detect.entity_counts(kept, detect.prepare_dictionary(bench), plan="broadcast")
    b = detect.entity_counts(kept, detect.prepare_dictionary(bench, force="shuffle"), plan="aggregate_first")
    hits = detect.entity_hits(kept, detect.prepare_dictionary(bench, force="shuffle"))
    c = hits.groupBy("entity_type", "entity_name").count().withColumnRenamed("count", "n")
    ra, rb, rc = (sorted(tuple(r) for r in x.collect()) for x in (a, b, c))
    assert ra == rb == rc and len(ra) > 100


def test_results_do_not_depend_on_shuffle_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = []
        for n in ("1", "7", "32"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(sorted(tuple(r) for r in QUERIES["entity_counts_large_dictionary"](spark, SF_SMALL).collect()))
        assert out[0] == out[1] == out[2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_bench_runs_on_small_data():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"BENCH_SF_DIR": SF_SMALL, "BENCH_CPUS": "2", "BENCH_REPEAT": "1"}
    out = subprocess.run([sys.executable, "bench.py"], cwd=root, env=env, capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    line = json.loads(out.stdout.strip().splitlines()[-1])
    assert line["unit"] == "sec" and line["sf"] == 0.001
    assert {"top_entities", "end_to_end_run"} <= set(line["queries"]) and all(t > 0 for t in line["queries"].values())


def test_filters_reach_the_scan(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "posts")
    rows = [(1, "t", "s"), (2, "", "s"), (3, None, "s"), (4, "t", " \t")]
    spark.createDataFrame(rows, "post_id bigint, title string, selftext string").write.parquet(path)
    for kept, ids in ((posts.live_filter, [1, 4]), (posts.strict_filter, [1])):
        df = kept(spark.read.parquet(path))
        (pushed,) = [ln for ln in _plan(df).split("\n") if "PushedFilters" in ln]
        for f in ("IsNotNull(title)", "IsNotNull(selftext)", "Not(EqualTo(title,))", "Not(EqualTo(selftext,))"):
            assert f in pushed
        assert sorted(r.post_id for r in df.collect()) == ids


def test_nothing_moves_below_tokenising(spark):
    plan = _plan(QUERIES["entity_hits"](spark, SF_SMALL))
    assert "Exchange" not in plan.replace("BroadcastExchange", "")


def test_marked_rows_bite(spark):
    """The rows that trimming, comments, blank bodies and UTF-16 lengths are there for do occur."""
    lines = QUERIES["java_trim_lengths"](spark, SF_SMALL)
    assert lines.where("n_chars <> trimmed_chars").count() > 50
    assert QUERIES["dictionary_clean"](spark, SF_SMALL).count() < 0.7 * lines.count()
    assert QUERIES["posts_strict"](spark, SF_SMALL).count() < QUERIES["posts_live"](spark, SF_SMALL).count()
    assert QUERIES["utf16_lengths"](spark, SF_SMALL).where("n_utf16 <> n_code_points").count() > 50
    checks = {r.check_id: r.n for r in QUERIES["quality_checks"](spark, SF_MID).collect()}
    assert checks["Q2"] > 0 and checks["Q4"] == 1 and checks["Q1"] == 0
    top = QUERIES["top_entities_large_dictionary"](spark, SF_SMALL).collect()
    assert len(top) == 500 and len({r.n for r in top}) < 300  # the limit cuts, and there are ties
