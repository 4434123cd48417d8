from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
from feedlens.llm import quality_rules
from feedlens.llm.common import land

from edge_cases import edge, edge_rows, nothing  # noqa: F401  (fixtures)
from test_dedup import brute_components, fold, sets_of
from test_scoring import brute_rules
from test_tokens import check_packing, ids

SF = "/root/testdata/sf0.001"


def brute_keep(text):
    (n, _, symbols, _, repeat), shares = brute_rules(text)
    seen, again, chars = set(), 0, sum(map(len, text.split()))
    for line in text.split("\n"):
        if line.strip() and line in seen:
            again += len("".join(line.split()))
        seen.add(line)
    limits = [quality_rules.NGRAM_LIMITS[k] for k in sorted(quality_rules.NGRAM_LIMITS)]
    return n >= 10 and 100 * repeat <= 20 * n and all(s <= m for s, m in zip(shares, limits, strict=True)) and again <= 0.2 * chars and symbols <= 0.5 * n


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "exact_dedup", "near_dedup", "source_mix", "best_fit_packing"]

    docs = land(stages["quality_rules"](spark, docs, SF), "t")
    good = {i for i, t in rows.items() if brute_keep(t)}
    assert docs.columns == columns and sorted(r.doc_id for r in docs.collect()) == sorted(good) and len(good) < len(rows)

    docs = land(stages["exact_dedup"](spark, docs, SF), "t")
    last = {}
    for i in sorted(good):
        last[fold(rows[i])] = i
    assert docs.columns == columns and sorted(r.doc_id for r in docs.collect()) == sorted(last.values())

    docs = land(stages["near_dedup"](spark, docs, SF), "t")
    parts = brute_components(sets_of([(i, rows[i]) for i in last.values()]))
    assert docs.columns == columns and sorted(r.doc_id for r in docs.collect()) == sorted({c for c in parts.values()})

    before = {r.doc_id: (r.source, len(r.text.split())) for r in docs.collect()}
    docs = land(stages["source_mix"](spark, docs, SF), "t")
    taken = Counter(r.doc_id for r in docs.collect())
    assert docs.columns == columns and set(taken) <= set(before) and max(taken.values()) <= 3
    words = defaultdict(int)
    for i, n in taken.items():
        words[before[i][0]] += n * before[i][1]
    total = sum(n for _, n in before.values())
    assert abs(sum(words.values()) - total) < 0.2 * total  # few and long documents: a coarse bound

    packed = stages["best_fit_packing"](spark, docs, SF).collect()
    assert check_packing(packed, 4096) <= sum(r.length for r in packed) // 4096 + 2
    assert Counter(r.doc_id for r in packed if r.piece == 0) == taken
    assert sum(r.length for r in packed) == sum(len(ids(rows[i], 1)) * n for i, n in taken.items())


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_edge_cases(spark, edge, nothing):
    for docs in (edge, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = land(stage(spark, docs, SF), name)
            assert docs.columns == edge.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()
