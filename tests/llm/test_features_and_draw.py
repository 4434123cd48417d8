"""The classifier's statistics one text at a time, and how often the mix takes a document."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlens.llm import mixing, quality_classifier


def plain_features(text: bytes) -> list[float]:
    words = text.split()
    size, n = max(len(text), 1), len(words)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / max(n, 1)
    sd = math.sqrt(max(sum(x * x for x in lengths) / max(n, 1) - mean**2, 0))
    among = lambda members: sum(text.count(bytes([b])) for b in members)
    upper, digits = among(range(65, 91)), among(range(48, 58))
    marks, shouts, symbols = among(b".,;:'\"()-"), among(b"!?"), among(b"#*$%&|<>@~^_=+/\\{}[]`")
    beyond, breaks = among(range(128, 256)), text.count(b"\n")
    others = size - (upper + digits + marks + shouts + symbols + beyond + breaks)
    kinds = Counter(words)
    again = sum(a == b for a, b in zip(words, words[1:]))
    marked = sum(w[-1:] in [bytes([b]) for b in b".,;:'\"()-!?#*$%&|<>@~^_=+/\\{}[]`"] for w in words)
    root = math.sqrt
    return [
        math.log1p(n), math.log1p(mean), math.log1p(sd), math.log1p(max(lengths, default=0)), root(upper / size), root(digits / size), root(marks / size), root(shouts / size),
        root(symbols / size), root(max(others, 0) / size), root(beyond / size), math.log1p(breaks + 1), math.log1p(n / (breaks + 1)), len(kinds) / max(n, 1),
        root(max(kinds.values(), default=0) / max(n, 1)), root(again / max(n, 1)), root(marked / max(n, 1)),
    ]


def test_features_against_one_text_at_a_time():
    import duckdb

    texts = [(r[0] or "").encode() for r in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    texts += [b"", b" \t\n ", b"\n\n", b"A", b"a a a b", "Ünï—“x”!?\n#1 #1".encode(), b"word " * 5000, b"x" * 20_000, b""]
    got = quality_classifier.features(texts)
    assert got.shape == (len(texts), len(quality_classifier.FEATURES))
    assert np.allclose(got, [plain_features(t) for t in texts], atol=1e-6)
    for k in range(0, len(texts), 97):  # a text alone has the same features
        assert np.allclose(quality_classifier.features(texts[k : k + 1])[0], got[k])


@pytest.mark.parametrize("weights, want", [((3.0, 1.0), {0: 1.5, 1: 0.5})])
def test_documents_of_any_size_are_taken_as_often(spark, weights, want):
    """400 sources with the same sizes are 200 draws for each of two targets. Documents of full
    merit have the same expected copies; filling the gap favours short ones, by about 0.08 of a copy
    in the shortest quarter of sources as small as these."""
    sources, per = 400, 40
    rng = np.random.default_rng(12)
    size = [int(x) for x in np.geomspace(50, 400, per)]
    rows = [(s * per + k, f"s{s:03d}", size[k], float(rng.uniform(1e-9, 1 - 1e-9)), s * per + k) for s in range(sources) for k in range(per)]
    docs = mixing.land(spark.createDataFrame(rows, "doc_id bigint, source string, size bigint, u double, tie bigint"), "test-sizes")
    drawn = mixing.copies(docs, mixing.source_targets(docs, weights))
    group = (F.substring("source", 2, 3).cast("int") % 2).alias("half")
    quarter = F.floor((F.col("doc_id") % per) / 10).alias("quarter")
    means = {(r["half"], r["quarter"]): r["m"] for r in drawn.groupBy(group, quarter).agg(F.avg("n_copies").alias("m")).collect()}
    whole = sum(size)
    for half, expected in want.items():
        for q in range(4):
            assert -0.08 < means[half, q] - expected < (0.12 if q == 0 else 0.08), means
    taken = drawn.groupBy("source", "target").agg(F.sum(F.col("size") * F.col("n_copies")).alias("words")).collect()
    assert all(abs(r["target"] - want[int(r["source"][1:]) % 2] * whole) < 1e-6 * whole for r in taken)
    assert max(abs(r["words"] - r["target"]) for r in taken) <= 0.05 * whole
