from __future__ import annotations

import numpy as np
import pytest

from feedlens.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, rank int, leaf string"


def brute(rows: list[tuple], k: int = 5, every: int = 50) -> dict[int, list[tuple[int, float]]]:
    """Each query's nearest ids by the cosine of the original vectors."""
    use = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    sizes = [len(v) for _, v in use]
    dim = min(set(sizes), key=lambda s: (-sizes.count(s), s), default=0)
    use = [(i, v) for i, v in use if len(v) == dim]
    out: dict[int, dict[int, float]] = {}
    for i, v in use:
        if i % every == 0:
            near = out.setdefault(i, {})
            for j, w in use:
                if j != i:
                    s = float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum())))
                    near[j] = max(near.get(j, -2.0), s)
    return {i: sorted(near.items(), key=lambda x: (-x[1], x[0]))[:k] for i, near in out.items()}


def found(df, **how) -> dict[int, list[tuple[int, float]]]:
    out: dict[int, list] = {}
    for r in sorted(neighbours.nearest_neighbours(df, **how).collect(), key=lambda r: (r.query_id, r.rank)):
        near = out.setdefault(r.query_id, [])
        assert r["rank"] == len(near) + 1
        near.append((r.vec_id, r.score))
    return out


def recall(got, want) -> float:
    return sum(len({i for i, _ in want[q]} & {i for i, _ in got.get(q, [])}) for q in want) / sum(map(len, want.values()))


def test_recall_and_scores_on_a_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    want, got = brute([tuple(r) for r in df.collect()]), found(df)
    assert got.keys() == want.keys() and all(len(got[q]) == 5 for q in want)
    assert recall(got, want) >= 0.9
    for q in want:
        exact = dict(want[q])
        assert all(abs(exact[i] - s) < 1e-12 for i, s in got[q] if i in exact)


def test_clustered_rows_need_few_leaves(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(60, 16))
    vectors = centres[rng.integers(0, 60, 8000)] + 0.15 * rng.normal(size=(8000, 16))
    rows = [(i, v.astype(np.float32).astype(float).tolist()) for i, v in enumerate(vectors)]
    seen = []
    calibrate = neighbours.calibrated_visits
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 64)
    monkeypatch.setattr(neighbours, "fitted_tree", lambda v, n, f=neighbours.fitted_tree: f(v, n, leaf_rows=64))
    monkeypatch.setattr(neighbours, "calibrated_visits", lambda *a, **b: seen.append((calibrate(*a, **b), a[2].leaves)) or seen[-1][0])
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert recall(found(df), brute(rows)) >= 0.9
    visits, leaves = seen[0]
    assert leaves >= 60 and visits <= leaves // 4


def test_edge_cases(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).astype(np.float32).astype(float).tolist()) for i in range(120)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)] + [(50, rows[50][1]), (3, rows[9][1])]  # a hot vector, repeated rows, an id with two vectors
    rows += [(150, [0.0] * 4), (200, None), (250, [1.0, None, 2.0, 3.0]), (300, [1.0, float("nan"), 0.0, 0.0]), (350, [float("inf"), 0.0, 0.0, 1.0]), (400, [1.0, 2.0]), (None, [1.0, 0.0, 0.0, 0.0]), (450, [])]
    rows += [(500, [1e30, 2e30, 0.0, 1e30]), (550, [1e-30, 2e-30, 0.0, 1e-30]), (600, rows[7][1]), (650, rows[7][1])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want, got = brute(rows), found(df)
    assert got.keys() == want.keys() == {0, 50, 100, 500, 550, 600, 650, *range(1000, 1030, 50)}
    for q in want:  # one leaf: exact
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)


@pytest.mark.parametrize("rows", [[], [(50, [1.0, 0.0], 1, "x")], [(1, [1.0], 1, "x"), (2, [2.0], 1, "x")], [(50, [1.0, 0.0], 1, "x"), (3, [1.0, 1.0], 1, "x")]])
def test_few_rows(spark, rows):
    assert neighbours.nearest_neighbours(spark.createDataFrame(rows, SCHEMA)).count() == (1 if len(rows) == 2 and rows[0][0] == 50 else 0)


def test_best_bin_first_visits_every_leaf_once():
    units = neighbours.unit_rows(np.random.default_rng(3).normal(size=(3000, 8)))
    tree = neighbours.fit_tree(units, 50)
    leaf = tree.descend(units)
    assert tree.leaves >= 50 and set(leaf.tolist()) == set(range(tree.leaves))
    for u, own in zip(units[:50], leaf[:50], strict=True):
        order = tree.visits(u, tree.leaves)
        assert sorted(order) == list(range(tree.leaves)) and tree.visits(u, 3) == order[:3]
        assert own in order[: tree.leaves // 2]
