from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from edge_cases import edge, edge_rows, nothing  # noqa: F401  (fixtures)
from feedlens.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows) -> dict[str, int]:
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def brute(words: dict[str, int]) -> set[tuple]:
    """Near words by deletions: two words are near if one is a deletion of the other, or both lose a code point at the same place."""
    lost: dict[tuple[str, int], set[str]] = {}
    for w in words:
        for k in range(len(w)):
            lost.setdefault((w[:k] + w[k + 1 :], k), set()).add(w)
    near: dict[str, set[str]] = {w: set() for w in words}
    for (short, _), group in lost.items():
        for w in group:
            near[w] |= group - {w}
            if short in words:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def found(df) -> list[tuple]:
    return [tuple(r) for r in spelling.spelling_variants(df).collect()]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got, want = found(docs), brute(brute_words([tuple(r) for r in docs.collect()]))
    assert len(got) == len(want) and set(got) == want
    assert sum(f is not None for _, f, *_ in want) > 100


def test_edits_at_every_place_and_long_words(spark):
    rng = random.Random(4)
    words: dict[str, int] = {}
    for base in ("banana", "aaaaaa", "aaaaaaaaaaaaaaaa", "überflüßig", "abcdefghijklmnopqrstuvwxyz" * 5, "xy" * 300, "é" * 70):
        words[base] = 3000
        for _ in range(40):
            k, c = rng.randrange(len(base) + 1), rng.choice("abxyé")
            for w in (base[:k] + c + base[k:], base[:k] + base[k + 1 :], base[:k] + c + base[k + 1 :]):
                if len(w) >= 6:
                    words.setdefault(w, rng.randint(5, 800))
    landed = spelling.land(spark.createDataFrame([(i, w, n) for i, (w, n) in enumerate(words.items())], "id bigint, word string, n bigint"), "test-words")
    got = [tuple(r) for r in spelling.variant_groups(landed).collect()]
    assert len(got) == len(words) and set(got) == brute(words)


def test_forms_follow_to_the_last(spark):
    words = {"abcdef": 5, "abcdeg": 25, "abcdhg": 125, "abcihg": 625, "abjihg": 3125, "kbjihg": 15625, "zzzzzz": 9}
    landed = spelling.land(spark.createDataFrame([(i, w, n) for i, (w, n) in enumerate(words.items())], "id bigint, word string, n bigint"), "test-words")
    got = {r.word: r for r in spelling.variant_groups(landed).collect()}
    assert all(r.root == ("zzzzzz" if w == "zzzzzz" else "kbjihg") for w, r in got.items())
    assert got["abcdef"].form == "abcdeg" and got["kbjihg"].form is None and got["zzzzzz"].n_near == 0


def test_hot_nodes_are_spread(spark):
    rng = random.Random(6)
    words = {"aaaaaa" + "".join(rng.choice("ab") for _ in range(7)): rng.randint(5, 90) for _ in range(200)}
    landed = spelling.land(spark.createDataFrame([(i, w, n) for i, (w, n) in enumerate(words.items())], "id bigint, word string, n bigint"), "test-words")
    edges = spelling.land(landed.select("id", "word").mapInArrow(spelling.edges_of, spelling.EDGE_SCHEMA).distinct(), "test-edges")
    states = spelling.land(landed.select("id", "word").mapInArrow(spelling.states_of, spelling.STATE_SCHEMA), "test-states")
    rows = lambda least: Counter((r.id, r.node, r.child) for r in spelling.spread_join(states, states.count(), edges, ["node"], least).collect())
    assert rows(20) == rows(10**9)


def test_edge_cases(spark, edge, edge_rows):
    assert set(found(edge)) == brute(brute_words([r[:2] for r in edge_rows]))
    more = [(i, "Tëst×÷ALPHA alphaa alphab ALPHAA " * 3, "s", "", 0) for i in range(400)] + [(None, "alphaa", None, None, None)] * 7
    df = edge.union(spark.createDataFrame(more, edge.schema))
    got = found(df)
    want = brute(brute_words([r[:2] for r in edge_rows + more]))
    assert len(got) == len(want) and set(got) == want


def test_no_rows(nothing):
    assert found(nothing) == []


@pytest.mark.parametrize("left", [0, 1, 7, 8, 9, 63, 64, 72, 512, 4096 + 64])
def test_edge_widths(left):
    now, steps = left, 0
    while now:
        width = int(spelling.widths(np.array([now]))[0])
        assert now % width == 0 and (now % (8 * width) != 0 or width * 8 > now or now % (8 * width))
        now, steps = now - width, steps + 1
    assert steps <= 7 * 5
