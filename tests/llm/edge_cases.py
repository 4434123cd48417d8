from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, source string, kept string, count int"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n)]


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty, blank, very long and repeated texts, exact and near copies;
    ``kept`` and ``count`` clash with names the operators use."""
    rng = random.Random(3)
    base = [words(rng, rng.randint(12, 90)) for _ in range(40)]
    rows = [(i, " ".join(w), f"s{i % 4}", "x", i) for i, w in enumerate(base)]
    rows += [(100 + i, " ".join(base[i]).upper(), "s0", None, None) for i in range(10)]  # equal after folding
    for i in range(20):  # near copies: a few words changed
        w = list(base[i + 10])
        for _ in range(rng.randint(1, 3)):
            w[rng.randrange(len(w))] = "zz" + str(rng.randrange(10**6))
        rows.append((200 + i, " ".join(w), "s1", "y", 1))
    rows += [(300, None, "s2", None, 0), (301, "", None, "", 0), (302, " \t\n ", "s2", "", 0), (None, "a text without an id, of a few words only", "s3", "", 0), (None, None, None, None, None)]
    rows += [(303, " ".join(words(rng, 30_000)), "s3", "", 0), (304, "ü" * 5000, "s3", "", 0), (305, "one two", "s2", "", 0), (306, "ONE two", "s2", "", 0)]
    rows += [rows[0], rows[0], (307, "Ünïcode Texte – mit “Zeichen”\nund Zeilen\nund Zeilen\n", "é", "", 0)]
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
