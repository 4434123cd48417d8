from __future__ import annotations

import random

from edge_cases import words
from feedlens.llm import near_dedup


def test_an_id_with_several_texts_joins_their_links(spark):
    rng = random.Random(8)
    a, b, c, d = (words(rng, 60) for _ in range(4))
    text = lambda w, k=0: " ".join([*w[: len(w) - k], *(f"zz{j}" for j in range(k))])
    rows = [
        (5, text(a)), (5, text(b)), (2, text(a, 1)), (7, text(b, 1)), (9, text(b)),  # 5 joins the groups of a and b
        (1, text(c)), (1, text(d)), (1, ""), (8, text(c)), (3, text(d, 1)),  # both texts of 1 are the least of their classes
        (4, text(words(rng, 60))), (4, ""), (6, ""), (10, " "),
    ]
    component = {5: 2, 2: 2, 7: 2, 9: 2, 1: 1, 8: 1, 3: 1, 4: 4, 6: 6, 10: 10}
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for parts in (1, 6):
        got = near_dedup.near_duplicates(df.repartition(parts)).collect()
        want = [(i, max(0, len(t.split()) - 3), component[i], component[i] == i) for i, t in rows]
        assert sorted(map(tuple, got)) == sorted(want)
    assert sorted(r.doc_id for r in near_dedup.drop_near_duplicates(df).collect()) == [1, 1, 1, 2, 4, 4, 6, 10]
